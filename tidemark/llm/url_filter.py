"""URL filter: rules on host and path, and gradient-boosted trees on lexical features where no rule fits.

DataFrame and ML-pipeline functions only. Labels for the trees come from the rules where one fits and otherwise from the
URLs: a host with a word of the seed list among its parts is to be blocked, other hosts are to be allowed. Neither rules
nor seed words are features, so the trees judge by shape: lengths, depth, digits, hyphens, entropy, parameters, and
statistics of the host's suffix over all pages; the share of blocked pages of a suffix leaves out the page's own fold of
hosts, so that no page's label is in its feature. The trees are fitted on a bounded sample of distinct labelled URLs, the
first of each label by a hash of the URL.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common

# (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SEEDS = ("ad", "ads", "adult", "bet", "bets", "bingo", "casino", "cheap", "click", "loan", "loans", "malware", "pharma", "phish", "pills",
         "poker", "porn", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "xxx")
SAMPLE = 10_000   # labelled URLs of each label the trees are fitted on, at most
TREES, DEPTH = 20, 3
FOLDS = 5         # of hosts, for the share of a suffix's pages that are blocked
FEATURES = ["f_length", "f_host_length", "f_labels", "f_longest_label", "f_depth", "f_digits", "f_host_digits", "f_hyphens", "f_entropy",
            "f_host_entropy", "f_params", "f_fragment", "f_suffix_pages", "f_suffix_blocked"]
INNER = ["f_vector", "f_label", "f_suffix", "f_fold", "f_pages", "f_blocked", "f_fold_pages", "f_fold_blocked", "f_probability", "f_raw", "f_prediction"]
OUTPUTS = ["host", "path", "rule", "verdict", "block_score"]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits host and path, null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, host + path).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def entropy(c: Column) -> Column:
    """Bits for each character of a text."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    share = lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / F.length(c)
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, x: acc - share(x) * F.log2(share(x)))


def share_of(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, "")) / F.greatest(F.lit(1), F.length(c))


def seeded(seeds: tuple[str, ...]) -> Column:
    """1 where a part of the host's labels is a seed word."""
    return F.arrays_overlap(F.split("host", r"[.\-_0-9]+"), F.array(*map(F.lit, seeds))).cast("int")


def featured(pages: DataFrame, url: str, seeds: tuple[str, ...], rules: list[tuple[str, str, str]]) -> DataFrame:
    """Pages with host, path, label and features; suffix statistics are over all of them."""
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    rows = pages.withColumns({"host": host_of(F.col(f"`{url}`")), "path": path_of(F.col(f"`{url}`"))}).withColumn(
        "f_label", F.coalesce((matched(rules)[1] == "block").cast("int"), seeded(seeds)))
    rows = rows.withColumns({
        "f_suffix": F.substring_index("host", ".", -2), "f_fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"),
        "f_length": F.length(u), "f_host_length": F.length("host"), "f_labels": F.size(labels),
        "f_longest_label": F.array_max(F.transform(labels, F.length)),
        "f_depth": F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit(""))),
        "f_digits": share_of(u, "[^0-9]"), "f_host_digits": share_of(F.col("host"), "[^0-9]"),
        "f_hyphens": F.length(F.regexp_replace("host", "[^-_]", "")), "f_entropy": entropy(u), "f_host_entropy": entropy(F.col("host")),
        "f_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), "f_fragment": F.instr(u, "#").cast("boolean").cast("int")})
    by_fold = lambda c: F.array(*[F.sum(F.when(F.col("f_fold") == k, c).otherwise(0)) for k in range(FOLDS)])
    suffixes = common.staged(rows.groupBy("f_suffix").agg(
        F.log(F.count(F.lit(1)).cast("double")).alias("f_suffix_pages"), F.count(F.lit(1)).alias("f_pages"), F.sum("f_label").alias("f_blocked"),
        by_fold(F.lit(1)).alias("f_fold_pages"), by_fold(F.col("f_label")).alias("f_fold_blocked")), "url-suffixes")
    others = lambda total, own: F.col(total) - F.get(own, F.col("f_fold"))
    share = (others("f_blocked", "f_fold_blocked") + 1) / (others("f_pages", "f_fold_pages") + 2)
    return rows.join(suffixes, "f_suffix").withColumn("f_suffix_blocked", share).drop(
        "f_suffix", "f_fold", "f_pages", "f_blocked", "f_fold_pages", "f_fold_blocked")


def fitted(rows: DataFrame, url: str, sample: int):
    """The trees, or the one label there is; None without labelled rows."""
    order = [F.md5(F.col(f"`{url}`")), F.col(f"`{url}`")]
    distinct = rows.where(F.col(f"`{url}`").isNotNull()).select(F.col(f"`{url}`"), "f_label", *FEATURES).dropDuplicates([url])
    ranked = [distinct.where(F.col("f_label") == k).orderBy(*order).limit(sample) for k in (0, 1)]
    chosen = common.staged(ranked[0].union(ranked[1]).select(F.col("f_label").cast("double").alias("label"), *FEATURES), "url-sample")
    kinds = [r[0] for r in chosen.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else None
    return GBTClassifier(featuresCol="f_vector", maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.2, seed=7).fit(
        VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(chosen).coalesce(4))


def filter_urls(pages: DataFrame, url_column: str = "url", rules: list[tuple[str, str, str]] | None = None,
                seeds: tuple[str, ...] = SEEDS, sample: int = SAMPLE) -> DataFrame:
    """Rows of `pages` with host, path, rule, verdict and block_score (the trees' probability, also where a rule fits).

    A null URL or one without :// has an empty host and path, fits no rule and is judged by the trees. Where all
    labelled URLs have one label, that is the verdict; without any, URLs are allowed. Repeated rows get equal verdicts.
    Columns of `pages` named like an output give way to it.
    """
    common.tune(pages.sparkSession)
    pages = common.without(pages, *OUTPUTS, *INNER, *FEATURES)
    rules = RULES if rules is None else rules
    rows = featured(pages, url_column, seeds, rules)
    model = fitted(rows, url_column, sample)
    if model is None or isinstance(model, float):
        rows = rows.withColumn("block_score", F.lit(float(model or 0.0)))
    else:
        scored = model.setProbabilityCol("f_probability").setRawPredictionCol("f_raw").setPredictionCol("f_prediction").transform(
            VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(rows))
        rows = scored.withColumn("block_score", vector_to_array("f_probability")[1])
    text, verdict = matched(rules)
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return rows.withColumn("rule", text).withColumn("verdict", F.coalesce(verdict, method)).select(
        *[F.col(f"`{c}`") for c in pages.columns], *OUTPUTS)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(common.read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", *OUTPUTS)


QUERIES = {"op10_url_filter": op10_url_filter}
ORACLE: dict[str, str] = {}
