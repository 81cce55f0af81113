"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's rate is the mean number of times each of its documents is to appear. A document's count is a Poisson
number of that mean, found by inverting the distribution at a uniform number hashed from seed, id and text; it is
repeated that often, and all copies are dealt out and sorted by a hash of their own. Everything depends on the rows
alone: a task run again after a lost executor makes the same rows, and a document's count does not depend on others
beyond its source's size.

Means above STEP are drawn as sums of independent parts of at most STEP, so no probability underflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common

TEMPERATURE = 0.7   # weight of a source: its size to this power
SEED = "mix-1"
STEP = 32.0         # largest mean inverted at once


def rates(df: DataFrame, source: str, text: str, weights: dict[str, float] | None, temperature: float, epochs: float) -> DataFrame:
    """(key, rate) of every source; the size of a document is its code points and one for its end."""
    sizes = df.groupBy(source_key(source).alias("key"), F.col(f"`{source}`").alias("name")).agg(
        F.sum(F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))) + 1).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(temperature))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("name")), F.lit(0.0))
    weighed = common.staged(sizes.select("key", "size", weight.alias("weight")), "mix-weights")
    sizes, weights = weighed.agg(F.coalesce(F.sum("size"), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    rate = epochs * F.lit(sizes) * F.col("weight") / F.lit(weights) / F.col("size") if weights > 0 else F.lit(0.0)
    return weighed.select("key", rate.alias("rate"))


def source_key(source: str) -> Column:
    """A key that tells a null source from every text."""
    return F.when(F.col(f"`{source}`").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")))


def poisson_table(rates: DataFrame) -> DataFrame:
    """(key, parts, below): below[k] is the probability of k or fewer for a mean of rate / parts."""
    mean = F.col("rate") / F.col("parts")
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("below"))
    merged = F.aggregate(F.sequence(F.lit(1), last), start, lambda acc, k: F.struct(
        (acc["p"] * mean / k).alias("p"),
        F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + acc["p"] * mean / k)).alias("below")))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    return rates.withColumn("parts", parts).select("key", "parts", merged["below"].alias("below"))


def hashed(*parts: Column, digits: int) -> Column:
    """The first hex digits of an MD5 as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits), 16, 10).cast("long")


def mix_sources(df: DataFrame, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text",
                weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0,
                seed: str = SEED) -> DataFrame:
    """Rows of `df` repeated to target weights, with n_copies, copy (from 1) and shuffle_key, in global random order.

    `weights` names a weight for each source (others get none); without it a source weighs its size to the power
    `temperature`. The expected size of the output is `epochs` times that of the input. A null source is a source of
    its own, null and empty texts have size one, rows equal in id and text get equal counts. Columns of `df` named
    like an output give way to it.
    """
    common.tune(df.sparkSession)
    df = common.without(df, "n_copies", "copy", "shuffle_key")
    table = common.staged(poisson_table(rates(df, source_column, text_column, weights, temperature, epochs)), "mix-table").select(
        F.col("key").alias("_mix_key"), F.col("parts").alias("_mix_parts"), F.col("below").alias("_mix_below"))
    # the table is read from a written one: Spark knows its size and broadcasts it only if that is small
    own = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("null")),
                      F.md5(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))))
    joined = df.join(table, source_key(source_column) == F.col("_mix_key")).withColumn("_mix_own", F.md5(own))
    uniform = lambda part: (hashed(F.col("_mix_own"), part.cast("string"), digits=12) + 0.5) / float(1 << 48)
    below = lambda part: F.size(F.filter("_mix_below", lambda p: p < uniform(part)))
    count = F.aggregate(F.sequence(F.lit(1), F.col("_mix_parts")), F.lit(0), lambda n, part: n + below(part))
    counted = joined.withColumn("_mix_u", uniform(F.lit(1))).withColumn(
        "n_copies", F.when(F.col("_mix_parts") == 1, F.size(F.filter("_mix_below", lambda p: p < F.col("_mix_u")))).otherwise(count).cast("long"))
    copies = (counted.drop("_mix_below", "_mix_parts", "_mix_key", "_mix_u").where("n_copies > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies")))))
    keyed = copies.withColumn("shuffle_key", hashed(F.col("_mix_own"), F.lit("at"), F.col("copy").cast("string"), digits=15)).drop("_mix_own")
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(common.read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


QUERIES = {"op5_mix_sources": op5_mix_sources}
ORACLE = {"op5_mix_sources": f"""
WITH RECURSIVE sizes AS (
    SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size FROM documents GROUP BY source),
rated AS (
    SELECT source, sum(size) OVER () * pow(size, {TEMPERATURE}) / sum(pow(size, {TEMPERATURE})) OVER () / size AS rate FROM sizes),
parted AS (SELECT source, greatest(1, CAST(ceil(rate / {STEP}) AS INT)) AS parts, rate / greatest(1, CAST(ceil(rate / {STEP}) AS INT)) AS mean FROM rated),
dist AS (
    SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS below FROM parted
    UNION ALL
    SELECT source, parts, mean, k + 1, p * mean / (k + 1), below + p * mean / (k + 1) FROM dist
    WHERE k < ceil(mean + 12 * sqrt(mean) + 20)),
lists AS (SELECT source, parts, list(below ORDER BY k) AS below FROM dist GROUP BY source, parts),
own AS (
    SELECT d.*, md5('{SEED}' || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))) AS own FROM documents d),
parts AS (
    SELECT o.*, l.below, unnest(range(1, l.parts + 1)) AS part FROM own o JOIN lists l ON o.source IS NOT DISTINCT FROM l.source),
drawn AS (
    SELECT doc_id, text, lang, source, n_chars, own,
           CAST(len(list_filter(below, lambda p: p < (CAST('0x' || substring(md5(own || '|' || CAST(part AS VARCHAR)), 1, 12) AS BIGINT) + 0.5)
                                                 / 281474976710656.0)) AS BIGINT) AS n
    FROM parts),
counted AS (SELECT doc_id, text, lang, source, n_chars, own, CAST(sum(n) AS BIGINT) AS n_copies FROM drawn GROUP BY ALL),
copied AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy,
       CAST('0x' || substring(md5(own || '|at|' || CAST(copy AS VARCHAR)), 1, 15) AS BIGINT) AS shuffle_key
FROM copied"""}
