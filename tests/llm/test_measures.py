"""Token entropy and bands of the quality rules by brute force; the URL trees on hosts they have not seen."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.llm import quality_rules, url_filter

WORDS = "the of river and lantern walked slowly 1987 under zebra crossing quantum ütf".split()


def window_entropy(tokens):
    if len(tokens) < 2:
        return 0.0
    bits = -sum(n / len(tokens) * math.log2(n / len(tokens)) for n in map(tokens.count, set(tokens)))
    return bits / max(1.0, math.log2(len(tokens)))


def test_entropy_is_that_of_all_windows_the_last_one_ending_with_the_text():
    r, size = np.random.default_rng(3), quality_rules.WINDOW
    texts = ["", "one", "same " * 300] + [" ".join(r.choice(WORDS, n)) for n in (5, 40, 63, 64, 65, 100, 127, 128, 129, 1000)]
    m = quality_rules.Measurer(None)
    got = m.measure([t.encode() for t in texts])
    for text, entropy, n in zip(texts, got["token_entropy"], got["n_tokens"]):
        words = [m.words[w] for w in text.encode().split()]
        tokens = [t for w in words for t in m.tokens.values[m.ends.values[w]:m.ends.values[w + 1]].tolist()]
        assert len(tokens) == n
        windows = [tokens[i:i + size] for i in range(0, len(tokens) - size + 1, size)] or ([tokens] if tokens else [])
        if len(tokens) > size and len(tokens) % size:
            windows.append(tokens[-size:])
        assert entropy == pytest.approx(np.mean([window_entropy(w) for w in windows]) if windows else 0.0, abs=1e-9)


def test_bands_are_exact_over_thousandths(spark):
    r = np.random.default_rng(4)
    rows = [(k, "en" if k % 3 else None, 100, 0, 100 + k % 2, float(r.normal(4, 0.5)), float(r.uniform(0, 0.3)), float(r.normal(0.9, 0.03))) for k in range(400)]
    names = "doc_id lang n_words n_repeat_words n_tokens chars_per_token byte_fallback_share token_entropy".split()
    got = {x.doc_id: x.kept for x in quality_rules.judged(spark.createDataFrame(rows, names)).collect()}

    def line(values, low):
        mid, high = np.percentile(np.round(values, 3), [50, 90])
        reach = quality_rules.BAND * max(high - mid, quality_rules.LEAST_SPREAD * mid)
        return mid - reach if low else max(mid + reach, quality_rules.FALLBACK_SHARE)

    for lang in ("en", None):
        own = [x for x in rows if x[1] == lang]
        chars, fallback, entropy = (line([x[k] for x in own], low) for k, low in ((5, True), (6, False), (7, True)))
        assert all(got[x[0]] == (x[5] >= chars and x[7] >= entropy and x[6] <= fallback) for x in own)


def test_trees_judge_unseen_hosts_by_several_features(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    rows = url_filter.featured(pages, "url", url_filter.SEEDS, url_filter.RULES)
    unseen = F.pmod(F.xxhash64("host", F.lit("unseen")), F.lit(4)) == 0
    model = url_filter.fitted(rows.where(~unseen), "url", 5_000)
    scored = model.transform(VectorAssembler(inputCols=url_filter.FEATURES, outputCol="f_vector").transform(rows.where(unseen)))
    auc = BinaryClassificationEvaluator(labelCol="f_label", rawPredictionCol=model.getRawPredictionCol()).evaluate(scored)
    print("unseen hosts AUC", auc)
    assert auc > 0.7 and (model.featureImportances.toArray() > 0.01).sum() >= 3


def test_a_repeated_url_does_not_fill_the_sample_nor_label_its_own_feature(spark):
    urls = ["http://casino-win.one.test/a"] * 300 + [f"http://casino-{k}.two.test/{k}" for k in range(60)] + [f"http://news{k}.three.test/{k}" for k in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.featured(pages, "url", url_filter.SEEDS, [])
    lone = rows.where("host = 'casino-win.one.test'").select("f_suffix_blocked").distinct().collect()
    assert [r[0] for r in lone] == [0.5]  # all pages of the suffix are of its own fold
    seen = url_filter.filter_urls(pages, rules=[], sample=50)
    assert {r.verdict for r in seen.where("host like 'casino%two.test'").collect()} == {"block"}
    assert {r.verdict for r in seen.where("host like 'news%'").collect()} == {"allow"}
