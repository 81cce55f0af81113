"""What the near-duplicate join deals out: postings of shared shingles and texts of pairs, nothing else."""

import random

import numpy as np
import pytest

from tidemark.llm import common, ngram_join


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(500)}" for _ in range(n))


@pytest.fixture
def docs(spark):
    common.tune(spark)
    passages = [prose(12, 100 + k) for k in range(60)]  # each in two texts, so that all have shared postings; only the copies are alike
    rows = [(k, f"{passages[k]} {passages[(k + 1) % 60]}") for k in range(60)]
    rows += [(60 + k, f"{rows[k][1]} end") for k in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("sent", [200_000, 0])
def test_only_texts_of_pairs_are_dealt_out(spark, docs, monkeypatch, sent):
    texts, staged = [], common.staged

    def counted(df, name):
        out = staged(df, name)
        if "text" in out.columns:
            texts.append(out.count())
        return out
    monkeypatch.setattr(common, "staged", counted)
    monkeypatch.setattr(ngram_join, "SENT_IDS", sent)
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs, n=3, percent=90).collect()}
    assert got == {k: k - 60 if k >= 60 else k for k in range(65)}
    assert texts and max(texts) <= 10


def test_a_bitmap_lacks_no_key_and_stops_others(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as key")
    marked = ngram_join.marks(keys)
    assert ngram_join.is_marked(marked, np.array([r.key for r in keys.collect()])).all()
    others = np.array([r.key for r in spark.range(5000, 10000).selectExpr("xxhash64(id) as key").collect()])
    assert ngram_join.is_marked(marked, others).mean() < 0.25
    assert len(ngram_join.marks(keys, 3)) == 8 and len(ngram_join.marks(keys.limit(0))) == 2
