"""Digest trees: which leaves a comparison reads, and that it says what the full comparison says."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, digests as d

SCHEMA = "k long, a string, b decimal(10,2)"


def pair(spark, tmp_path, left, right, n_leaves=16):
    return [d.DigestedTable.write(df, str(tmp_path / n), ["k"], n_leaves) for n, df in (("left", left), ("right", right))]


def leaf_of(spark, k, n_leaves):
    return spark.range(1).select(F.pmod(F.xxhash64(F.lit(k).cast("long")), F.lit(n_leaves))).first()[0]


def test_one_changed_row_reads_one_leaf(spark, tmp_path, rows):
    base = spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("a"), F.lit(1).cast("decimal(10,2)").alias("b"))
    changed = base.withColumn("a", F.when(F.col("k") == 7, "new").otherwise(F.col("a")))
    left, right = pair(spark, tmp_path, changed, base, 64)
    leaves = left.differing(right)
    assert leaves == [leaf_of(spark, 7, 64)]
    assert left.read(leaves).count() < 20_000 / 32
    plan = left.read(leaves)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_group", plan) and re.search(r"PushedFilters: \[[^\]]*_leaf", plan)
    assert rows(d.changes_by_digest(left, right, identical=False), "k", "change_type", "master_a") == [(7, "C", "new")]
    assert d.changes_by_digest(left, right).where("change_type = 'I'").count() == 19_999
    assert rows(d.reconcile("t", left, right)) == [("t", 0, 0, 1, 19_999)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_full_comparison(spark, tmp_path, rows, seed):
    r = random.Random(seed)
    value = lambda: (r.choice([None, "", "x", "y"]), r.choice([None, "1.00", "2.50"]))
    make = lambda: spark.createDataFrame([(k, *value()) for k in r.sample(range(60), r.choice([5, 40]))], "k long, a string, b string").select(
        "k", "a", F.col("b").cast("decimal(10,2)").alias("b"))
    left, right = make(), make()
    out = d.changes_by_digest(*pair(spark, tmp_path, left, right))
    assert rows(out) == rows(changes.detect_changes(left, right, ["k"], ["a", "b"]))


def test_nulls_do_not_change_places_unseen(spark, tmp_path):
    left = spark.createDataFrame([(1, "x", None)], "k long, a string, b string")
    right = spark.createDataFrame([(1, None, "x")], "k long, a string, b string")
    assert len(pair(spark, tmp_path, left, right)[0].differing(d.DigestedTable.open(spark, str(tmp_path / "right")))) == 1


def test_empty_and_equal_tables(spark, tmp_path, rows):
    some = spark.createDataFrame([(1, "x", None), (2, None, None)], SCHEMA)
    left, none = pair(spark, tmp_path, some, some.limit(0))
    again = d.DigestedTable.write(some.orderBy(F.desc("k")), str(tmp_path / "again"), ["k"], 16)
    assert left.differing(again) == [] and rows(d.changes_by_digest(left, again, identical=False)) == []
    assert rows(d.changes_by_digest(left, none), "k", "change_type") == [(1, "N"), (2, "N")]
    assert rows(d.changes_by_digest(none, left), "k", "change_type") == [(1, "D"), (2, "D")]
    assert rows(d.reconcile("t", none, none)) == [("t", 0, 0, 0, 0)]


def test_unfinished_and_unlike_tables_are_refused(spark, tmp_path):
    some = spark.createDataFrame([(1, "x", None)], SCHEMA)
    left, right = pair(spark, tmp_path, some, some.withColumn("b", F.lit(1)))
    with pytest.raises(ValueError):
        left.differing(right)
    with pytest.raises(ValueError):
        d.DigestedTable.write(some, str(tmp_path / "odd"), ["k"], 8)
    with pytest.raises(Exception):
        d.DigestedTable.open(spark, str(tmp_path / "nowhere"))
    assert [d.leaves_for(n) for n in (0, 1, 500_000, 10 ** 9, 10 ** 12)] == [4, 4, 16, 16_384, 65_536]
