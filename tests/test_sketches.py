"""Daily states of columns: error bounds, windows from the stored rows alone, days without values."""

import statistics

from pyspark.sql import functions as F

from tidemark.operators import sketches as s
from tidemark.sources.versions import VersionedTable


def many(spark):
    i = F.col("id")
    return spark.range(120_000).select(
        F.date_add(F.lit("2024-01-01"), (i % 40).cast("int")).alias("d"), (F.pmod(F.xxhash64("id"), F.lit(30_000))).alias("x"),
        F.when(i % 3 > 0, F.md5((i % 9_000).cast("string"))).alias("t"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10 ** 6)) / 7).alias("f"))


def test_a_window_of_thirty_days_comes_from_thirty_rows_a_column(spark, tmp_path):
    df, table = many(spark), VersionedTable(spark, str(tmp_path / "t"))
    table.merge(s.daily_states(df, "T", "d", ["x", "t", "f"]), s.KEYS)
    stored = table.read()
    assert stored.count() == 40 * 3
    window = df.where("d between '2024-01-05' and '2024-02-03'")
    got = {r["column_name"]: r for r in s.merged_profile(stored, "2024-01-05", "2024-02-03").collect()}
    assert {r["days"] for r in got.values()} == {30}
    for c in ("x", "t", "f"):
        want = window.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.count_distinct(c)).first()
        assert (got[c]["row_count"], got[c]["null_count"]) == (want[0], want[1])
        assert abs(got[c]["distinct_estimate"] - want[2]) <= 4 * s.DISTINCT_ERROR * want[2]
    for c in ("x", "f"):
        below, n, mean, least = window.agg(F.count_if(F.col(c) <= got[c]["median_estimate"]), F.count(c), F.avg(c), F.min(c)).first()
        assert abs(below / n - 0.5) <= 0.03
        assert abs(got[c]["avg_value"] - mean) < 1e-6 * mean and float(got[c]["min_value"]) == least
    assert got["t"]["median_estimate"] is None and got["t"]["avg_value"] is None


def test_small_days_are_exact_and_a_day_taken_again_replaces_itself(spark, tmp_path):
    values = [(1, "a"), (1, None), (None, "b"), (7, "a"), (9, "")]
    df = spark.createDataFrame([("2024-01-01", *v) for v in values], "d string, x int, t string")
    table = VersionedTable(spark, str(tmp_path / "t"))
    for _ in range(2):
        table.merge(s.daily_states(df, "T", "d", ["x", "t"]), s.KEYS)
    got = {r["column_name"]: r for r in s.merged_profile(table.read()).collect()}
    assert (got["x"]["row_count"], got["x"]["null_count"], got["x"]["distinct_estimate"]) == (5, 1, 3)
    assert got["x"]["median_estimate"] in (1.0, 7.0) and got["x"]["avg_value"] == statistics.mean([1, 1, 7, 9])
    assert (got["t"]["null_count"], got["t"]["distinct_estimate"], got["t"]["min_value"], got["t"]["max_value"]) == (1, 3, "", "b")


def test_columns_without_values_days_without_date_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, 1.5, True), (None, None, float("nan"), None)], "d date, n decimal(10,2), f double, b boolean")
    states = s.daily_states(df, "T", "d", ["n", "f", "b"])
    got = {r["column_name"]: r for r in s.merged_profile(states).collect()}
    assert (got["n"]["null_count"], got["n"]["distinct_estimate"], got["n"]["median_estimate"], got["n"]["avg_value"]) == (2, 0, None, None)
    assert got["f"]["median_estimate"] == 1.5 and got["b"]["distinct_estimate"] == 1
    assert s.merged_profile(states, "2024-01-01").count() == 0
    assert s.merged_profile(s.daily_states(df.limit(0), "T", "d", ["n", "f"])).count() == 0
