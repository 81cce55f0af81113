"""Small aggregate and window shapes used by reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import all_of, mean, percent, ratio


def summary(df: DataFrame, value: str, digits: int = 2) -> DataFrame:
    """count, sum, avg, min and max of one column, rounded."""
    return df.agg(
        F.count(F.lit(1)).alias("row_total"),
        F.round(F.sum(value), digits).alias("total"), F.round(mean(value), digits).alias("average"),
        F.round(F.min(value), digits).alias("smallest"), F.round(F.max(value), digits).alias("largest"))


def distribution(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Value counts with their percent of the total; the total is a scalar, so many values need no single task."""
    total = df.agg(F.count("*")).scalar()
    g = df.groupBy(F.col(column).alias(name or column)).agg(F.count("*").alias("count"))
    return g.withColumn("percentage", F.round(percent("count", total), 2))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, and of all columns together; `approximate` uses mergeable sketches."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    complete = F.when(all_of([F.col(c).isNotNull() for c in columns]), F.struct(*columns))  # a null makes no joint value
    together = F.approx_count_distinct(complete) if approximate else F.count_distinct(*columns)
    return df.agg(*[count(F.col(c)).alias(f"distinct_{c}") for c in columns], together.alias("distinct_together"))


def conditional_counts(df: DataFrame, by: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def safe_ratio(df: DataFrame, by: Sequence[str], num: str, den: str, name: str, digits: int = 4) -> DataFrame:
    """sum(num) / sum(den) per group; null where the denominator is 0."""
    return df.groupBy(*by).agg(F.round(ratio(F.sum(num), F.sum(den)), digits).alias(name))


def moving_average(daily: DataFrame, day: str, value: str, rows: int = 7, name: str = "moving_avg") -> DataFrame:
    """Mean of the last `rows` rows by day; for one row per day."""
    w = W.orderBy(day).rowsBetween(-(rows - 1), 0)
    return daily.withColumn(name, F.avg(F.col(value).cast("double")).over(w))


def exists(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first."""
    return not df.isEmpty()


def sample_by_hash(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """A repeatable sample: the same keys are chosen in every run and on every cluster."""
    slots = 16 ** 6
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.where(F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long") < int(fraction * slots))


def exact_cuts(df: DataFrame, columns: Sequence[str], cuts: Sequence[tuple[int, int]], buckets: int = 256) -> DataFrame:
    """(column_name, cuts): the smallest value of each column that k of n parts of its rows do not exceed, for each (k, n).

    Exact at every size: values are counted, dealt to buckets in order, and
    the counts summed within each bucket and over the buckets before it.
    Bucket bounds come from a sketch of the distinct values, which decides only
    how even the buckets are. Nulls are left out; values are doubles.
    """
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])))
    counts = pairs.where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    bounds = counts.groupBy("column_name").agg(
        F.percentile_approx("v", [k / buckets for k in range(1, buckets)], 10000).alias("_bounds"), F.sum("n").alias("_total"))
    dealt = counts.join(F.broadcast(bounds), "column_name").withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < F.col("v")))).drop("_bounds")
    totals = dealt.groupBy("column_name", "_bucket").agg(F.sum("n").alias("_n"))
    w = W.partitionBy("column_name").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    before = totals.select("column_name", "_bucket", (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
    w = W.partitionBy("column_name", "_bucket").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    ranked = dealt.withColumn("_inside", F.sum("n").over(w)).join(F.broadcast(before), ["column_name", "_bucket"])
    reached = F.col("_before") + F.col("_inside")
    return ranked.groupBy("column_name").agg(
        F.array(*[F.min(F.when(reached * n >= F.col("_total") * k, F.col("v"))) for k, n in cuts]).alias("cuts"))
