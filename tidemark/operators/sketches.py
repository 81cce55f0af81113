"""Column profiles kept as one row a day, merged over any window of days from those rows alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

DISTINCT_BITS = 12      # 2^12 registers
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)   # the standard error, 1.6 %
QUANTILE_K = 200        # rank error of about 1.65 % with 99 % confidence
KEYS = ["table_name", "column_name", "day"]


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _of_column(name: str, kind: T.DataType) -> Column:
    """The day's state of one column. Sketches are null where the column has no value that day."""
    c = F.col(name)
    number = c.cast("double") if _is_number(kind) else F.lit(None).cast("double")
    identity = F.when(c.isNotNull(), F.xxhash64(c))  # the sketch itself would leave out empty texts
    some = F.count(c) > 0
    finite = F.when(~F.isnan(number), number)
    quantiles = F.when(F.count(finite) > 0, F.kll_sketch_agg_double(finite, QUANTILE_K)) if _is_number(kind) else F.lit(None).cast("binary")
    return F.struct(
        F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count_if(c.isNull()).alias("null_count"),
        F.min(c).cast("string").alias("min_text"), F.max(c).cast("string").alias("max_text"),
        F.min(number).alias("min_value"), F.max(number).alias("max_value"), F.sum(number).alias("total"),
        F.when(some, F.hll_sketch_agg(identity, DISTINCT_BITS)).alias("distinct_sketch"), quantiles.alias("quantile_sketch"))


def daily_states(df: DataFrame, table: str, day: str, columns: Sequence[str]) -> DataFrame:
    """One row for each day and column: counts, extremes, sum, and the two sketches.

    One aggregate by day; map tasks combine, so a day that holds most rows
    sends one state a task. Rows without a day form a day of their own, null.
    """
    one = df.groupBy(F.to_date(F.col(day)).alias("day")).agg(*[_of_column(c, df.schema[c].dataType).alias(f"_{k}") for k, c in enumerate(columns)])
    return one.select(F.lit(table).alias("table_name"), "day", F.inline(F.array(*[f"_{k}" for k in range(len(columns))])))


def merged_profile(states: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The profile of a window of days from the daily rows: counts and extremes exact, distinct values and median from sketches.

    Days without a date count only where no window is given.
    """
    if first is not None:
        states = states.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        states = states.where(F.col("day") <= F.lit(last).cast("date"))
    is_number = F.max("min_value").isNotNull()
    merged = states.groupBy("table_name", "column_name").agg(
        F.count(F.lit(1)).alias("days"), F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.when(is_number, F.min("min_value").cast("string")).otherwise(F.min("min_text")).alias("min_value"),
        F.when(is_number, F.max("max_value").cast("string")).otherwise(F.max("max_text")).alias("max_value"),
        F.sum("total").alias("_total"), F.count("distinct_sketch").alias("_d"), F.count("quantile_sketch").alias("_q"),
        F.hll_union_agg("distinct_sketch").alias("_hll"), F.kll_merge_agg_double("quantile_sketch").alias("_kll"))
    filled = F.col("row_count") - F.col("null_count")
    return merged.select(
        "table_name", "column_name", "days", "row_count", "null_count", "min_value", "max_value",
        F.when(filled > 0, F.col("_total") / filled).alias("avg_value"),
        F.when(F.col("_d") > 0, F.hll_sketch_estimate("_hll")).otherwise(F.lit(0)).alias("distinct_estimate"),
        F.when(F.col("_q") > 0, F.kll_sketch_get_quantile_double("_kll", F.lit(0.5).cast("double"))).alias("median_estimate"))
