"""High-water marks: which source rows are new."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import as_col, day, elapsed, ts

DEFAULT_WATERMARK = "1900-01-01 00:00:00"


def high_water_mark(target: DataFrame | None, column: str, default: str = DEFAULT_WATERMARK):
    """The largest value seen, as one scalar fetched now, so that the filter is a literal the scan can use."""
    if target is None:
        return default
    value = target.agg(F.max(column).cast("string")).first()[0]
    return value or default


def hwm_lookup(target: DataFrame, column: str, default: str = "1990-01-01 00:00:00") -> DataFrame:
    """One row: the mark as text."""
    return target.agg(F.coalesce(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss"), F.lit(default)).alias("high_water_mark"))


def watermark_filter(source: DataFrame, column: str, mark, *, default: str = DEFAULT_WATERMARK,
                     full_reload: bool = False, lookback_days: int = 0, from_date: str | None = None,
                     start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Rows strictly after the mark.

    `mark` is a scalar (a literal predicate that reaches the file scan) or a
    Column such as a scalar subquery. Overrides: `full_reload` ignores the
    mark, `lookback_days` moves it back (load the result by upsert),
    `from_date` replaces it, and `start_date`/`end_date` give an explicit window.
    """
    if full_reload:
        out = source
    elif start_date or end_date:
        out = source
        if start_date:
            out = out.where(F.col(column) >= ts(start_date))
        if end_date:
            out = out.where(F.col(column) < ts(end_date))
    else:
        base = ts(from_date or (mark if mark is not None else default))
        if lookback_days:
            base = base - F.make_dt_interval(F.lit(lookback_days))
        out = source.where(F.col(column) > base)
    return out


def target_mark(target: DataFrame, column: str, default: str = DEFAULT_WATERMARK) -> Column:
    """The mark as a scalar subquery, evaluated when the query runs."""
    return target.agg(F.coalesce(F.max(column), ts(default))).scalar()


def watermark_gap(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Newest source and target time and the whole hours between; two one-row aggregates."""
    mark = target.agg(F.max(column)).scalar()
    return source.agg(F.max(column).alias("source_max")).select(
        "source_max", mark.alias("target_max")).withColumn("gap_hours", elapsed("HOUR", "target_max", "source_max"))


def incremental_status(tables: dict[str, tuple[DataFrame, str]], as_of) -> DataFrame:
    """Per table: newest time, rows, days since. One partial aggregate per table."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.max(column).cast("timestamp_ntz").alias("last_loaded_timestamp"),
               F.count(F.lit(1)).alias("total_rows"))
        for name, (df, column) in tables.items()]
    merged = reduce(DataFrame.unionByName, parts)
    return merged.withColumn("last_load_date", F.to_date("last_loaded_timestamp")).withColumn(
        "days_since_update", F.datediff(day(as_of), "last_load_date"))


def stale_tables(status: DataFrame, days: int = 7) -> DataFrame:
    return status.where(as_col("days_since_update") > days)
