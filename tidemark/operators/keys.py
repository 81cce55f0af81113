"""Surrogate keys: dense, increasing, assigned without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _bucket(keys: Sequence[str], digits: int) -> Column:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, digits)


def surrogate_key(df: DataFrame, keys: Sequence[str], name: str, start: int | Column = 0, digits: int = 4) -> DataFrame:
    """Number the rows start+1, start+2, ... in the order (hash prefix of the keys, keys).

    The keys are unique (one row per natural key), so the md5 prefix spreads
    them evenly over 16**digits buckets: each bucket is numbered by its own
    window and shifted by the total of the buckets before it. The only
    single-task step runs over at most 16**digits counts. The order depends on
    the data alone, so a task run again after an executor loss gives the same
    keys.
    """
    bucketed = df.withColumn("_bucket", _bucket(keys, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_bucket",
        (F.sum("_n").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(*keys))
    base = start if isinstance(start, Column) else F.lit(start)
    return bucketed.withColumn("_row", inside).join(F.broadcast(before), "_bucket").select(
        (base + F.col("_before") + F.col("_row")).cast("bigint").alias(name),
        *[F.col(c) for c in df.columns])


def max_key(df: DataFrame, name: str) -> Column:
    """Largest key in use, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
