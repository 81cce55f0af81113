"""The next row of a key in time order, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def next_value(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str,
               bucket: Column | None = None) -> DataFrame:
    """lead(value) per key, computed per (key, time bucket) and stitched at the bucket edges.

    A plain window would pull all rows of a key into one task. Here a window
    spans one key within one month (or the given bucket); the first value of
    each non-empty bucket is pre-aggregated, and only those edge rows, at most
    one per key and month, are ordered per key.
    """
    b = bucket if bucket is not None else F.date_trunc("month", F.col(order))
    rows = df.withColumn("_b", b)
    lead = F.lead(F.struct(F.col(value).alias("v"))).over(W.partitionBy(*keys, "_b").orderBy(order))
    inner = rows.withColumn("_in", lead)
    edges = rows.groupBy(*keys, "_b").agg(F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))).alias("_first"))
    w = W.partitionBy(*keys).orderBy("_b")
    edges = edges.select(*keys, "_b", F.lead(F.col("_first.v")).over(w).alias("_edge"))
    return inner.join(edges, [*keys, "_b"], "left").withColumn(
        name, F.when(F.col("_in").isNotNull(), F.col("_in.v")).otherwise(F.col("_edge"))).drop("_b", "_in", "_edge")
