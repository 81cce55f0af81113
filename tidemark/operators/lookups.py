"""Natural key to surrogate key lookups, orphans, point-in-time joins.

No join here carries a broadcast hint: a dimension is broadcast by the
planner when its measured size is below spark.sql.autoBroadcastJoinThreshold
(AQE also decides from the real shuffle size) and otherwise joined by key,
with AQE splitting the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import all_of, date_key, ts

UNKNOWN_KEY = -1


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current")) if "is_current" in dim.columns else dim


def _keys_of(dim: DataFrame, natural: str, key: str) -> DataFrame:
    return current(dim).select(F.col(natural), F.col(key))


def lookup_inner(df: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Keep rows whose natural key has a current version; add its surrogate key."""
    return df.join(_keys_of(dim, natural, key), natural, "inner")


def lookup_left(df: DataFrame, dim: DataFrame, natural: str, key: str, unknown: int | None = None) -> DataFrame:
    """Optional lookup: the key is null, or `unknown`, where nothing matches."""
    # rows without a natural key match nothing; a number of their own spreads them, where all would meet in one partition
    apart = df.withColumn("_apart", F.when(F.col(natural).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)))
    keys = _keys_of(dim, natural, key).select(F.col(natural).alias("_nk"), key, F.lit(0).cast("bigint").alias("_one"))
    out = apart.join(keys, (F.col(natural) == F.col("_nk")) & (F.col("_apart") == F.col("_one")), "left").drop("_apart", "_nk", "_one")
    return out if unknown is None else out.withColumn(key, F.coalesce(key, F.lit(unknown)))


def lookup_with_orphans(df: DataFrame, dim: DataFrame, natural: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(matched with key, unmatched); rows with a null natural key count as unmatched."""
    keys = _keys_of(dim, natural, key)
    return df.join(keys, natural, "inner"), df.join(keys, natural, "left_anti")


def join_calendar(df: DataFrame, calendar: DataFrame, date_column: str) -> DataFrame:
    """Add date_key. The calendar has one row per day of a fixed range, so it is always small."""
    days = calendar.select("date_key")
    return df.withColumn("_dk", date_key(date_column)).join(
        F.broadcast(days), F.col("_dk") == F.col("date_key")).drop("_dk")


def orphans(df: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    keys = parent.select(F.col(parent_column or column).alias(column))
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_count(df: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None, name: str = "actual") -> DataFrame:
    """How many rows have a foreign key without parent.

    Rows are counted per key on the map side first, so the join sees each key
    once and a hot key costs no more than a rare one.
    """
    keys = parent.select(F.col(parent_column or column).alias(column))
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.join(keys, column, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def semi_exists(df: DataFrame, mapping: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(mapping, list(on), "left_semi")


def join_generic(left: DataFrame, right: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    return left.join(right, on, how)


def valid_at(moment: Column) -> Column:
    """Half-open [valid_from, valid_to): a change instant belongs to one version only."""
    return (F.col("valid_from") <= moment) & (moment < F.col("valid_to"))


def asof_dimension(dim: DataFrame, moment: str, natural: str | None = None, value: str | None = None) -> DataFrame:
    """The dimension as it was at `moment`, whole or for one key."""
    out = dim.where(valid_at(ts(moment)))
    return out.where(F.col(natural) == value) if natural else out


MET_VERSIONS = 32   # of one key, up to which a row may meet all of them


def asof_merge(fact: DataFrame, dim: DataFrame, natural: str, event_time: str, key: str, attributes: Sequence[str] = (),
               bucket: str = "day") -> DataFrame:
    """Join each fact row to the version valid at its event time, at the cost of rows plus versions.

    Events and versions go as one stream, by key and time bucket, in order of time: an event takes the last version
    that began before it. The last version of each bucket is carried to the buckets after it by a pass over one row for
    each key and bucket, so a key is spread over its buckets. Versions of a key do not overlap; of several that begin
    at one moment the one that ends last counts.
    """
    moment, carried = F.col(event_time).cast("timestamp_ntz"), [key, "valid_from", "valid_to", *attributes]
    events = fact.select(F.col(natural).alias("_nk"), moment.alias("_at"), F.lit(1).alias("_kind"), F.struct(*[F.col(c) for c in fact.columns]).alias("_row"),
                         F.lit(None).cast(dim.select(F.struct(*carried).alias("v")).schema["v"].dataType).alias("_version"))
    versions = dim.where(F.col(natural).isNotNull()).select(
        F.col(natural).alias("_nk"), F.col("valid_from").cast("timestamp_ntz").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(events.schema["_row"].dataType).alias("_row"), F.struct(*carried).alias("_version"))
    stream = events.where(F.col("_nk").isNotNull() & F.col("_at").isNotNull()).unionByName(versions).withColumn("_b", F.date_trunc(bucket, "_at"))
    ends = F.when(F.col("_kind") == 0, F.col("_version.valid_to"))
    inside = W.partitionBy("_nk", "_b").orderBy("_at", "_kind", ends).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = stream.withColumn("_last", F.last("_version", ignorenulls=True).over(inside)).where("_kind = 1")
    edges = stream.groupBy("_nk", "_b").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_at", F.col("_version.valid_to").alias("_end"), "_version"))).alias("_edge"))
    before = W.partitionBy("_nk").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    edges = edges.select(F.col("_nk").alias("_ek"), F.col("_b").alias("_eb"), F.last("_edge._version", ignorenulls=True).over(before).alias("_carried"))
    met = rows.join(edges.where("_carried IS NOT NULL"), (F.col("_nk") == F.col("_ek")) & (F.col("_b") == F.col("_eb")), "left").withColumn(
        "_v", F.coalesce("_last", "_carried"))
    return met.where(F.col("_at") < F.col("_v.valid_to")).select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in (key, *attributes)])


def fact_asof_lookup(fact: DataFrame, dim: DataFrame, natural: str, event_time: str, key: str,
                     attributes: Sequence[str] = ()) -> DataFrame:
    """Join each fact row to the version valid at its event time.

    Where no key has more than a few versions, equality on the natural key
    carries the join and the range is a residual condition; beyond that a row
    would meet all versions of its key, and both sides are merged in order of
    time instead. Both give the same rows for versions that do not overlap.
    """
    most = dim.groupBy(natural).count().agg(F.max("count")).first()[0]
    if (most or 0) > MET_VERSIONS:
        return asof_merge(fact, dim, natural, event_time, key, attributes)
    d = dim.select(F.col(natural).alias("_nk"), key, "valid_from", "valid_to", *attributes)
    moment = F.col(event_time).cast("timestamp_ntz")
    return fact.join(d, all_of([F.col(natural) == F.col("_nk"), valid_at(moment)]), "inner").drop(
        "_nk", "valid_from", "valid_to")
