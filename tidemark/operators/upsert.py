"""MERGE on file tables: matched rows take the source's columns, others are inserted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import all_of, any_of
from .changes import dedupe_latest


class DuplicateSourceKeys(ValueError):
    pass


def ensure_unique(source: DataFrame, keys: Sequence[str], newest: str | None, strict: bool) -> DataFrame:
    """One row per key: the newest, or the largest of the other columns where no time is named; `strict` raises instead."""
    if strict:
        if not source.groupBy(*keys).count().where("count > 1").isEmpty():
            raise DuplicateSourceKeys(f"source holds several rows for one of {list(keys)}")
        return source
    if newest:
        return dedupe_latest(source, keys, newest=newest)
    rest = [c for c in source.columns if c not in keys]
    return dedupe_latest(source, keys, [F.col(c).desc_nulls_last() for c in rest[1:]] or [F.lit(0)], newest=rest[0] if rest else keys[0])


def without_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has a null: a merge leaves them out, the load may park them."""
    return source.where(any_of([F.col(k).isNull() for k in keys]))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, update: Sequence[str] | None = None,
           newest: str | None = None, strict: bool = False, unique: bool = False) -> DataFrame:
    """The target after the merge.

    `update` lists the columns a match overwrites (default: every source
    column but the keys); columns not listed keep the target's value. Columns
    the source lacks stay null on insert, columns only the source has are
    added. With `newest` an older source row never replaces a newer target
    row. Several source rows of a key collapse to the latest (`strict` raises
    instead), and rows without a key are left out; see `without_key`, and
    `VersionedTable.merge`, which keeps them. `unique` says that the source
    has one row for each key and none without.

    One full outer join on the keys, one row per key on both sides: no join
    partition can be hot, and AQE broadcasts where a side is small.
    """
    src = source if unique else ensure_unique(source.where(all_of([F.col(k).isNotNull() for k in keys])), keys, newest, strict)
    updated = set(update if update is not None else [c for c in source.columns if c not in keys])
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = src.withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    from_source, existing = F.col("s._s").isNotNull(), F.col("t._t").isNotNull()
    if newest and newest in target.columns:
        stale = existing & (F.col(f"t.{newest}") > F.col(f"s.{newest}"))
        from_source = from_source & ~F.coalesce(stale, F.col(f"s.{newest}").isNull() & F.col(f"t.{newest}").isNotNull(), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            expr = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c not in source.columns:
            expr = F.col(f"t.{c}")
        elif c in updated:
            expr = F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            expr = F.when(existing, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        out.append(expr.cast(target.schema[c].dataType).alias(c))
    added = [F.when(from_source, F.col(f"s.{c}")).alias(c) for c in source.columns if c not in target.columns]
    return joined.select(*out, *added)


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows of the source's keys, then append the source."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").unionByName(source)
