"""Slowly changing dimensions of types 1, 2 and 3."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import OPEN_END, all_of, any_of, ts
from ..session import cut_lineage
from .changes import dedupe_latest, same
from .keys import max_key, surrogate_key
from .neighbors import next_value
from .upsert import ensure_unique, upsert

SCD2_COLUMNS = ["valid_from", "valid_to", "is_current", "version_number", "created_timestamp", "updated_timestamp"]


def scd1(target: DataFrame | None, source: DataFrame, natural: str, key: str, run_ts) -> DataFrame:
    """Overwrite in place; created_timestamp is kept, updated_timestamp set, new rows get the next keys."""
    stamped = source.withColumn("updated_timestamp", ts(run_ts))
    if target is None:
        stamped = ensure_unique(stamped.where(F.col(natural).isNotNull()), [natural], None, strict=False)
        return surrogate_key(stamped.withColumn("created_timestamp", ts(run_ts)), [natural], key)
    merged = upsert(target, stamped, [natural])
    known = merged.where(F.col(key).isNotNull())
    new = merged.where(F.col(key).isNull()).drop(key).withColumn("created_timestamp", ts(run_ts))
    return known.unionByName(surrogate_key(new, [natural], key, start=max_key(target, key)).select(*known.columns))


def scd2_initial(source: DataFrame, natural: str, key: str, run_ts, valid_from=None) -> DataFrame:
    """Every row is version 1, current, open ended."""
    now = ts(run_ts)
    source = ensure_unique(source.where(F.col(natural).isNotNull()), [natural], None, strict=False)
    return surrogate_key(source, [natural], key).withColumns({
        "valid_from": ts(valid_from) if valid_from is not None else now,
        "valid_to": ts(OPEN_END),
        "is_current": F.lit(True),
        "version_number": F.lit(1),
        "created_timestamp": now,
        "updated_timestamp": now,
    })


def scd2_incremental(target: DataFrame, source: DataFrame, natural: str, key: str, run_ts, *,
                     track: Sequence[str] | None = None, close_deleted: bool = False, newest: str | None = None,
                     stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The whole dimension after one load.

    Old versions pass through untouched. Current versions meet the source in
    one full outer join on the natural key; each match yields one row, or two
    when a tracked column changed: the closed version and the new one. Rows
    missing from the source stay open unless `close_deleted`.

    Several source rows of one key collapse to the latest by `newest` (or to
    one by their values), rows without a key are left out: there is never more
    than one current version. New rows are numbered after the join. `stage` may write the joined rows
    (session.cut_lineage does), so that numbering them does not repeat the
    join.
    """
    attributes = [c for c in source.columns if c != natural]
    tracked = list(track or [c for c in attributes if c != "source_system"])
    now = ts(run_ts)
    source = ensure_unique(source.where(F.col(natural).isNotNull()), [natural], newest, strict=False)
    history = target.where(~F.col("is_current"))
    d = target.where(F.col("is_current")).withColumn("_old", F.lit(True)).alias("d")
    s = source.withColumn("_new", F.lit(True)).alias("s")
    both = d.join(s, F.col(f"d.{natural}") == F.col(f"s.{natural}"), "full_outer")

    is_new, is_gone = F.col("d._old").isNull(), F.col("s._new").isNull()
    changed = ~is_new & ~is_gone & ~same("d", "s", tracked)
    kind = F.when(is_new, "N").when(is_gone, "D").when(changed, "C").otherwise("I")

    def field(name: str, value: Column) -> Column:
        return value.cast(target.schema[name].dataType).alias(name)

    def kept(closed: Column) -> Column:
        values = {c: F.col(f"d.{c}") for c in target.columns}
        values["valid_to"] = F.when(closed, now).otherwise(values["valid_to"])
        values["updated_timestamp"] = F.when(closed, now).otherwise(values["updated_timestamp"])
        values["is_current"] = ~closed
        return F.struct(*[field(c, v) for c, v in values.items()])

    def opened() -> Column:
        values = {
            key: F.lit(None), natural: F.col(f"s.{natural}"),
            "valid_from": now, "valid_to": ts(OPEN_END), "is_current": F.lit(True),
            "version_number": F.coalesce(F.col("d.version_number"), F.lit(0)) + 1,
            "created_timestamp": F.coalesce(F.col("d.created_timestamp"), now),
            "updated_timestamp": now, **{c: F.col(f"s.{c}") for c in attributes}}
        return F.struct(*[field(c, values.get(c, F.lit(None))) for c in target.columns])

    closing = (kind == "C") | ((kind == "D") & F.lit(close_deleted))
    rows = F.when(kind == "N", F.array(opened())).when(kind == "C", F.array(kept(closing), opened())).otherwise(
        F.array(kept(closing)))
    loaded = stage(both.select(F.inline(rows)).select(*target.columns))
    settled = loaded.where(F.col(key).isNotNull())
    fresh = loaded.where(F.col(key).isNull()).drop(key)
    numbered = surrogate_key(fresh, [natural], key, start=max_key(target, key)).select(*target.columns)
    return history.unionByName(settled).unionByName(numbered)


def scd2_load(target: DataFrame | None, source: DataFrame, natural: str, key: str, run_ts, **options) -> DataFrame:
    """Initial load on an empty target, else the incremental one."""
    if target is None or target.isEmpty():
        return scd2_initial(source, natural, key, run_ts)
    return scd2_incremental(target, source, natural, key, run_ts, **{"stage": cut_lineage, **options})


def collapse_batch(source: DataFrame, natural: str, newest: str = "last_modified_timestamp") -> DataFrame:
    """Several changes of one key in a batch: keep the latest."""
    return dedupe_latest(source, [natural], newest=newest)


def scd2_replay(changes: DataFrame, natural: str, key: str, moment: str, columns: Sequence[str]) -> DataFrame:
    """Build versions straight from a change log: each differing row in time order becomes a version."""
    w = W.partitionBy(natural).orderBy(moment)
    prior = {c: F.lag(c).over(w) for c in columns}
    first = F.row_number().over(w) == 1
    steps = changes.withColumn("_step", first | any_of([~F.col(c).eqNullSafe(v) for c, v in prior.items()])).where("_step")
    v = W.partitionBy(natural).orderBy(moment)
    versions = steps.select(
        natural, *columns, F.col(moment).alias("valid_from"),
        F.coalesce(F.lead(moment).over(v), ts(OPEN_END)).alias("valid_to"),
        F.lead(moment).over(v).isNull().alias("is_current"),
        F.row_number().over(v).alias("version_number"))
    return surrogate_key(versions, [natural, "version_number"], key)


def scd2_repair(dim: DataFrame, natural: str) -> DataFrame:
    """Close every version but the latest; each ends where the next begins."""
    with_next = next_value(dim, [natural], "valid_from", "valid_from", "_next")
    return with_next.withColumns({
        "valid_to": F.coalesce(F.col("_next"), ts(OPEN_END)),
        "is_current": F.col("_next").isNull(),
    }).drop("_next")


def scd3(target: DataFrame | None, source: DataFrame, natural: str, key: str, tracked: str, run_ts) -> DataFrame:
    """current_<tracked>, previous_<tracked>, <tracked>_changed_date; the previous value survives unchanged runs."""
    cur, prev, when = f"current_{tracked}", f"previous_{tracked}", f"{tracked}_changed_date"
    now = ts(run_ts)
    source = ensure_unique(source.where(F.col(natural).isNotNull()), [natural], None, strict=False)  # before the shift: one row decides
    renamed = source.withColumnRenamed(tracked, cur)
    if target is None:
        out = renamed.withColumns({
            prev: F.lit(None).cast(source.schema[tracked].dataType), when: F.lit(None).cast("timestamp_ntz"),
            "created_timestamp": now, "updated_timestamp": now})
        return surrogate_key(out, [natural], key)
    before = target.select(natural, F.col(cur).alias("_cur"), F.col(prev).alias("_prev"), F.col(when).alias("_when"),
                           F.lit(True).alias("_known"))
    moved = F.coalesce(F.col("_known"), F.lit(False)) & ~F.col(cur).eqNullSafe(F.col("_cur"))
    shifted = renamed.join(before, natural, "left").withColumns({
        prev: F.when(moved, F.col("_cur")).otherwise(F.col("_prev")),
        when: F.when(moved, now).otherwise(F.col("_when")),
    }).drop("_cur", "_prev", "_when", "_known")
    return scd1(target, shifted, natural, key, run_ts)


def scd3_moved(dim: DataFrame, tracked: str, old: str, new: str) -> DataFrame:
    return dim.where((F.col(f"previous_{tracked}") == old) & (F.col(f"current_{tracked}") == new))


def dimension_audit(dim: DataFrame, natural: str, key: str, tracked: Sequence[str], table: str,
                    scd_type: str = "TYPE_2") -> DataFrame:
    """One row per changed attribute of every version, INSERT rows for first versions, EXPIRE rows for closed ones.

    A version meets its predecessor by equality on (natural key, version - 1):
    rows of one entity spread over all tasks.
    """
    p = dim.select(F.col(natural).alias("_nk"), (F.col("version_number") + 1).alias("_v"),
                   *[F.col(c).alias(f"_old_{c}") for c in tracked])
    paired = dim.join(p, (F.col(natural) == F.col("_nk")) & (F.col("version_number") == F.col("_v")), "left")
    first = F.col("version_number") == 1
    text = "string"
    changed = [F.when(~first & ~F.col(c).eqNullSafe(F.col(f"_old_{c}")), F.struct(
        F.lit("UPDATE").alias("operation_type"), F.lit(c).alias("attribute_changed"),
        F.col(f"_old_{c}").cast(text).alias("old_value"), F.col(c).cast(text).alias("new_value"))) for c in tracked]

    def event(name: str, condition: Column) -> Column:
        nothing = F.lit(None).cast(text)
        return F.when(condition, F.struct(F.lit(name).alias("operation_type"), nothing.alias("attribute_changed"),
                                          nothing.alias("old_value"), nothing.alias("new_value")))

    events = F.array_compact(F.array(event("INSERT", first), event("EXPIRE", ~F.col("is_current")), *changed))
    return paired.select(
        F.lit(table).alias("dimension_table"), F.lit(scd_type).alias("scd_type"),
        F.col(natural).alias("natural_key"), F.col(key).alias("surrogate_key"),
        "version_number", "valid_from", "valid_to", "is_current", F.inline(events))


def version_history(dim: DataFrame, natural: str, value: str) -> DataFrame:
    return dim.where(F.col(natural) == value).orderBy("version_number")


def tier_moves(dim: DataFrame, natural: str, column: str) -> DataFrame:
    """Rows where a column differs from the version before, with both values."""
    p = dim.select(F.col(natural).alias("_nk"), (F.col("version_number") + 1).alias("_v"), F.col(column).alias(f"from_{column}"))
    pairs = dim.join(p, all_of([F.col(natural) == F.col("_nk"), F.col("version_number") == F.col("_v")]))
    return pairs.where(~F.col(f"from_{column}").eqNullSafe(F.col(column))).select(
        natural, "version_number", f"from_{column}", F.col(column).alias(f"to_{column}"), "valid_from")
