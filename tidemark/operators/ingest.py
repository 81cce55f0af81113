"""Config-driven ingestion of many tables with a log row per table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.expressions import ts
from ..sources.sinks import VersionedTable, load
from .changes import dedupe_latest
from .infer import NO_KEY, NO_TIME
from .watermark import watermark_filter

LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("load_mode", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("row_count_affected", T.LongType()), T.StructField("watermark_from", T.StringType()),
    T.StructField("watermark_to", T.StringType()), T.StructField("error_severity", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("execution_time_seconds", T.DoubleType()),
    T.StructField("logged_at", T.TimestampNTZType())])

STATE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType())])


@dataclass(frozen=True)
class TableConfig:
    table_name: str
    incremental_column: str | None = None
    primary_key: tuple[str, ...] = ()

    @classmethod
    def from_row(cls, row) -> "TableConfig":
        column = row["incremental_column"]
        key = row["primary_key"]
        return cls(row["table_name"], None if column in (None, "", NO_TIME) else column,
                   () if key in (None, "", NO_KEY) else tuple(k.strip() for k in key.split(",")))


class WatermarkState:
    """Marks per table, kept as an appended table; a mark is written only after its load succeeded."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root)

    def get(self, name: str) -> str | None:
        df = self.table.read()
        if df is None:
            return None
        return df.where(F.col("table_name") == name).agg(F.max("value")).first()[0]

    def set_all(self, rows: list[tuple]) -> None:
        if rows:
            df = self.spark.createDataFrame(rows, "table_name string, column_name string, value string, run_id string, run_ts string")
            self.table.append(df.withColumn("run_ts", ts(F.col("run_ts").cast("timestamp_ntz"))).coalesce(1))


def untimed(source: DataFrame, target: VersionedTable, config: TableConfig) -> DataFrame:
    """Rows without a change time that the target has neither taken nor rejected: no mark tells which of them are new.

    Compared as a multiset, so that a repeated row counts as often as it comes. Of the rows of a key the one counts that
    a merge would take, and it gives way to any row of its key that has a time.
    """
    column, keys = config.incremental_column, list(config.primary_key)
    new, held, refused = source.where(F.col(column).isNull()), target.read(), target.rejected()
    if keys:
        new = dedupe_latest(new, keys, newest=column)
    for known in (held, refused):
        if known is not None:
            new = new.exceptAll(known.where(F.col(column).isNull()).select(*[F.col(c).cast(source.schema[c].dataType).alias(c) for c in source.columns]))
    if held is not None and keys:
        new = new.join(held.where(F.col(column).isNotNull()).select(*keys), keys, "left_anti")
    return new


def ingest_table(spark: SparkSession, source: DataFrame, target: VersionedTable, config: TableConfig, mark: str | None,
                 mode: str | None = None, load_id: str = "") -> tuple[str, int, str | None]:
    """Load one table; (mode used, rows read, new mark). The mark is the largest source value seen.

    A keyed table is merged, from the first load on: what is written is what is new, rows without a key are kept as the
    table's rejects. Rows without a time are taken by the load that first sees them.
    """
    chosen = mode or ("incremental_merge" if config.primary_key else "incremental_append")
    if config.incremental_column is None:
        chosen, fresh = "replace", source
    else:
        fresh = watermark_filter(source, config.incremental_column, mark or "1990-01-01 00:00:00")
    column = config.incremental_column
    stats = fresh.agg(F.count(F.lit(1)), F.max(column).cast("string") if column else F.lit(None).cast("string")).first()
    rows, newest = stats[0], stats[1]
    late = untimed(source, target, config) if column and not source.where(F.col(column).isNull()).isEmpty() else None
    rows += late.count() if late is not None else 0
    if rows == 0 and target.exists():
        return chosen, 0, mark
    if column and newest:
        # rows landing while this load runs stay for the next one
        fresh = fresh.where(F.col(column) <= ts(newest))
    if late is not None:
        fresh = fresh.unionByName(late)
    keys = config.primary_key
    if keys and column and (not target.exists() or chosen == "incremental_merge"):
        target.merge(fresh, keys, column, load=load_id, read=rows)
    elif not target.exists():
        target.publish(fresh)
    elif chosen == "incremental_append":
        target.append(fresh)
    else:
        load(target, fresh, chosen, keys=keys)
    return chosen, rows, newest or mark


def multi_table_ingest(spark: SparkSession, configs: Iterable[TableConfig], read: Callable[[str], DataFrame], root: str,
                       run_id: str, run_ts: str, concurrency: int = 1) -> DataFrame:
    """Ingest every configured table; a failing table is logged and does not stop the others.

    Tables are independent Spark jobs submitted from `concurrency` driver
    threads. Returns the log, which is also appended to <root>/_log.
    """
    state = WatermarkState(spark, f"{root}/_watermarks")
    configs, saving = list(configs), Lock()

    def one(config: TableConfig) -> tuple:
        start = time.time()
        mark = None
        try:
            mark = state.get(config.table_name)
            target = VersionedTable(spark, f"{root}/{config.table_name}")
            mode, rows, newest = ingest_table(spark, read(config.table_name), target, config, mark, load_id=run_id)
            if newest and newest != mark:  # at once: a driver lost later must not load this table again
                with saving:
                    state.set_all([(config.table_name, config.incremental_column, newest, run_id, run_ts)])
            return (run_id, config.table_name, mode, "SUCCESS", rows, mark, newest, None, None, time.time() - start)
        except Exception as e:
            return (run_id, config.table_name, None, "FAILED", 0, mark, mark, "CRITICAL", str(e), time.time() - start)

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        rows = list(pool.map(one, configs))
    log = spark.createDataFrame([(*r, None) for r in rows], LOG_SCHEMA).withColumn("logged_at", ts(run_ts)).coalesce(1)
    VersionedTable(spark, f"{root}/_log").append(log)
    return log


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    return VersionedTable(spark, f"{root}/_log").read()
