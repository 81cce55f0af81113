"""Writing tables: append, refresh, daily replace, merge of touched partitions, load modes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..operators.upsert import upsert
from ..operators.watermark import high_water_mark, watermark_filter
from .versions import READER, REASON, Balance, VersionedTable, spread


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Source to target names; only mapped columns are kept."""
    return df.select(*[F.col(source).alias(target) for source, target in mapping.items()])


def calculator(df: DataFrame, calculations: Mapping[str, str], keep_input: bool = True) -> DataFrame:
    """Add columns from SQL expressions over the input columns."""
    added = {name: F.expr(text) for name, text in calculations.items()}
    return df.withColumns(added) if keep_input else df.select(*[c.alias(n) for n, c in added.items()])


def write_append(df: DataFrame, path: str, mapping: Mapping[str, str] | None = None,
                 partition_by: Sequence[str] = ()) -> None:
    out = rename_map(df, mapping) if mapping else df
    spread(out, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def write_new(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), more: bool = False) -> None:
    """Write to a path that must not exist yet, or `more` of the same table to it."""
    out = spread(df, partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    out.write.mode("append" if more else "errorifexists").options(**session.STORED).partitionBy(*partition_by).parquet(path)


def file_slices(spark: SparkSession, path: str, schema: T.StructType, n: int | None = None) -> list[DataFrame]:
    """A written table in parts of about equal bytes: each of its files, in order of their paths, is in one of them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True), []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            files.append((f.getPath().toString(), f.getLen()))
    total, before, parts = sum(size for _, size in files), 0, {}
    n = n or session.slices_for(total)
    for name, size in sorted(files):
        parts.setdefault(before * n // max(1, total), []).append(name)
        before += size
    if len(parts) < 2:
        return [spark.read.schema(schema).parquet(path)]
    return [spark.read.schema(schema).option("basePath", path).parquet(*names) for names in parts.values()]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in df."""
    spread(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by).parquet(path)


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str, newest: str | None = None) -> None:
    """Merge into a partitioned table, rewriting only the partitions the source touches.

    For keys that never change their partition, such as facts by event month.
    The touched partition values prune the read of the target by a semi-join
    and are replaced in one commit.
    """
    touched = source.select(partition).distinct()
    current = spark.read.parquet(path).join(touched, partition, "left_semi")
    replace_partitions(upsert(current, source, list(keys), newest=newest), path, [partition])


MODES = ("initial", "replace", "truncate_insert", "incremental_append", "incremental_merge")


def load(table: VersionedTable, source: DataFrame, mode: str, *, keys: Sequence[str] = (),
         watermark: str | None = None, mark: str | None = None) -> int:
    """Load one table in one of five modes; returns the published version.

    initial: create, error if present. replace: new rows and new schema.
    truncate_insert: new rows, the schema kept. incremental_append: rows after
    the mark are added. incremental_merge: rows after the mark are merged by
    key (appended where there is no key), and only they are written.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    current = table.read()
    if mode == "initial":
        if current is not None:
            raise ValueError("the target exists already")
        return table.publish(source)
    if mode == "replace" or current is None:
        return table.publish(source)
    if mode == "truncate_insert":
        kept = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in source.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in current.schema.fields]
        return table.publish(source.select(*kept))
    fresh = source
    if watermark:
        fresh = watermark_filter(source, watermark, mark if mark is not None else high_water_mark(current, watermark))
    if mode == "incremental_append" or not keys:
        return table.append(fresh)
    table.merge(fresh, keys, watermark, load=mode)
    return table.version()


def load_dimension(table: VersionedTable, source: DataFrame, natural: str, how: Callable[[DataFrame | None, DataFrame], DataFrame], load: str) -> Balance:
    """Publish the dimension `how(before, source)`; rows without a natural key and the balance of the load appear with it."""
    rows, keyed, distinct = source.agg(F.count(F.lit(1)), F.count(natural), F.count_distinct(natural)).first()
    balance = Balance(load, rows, distinct, keyed - distinct, rows - keyed)
    refused = source.where(F.col(natural).isNull()).withColumns({REASON: F.lit(f"null key: {natural}"), READER: F.lit(load)})
    table.publish(how(table.read(), source), rejected=refused if balance.rejected else None, balance=balance)
    return balance


def create_if_not_exists(table: VersionedTable, source: DataFrame) -> bool:
    """Create an empty table with the source's schema; False when it exists."""
    if table.exists():
        return False
    table.publish(source.limit(0))
    return True
