"""Which column tracks changes, which columns form the key: proposed by name, confirmed on the data."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions.expressions import all_of, any_of

NO_TIME, NO_KEY = "NO_TIMESTAMP_COLUMN", "NO_PRIMARY_KEY"
# Preference of change columns by name part, best first (fixed values).
NAME_PRIORITY = ["updated_at", "last_modified", "modified_date", "last_updated", "updated", "modified", "timestamp", "date"]

METADATA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()), T.StructField("is_nullable", T.BooleanType()),
    T.StructField("ordinal_position", T.IntegerType())])


def column_metadata(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column, from the schemas alone."""
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable, i)
            for name, df in tables.items() for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(rows, METADATA)


def find_time_columns(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("data_type").isin("date", "timestamp", "timestamp_ntz"))


def _time_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def time_column_null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, non-null, null, oldest and newest of every time column: one pass per table."""
    parts = []
    for name, df in tables.items():
        columns = _time_names(df)
        if not columns:
            continue
        one = df.agg(F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("total_rows"), F.count(c).alias("non_null_rows"),
            (F.count(F.lit(1)) - F.count(c)).alias("null_rows"), F.min(c).cast("timestamp_ntz").alias("oldest"),
            F.max(c).cast("timestamp_ntz").alias("newest")) for c in columns]).alias("_p"))
        parts.append(one.select(F.lit(name).alias("table_name"), F.inline("_p")))
    return reduce(DataFrame.unionByName, parts)


def key_uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per candidate key: rows, duplicated keys, rows with a null part, and whether it can serve as key.

    Rows are counted per key with map-side combine, so repeated keys shrink
    before the exchange.
    """
    parts = []
    for name, columns in keys.items():
        missing = any_of([F.col(c).isNull() for c in columns])
        grouped = tables[name].groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(grouped.agg(
            F.lit(name).alias("table_name"), F.lit(", ".join(columns)).alias("key_columns"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_rows")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("is_key", (F.col("duplicate_keys") == 0) & (F.col("null_rows") == 0))


SKETCH_ERROR = 0.02
SKETCHES = 64   # of one pass
CHANCE = 10     # pairs of rows that would meet if columns were independent: with fewer, being unique is no evidence
IDENTIFYING = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def minimal_keys(df: DataFrame, most: int = 3) -> list[tuple[str, ...]]:
    """All sets of up to `most` columns that are unique and have no null and no unique part, the likeliest first.

    Level by level: a set is looked at if none of its parts is a key and its columns' distinct values, multiplied, reach
    the number of rows; a sketch over all rows then tells sets that are far from unique, many sets a pass; what is left
    is counted exactly. Sets with so many possible combinations that rows drawn at random would hardly ever meet are left
    out: that they are unique says nothing. Measures (fractions) identify nothing and are left out. Likelier is a set of fewer columns, then
    one whose columns have fewer possible combinations, whole numbers before texts and times, columns further left first.
    """
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, IDENTIFYING)]
    if not columns:
        return []
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_c_{c}") for c in columns],
                 *[F.approx_count_distinct(c, SKETCH_ERROR).alias(f"_d_{c}") for c in columns]).first()
    rows, enough = one["_n"], one["_n"] * (1 - 4 * SKETCH_ERROR)
    if not rows:
        return []
    distinct = {c: one[f"_d_{c}"] for c in columns if one[f"_c_{c}"] == rows}
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, IDENTIFYING[:4])}
    found: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        sets = [s for s in itertools.combinations(distinct, size) if not any(set(k) <= set(s) for k in found)
                and enough <= math.prod(distinct[c] for c in s) and (size == 1 or math.prod(distinct[c] for c in s) <= rows * rows / (2 * CHANCE))]
        if size > 1:
            seen: dict[tuple[str, ...], int] = {}
            for at in range(0, len(sets), SKETCHES):
                part = sets[at:at + SKETCHES]
                seen.update(zip(part, df.agg(*[F.approx_count_distinct(F.xxhash64(*s), SKETCH_ERROR).alias(f"_{k}") for k, s in enumerate(part)]).first()))
            sets = [s for s in sets if seen[s] >= enough]
        found += [s for s in sets if df.groupBy(*s).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()]
    place = {c: k for k, c in enumerate(df.columns)}
    return sorted(found, key=lambda s: (len(s), math.prod(distinct[c] for c in s) if len(s) > 1 else rows, sum(c not in whole for c in s), [place[c] for c in s]))


def discover_keys(tables: Mapping[str, DataFrame], most: int = 2) -> dict[str, list[str]]:
    """The likeliest key of each table that has one."""
    found = {name: minimal_keys(df, most) for name, df in tables.items()}
    return {name: list(keys[0]) for name, keys in found.items() if keys}


def primary_keys(uniqueness: DataFrame) -> DataFrame:
    return uniqueness.where("is_key").select("table_name", F.col("key_columns").alias("primary_key"))


def rank_time_columns(candidates: DataFrame) -> DataFrame:
    """The best change column per table: by name, then alphabetically."""
    priority = F.lit(len(NAME_PRIORITY) + 1)
    for i, part in reversed(list(enumerate(NAME_PRIORITY, 1))):
        priority = F.when(F.col("column_name").ilike(f"%{part}%"), i).otherwise(priority)
    w = W.partitionBy("table_name").orderBy("_p", "column_name")
    return candidates.withColumn("_p", priority).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(
        "table_name", F.col("column_name").alias("incremental_column"))


def infer_table_config(spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(table_name, incremental_column, primary_key), columns with nulls and keys with duplicates rejected.

    Keys are those proposed in `keys`, or found on the data.
    """
    keys = keys if keys is not None else discover_keys(tables)
    names = spark.createDataFrame([(n,) for n in tables], "table_name string")
    usable = time_column_null_profile(tables).where((F.col("null_rows") == 0) & (F.col("total_rows") > 0))
    best = rank_time_columns(usable.select("table_name", "column_name"))
    confirmed = primary_keys(key_uniqueness(tables, keys))
    return names.join(best, "table_name", "left").join(confirmed, "table_name", "left").select(
        "table_name", F.coalesce("incremental_column", F.lit(NO_TIME)).alias("incremental_column"),
        F.coalesce("primary_key", F.lit(NO_KEY)).alias("primary_key")).orderBy("table_name")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for name, df in tables.items()])


def tables_without_time_column(meta: DataFrame) -> DataFrame:
    return meta.select("table_name").distinct().join(
        find_time_columns(meta).select("table_name").distinct(), "table_name", "left_anti").orderBy("table_name")


def time_column_patterns(meta: DataFrame, names: Sequence[str]) -> DataFrame:
    """In how many tables, and which, each of the usual change columns occurs."""
    found = find_time_columns(meta).where(F.col("column_name").isin(list(names)))
    return found.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("table_count"),
        F.array_join(F.array_sort(F.collect_set("table_name")), ", ").alias("tables")).orderBy(F.desc("table_count"), "column_name")


def composite_keys(uniqueness: DataFrame) -> DataFrame:
    parts = F.size(F.split("key_columns", ", "))
    return uniqueness.withColumn("pk_column_count", parts).where(F.col("pk_column_count") > 1)


def column_presence(meta: DataFrame, column: str) -> DataFrame:
    """Which tables have a column of this name."""
    has = meta.where(F.col("column_name") == column).select("table_name", "column_name", "data_type")
    return meta.select("table_name").distinct().join(has, "table_name", "left").withColumn(
        "status", F.when(F.col("column_name").isNotNull(), "✅ Has Column").otherwise("❌ MISSING")).orderBy("status", "table_name")


def config_validate(config: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per problem of an ingestion grid."""
    c = config.select(*[F.trim(F.coalesce(x, F.lit(""))).alias(x) for x in ("table_name", "incremental_column", "primary_key")])

    def issue(df: DataFrame, column: str, text: str) -> DataFrame:
        return df.select("table_name", F.col(column).alias("column_name"), F.lit(text).alias("issue"))

    blank = any_of([F.col(x) == "" for x in c.columns])
    rows = c.where(F.col("table_name") != "")
    known = rows.join(meta.select("table_name").distinct(), "table_name", "left_semi")
    typed = meta.select("table_name", F.col("column_name").alias("incremental_column"), "data_type")
    with_type = known.where(F.col("incremental_column") != "").join(typed, ["table_name", "incremental_column"], "left")
    key_parts = known.where(F.col("primary_key") != "").select(
        "table_name", F.explode(F.split("primary_key", r"\s*,\s*")).alias("column_name"))
    doubled = rows.groupBy("table_name").count().where("count > 1")
    parts = [
        issue(c.where(blank), "incremental_column", "blank value"),
        issue(rows.join(meta.select("table_name").distinct(), "table_name", "left_anti"), "table_name", "table not found"),
        issue(with_type.where(F.col("data_type").isNull()), "incremental_column", "incremental column not found"),
        issue(with_type.where(all_of([F.col("data_type").isNotNull(), ~F.col("data_type").isin("date", "timestamp", "timestamp_ntz")])),
              "incremental_column", "incremental column is not a date or timestamp"),
        issue(key_parts.join(meta.select("table_name", "column_name"), ["table_name", "column_name"], "left_anti"),
              "column_name", "key column not found"),
        issue(doubled, "table_name", "table listed more than once"),
    ]
    return reduce(DataFrame.unionByName, parts)
