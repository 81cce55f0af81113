"""Reading tables: by name, by file pattern, over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.watermark import watermark_filter


def scan_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Chosen columns of a catalog table, or of a Parquet folder when `name` is a path."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def load_parquet_by_name(spark: SparkSession, path: str, pattern: str, target: T.StructType) -> DataFrame:
    """Files matching a glob, matched to the target schema by column name whatever the case.

    Missing columns become null, extra ones are dropped, an unreadable file
    fails the load, and the files stay where they are.
    """
    df = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "false").option(
        "mergeSchema", "true").parquet(path)
    by_lower: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in by_lower:
            raise ValueError(f"columns {by_lower[c.lower()]!r} and {c!r} differ in case only")
        by_lower[c.lower()] = c
    return df.select(*[
        (F.col(f"`{by_lower[f.name.lower()]}`") if f.name.lower() in by_lower else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in target.fields])


def jdbc_options(url: str, table: str, *, schema: str | None = None, columns: Sequence[str] | None = None,
                 split_column: str | None = None, bounds: tuple | None = None, partitions: int = 1,
                 fetch_size: int = 10000, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options for one relational table; a split column makes the read parallel."""
    full = f"{schema}.{table}" if schema else table
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if columns:
        options["dbtable"] = f"(SELECT {', '.join(columns)} FROM {full}) AS src"
    else:
        options["dbtable"] = full
    if split_column:
        if not bounds:
            raise ValueError("a split column needs its lower and upper bound")
        options.update(partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                       numPartitions=str(partitions))
    return options


def jdbc_read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """One relational table; filters and columns used later are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def incremental_read(source: DataFrame, column: str, mark: str | None, default: str = "1990-01-01 00:00:00") -> DataFrame:
    """Rows of a JDBC or file source after the mark; the literal predicate is pushed to the source."""
    return watermark_filter(source, column, mark or default)


CONFIG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("incremental_column", T.StringType()),
    T.StructField("primary_key", T.StringType()),
])


def config_read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (table_name, incremental_column, primary_key) of the ingestion grid."""
    raw = spark.read.schema(CONFIG_SCHEMA).option("header", "true").option("mode", "FAILFAST").csv(path)
    return raw.select(*[F.trim(c).alias(c) for c in raw.columns])


FOOTER_BYTES = 1 << 20  # a Parquet file without rows is no more than its footer


def file_checks(spark: SparkSession, path: str, name_regex: str, as_of: str, recent_days: int = 1, pattern: str = "*") -> DataFrame:
    """Every file below a landing folder: rows, size, name pattern, age, and whether it can be read as Parquet.

    Files are counted from their footers, all in one job, and an unreadable one is a value, not a failure. A file that
    gives no row is readable if it is small and bounded by the format's marks: an empty table. A file without a byte
    has no age.
    """
    def uri(column: str) -> Column:
        return F.regexp_replace(column, r"^(\w+):/+", "$1:/")

    everything = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    # the listing itself: a reader passes over files without a byte
    names = spark.createDataFrame([(f,) for f in everything.inputFiles()], "path string").select(uri("path").alias("path"))
    listed = everything.select(uri("_metadata.file_path").alias("path"), "length", "modificationTime", "content")
    rows = (spark.read.schema("_none string").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "true")
            .parquet(path).groupBy(uri("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_rows")))
    mark = F.lit(bytearray(b"PAR1"))
    whole = listed.where(F.col("length") <= FOOTER_BYTES).select(
        "path", ((F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)).alias("_whole"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("modificationTime"))
    name = F.url_decode(F.replace(F.regexp_extract("path", r"[^/]+$", 0), F.lit("+"), F.lit("%2B")))
    size = F.coalesce("length", F.lit(0))
    return names.join(listed.drop("content"), "path", "left").join(rows, "path", "left").join(whole, "path", "left").select(
        name.alias("file_name"), "path", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), size.alias("bytes"),
        (size > 0).alias("not_empty"),
        name.rlike(name_regex).alias("name_ok"),
        F.coalesce(age <= recent_days, F.lit(False)).alias("is_recent"),
        (F.col("n_rows").isNotNull() | F.coalesce("_whole", F.lit(False))).alias("readable"))
