"""Semi-structured rows to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def flatten_json(df: DataFrame, raw: str, paths: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns {name: (json path, type)} from a JSON text column.

    `is_malformed` marks text that does not parse. Values that do not fit
    their type become null. Filter on the mark to set bad rows aside.
    """
    parsed = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    return parsed.select(
        *keep,
        *[F.try_variant_get("_v", path, kind).alias(name) for name, (path, kind) in paths.items()],
        (F.col(raw).isNotNull() & F.col("_v").isNull()).alias("is_malformed"),
        F.col(raw).alias(raw))


def json_validation_issues(df: DataFrame, raw: str, record: str, required: Sequence[str], table: str, run_ts) -> DataFrame:
    """One row per failing record and path: malformed text, or a required path that is missing or null."""
    parsed = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    malformed = F.col(raw).isNull() | F.col("_v").isNull()

    def issue(path: str, error: str):
        return F.struct(F.lit(path).alias("json_path"), F.lit(error).alias("validation_error"))

    candidates = [F.when(malformed, issue("$", "malformed JSON"))]
    candidates += [F.when(~malformed & F.try_variant_get("_v", p, "string").isNull(), issue(p, "required path missing"))
                   for p in required]
    return parsed.withColumn("_issues", F.array_compact(F.array(*candidates))).where(F.size("_issues") > 0).select(
        F.lit(table).alias("table_name"), F.lit(run_ts).cast("timestamp_ntz").alias("validation_timestamp"),
        F.col(record).cast("string").alias("record_identifier"), F.inline("_issues"), F.col(raw).alias("raw_data"),
        F.lit("OPEN").alias("resolution_status"))
