"""Archiving by age."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import day

if TYPE_CHECKING:
    from ..sources.versions import VersionedTable

# Days a layer keeps its rows (fixed values).
LAYER_DAYS = {"raw": 7, "bronze": 14, "silver": 30}


def is_old(column: str, days: int, as_of) -> Column:
    """Rows without a time are not old."""
    return F.coalesce(F.col(column) < F.date_sub(day(as_of), days).cast("timestamp_ntz"), F.lit(False))


def split_by_age(df: DataFrame, column: str, days: int, as_of) -> tuple[DataFrame, DataFrame]:
    """(to archive, to keep); rows without a time are kept."""
    old = is_old(column, days, as_of)
    return df.where(old), df.where(~old)


def archive(table: VersionedTable, column: str, days: int, as_of, elsewhere: str | None = None) -> int:
    """Move the rows of a published table that are older than `days` to its archive; the version after it.

    Both sides change by one pointer, so a run that dies leaves the table as it was, and one run twice moves nothing twice.
    """
    return table.archive(lambda df: df.withColumn("_old", is_old(column, days, as_of)), elsewhere)


def archive_layers(tables: dict[str, tuple[VersionedTable, str]], as_of, layer_days: dict[str, int] | None = None) -> DataFrame:
    """Archive each layer by its own days; rows on both sides, as read back."""
    limits = layer_days or LAYER_DAYS
    out = None
    for layer, (table, column) in tables.items():
        archive(table, column, limits[layer], as_of)
        sides = []
        for name, rows in (("archive_rows", table.archived()), ("keep_rows", table.read())):
            sides.append(rows.agg(F.count(F.lit(1)).alias(name)) if rows is not None else table.spark.range(1).select(F.lit(0).cast("bigint").alias(name)))
        part = sides[0].select(F.lit(layer).alias("layer"), F.lit(limits[layer]).alias("retention_days"), "archive_rows",
                               sides[1].scalar().alias("keep_rows"))
        out = part if out is None else out.unionByName(part)
    return out
