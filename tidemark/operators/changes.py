"""De-duplication and full comparison of two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import all_of, any_of


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (),
                  newest: str = "last_modified_timestamp") -> DataFrame:
    """One row per key: the newest, ties broken by `order` or by all other columns.

    The filter on row_number = 1 becomes a window group limit, so every map
    task sends at most one row per key: a hot key costs no more than others.
    A hash leads the partition key, so the sort compares longs, and texts with
    a common prefix only where hashes meet. Rows with a null in their key are
    no copies of each other: each stays, under a number of its own, so that
    they are spread over all tasks.
    """
    rest = list(order) or [F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, newest)]
    window = W.partitionBy("_kh", *keys).orderBy(F.col(newest).desc_nulls_last(), *rest)
    keyless = any_of([F.col(k).isNull() for k in keys])
    return df.withColumn("_kh", F.when(keyless, F.monotonically_increasing_id()).otherwise(F.xxhash64(*keys))).withColumn("_rn", F.row_number().over(window)).where(
        F.col("_rn") == 1).drop("_kh", "_rn")


def repeated_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, each once with its count `copies`.

    A first pass shuffles 8 bytes per row: only rows whose hash repeats are
    then compared in full, so wide rows do not cross the network.
    """
    hashed = df.withColumn("_h", F.xxhash64(*df.columns))
    suspects = hashed.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h")
    return hashed.join(suspects, "_h", "left_semi").drop("_h").groupBy(*df.columns).agg(
        F.count("*").alias("copies")).where("copies > 1")


def same(a: str, b: str, columns: Sequence[str]) -> Column:
    return all_of([F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def detect_changes(master: DataFrame, compare: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   indicator: str = "change_type") -> DataFrame:
    """Full comparison: N only in master, D only in compare, C differing, I identical.

    Output: the keys, the indicator, master_* and compare_* for every other
    column. One exchange per side on the keys; both sides hold one row per
    key, so no partition can be hot.
    """
    m = master.withColumn("_m", F.lit(True)).alias("m")
    c = compare.withColumn("_c", F.lit(True)).alias("c")
    joined = m.join(c, all_of([F.col(f"m.{k}") == F.col(f"c.{k}") for k in keys]), "full_outer")
    kind = (F.when(F.col("c._c").isNull(), "N").when(F.col("m._m").isNull(), "D")
            .when(same("m", "c", columns), "I").otherwise("C"))
    return joined.select(
        *[F.coalesce(F.col(f"m.{k}"), F.col(f"c.{k}")).alias(k) for k in keys],
        kind.alias(indicator),
        *[F.col(f"m.{n}").alias(f"master_{n}") for n in master.columns if n not in keys],
        *[F.col(f"c.{n}").alias(f"compare_{n}") for n in compare.columns if n not in keys])
