"""Tables stored with a two-level digest tree, so that a comparison reads only the buckets that differ."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.expressions import any_of
from .changes import detect_changes

GROUP, LEAF = "_group", "_leaf"
LEAF_ROWS = 100_000
MAX_LEAVES = 65_536
DIGEST = ["n", "low", "high"]


def leaves_for(rows: int) -> int:
    """Leaves of about LEAF_ROWS rows, a power of four, so that the tree is as wide above as below."""
    return min(MAX_LEAVES, 4 ** max(1, math.ceil(math.log(max(1, rows) / LEAF_ROWS, 4))))


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row. Nulls are hashed as flags of their own, since the hash itself skips them."""
    return F.xxhash64(F.lit(seed), *[F.col(c).isNull() for c in columns], *[F.col(c) for c in columns])


def digest(columns: Sequence[str]) -> list[Column]:
    """Rows and 128 bits of them. Exclusive or does not depend on the order, combines in every map task, and undoes itself."""
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(row_hash(columns, 1)).alias("low"), F.bit_xor(row_hash(columns, 2)).alias("high")]


def _combined() -> list[Column]:
    return [F.sum("n").alias("n"), F.bit_xor("low").alias("low"), F.bit_xor("high").alias("high")]


def _differing(a: DataFrame, b: DataFrame, by: str) -> list[int]:
    """Numbers of the buckets whose digests differ or that one side lacks; one row a bucket, so bounded by MAX_LEAVES."""
    joined = a.alias("a").join(b.alias("b"), F.col(f"a.{by}") == F.col(f"b.{by}"), "full_outer")
    unlike = any_of([~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DIGEST])
    return sorted(r[0] for r in joined.where(unlike).select(F.coalesce(f"a.{by}", f"b.{by}")).collect())


@dataclass(frozen=True)
class DigestedTable:
    """Rows by leaf in folders by group, one digest a leaf and one a group, below `path`.

    The description is written last: a folder without it is an unfinished
    table, which `open` refuses. Rows hold each key once, and no null in it.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    n_leaves: int
    schema: T.StructType

    @classmethod
    def write(cls, df: DataFrame, path: str, keys: Sequence[str], n_leaves: int | None = None) -> "DigestedTable":
        """Deal rows out by the hash of their key and write them with their tree, which is taken from the written rows.

        `n_leaves` defaults to what the number of rows asks for; tables to be compared need the same. A leaf holds a
        range of key hashes, so no key makes it hot. Maps cannot be hashed and are refused by Spark.
        """
        n_leaves = n_leaves or leaves_for(df.count())
        wide = math.isqrt(n_leaves)
        if wide * wide != n_leaves or n_leaves > MAX_LEAVES:
            raise ValueError(f"{n_leaves} leaves are no square number up to {MAX_LEAVES}")
        table = cls(df.sparkSession, path.rstrip("/"), tuple(keys), n_leaves, df.schema)
        dealt = df.withColumn(LEAF, F.pmod(F.xxhash64(*keys), F.lit(n_leaves)).cast("int"))
        dealt = dealt.withColumn(GROUP, F.floor(F.col(LEAF) / wide).cast("int"))
        dealt.hint("rebalance", GROUP).sortWithinPartitions(GROUP, LEAF).write.partitionBy(GROUP).parquet(f"{table.path}/rows")
        table._rows().groupBy(GROUP, LEAF).agg(*digest(df.columns)).write.parquet(f"{table.path}/leaves")
        table.leaves().groupBy(GROUP).agg(*_combined()).write.parquet(f"{table.path}/groups")
        about = [(list(keys), n_leaves, df.schema.json())]
        df.sparkSession.createDataFrame(about, "keys array<string>, n_leaves int, schema string").write.parquet(f"{table.path}/about")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "DigestedTable":
        path = path.rstrip("/")
        about = spark.read.schema("keys array<string>, n_leaves int, schema string").parquet(f"{path}/about").first()
        if about is None:
            raise ValueError(f"{path} holds no finished table")
        return cls(spark, path, tuple(about["keys"]), about["n_leaves"], T.StructType.fromJson(json.loads(about["schema"])))

    def _rows(self) -> DataFrame:
        fields = [*self.schema.fields, T.StructField(LEAF, T.IntegerType()), T.StructField(GROUP, T.IntegerType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/rows")

    def _tree(self, level: str) -> DataFrame:
        return self.spark.read.schema(f"{GROUP} int, {LEAF} int, n long, low long, high long").parquet(f"{self.path}/{level}")

    def leaves(self) -> DataFrame:
        return self._tree("leaves")

    def groups(self) -> DataFrame:
        return self._tree("groups").drop(LEAF)

    def read(self, leaves: Sequence[int] | None = None, without: bool = False) -> DataFrame:
        """All rows, or those of some leaves (`without`: of the others). Groups are pruned as folders, leaves by file statistics."""
        rows = self._rows()
        if leaves is not None:
            chosen = F.col(LEAF).isin(list(leaves))
            groups = sorted({x // math.isqrt(self.n_leaves) for x in leaves})
            rows = rows.where(~chosen) if without else rows.where(F.col(GROUP).isin(groups) & chosen)
        return rows.drop(LEAF, GROUP)

    def differing(self, other: "DigestedTable") -> list[int]:
        """Leaves whose rows are not the same on both sides: groups are compared first, then the leaves of unlike groups."""
        if (self.n_leaves, self.keys, self.schema.simpleString()) != (other.n_leaves, other.keys, other.schema.simpleString()):
            raise ValueError("tables with other keys, columns, types or numbers of leaves have no digests in common")
        groups = _differing(self.groups(), other.groups(), GROUP)
        if not groups:
            return []
        return _differing(*[t.leaves().where(F.col(GROUP).isin(groups)) for t in (self, other)], LEAF)


def changes_by_digest(master: DigestedTable, compare: DigestedTable, indicator: str = "change_type", identical: bool = True) -> DataFrame:
    """What `detect_changes` says of two tables, with a join of the differing leaves only.

    Rows of equal leaves are identical ones: with `identical` they come from
    the master side alone, without an exchange, else they are not read at all.
    """
    keys = list(master.keys)
    columns = [c for c in master.schema.fieldNames() if c not in keys]
    leaves = master.differing(compare)
    out = detect_changes(master.read(leaves), compare.read(leaves), keys, columns, indicator)
    if not identical:
        return out.where(F.col(indicator) != "I")
    calm = master.read(leaves, without=True)
    return out.unionByName(calm.select(*keys, F.lit("I").alias(indicator), *[F.col(c).alias(f"master_{c}") for c in columns],
                                       *[F.col(c).alias(f"compare_{c}") for c in columns]))


def reconcile(name: str, master: DigestedTable, compare: DigestedTable) -> DataFrame:
    """One row: rows only in one of the tables, differing and equal ones. Counts of equal leaves come from their digests."""
    kinds = changes_by_digest(master, compare, "kind", identical=False).groupBy().agg(
        *[F.count_if(F.col("kind") == k).alias(n) for k, n in (("N", "only_master"), ("D", "only_compare"), ("C", "differing"))])
    total = master.groups().agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return kinds.select(F.lit(name).alias("table_name"), "only_master", "only_compare", "differing",
                        (total - F.col("only_master") - F.col("differing")).alias("same"))
