"""Row rules counted once a partition: a run of checks scans the partitions that are new or were written anew."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.versions import VersionedTable
from .quality import RESULT_COLUMNS, Check, Tables, evaluate

STATE = "table_name string, part string, check_id string, rule string, signature string, violations long"
STATE_KEYS = ["table_name", "part", "check_id"]


@dataclass(frozen=True)
class Partitioned:
    """A published table whose folders are partitioned by `column`; loads add or replace whole folders.

    A table merged by key is refused: there a row of a folder need not be a row of the table.
    """

    table: VersionedTable
    column: str

    def folders(self) -> list[tuple[str, T.StructType]]:
        """Where the table's rows are, with the columns there."""
        parts = self.table.manifest().of("rows", "base", "delta")
        if any(p.kind != "rows" or self.column not in p.by for p in parts):
            raise ValueError(f"{self.table.root} is not made of folders by {self.column}")
        return [(self.table.at(p.folder), T.StructType.fromJson(json.loads(p.schema))) for p in parts]

    def part(self):
        """A row's or file's partition, as the path spells it."""
        return F.regexp_extract("_metadata.file_path", f"/{self.column}=([^/]*)/", 1)

    def files(self, spark: SparkSession) -> DataFrame:
        """(part, signature): what files a partition has, from the listing alone; no file is opened."""
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(
            [path for path, _ in self.folders()])
        one = F.xxhash64("_metadata.file_path", "_metadata.file_size", F.col("_metadata.file_modification_time").cast("long"))
        return listed.select(self.part().alias("part"), one.alias("file")).groupBy("part").agg(
            F.concat_ws("-", F.count(F.lit(1)), F.bit_xor("file")).alias("signature"))

    def rows(self, spark: SparkSession, parts: Sequence[str]) -> DataFrame:
        """Rows of some partitions; the condition is on the files' paths, so no other file is opened."""
        found = [spark.read.schema(schema).parquet(path).withColumn("_part", self.part()).where(self.part().isin(list(parts)))
                 for path, schema in self.folders()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def is_row_rule(tables: Tables, check: Check) -> bool:
    """Whether a check counts rows that each break a condition by itself: no comparison with a whole table or with the clock."""
    if check.violates is None:
        return False
    condition = check.violates(tables)
    plan = tables[check.table].select(condition)._jdf.queryExecution().analyzed()
    return plan.subqueriesAll().isEmpty() and "current_" not in str(condition)


class CheckStates:
    """Violations by table, partition and check, each with the rule's text and the partition's files it was counted for.

    A count holds as long as both are the same: a partition with other files
    and a rule with another condition (also another day in it) are counted
    again, all others are added up from here. Counts are published after the
    scan, so a run that dies is simply run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.states = spark, VersionedTable(spark, root)

    def _known(self) -> DataFrame:
        known = self.states.read()
        return self.spark.createDataFrame([], STATE) if known is None else known

    def refresh(self, tables: Tables, name: str, stored: Partitioned, checks: Sequence[Check]) -> dict[str, int]:
        """Count what is not known yet; returns the partitions scanned and the number of checks counted in each."""
        rules = self.spark.createDataFrame([(c.check_id, str(c.violates(tables))) for c in checks], "check_id string, rule string")
        files = stored.files(self.spark)
        known = self._known().where(F.col("table_name") == name)
        due = files.crossJoin(F.broadcast(rules)).join(known, ["part", "check_id", "rule", "signature"], "left_anti")
        wanted: dict[str, list[str]] = {r["part"]: sorted(r["ids"]) for r in due.groupBy("part").agg(F.collect_set("check_id").alias("ids")).collect()}
        gone = known.select("part", "check_id").join(files, "part", "left_anti").select(F.lit(name).alias("table_name"), "part", "check_id")
        scans: dict[tuple[str, ...], list[str]] = {}
        for part, ids in wanted.items():
            scans.setdefault(tuple(ids), []).append(part)
        counted = [self._counted(tables, stored, [c for c in checks if c.check_id in ids], parts) for ids, parts in scans.items()]
        empty = self.spark.createDataFrame([], STATE)
        if not counted and gone.isEmpty():
            return {}
        fresh = empty
        if counted:
            fresh = reduce(DataFrame.unionByName, counted).join(F.broadcast(rules), "check_id").join(files, "part").select(
                F.lit(name).alias("table_name"), "part", "check_id", "rule", "signature", "violations")
        self.states.merge(fresh, STATE_KEYS, load=f"checks of {name}", gone=gone)
        return {part: len(ids) for part, ids in wanted.items()}

    def _counted(self, tables: Tables, stored: Partitioned, checks: Sequence[Check], parts: Sequence[str]) -> DataFrame:
        """One scan of these partitions for these checks, one row for each pair."""
        one = stored.rows(self.spark, parts).groupBy(F.col("_part").alias("part")).agg(
            *[F.count_if(c.violates(tables)).alias(c.check_id) for c in checks])
        return one.select("part", F.inline(F.array(*[F.struct(F.lit(c.check_id).alias("check_id"), F.col(c.check_id).alias("violations")) for c in checks])))

    def results(self, name: str, checks: Sequence[Check]) -> DataFrame:
        """Result rows of checks from the counts; 0 for a table without rows."""
        total = {r["check_id"]: r["n"] for r in self._known().where(F.col("table_name") == name).groupBy("check_id").agg(
            F.sum("violations").alias("n")).collect()}
        rows = [(c.check_id, float(total.get(c.check_id, 0)), float(c.expected)) for c in checks]
        status = reduce(lambda otherwise, c: F.when(F.col("check_id") == c.check_id, c.status(F.col("actual_value"))).otherwise(otherwise), checks, F.lit(None))
        return self.spark.createDataFrame(rows, "check_id string, actual_value double, expected_value double").withColumn(
            "check_status", status).select(*RESULT_COLUMNS)

    def evaluate(self, tables: Tables, checks: Sequence[Check], stored: Mapping[str, Partitioned]) -> DataFrame:
        """What `quality.evaluate` gives: row rules of stored tables from their counts, everything else as there."""
        by_rows = {c.check_id for c in checks if c.table in stored and is_row_rule(tables, c)}
        rest = [c for c in checks if c.check_id not in by_rows]
        out = [evaluate(tables, rest)] if rest else []
        for name in sorted({c.table for c in checks if c.check_id in by_rows}):
            mine = [c for c in checks if c.check_id in by_rows and c.table == name]
            self.refresh(tables, name, stored[name], mine)
            out.append(self.results(name, mine))
        return reduce(DataFrame.unionByName, out)
