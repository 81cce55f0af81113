"""Exact de-duplication by Grace hashing.

Texts are equal when identical after every run of ASCII white space became one space. Two steps compare complete
contents in open-addressing tables:

1. In each input split a bounded table absorbs repeated texts as they stream by. Every row gets the number of its
   table entry, so a text that fills a third of the input leaves one entry for each split. A full table is emptied
   and started again: the step only pre-aggregates.
2. The entries are dealt out by the SHA-256 of their text. Each task fills a table up to a byte budget; further
   contents go to spill files by the next bits of their hash, and each file is treated in the same way until it
   fits. Texts already in the table never spill, so copies cannot make a bucket too large.

Ids, counts and the row that stays are then narrow joins and sums on entry numbers. The spill files are private to a
running task, as Spark's own spills are, and go with it; a repeated task writes its own.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

ABSORB_BYTES = 32 << 20   # texts a split's table holds before it is emptied
TABLE_BYTES = 64 << 20    # texts a bucket's table holds before contents spill
FAN_OUT = 16              # spill files of one level


class Table:
    """Open addressing with linear probing from a hash to a complete content."""

    def __init__(self):
        self.slots, self.hashes, self.contents, self.bytes = [-1] * 1024, [], [], 0

    def place(self, key: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where it is or belongs)"""
        slots, hashes, mask = self.slots, self.hashes, len(self.slots) - 1
        at = key & mask
        while (e := slots[at]) >= 0:
            if hashes[e] == key and self.contents[e] == content:
                return e, at
            at = (at + 1) & mask
        return -1, at

    def insert(self, slot: int, key: int, content: bytes) -> int:
        e = len(self.hashes)
        self.hashes.append(key)
        self.contents.append(content)
        self.slots[slot] = e
        self.bytes += len(content) + 200
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return e

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for e, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


class Spill:
    """FAN_OUT files of records, chosen by bits of a hash that differ at each level."""

    def __init__(self, folder: str, level: int):
        self.level, self.folder, self.files = level, tempfile.mkdtemp(prefix=f"level{level}-", dir=folder), {}

    def add(self, key: int, record) -> None:
        k = (key * 0x9E3779B97F4A7C15 + self.level * 0xD1B54A32D192ED03 >> 40) % FAN_OUT
        if k not in self.files:
            self.files[k] = open(os.path.join(self.folder, str(k)), "wb")
        pickle.dump(record, self.files[k], pickle.HIGHEST_PROTOCOL)

    def close(self) -> list[tuple[int, str]]:
        for f in self.files.values():
            f.close()
        return [(self.level + 1, f.name) for f in self.files.values()]


def _records(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                break
    os.unlink(path)


def grace_groups(records: Iterable[tuple[int, bytes, int]], budget: int = TABLE_BYTES) -> Iterator[tuple[int, int]]:
    """(payload, payload of the first record with the same content) for records (hash, content, payload).

    Every level keeps `budget` bytes of contents in memory and settles them, so levels end even where all hashes
    are equal.
    """
    folder = None
    try:
        waiting: list[tuple[int, str | None]] = [(0, None)]
        while waiting:
            level, path = waiting.pop()
            table, first, spill = Table(), [], None
            for key, content, payload in records if path is None else _records(path):
                e, slot = table.place(key, content)
                if e >= 0:
                    yield payload, first[e]
                elif spill is None and (not first or table.bytes + len(content) <= budget):
                    table.insert(slot, key, content)
                    first.append(payload)
                    yield payload, payload
                else:
                    if spill is None:
                        folder = folder or tempfile.mkdtemp(prefix="grace-")
                        spill = Spill(folder, level)
                    spill.add(key, (key, content, payload))
            if spill is not None:
                waiting += spill.close()
    finally:
        if folder:
            with contextlib.suppress(OSError):
                shutil.rmtree(folder)


def normalised(column: pa.Array) -> list[bytes]:
    """Texts with each run of ASCII white space as one space; single spaces need no replacement."""
    return common.texts(pc.replace_substring_regex(column, pattern=r"[ \t-\r]{2,}|[\t-\r]", replacement=" "))


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little")


def _absorb(text: str, names: list[str], budget: int):
    def run(batches):
        number = (TaskContext.get().partitionId() << 36) if TaskContext.get() else 0
        table, entries = Table(), []
        for batch in batches:
            rids, own, digests, firsts = [], [], [], []
            for content in normalised(batch.column(text)):
                digest = hashlib.sha256(content).digest()
                key = _key(digest)
                e, slot = table.place(key, content)
                if first := e < 0:
                    if table.bytes > budget:
                        table, entries = Table(), []
                        e, slot = table.place(key, content)
                    e = table.insert(slot, key, content)
                    entries.append(number)
                rids.append(number)
                own.append(entries[e])
                digests.append(digest)
                firsts.append(first)
                number += 1
            yield common.append(batch, dict(zip(names, (
                pa.array(rids, pa.int64()), pa.array(own, pa.int64()), pa.array(digests, pa.binary()), pa.array(firsts, pa.bool_())))))
    return run


def _settle(budget: int):
    def records(batches):
        for batch in batches:
            for content, digest, entry in zip(normalised(batch.column("text")), batch.column("digest").to_pylist(),
                                              batch.column("entry").to_pylist()):
                yield _key(digest), content, entry

    def run(batches):
        rows: list[tuple[int, int]] = []
        for pair in grace_groups(records(batches), budget):
            rows.append(pair)
            if len(rows) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["entry", "class"])
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["entry", "class"])
    return run


def classes(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", absorb_bytes: int = ABSORB_BYTES,
            table_bytes: int = TABLE_BYTES) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """(rows of `df` with their entry, one row per entry with its group, names of the added row columns)."""
    added = {k: common.free_name(df, k) for k in ("rid", "entry", "digest", "first")}
    schema = T.StructType(df.schema.fields + [
        T.StructField(added["rid"], T.LongType()), T.StructField(added["entry"], T.LongType()),
        T.StructField(added["digest"], T.BinaryType()), T.StructField(added["first"], T.BooleanType())])
    rows = common.staged(df.mapInArrow(_absorb(text_column, list(added.values()), absorb_bytes), schema), "dedup-rows")
    rid, entry, digest, first = (F.col(added[k]) for k in ("rid", "entry", "digest", "first"))
    owner = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), rid.alias("rid"))
    counts = rows.groupBy(entry.alias("entry")).agg(F.min(owner).alias("owner"), F.count(F.lit(1)).alias("n"))
    settled = common.staged(
        rows.where(first).select(entry.alias("entry"), digest.alias("digest"), F.col(text_column).alias("text")).repartition("digest")
        .mapInArrow(_settle(table_bytes), "entry long, class long"), "dedup-classes")
    groups = settled.join(counts, "entry").groupBy("class").agg(F.min("owner").alias("owner"), F.sum("n").alias("group_size"))
    members = settled.join(groups, "class").select(
        "entry", F.col("owner.id").alias("keep_id"), F.col("owner.rid").alias("keep_rid"), "group_size")
    return rows, members, added


def exact_dedup(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **budgets) -> DataFrame:
    """Every row of `df` with keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the smallest id stays; ids that are null come last, and of equal ids exactly one row
    stays. A null text counts as empty and is equal to one of white space only if both normalise alike (" " is not
    empty). Columns of `df` named like an output give way to it. An empty table gives an empty result.
    """
    df = common.without(df, "keep_id", "group_size", "kept", "text_sha256")
    rows, members, added = classes(df, id_column, text_column, **budgets)
    joined = rows.join(members.withColumnRenamed("entry", "_entry"), F.col(added["entry"]) == F.col("_entry"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], "keep_id", "group_size",
                         (F.col(added["rid"]) == F.col("keep_rid")).alias("kept"),
                         F.lower(F.hex(F.col(added["digest"]))).alias("text_sha256"))


def keep_first(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **budgets) -> DataFrame:
    """The rows of `df` that stay, with its columns."""
    rows, members, added = classes(df, id_column, text_column, **budgets)
    stay = members.select("keep_rid").distinct()
    return rows.join(stay, rows[added["rid"]] == stay["keep_rid"], "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    rows, members, added = classes(docs)
    return rows.join(members.withColumnRenamed("entry", "_entry"), F.col(added["entry"]) == F.col("_entry")).select(
        "doc_id", "keep_id", "group_size", (F.col(added["rid"]) == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex(F.col(added["digest"]))).alias("text_sha256"))


QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLE = {"op6_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)"""}
