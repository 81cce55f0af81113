"""Token ids as Parquet list columns.

Documents are dealt out by ranges of their id, encoded, and written with the ids as one dictionary- or delta-encoded
list column beside narrow columns, in row groups and pages of set sizes with page indexes. A reader of doc_id, n_tokens
or places touches no token; a reader of some documents finds their pages by the index on doc_id, which is in order
within and across files.

Each distinct word is encoded once a worker, by the tokenizers library: the vocabulary's rules drop white space and
let no token cross it, so the ids of a text are those of its words, one after another. They also cut words into runs of
letters, single digits and runs of other signs, in lower case: words of ASCII (no apostrophe) and Latin-1 letters are cut
here, and of those pieces each distinct one is encoded once, by a copy of the tokenizer that leaves out what is done.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark import session

from . import common

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
# Page and row group sizes of the token files; 16-bit ids need two bytes, so a row group holds some ten million.
LAYOUT = {"parquet.block.size": str(32 << 20), "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "4000",
          "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20), "parquet.writer.version": "v2", "compression": "zstd"}
_CHUNK = 10_000  # new words handed to the library at once
MEMO_BYTES = 192 << 20  # of words and ids that a worker remembers before it starts afresh; pieces stay while they are half of it or less
WORD_BYTES = 160        # of a remembered word, or piece of words, besides its letters and ids


@lru_cache(maxsize=2)
def tokenizer(path: str | None = None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


_LETTER = r"a-z\u00DF-\u00F6\u00F8-\u00FF"
_PLAIN = re.compile(rf"[!-&(-@\[-~{_LETTER}]+").fullmatch  # lower-case Latin-1 letters and ASCII signs but the apostrophe
_PIECES = re.compile(rf"[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+").findall
# What the cutting stands for; a vocabulary with other rules has its words encoded whole.
_RULES = ([{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
          {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"})


@lru_cache(maxsize=2)
def piece_tokenizer(path: str | None = None):
    """A copy of the tokenizer for pieces of words that are normal and cut already, or None where its rules are others."""
    from tokenizers import Tokenizer
    rules = json.loads(tokenizer(path).to_str())
    steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    if ((rules["normalizer"] or {}).get("normalizers") != _RULES[0] or [s["type"] for s in steps] != ["Split", "ByteLevel"]
            or steps[0]["pattern"] != _RULES[1] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"]
            or steps[1]["add_prefix_space"] or steps[1]["use_regex"] or any("<|" not in t["content"] for t in rules["added_tokens"])):
        return None
    rules["normalizer"], rules["pre_tokenizer"]["pretokenizers"], rules["added_tokens"] = None, steps[1:], []
    rules["post_processor"] = None
    return Tokenizer.from_str(json.dumps(rules))


def _encoded(tokenizer, texts: list[str]) -> list[bytes]:
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    ends = [0, *itertools.accumulate(map(len, found))]
    ids = np.fromiter(itertools.chain.from_iterable(found), np.int32, ends[-1]).tobytes()
    return [ids[4 * a:4 * b] for a, b in itertools.pairwise(ends)]


class WordEncoder:
    """Ids of texts, by way of their words."""

    def __init__(self, path: str | None = None):
        self.tokenizer, self.cutter = tokenizer(path), piece_tokenizer(path)
        self.pieces: dict[str, bytes] = {}
        self.held_pieces = 0
        self._reset()

    def _reset(self) -> None:
        if self.held_pieces > MEMO_BYTES // 2:
            self.pieces, self.held_pieces = {}, 0
        self.words, self.held = common.Words(self._encode), self.held_pieces
        self.ids, self.ends = common.Growing(np.int32), common.Growing(np.int64)
        self.ends.extend([0])

    def _encode(self, new: list[bytes]) -> None:
        for k in range(0, len(new), _CHUNK):
            found = self._ids([w.decode("utf-8", "replace") for w in new[k:k + _CHUNK]])
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            self.ids.extend(np.frombuffer(b"".join(found), np.int32))
            self.ends.extend(self.ends.values[-1] + np.cumsum(lengths))
            self.held += 4 * int(lengths.sum())
        self.held += sum(map(len, new)) + WORD_BYTES * len(new)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as 32-bit integers."""
        lower = [w.lower() for w in words]
        cut = [_PIECES(low) if self.cutter and _PLAIN(low) and "<|" not in low and ord(max(w)) < 256 else None for w, low in zip(words, lower)]
        pieces = list(dict.fromkeys(p for c in cut if c for p in c if p not in self.pieces))
        if pieces:
            self.pieces.update(zip(pieces, found := _encoded(self.cutter, pieces)))
            more = sum(map(len, found)) + sum(map(len, pieces)) + WORD_BYTES * len(pieces)
            self.held, self.held_pieces = self.held + more, self.held_pieces + more
        whole = iter(_encoded(self.tokenizer, [w for w, c in zip(words, cut) if c is None]))
        return [next(whole) if c is None else b"".join([self.pieces[p] for p in c]) for c in cut]

    def encode(self, texts: list[bytes] | pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with its end, and the places where texts end)"""
        if self.held > MEMO_BYTES:
            self._reset()
        flat, offsets = self.words.of_texts(common.binary(texts))
        starts, lengths = self.ends.values[flat], np.diff(self.ends.values)[flat] if len(flat) else np.zeros(0, np.int64)
        total = int(lengths.sum())
        done = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids.values[np.repeat(starts - done[:-1], lengths) + np.arange(total)] if total else np.zeros(0, np.int32)
        bounds = done[offsets[1:]]
        return np.insert(ids, bounds, end_id), bounds + np.arange(1, len(texts) + 1)


@lru_cache(maxsize=1)
def remembered(path: str | None = None) -> WordEncoder:
    """A worker's encoder: the words it has seen outlive its tasks."""
    return WordEncoder(path)


def _encode(path: str | None, end_id: int):
    def run(batches):
        own, number, at = remembered(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, ends = own.encode(batch.column("text"), end_id)
            bounds = np.concatenate(([0], ends))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(batch.num_rows, number, np.int64)), pa.array(at + bounds[:-1]),
                pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))],
                names=["doc_id", "file", "at", "n_tokens", "ids"])
            at += int(bounds[-1])
    return run


def write_token_files(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None,
                      end_id: int = END_ID, layout: dict[str, str] | None = None) -> None:
    """Encode the texts of `df` and write them below `path`, in ascending id (nulls first, equal ids by text).

    A file's rows have doc_id, file (number in order), at (ids before it in the file), n_tokens and ids. Null and
    empty texts are just the end id. Other columns of `df` are not written. An empty table writes no rows.
    """
    common.tune(df.sparkSession)
    docs = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(_encode(vocabulary, end_id), "doc_id long, file long, at long, n_tokens long, ids array<int>")
    encoded.write.options(**(LAYOUT | (layout or {}))).parquet(path)


COLUMNS = "doc_id long, file long, at long, n_tokens long, ids array<int>"


def _started(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows of token files with start, the ids of all documents before, in place of file and at."""
    totals = spark.read.schema(COLUMNS).parquet(path).groupBy("file").agg(F.sum("n_tokens").alias("n"))
    one_each = Window.orderBy("file")  # over a row for each file
    before = totals.select(F.col("file").alias("_file"), (F.sum("n").over(one_each) - F.col("n")).alias("_before"))
    return rows.join(before, F.col("file") == F.col("_file")).withColumn("start", F.col("_before") + F.col("at")).drop("_file", "_before", "file", "at")


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, start) of token files; without `ids` no token page is read."""
    rows = spark.read.schema(COLUMNS).parquet(path)
    return _started(spark, path, rows if ids else rows.drop("ids"))


def _checksum(batches):
    for batch in batches:
        column = batch.column("ids")
        values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = column.offsets.to_numpy().tolist()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield common.append(batch.select(["doc_id", "file", "at", "n_tokens"]), {"ids_crc32": pa.array(sums, pa.int64())})


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of token files; the checksum is of the ids as read."""
    rows = spark.read.schema(COLUMNS).parquet(path).mapInArrow(_checksum, "doc_id long, file long, at long, n_tokens long, ids_crc32 long")
    return _started(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    path = session.scratch_path(spark, "token-files")
    write_token_files(docs, path)
    return checksums(spark, path)


QUERIES = {"op8_token_files": op8_token_files}
ORACLE: dict[str, str] = {}
