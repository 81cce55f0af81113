"""Helpers shared by the training-data operators: sessions, staged tables, words and column names."""

from __future__ import annotations

import itertools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import session

# A batch handed to Python holds at most this much, so that a task's memory does not follow the length of the texts.
BATCH_BYTES = "4m"
# Distinct words a worker remembers before it starts afresh.
MEMO_WORDS = 300_000

_MASK = (1 << 64) - 1
SPACE = b" \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if os.path.isdir(package):
            folder = tempfile.mkdtemp(prefix="package-")
            sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark"), "zip", os.path.dirname(package), "tidemark"))
        _SHIPPED.add(sc.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, and batches to Python bounded in bytes."""
    session.tune(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder and read again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = session.scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


_STAGED: dict[str, list[str]] = {}


def staged_paths(spark: SparkSession) -> list[str]:
    """Staged tables of this application that have not been removed."""
    return list(_STAGED.get(spark.sparkContext.applicationId, []))


def remove(spark: SparkSession, *tables: DataFrame | str | None) -> None:
    """Delete staged tables, given themselves or by path, that nothing reads any more."""
    known = _STAGED.get(spark.sparkContext.applicationId, [])
    for table in tables:
        path = table if isinstance(table, str) else getattr(table, "staged_at", None)
        if path in known:
            known.remove(path)
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` less the columns an operator is about to produce, compared without case as Spark does."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, wish: str) -> str:
    """A column name near `wish` that `df` does not use."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [t or b"" for t in pc.cast(column, pa.binary()).to_pylist()]


def fold(df: DataFrame, id_column: str, modulus: int):
    """crc32 of the id written as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def one_text(rows: DataFrame, *key: str) -> DataFrame:
    """(*key, text): one text for each key, the same however the rows are dealt, so that a sample of keys bounds the rows."""
    return rows.groupBy(*key).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


class Words(dict):
    """Numbers distinct words as they come; `on_new(list of words)` is called once for each new batch of them."""

    def __init__(self, on_new: Callable[[list[bytes]], None] | None = None):
        super().__init__()
        self.fresh: list[bytes] = []
        self.on_new = on_new

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def numbers(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all lists, offsets of the lists)"""
        offsets = np.zeros(len(split) + 1, np.int64)
        np.cumsum([len(x) for x in split], out=offsets[1:])
        flat = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(offsets[-1]))
        if self.fresh and self.on_new:
            self.on_new(self.fresh)
        self.fresh = []
        return flat, offsets

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, offsets of the texts); each distinct word of `texts` is looked up once"""
        words, codes, lengths = split_words(texts)
        own, _ = self.numbers([listed(words)])
        return own[codes], np.concatenate(([0], np.cumsum(lengths)))


def binary(texts: list[bytes] | pa.Array) -> pa.Array:
    """Texts as a string column without nulls; bytes are taken as they are."""
    if isinstance(texts, list):
        return pa.array(texts, pa.binary()).view(pa.string())
    return pc.fill_null(pc.cast(texts, pa.string()), "")


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words in the order they come, number of each word of all texts, words of each text); with `lower`, A-Z lower-cased."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts) if lower else texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    lengths, words = np.diff(offsets), lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    empty = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)) == 0 if len(texts) else np.zeros(0, bool)
    if empty.any():  # such a text is split into one empty word
        words, lengths = words.filter(pa.array(np.repeat(~empty, lengths))), np.where(empty, 0, lengths)
    found = words.dictionary_encode()
    return found.dictionary.view(pa.binary()), found.indices.to_numpy(), lengths


def listed(words: pa.Array) -> list[bytes]:
    """Words without white space as a list."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py().split(b" ")


class Growing:
    """A numpy array that is appended to."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def extend(self, values) -> None:
        values = np.asarray(values, self.data.dtype)
        if self.n + len(values) > len(self.data):
            grown = np.empty(max(2 * len(self.data), self.n + len(values)), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.data[:self.n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = np.asarray(x, np.uint64).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def odd_factors(n: int, seed: int = 7) -> np.ndarray:
    """`n` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every `n` consecutive numbers; the last n - 1 places have none."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for k, factor in enumerate(odd_factors(n)):
        out += hashes[k:k + count] * factor
    return mix(out)


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]):
    """A mapInArrow function from a factory of per-batch functions; the factory runs once a task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            if batch.num_rows:
                yield apply(batch)
    return run


def append(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = list(batch.schema.names) + list(columns)
    return pa.RecordBatch.from_arrays(list(batch.columns) + list(columns.values()), names=names)
