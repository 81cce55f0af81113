"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Words are seen twice: as themselves and as shapes (runs of upper case, lower case, digits and each other sign, with a
mark where a word repeats the one before or where its three-word window occurs elsewhere in the text). Hashed 1- and
2-grams of words and 1- to 3-grams of shapes are counted over the whole text and divided by its number of words, so
the score of a text is a sparse dot product that does not depend on its length.

The model learns from a bounded sample of labelled rows (the first by a hash of the id), streamed through one task as
often as there are epochs; the state is two numbers for each hashed coordinate. All documents are then scored in place.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

BITS = 18            # hashed coordinates: 2 to this power
SAMPLE = 12_000      # labelled rows learnt from, at most
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-3
HELD_OUT = (4, 2)    # fold of crc32(id) that is never learnt from
CUT = 0.7
_SHAPES = [(re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0")]


def shape(word: bytes) -> str:
    """The word with runs of letters and digits as one sign each, and runs of another sign as that sign."""
    text = word.decode("utf-8", "replace")
    text = _SHAPES[0][0].sub(lambda m: "A" if m[0].isupper() else "a" if m[0][0].islower() else "Aa", text)
    return re.sub(r"(\W)\1+", r"\1\1", _SHAPES[1][0].sub("0", text))


class Features:
    """Hashed n-grams of texts, at every word of all texts of a batch."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self._reset()

    def _reset(self) -> None:
        self.own, self.shapes = common.Growing(np.uint64), common.Growing(np.uint64)
        self.words = common.Words(self._new)

    def _new(self, new: list[bytes]) -> None:
        self.own.extend(np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in new), np.uint64, len(new)))
        self.shapes.extend(np.fromiter((xxhash.xxh3_64_intdigest(shape(w)) for w in new), np.uint64, len(new)))

    def places(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(coordinate of each n-gram kind at each word, text of each word, words of each text)"""
        if len(self.words) > common.MEMO_WORDS:
            self._reset()
        flat, offsets = self.words.numbers([t.split() for t in texts])
        n_words = np.diff(offsets)
        doc = np.repeat(np.arange(len(texts)), n_words)
        own, marks = self.own.values[flat], self.shapes.values[flat].copy()
        start = np.zeros(len(flat) + 1, bool)
        start[offsets[:-1]] = True
        same = np.zeros(len(flat), bool)
        same[1:] = (flat[1:] == flat[:-1]) & ~start[1:len(flat)]
        marks += same.astype(np.uint64) + np.uint64(2) * self._echo(flat, doc)
        shift = np.uint64(64 - self.bits)
        out = []
        for kind, (base, sizes) in enumerate(((own, (1, 2)), (marks, (1, 2, 3)))):
            for n in sizes:
                grams = common.mix(base * np.uint64(2 * kind + 3) + np.uint64(n))
                for back in range(1, n):
                    before = np.zeros(len(flat), np.uint64)  # places before a text count as 0
                    before[back:] = np.where(doc[back:] == doc[:len(flat) - back], base[:len(flat) - back], np.uint64(0)) if len(flat) > back else 0
                    grams = common.mix(grams + common.mix(before + np.uint64(back)))
                out.append((grams >> shift).astype(np.int64))
        return out, doc, n_words

    @staticmethod
    def _echo(flat: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """1 where the window of three words that ends at a word occurs elsewhere in its text."""
        out = np.zeros(len(flat), np.uint64)
        if len(flat) < 3:
            return out
        inside = np.flatnonzero(doc[:-2] == doc[2:])
        keys = common.windows(common.mix(flat + 1), 3)[inside] ^ common.mix(doc[inside] + 1)
        ordered = np.sort(keys)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            out[inside[twice[at] == keys] + 2] = 1
        return out


def dots(weights: np.ndarray, places: list[np.ndarray], doc: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Dot product of each text's features with the weights."""
    at = np.zeros(len(doc))
    for kind in places:
        at += weights[kind]
    return np.bincount(doc, weights=at, minlength=len(n_words)) / np.maximum(1, n_words)


class Leader:
    """Follow the (proximally) regularised leader for logistic loss; coordinate 2^bits is the constant."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-float(w @ values))) - label) * values
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def sparse(places: list[np.ndarray], doc: np.ndarray, n_words: np.ndarray, bits: int):
    """(coordinates, values) of each text, its constant last."""
    n_docs, size = len(n_words), len(places)
    keys = np.concatenate([(doc << (bits + 1)) | p for p in places]) if len(doc) else np.zeros(0, np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    ends = np.searchsorted(keys, np.arange(n_docs + 1) << (bits + 1))
    for k in range(n_docs):
        part = slice(ends[k], ends[k + 1])
        yield (np.append(keys[part] & ((1 << (bits + 1)) - 1), 1 << bits),
               np.append(counts[part] / max(1, n_words[k]), 1.0), size)


def _train(bits: int, options: dict):
    def run(batches):
        features, leader = Features(bits), Leader(bits, **options)
        seen = 0
        for batch in batches:
            labels = batch.column("label").to_pylist()
            for (at, values, _), label in zip(sparse(*features.places(common.texts(batch.column("text"))), bits), labels):
                leader.learn(at, values, label)
                seen += 1
        weights = leader.weights(slice(None)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([weights.tobytes()], pa.binary())], names=["seen", "weights"])
    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: tuple[int, int], bound: int) -> DataFrame:
    """(doc_id, text, label) of at most `bound` labelled rows outside the held-out fold, the first by a hash of the id.

    An id given several times has one row for each of its labels, with one of its texts.
    """
    modulus, fold = held_out
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (common.fold(labels, "doc_id", modulus) != fold))
           .select("doc_id", F.col(label).cast("double").alias("label")).distinct().orderBy(F.md5(F.col("doc_id").cast("string")), "label").limit(bound))
    return common.one_text(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "doc_id", "label")  # `bound` rows of two numbers


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: tuple[int, int] = HELD_OUT, bits: int = BITS,
          sample: int = SAMPLE, epochs: int = EPOCHS, **options) -> np.ndarray:
    """Weights learnt from labelled rows outside the held-out fold; all zero without any."""
    rows = (labelled_sample(docs, labels, label, held_out, sample).select("text", "label", F.md5(F.col("doc_id").cast("string")).alias("turn"))
            .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).repartition(1).sortWithinPartitions("epoch", "turn", "label"))
    learnt = rows.select("text", "label").mapInArrow(_train(bits, options), "seen long, weights binary").collect()
    return np.frombuffer(learnt[0].weights, np.float32) if learnt else np.zeros((1 << bits) + 1, np.float32)


def _score(shared, bits: int, text: str):
    def make():
        features, weights = Features(bits), shared.value.astype(np.float64)

        def apply(batch):
            found = features.places(common.texts(batch.column(text)))
            scores = 1 / (1 + np.exp(-np.clip(dots(weights, *found) + weights[-1], -500, 500)))
            return common.append(batch.select([c for c in batch.schema.names if c != text]), {"score": pa.array(scores)})
        return apply
    return common.per_batch(make)


def score_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT, held_out: tuple[int, int] = HELD_OUT, bits: int = BITS,
                  sample: int = SAMPLE, epochs: int = EPOCHS, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    The score is the probability of label 1. Null and empty texts get the constant's score; without any labelled row
    every score is 0.5. Rows with the same text get the same score. Labels of the held-out fold are never read for
    learning; a label given several times for an id counts once, with one of the id's texts, null labels not at all.
    """
    spark = common.tune(docs.sparkSession)
    weights = spark.sparkContext.broadcast(train(docs, labels, "quality", held_out, bits, sample, epochs, **options))
    scored = docs.select("doc_id", "text").mapInArrow(_score(weights, bits, "text"), "doc_id long, score double")
    return scored.select("doc_id", (common.fold(scored, "doc_id", held_out[0]) == held_out[1]).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))


QUERIES = {"op3_quality_classifier": op3_quality_classifier}
ORACLE: dict[str, str] = {}
