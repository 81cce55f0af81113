"""Quality rules on tokeniser fertility.

Two public vocabularies read every word of a text, each distinct word once a worker:

* chars_per_token: code points of words for each token of a byte-level BPE vocabulary;
* byte_fallback_share: share of the tokens of a vocabulary with byte fallback that are single bytes;
* token_entropy: entropy of that vocabulary's tokens, relative to the largest possible, averaged over consecutive
  windows of 64 tokens; a text with fewer tokens is one window, the last window of a longer one ends with the text, so
  that all windows are of one size and every token counts.

Bands are drawn for each language from all documents that pass the base rules: a measure may fall short of its median
by at most BAND times the distance of the median from the 90th percentile, measures rounded to thousandths. Texts of less than one window have bands of
their own, for their measures scatter more. Symbol noise, tables of shuffled words and shouting push tokens for each
character up or their entropy down far beyond what good texts of the same language show, whatever the language is.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

PIECES = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WINDOW = 64
BAND = 4.0             # times the distance of the median from the 90th percentile
LEAST_SPREAD = 0.02    # that distance is at least this share of the median
FALLBACK_SHARE = 0.2   # a share of byte tokens below this is always within its band
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
            ("n_tokens", "long"), ("chars_per_token", "double"), ("byte_fallback_share", "double"), ("token_entropy", "double")]
OUTPUTS = [m for m, _ in MEASURES] + ["base_failed", "kept"]


@lru_cache(maxsize=2)
def vocabularies(folder: str | None):
    """(sentence-piece processor, its byte tokens, byte-level encoder); files from `folder` or the installed package."""
    import os

    import public_tokenizers
    import sentencepiece
    import tiktoken

    place = (lambda name: os.path.join(folder, name)) if folder else public_tokenizers.path
    pieces = sentencepiece.SentencePieceProcessor(model_file=place(PIECES))
    with open(place(BYTE_RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return pieces, np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())]), encoder


class Measurer:
    def __init__(self, folder: str | None):
        self.pieces, self.is_byte, self.encoder = vocabularies(folder)
        self._reset()

    def _reset(self) -> None:
        self.words = common.Words(self._encode)
        self.tokens, self.ends = common.Growing(np.int32), common.Growing(np.int64)
        self.ends.extend([0])
        self.bytes_, self.ranks = common.Growing(np.int32), common.Growing(np.int32)

    def _encode(self, new: list[bytes]) -> None:
        plain = [w.decode("utf-8", "replace") for w in new]
        found = self.pieces.encode(plain, num_threads=1)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for x in found for t in x), np.int32, int(lengths.sum()))
        ends = np.cumsum(lengths)
        self.tokens.extend(flat)
        self.ends.extend(self.ends.values[-1] + ends)
        byte = np.concatenate(([0], np.cumsum(self.is_byte[flat])))
        self.bytes_.extend(byte[ends] - byte[ends - lengths])
        self.ranks.extend([len(self.encoder.encode_ordinary(" " + w)) for w in plain])

    def repeats(self, flat: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """Words of each document that lie in a 5-word window found twice or more in it."""
        if len(flat) < 5:
            return np.zeros(n_docs, np.int64)
        keys = common.windows(common.mix(flat + 1), 5)
        inside = np.flatnonzero(doc[:-4] == doc[4:])
        keys = keys[inside] ^ common.mix(doc[inside] + 1)
        ordered = np.sort(keys)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return np.zeros(n_docs, np.int64)
        at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        starts = inside[twice[at] == keys]
        steps = np.zeros(len(flat) + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + 5, -1)
        return np.bincount(doc, weights=np.cumsum(steps)[:-1] > 0, minlength=n_docs).astype(np.int64)

    def entropy(self, flat: np.ndarray, lengths: np.ndarray, doc: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        total, n_docs = int(lengths.sum()), len(per_doc)
        out = np.zeros(n_docs)
        if not total:
            return out
        begun = np.cumsum(lengths) - lengths
        tokens = self.tokens.values[np.repeat(self.ends.values[flat] - begun, lengths) + np.arange(total)]
        first = np.cumsum(per_doc) - per_doc
        place = np.arange(total) - np.repeat(first, per_doc)
        whole = per_doc // WINDOW
        ragged = np.flatnonzero((per_doc > WINDOW) & (per_doc % WINDOW > 0))  # one more window, which ends with the text
        n_windows = np.maximum(whole, per_doc > 0)
        n_windows[ragged] += 1
        number = np.cumsum(n_windows) - n_windows
        use = place < np.repeat(np.where(whole > 0, whole * WINDOW, per_doc), per_doc)
        window = np.repeat(number, per_doc) + place // WINDOW
        last = np.repeat(first[ragged] + per_doc[ragged] - WINDOW, WINDOW) + np.tile(np.arange(WINDOW), len(ragged))
        keys = np.sort(np.concatenate([(window[use] << 20) | tokens[use], (np.repeat(number[ragged] + whole[ragged], WINDOW) << 20) | tokens[last]]))
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(starts, len(keys))).astype(float)
        owner = keys[starts] >> 20
        n_all = int(n_windows.sum())
        size = np.bincount(owner, weights=counts, minlength=n_all)
        bits = np.log2(size) - np.bincount(owner, weights=counts * np.log2(counts), minlength=n_all) / size
        bits = bits / np.maximum(1.0, np.log2(size))
        sums = np.bincount(np.repeat(np.arange(n_docs), n_windows), weights=bits, minlength=n_docs)
        return np.divide(sums, n_windows, out=out, where=n_windows > 0)

    def measure(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        if len(self.words) > common.MEMO_WORDS:
            self._reset()
        n_docs = len(texts)
        flat, offsets = self.words.numbers([t.split() for t in texts])
        n_words = np.diff(offsets)
        doc = np.repeat(np.arange(n_docs), n_words)
        lengths = np.diff(self.ends.values)[flat] if len(flat) else np.zeros(0, np.int64)
        sums = lambda v: np.bincount(doc, weights=v, minlength=n_docs).astype(np.int64)
        per_doc, ranks = sums(lengths), sums(self.ranks.values[flat])
        chars = np.array([len(t.translate(None, common.SPACE + _CONTINUATION)) for t in texts], np.int64)
        dup = []
        for t in texts:
            lines = [x for x in t.split(b"\n") if x.strip()]
            dup.append(len(lines) - len(set(lines)))
        return {
            "n_words": n_words, "word_chars": chars, "n_symbols": np.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], np.int64),
            "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": self.repeats(flat, doc, n_docs), "n_tokens": per_doc,
            "chars_per_token": chars / np.maximum(1, ranks), "byte_fallback_share": sums(self.bytes_.values[flat]) / np.maximum(1, per_doc),
            "token_entropy": self.entropy(flat, lengths, doc, per_doc)}


def _measure(text: str, carried: list[str], folder: str | None):
    def make():
        measurer = Measurer(folder)

        def apply(batch):
            found = measurer.measure(common.texts(batch.column(text)))
            kept = batch.select(carried)
            return common.append(kept, {m: pa.array(found[m]) for m, _ in MEASURES})
        return apply
    return common.per_batch(make)


def measures(df: DataFrame, text_column: str = "text", carry_text: bool = True, folder: str | None = None) -> DataFrame:
    """Rows of `df` (without its text on demand) with the base counts and fertility measures, staged."""
    df = common.without(df, *OUTPUTS)
    carried = [c for c in df.columns if carry_text or c != text_column]
    schema = T.StructType([df.schema[c] for c in carried] + [T.StructField(m, T.LongType() if k == "long" else T.DoubleType()) for m, k in MEASURES])
    return common.staged(df.mapInArrow(_measure(text_column, carried, folder), schema), "quality-measures")


def judged(found: DataFrame, lang_column: str = "lang", band: float = BAND) -> DataFrame:
    """Measured rows with base_failed and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    lang, short = common.free_name(found, "band_lang"), common.free_name(found, "band_short")
    found = (found.withColumn("base_failed", failed).withColumn(lang, F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("")))
             .withColumn(short, F.col("n_tokens") < WINDOW))

    def lines(measure: str, low: bool):
        # exact over thousandths, so there are few distinct values to keep, however many documents there are
        mid, high = (F.percentile(F.round(measure, 3), F.lit(p)) for p in (0.5, 0.9))
        reach = band * F.greatest(high - mid, LEAST_SPREAD * mid)
        return mid - reach if low else F.greatest(mid + reach, F.lit(FALLBACK_SHARE))

    # written first: Spark then knows the size of this small table and need not deal the documents out by language
    bands = common.staged(found.where(~F.col("base_failed")).groupBy(F.col(lang).alias("b_lang"), F.col(short).alias("b_short")).agg(
        lines("chars_per_token", True).alias("b_chars"), lines("token_entropy", True).alias("b_entropy"),
        lines("byte_fallback_share", False).alias("b_fallback")), "quality-bands")
    within = ((F.col("chars_per_token") >= F.col("b_chars")) & (F.col("token_entropy") >= F.col("b_entropy"))
              & (F.col("byte_fallback_share") <= F.col("b_fallback")))
    joined = found.join(bands, (F.col(lang) == F.col("b_lang")) & (F.col(short) == F.col("b_short")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False))).drop(lang, short, *bands.columns)


def quality_rules(df: DataFrame, text_column: str = "text", lang_column: str = "lang", carry_text: bool = True, band: float = BAND,
                  folder: str | None = None) -> DataFrame:
    """Rows of `df` with base counts, fertility measures, base_failed and kept.

    Null and empty texts have no words and fail the base rules. A null language has bands of its own, as each language
    has. Equal rows get equal verdicts. Columns of `df` named like an output give way to it.
    """
    common.tune(df.sparkSession)
    return judged(measures(df, text_column, carry_text, folder), lang_column, band)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules(docs, carry_text=False).select("doc_id", *OUTPUTS)


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLE: dict[str, str] = {}
