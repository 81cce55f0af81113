"""Byte-level BPE, encoding and decoding, by dynamic programming over prefixes.

Merging by rank gives every prefix of a piece exactly one encoding, and its last token follows from shorter prefixes:
it is the one vocabulary token that is a suffix of the prefix and compatible with the last token of what is left of
it. An automaton over the vocabulary reports the suffix tokens at each place; whether two tokens may stand side by
side is decided from the merges alone and remembered. Following the stored tokens back from the end emits the ids.

Texts are cut into pieces as the vocabulary file's byte-level splitter does. A worker remembers the ids of distinct
stretches between single spaces, where a cut never changes the pieces, so each is worked out once.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from . import common

VOCABULARY = "byte_bpe_50k.json"
# Fixed: the splitter of byte-level vocabularies, with white space as Unicode's property of that name.
_WS = r"\t-\r \x85\xa0  -     　"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((_WS,) * 4))
_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
MEMO = 400_000   # stretches and token pairs a worker remembers before it starts afresh


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and number the others from U+0100 up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """Which tokens may be neighbours, from the order of the merges."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocabulary.values()) + 1
        self.born, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            token = vocabulary[a + b]
            if self.born[token] >= 0:
                raise ValueError(f"two merges make the token {a + b!r}")
            self.born[token], self.left[token], self.right[token] = rank, vocabulary[a], vocabulary[b]
            self.merged[vocabulary[a], vocabulary[b]] = rank

    def apart(self, a: int, b: int, whole: bool = True) -> bool:
        """Whether no merge crosses the border between tokens a and b while both were built up.

        Walks back in time: the younger token is undone, and the pair that then met at the border must not have had a
        merge due before that token's own. Equal pairs merge from the left, so a merge of b's rank is due before it.
        """
        due = None
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and (whole if due is None else rank < due):
                return False
            if self.born[a] > self.born[b]:
                due, a = self.born[a], self.right[a]
            elif self.born[b] >= 0:
                due, b = self.born[b] + 1, self.left[b]
            else:
                return True

    def stands(self) -> list[bool]:
        """For each token, whether its own text is encoded as that one token."""
        out = [True] * len(self.born)
        for token in sorted(range(len(out)), key=self.born.__getitem__):
            if self.born[token] >= 0:
                a, b = self.left[token], self.right[token]
                out[token] = out[a] and out[b] and self.apart(a, b, whole=False)
        return out


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocabulary = byte_of_letter(), spec["model"]["vocab"]
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(letters[c] for c in token)
        self.merges = Merges(vocabulary, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, number in self.special.items():
            self.bytes_of += [b""] * (number + 1 - len(self.bytes_of))
            self.bytes_of[number] = content.encode()
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.automaton = ahocorasick.Automaton()
        for number, (text, alone) in enumerate(zip(self.bytes_of[:len(self.merges.born)], self.merges.stands())):
            if text and alone:
                self.automaton.add_word(text.decode("latin-1"), (number, len(text)))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PATTERN)
        self.memo = _Memo(self._stretch)
        self.pairs: dict[int, bool] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece: the last token of every prefix, then back from the end."""
        last, pairs, apart = [-1] * (len(piece) + 1), self.pairs, self.merges.apart
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - length
                if start:
                    before = last[start]
                    key = before << 32 | token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = apart(before, token)
                    if not fits:
                        continue
                last[end] = token
        out, end = [], len(piece)
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        out.reverse()
        return out

    def _stretch(self, stretch: str) -> bytes:
        if len(self.pairs) > 4 * MEMO:
            self.pairs.clear()
        ids = [i for piece in self.pieces.findall(stretch) for i in self.encode_piece(piece.encode())]
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        parts = text.split(" ") if not _RUN.search(text) else _CUT.split(text)
        stretches = [parts[0], *[" " + p for p in parts[1:]]]
        return b"".join(map(self.memo.__getitem__, stretches))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; special tokens in it keep their ids."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        if self.special_cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.special_cut.split(text))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text that ids stand for; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = raw.decode("utf-8", "replace").encode()
        return raw


class _Memo(dict):
    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key):
        self[key] = out = self.work(key)
        return out


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> Codec:
    """A worker's codec; the vocabulary file is the installed package's unless a path is given."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    return Codec(path)


def _encode(text: str, path: str | None, keep_ids: bool, keep_text: bool):
    def make():
        own = codec(path)

        def apply(batch):
            n, digests, back, all_ids, decoded = [], [], [], [], []
            for raw in common.texts(batch.column(text)):
                ids = own.encode(raw.decode("utf-8", "replace"))
                plain = own.decode(ids)
                n.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(plain).hexdigest())
                all_ids += [np.frombuffer(ids, "<u4").astype(np.int32)] if keep_ids else []
                decoded += [plain.decode()] if keep_text else []
            new = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(digests), "decoded_sha256": pa.array(back)}
            if keep_ids:
                ends = np.cumsum([0] + [len(i) for i in all_ids])
                new["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(all_ids), pa.int32()))
            if keep_text:
                new["decoded"] = pa.array(decoded, pa.string())
            return common.append(batch.select([c for c in batch.schema.names if c != text]), new)
        return apply
    return common.per_batch(make)


def encode_texts(df: DataFrame, text_column: str = "text", vocabulary: str | None = None, keep_ids: bool = True,
                 keep_text: bool = False) -> DataFrame:
    """Rows of `df` without the text, with n_tokens, ids (array<int>), ids_sha256, decoded_sha256 and, on demand, decoded.

    Ids are those of the vocabulary file at `vocabulary`. Null and empty texts have no ids. The whole of each text is
    encoded, each row by itself: repeated rows give repeated results. Columns of `df` named like an output give way.
    """
    common.tune(df.sparkSession)
    df = common.without(df, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids, *["decoded"] * keep_text)
    fields = [f for f in df.schema.fields if f.name != text_column]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids + [T.StructField("decoded", T.StringType())] * keep_text
    return df.mapInArrow(_encode(text_column, vocabulary, keep_ids, keep_text), T.StructType(fields))


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, keep_ids=False)


QUERIES = {"op1_bpe_codec": op1_bpe_codec}
ORACLE: dict[str, str] = {}
