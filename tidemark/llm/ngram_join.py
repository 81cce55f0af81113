"""Set-similarity join on word n-grams, and the groups its links form.

Two documents link when percent/100 of the union of their sets of word n-grams lies in the intersection. The join is
prefix filtering with a rare-first order:

* A hashed table of counters, summed over all documents, says how frequent a shingle is; any fixed order is right, a
  rarer-first order makes posting lists short. Its size is a parameter, so its broadcast is bounded.
* Documents with equal sets are one node from the start.
* A node posts the shingles of its prefix (the rarest n - ceil(t n) + 1): two nodes that link share one of them.
  Shingles posted once are dropped: a bitmap of those posted more often keeps most of them from being dealt out, and
  an exact join drops the rest.
* Candidate pairs on a shared posting pass the length filter, the positional filter, and the suffix filter in two
  forms: the parities of hash parts differ in no more places than the sets have different shingles, which is told by
  a few XORs while the posting lists meet; and the sizes of parts differ by no more than that. Pairs that remain are
  verified once, on whole texts. No text is dealt out but those of such pairs: a broadcast of their ids finds them in the
  table, or, where they are many, a bitmap of their ids and then an exact join.

Groups of near copies must not become all their pairs. Only what links join matters: every member of a posting list has
a slot in it, by its hash, and rounds compare the members of the first few slots, then of the next eight times as many,
with all that come after them. Between rounds the links found are contracted; pairs of nodes known to be in one component
are left out, and lists whose remaining members are in one component are done. The rounds go on until every pair of
slots has met or is known to be joined, so no link between different components can be missed, and each pair meets once
in a list.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .components import components

COUNTERS = 1 << 20   # of the frequency table; 4 bytes each
BLOCK = 1 << 12      # counters summed at a time
PARTS = 16           # hash ranges of the suffix filter
LANES = 4            # 64-bit words of part parities
SENT_IDS = 200_000   # rows of ids that may be broadcast; more are joined by key
MARKS = 22           # a bitmap has at most 2^22 words of 64 bits
SLOTS, WIDER = 1, 8  # of a posting list that the first round compares with the rest; how many times more the next does
_BITS = 64 - int(np.log2(PARTS))
_LANES = [f"lane{k}" for k in range(LANES)]


class Shingler:
    """Sets of hashed word n-grams of texts."""

    def __init__(self, n: int):
        self.n = n
        self._reset()

    def _reset(self) -> None:
        self.hashes = common.Growing(np.uint64)
        self.words = common.Words(lambda new: self.hashes.extend(
            np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingles; a text of fewer than n words is one shingle, one without words has none."""
        if len(self.words) > common.MEMO_WORDS:
            self._reset()
        flat, offsets = self.words.numbers([t.lower().split() for t in texts])
        hashes = self.hashes.values[flat]
        whole = common.windows(hashes, self.n)
        out = []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if end - start >= self.n:
                part = np.sort(whole[start:end - self.n + 1])
                keep = np.empty(len(part), bool)
                keep[0] = True
                np.not_equal(part[1:], part[:-1], out=keep[1:])
                part = part[keep]
            elif end > start:
                part = common.windows(hashes[start:end], end - start) ^ np.uint64(end - start)
            else:
                part = hashes[:0]
            out.append(part)
        return out


def _count(text: str, n: int, counters: int):
    def run(batches):
        shingler, shift = Shingler(n), np.uint64(64 - int(np.log2(counters)))
        total = np.zeros(counters, np.int32)
        for batch in batches:
            found = shingler.sets(common.texts(batch.column(text)))
            if any(len(x) for x in found):
                total += np.bincount(np.concatenate(found) >> shift, minlength=counters).astype(np.int32)
        for k in range(0, counters, BLOCK):
            part = total[k:k + BLOCK]
            if part.any():
                narrow = part.astype(np.min_scalar_type(part.max()))  # the width tells the reader the type
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([narrow.tobytes()], pa.binary())],
                                                 names=["block", "counts"])
    return run


def _add(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(counts, f"u{len(counts) // BLOCK}")
            sums[block] = sums[block] + got if block in sums else got.astype(np.int64)
    for block, counts in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                         names=["block", "counts"])


def frequencies(df: DataFrame, text: str, n: int, counters: int) -> np.ndarray:
    """How many documents have a shingle of each hash range, over all documents; `counters` numbers."""
    rows = (df.select(text).mapInArrow(_count(text, n, counters), "block int, counts binary").repartition("block")
            .mapInArrow(_add, "block int, counts binary").collect())
    out = np.zeros(counters, np.int64)
    for block, counts in rows:
        out[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(counts, np.int64)
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def _sign(id_column: str, text: str, n: int, percent: int, shared):
    def run(batches):
        shingler, frequency = Shingler(n), shared.value
        shift = np.uint64(64 - int(np.log2(len(frequency))))
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, digests, prefixes, parts, lanes = [], [], [], [], []
            for found in shingler.sets(common.texts(batch.column(text))):
                size = len(found)
                sizes.append(size)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if size else None)
                order = np.argsort(frequency[found >> shift], kind="stable")[:size - -(-percent * size // 100) + 1]
                prefixes.append(found[order].view(np.int64))
                parts.append(np.bincount(found >> np.uint64(_BITS), minlength=PARTS))
                odd = np.bincount(found & np.uint64(64 * LANES - 1), minlength=64 * LANES) & 1
                lanes.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            lengths, lanes = np.cumsum([0] + [len(p) for p in prefixes]), np.stack(lanes)
            yield pa.RecordBatch.from_arrays([
                batch.column(id_column), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(prefixes))),
                pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(parts).astype(np.int32)), PARTS).cast(pa.list_(pa.int32())),
                *[pa.array(lanes[:, k]) for k in range(LANES)]],
                names=["doc_id", "n_shingles", "digest", "prefix", "parts", *_LANES])
    return run


def marks(keys: DataFrame, most: int = MARKS) -> np.ndarray:
    """A bitmap of the hashed column `key` of a staged table, eight bits a key up to 2^most words of 64.

    No key lacks its bit; others may share one, so what it lets pass is to be joined exactly.
    """
    bits = max(1, min(most, keys.count().bit_length() - 3))  # 2^bits words
    words = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def is_marked(marked: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys = keys.view(np.uint64)
    word = keys >> np.uint64(64 - (len(marked).bit_length() - 1))
    return (marked[word] >> (keys & np.uint64(63))) & np.uint64(1) == 1


def _posted(shared):
    """(node, pos, token) of the tokens of prefixes that are marked."""
    def run(batches):
        for batch in batches:
            lists = batch.column("prefix")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(is_marked(shared.value, tokens))
            row = np.repeat(np.arange(len(lengths)), lengths)[keep]
            starts = np.cumsum(lengths) - lengths
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(row)), pa.array((keep - starts[row]).astype(np.int32)),
                                              pa.array(tokens[keep])], names=["node", "pos", "token"])
    return run


def _verify(n: int, percent: int):
    def run(batches):
        shingler, last, last_set = Shingler(n), None, None
        for batch in batches:  # rows come sorted by a, whose set serves the next batch too
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            texts = dict(zip(b, common.texts(batch.column("text_b")))) | dict(zip(a, common.texts(batch.column("text_a"))))
            sets = {last: last_set} if last in texts else {}
            new = [i for i in texts if i not in sets]
            sets.update(zip(new, shingler.sets([texts[i] for i in new])))
            linked = []
            for x, y in zip(a, b):
                both = np.concatenate((sets[x], sets[y]))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(100 * shared >= percent * (len(both) - shared))
            last, last_set = a[-1], sets[a[-1]]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def _sent(rows: DataFrame) -> DataFrame:
    """A staged table of ids, to be broadcast where it is counted to be small."""
    return F.broadcast(rows) if rows.count() <= SENT_IDS else rows


def _of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the rows of `docs` whose id is among `nodes` (staged); other texts are not dealt out."""
    rows = docs.select(F.col("doc_id").alias("node"), "text")
    if nodes.count() <= SENT_IDS:
        return rows.join(F.broadcast(nodes), "node", "left_semi")
    marked = docs.sparkSession.sparkContext.broadcast(marks(nodes.select(F.xxhash64("node").alias("key"))))
    passes = F.pandas_udf(lambda keys: pd.Series(is_marked(marked.value, keys.to_numpy())), "boolean")
    return rows.where(F.col("node").isNotNull()).where(passes(F.xxhash64("node"))).join(nodes, "node", "left_semi")


class _Join:
    """State of one join: postings, node tables, pairs tested and components so far."""

    def __init__(self, docs: DataFrame, signs: DataFrame, reps: DataFrame, n: int, percent: int):
        self.n, self.percent, self.spark = n, percent, docs.sparkSession
        self.docs = docs
        mine = signs.where("n_shingles > 0").select(F.col("doc_id").alias("node"), "prefix").join(reps.select("node"), "node", "left_semi")
        prefixes = common.staged(mine, "join-prefixes")
        shared = common.staged(prefixes.select(F.explode("prefix").alias("token")).groupBy("token")
                               .agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "join-shared")
        marked = self.spark.sparkContext.broadcast(marks(shared.select(F.col("token").alias("key"))))
        posted = prefixes.mapInArrow(_posted(marked), "node long, pos int, token long")
        slot = F.pmod(F.xxhash64("node", "token"), F.col("n")).alias("slot")
        # few postings are shared: the rest of a node joins them now
        kept = common.staged(posted.join(shared, "token").select("token", "node", "pos", slot), "join-kept")
        mine = kept.select(F.col("node").alias("doc_id")).distinct()
        self.nodes = common.staged(signs.where("n_shingles > 0").join(mine, "doc_id", "left_semi")
                                   .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("size"), "parts", *_LANES), "join-nodes")
        self.postings = common.staged(kept.join(self.nodes.drop("parts"), "node").withColumn("root", F.col("node")), "join-postings")
        common.remove(self.spark, kept, shared, prefixes)
        self.tested: DataFrame | None = None
        self.roots: DataFrame | None = None

    def open(self, lo: int) -> bool:
        """Leave the postings from slot `lo` on, with their node's component, of tokens whose nodes are not all in one."""
        if not lo:  # every node is its own component, and every token has two nodes or more
            return not self.postings.isEmpty()
        rows = self.postings.where(F.col("slot") >= lo)
        if self.roots is not None:
            rows = rows.drop("root").join(_sent(self.roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
        now = common.staged(rows, "join-rooted")
        mixed = now.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
        out = common.staged(now.join(mixed, "token", "left_semi"), "join-mixed")
        common.remove(self.spark, now, self.postings)
        self.postings = out
        return not out.isEmpty()

    def possible(self, x: str, y: str):
        """Length, positional and parity filter on two postings of one token."""
        size = F.col(f"{x}.size") + F.col(f"{y}.size")
        need = self.need(size)
        rest = F.least(*[F.col(f"{k}.size") - F.col(f"{k}.pos") for k in (x, y)])
        smaller, larger = (f(F.col(f"{x}.size"), F.col(f"{y}.size")) for f in (F.least, F.greatest))
        apart = sum(F.bit_count(F.col(f"{x}.{k}").bitwiseXOR(F.col(f"{y}.{k}"))) for k in _LANES)
        return ((100 * smaller >= self.percent * larger) & (rest >= need) & (F.col(f"{x}.root") != F.col(f"{y}.root"))
                & (apart <= size - 2 * need))

    def need(self, sizes):
        """Intersection that a union of sets of these sizes together asks for."""
        return F.floor((self.percent * sizes + 99 + self.percent) / (100 + self.percent)).cast("long")

    def met(self, lo: int, hi: int) -> DataFrame:
        """Pairs of members of slots from `lo` to before `hi` with all that come after them in a list, untested and staged."""
        lead = self.postings.where((F.col("slot") >= lo) & (F.col("slot") < hi)).alias("y")
        later = F.struct("x.slot", "x.node") > F.struct("y.slot", "y.node")
        return self.untested(self.postings.alias("x").join(lead, "token").where(later & self.possible("x", "y")))

    def untested(self, met: DataFrame) -> DataFrame:
        a, b = F.col("x.node"), F.col("y.node")
        pairs = met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        return common.staged(pairs, "join-pairs")

    def test(self, pairs: DataFrame) -> None:
        """Verify new (staged) pairs and take their links into the components."""
        a, b = (self.nodes.select(F.col("node").alias(k), F.col("size").alias(f"size_{k}"), F.col("parts").alias(f"parts_{k}")) for k in "ab")
        apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda p, q: F.abs(p - q)), F.lit(0), lambda s, d: s + d)
        sizes = F.col("size_a") + F.col("size_b")
        close = common.staged(pairs.join(a, "a").join(b, "b").where(apart <= sizes - 2 * self.need(sizes)).select("a", "b").distinct(), "join-close")
        asked = common.staged(close.select(F.col("a").alias("node")).union(close.select("b")).distinct(), "join-asked")
        few = common.staged(_of_nodes(self.docs, asked), "join-few")  # only these texts are dealt out
        ta, tb = (few.select(F.col("node").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
        found = common.staged(close.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b")
                              .mapInArrow(_verify(self.n, self.percent), "a long, b long, linked boolean"), "join-found")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        links = found.where("linked").select("a", "b")
        if self.roots is not None:
            olds = {c: self.roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}2")) for c in "ab"}
            links = links.join(olds["a"], "a", "left").join(olds["b"], "b", "left").select(
                F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b"))
        new = components(links)
        common.remove(self.spark, found, close, asked, few)
        if self.roots is None:
            self.roots = new
        else:
            before = self.roots
            moved = self.roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
            fresh = new.join(self.roots.select("node"), "node", "left_anti")
            self.roots = common.staged(moved.select("node", F.coalesce("top", "root").alias("root")).union(fresh), "join-roots")
            common.remove(self.spark, before, new)


def similar_groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = 5, percent: int = 80,
                   counters: int = COUNTERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `df`.

    Texts null or without words have no shingles, link with nothing and are their own component. Rows that share an id
    are one node; rows without an id have no component. Letters A-Z are lower-cased. An empty table gives no rows.
    """
    spark = common.tune(df.sparkSession)
    docs = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    shared = spark.sparkContext.broadcast(frequencies(docs, "text", n, counters))
    signs = common.staged(docs.mapInArrow(_sign("doc_id", "text", n, percent, shared),
                                          "doc_id long, n_shingles long, digest binary, prefix array<long>, parts array<int>, "
                                          + ", ".join(f"{k} long" for k in _LANES)), "join-signs")
    sets = signs.where("n_shingles > 0 and doc_id is not null")
    reps = common.staged(sets.groupBy("digest").agg(F.min("doc_id").alias("node")), "join-reps")
    join = _Join(docs, signs, reps, n, percent)
    lo, hi = 0, SLOTS
    while join.open(lo):
        pairs = join.met(lo, hi)
        if not pairs.isEmpty():
            join.test(pairs)
        lo, hi = hi, hi * WIDER
    common.remove(spark, join.postings, join.nodes)
    # rows of one id are one node even where their texts differ
    same = sets.select("digest", "doc_id").join(reps, "digest").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    twice = same.join(sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("a")), "a", "left_semi")
    roots = join.roots if join.roots is not None else spark.createDataFrame([], "node long, root long")
    if not (twice := common.staged(twice, "join-twice")).isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(twice))
    named = reps.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component_id"))
    with_set = sets.select("doc_id", "n_shingles", "digest").join(named, "digest").select("doc_id", "n_shingles", "component_id")
    without = signs.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_set.union(without)


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of `df` that are the smallest id of their component; rows without id or words all stay."""
    groups = similar_groups(df, id_column, text_column, **options)
    gone = groups.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return df.join(gone, F.col(f"`{id_column}`") == F.col("_gone"), "left_anti")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(common.read(spark, sf_dir, "documents"), n=3, percent=90)


QUERIES = {"op4_ngram_jaccard_join": op4_ngram_jaccard_join}
ORACLE = {"op4_ngram_jaccard_join": r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
    SELECT doc_id, unnest(list_distinct(
        CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
             WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS gram FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * met >= 90 * (p.n + q.n - met)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
    SELECT x AS doc_id, x AS root FROM ways
    UNION
    SELECT w.y, r.root FROM reached r JOIN ways w ON r.doc_id = w.x)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
LEFT JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) r ON d.doc_id = r.doc_id"""}
