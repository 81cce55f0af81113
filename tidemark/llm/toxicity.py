"""Toxicity by weak supervision.

Ten voters look at the words of a text: public lists of insults, lexica of words and of word beginnings mined from the
labelled rows that may be learnt from, and patterns (masked or stretched letters, shouting, direct address). No voter
is trusted. A generative model of a hidden class and the votes, with terms for the pairs of voters whose agreement the
class does not explain, is fitted to how often each of the 1,024 combinations of votes occurs in all documents; it
gives each combination a posterior. A linear classifier on the words and word beginnings that a text has is then
trained on posteriors, not on labels, and scores every document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .quality_classifier import Leader, labelled_sample

BITS = 18
LABELLED = 12_000      # labelled rows the lexica are mined from, at most
SAMPLE = 12_000        # documents the classifier is trained on, at most
LEXICON = 3_000        # entries of the mined lexica, at most
EVIDENCE = 12.0        # nats by which an entry must favour toxic rows
EDGES = 6              # pairs of voters with a term of their own
HELD_OUT = (5, 0)
CUT = 0.5
PREFIXES = (4, 5)      # lengths of word beginnings
LEARNING = {"alpha": 1.0, "beta": 1.0, "l1": 8.0, "l2": 1e-3}
VOTERS = ["list_en", "list_other", "words_0", "words_1", "words_2", "starts_0", "starts_1", "masked", "shouted", "addressed"]

# Public insults, a few of each language
INSULTS_EN = """ass asshole bastard bitch bullshit clown crap cretin cunt damn degenerate dick disgusting dumb dumbass fag faggot filthy fool fuck
fucking garbage hate idiot idiotic imbecile jerk kill loser lunatic moron motherfucker nazi nigger pathetic pig prick pussy rapist retard
scum scumbag shit slut stupid subhuman suck terrorist trash twat ugly vermin whore worthless""".split()
INSULTS_OTHER = """arsch arschloch abschaum blödmann depp dumm dummkopf hurensohn hure idiotin miststück schlampe schwachkopf schwein scheisse scheiße
trottel untermensch wichser abruti bâtard bouffon con connard connasse crétin débile enculé imbécile merde nazi ordure pourriture pute
racaille salaud salope stupide cabrón basura bastardo estúpido gilipollas hijoputa idiota imbécil maricón mierda pendejo puta puto
tonto zorra escoria""".split()
YOU = set("you your youre u du ihr sie tu vous t vosotros usted eres".split())
ARE = set("are re is were bist seid sind es êtes eres son sois".split())

_RUN = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_][*@#$!]+[^\W\d_]|([^\W\d_])\1{3,}")


def runs(word: bytes) -> list[str]:
    return _RUN.findall(word.decode("utf-8", "replace").lower())


def starts(run: str) -> list[str]:
    return [run[:n] + "-" for n in PREFIXES if len(run) > n + 1]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


class Reader:
    """What is known of each distinct word: the voters it sets off, and its hashed features."""

    def __init__(self, lexicon: dict[str, int] | None, weights: np.ndarray | None = None, bits: int = BITS):
        """lexicon: mined words and beginnings (ending in -) with the bits of their voters; weights: for scores of words."""
        self.lexicon, self.weights, self.shift = lexicon or {}, weights, 64 - bits
        self.public = {w: 1 for w in INSULTS_EN}
        for w in INSULTS_OTHER:
            self.public[w] = self.public.get(w, 0) | 2
        self._reset()

    def _reset(self) -> None:
        self.words = common.Words(self._new)
        self.votes, self.you, self.are = common.Growing(np.int32), common.Growing(bool), common.Growing(bool)
        self.features, self.ends, self.scores = common.Growing(np.int64), common.Growing(np.int64), common.Growing(float)
        self.ends.extend([0])

    def _new(self, new: list[bytes]) -> None:
        votes, you, are, features, counts = [], [], [], [], []
        for word in new:
            found, vote, mine = runs(word), 0, []
            for run in found:
                vote |= self.public.get(run, 0) | self.lexicon.get(run, 0)
                mine.append(_hash(run) >> self.shift)
                for s in starts(run):
                    vote |= self.lexicon.get(s, 0)
                    mine.append(_hash(s) >> self.shift)
            text = word.decode("utf-8", "replace")
            vote |= (1 << 7) * bool(_MASKED.search(text)) | (1 << 8) * (text.isupper() and len(text) > 4 and "!" in text)
            votes.append(vote)
            you.append(bool(found) and found[0] in YOU)
            are.append(bool(found) and found[-1 if found[0] in YOU else 0] in ARE)
            features += mine
            counts.append(len(mine))
        self.votes.extend(votes)
        self.you.extend(you)
        self.are.extend(are)
        ends = self.ends.values[-1] + np.cumsum(counts)
        self.features.extend(features)
        self.ends.extend(ends)
        if self.weights is not None and len(new):
            at = np.concatenate(([0.0], np.cumsum(self.weights[np.array(features, np.int64)])))
            ends = ends - ends[0] + counts[0]
            self.scores.extend(at[ends] - at[ends - counts])

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct word numbers of each text, their texts, vote combination of each text)"""
        if len(self.words) > common.MEMO_WORDS:
            self._reset()
        flat, offsets = self.words.numbers([t.split() for t in texts])
        n_docs = len(texts)
        doc = np.repeat(np.arange(n_docs), np.diff(offsets))
        at = self.votes.values[flat]
        combos = np.zeros(n_docs, np.int64)
        for bit in range(len(VOTERS) - 1):
            hit = doc[(at >> bit) & 1 == 1]
            combos[hit] |= 1 << bit
        you, are = self.you.values[flat], self.are.values[flat]
        combos[doc[you & are]] |= 1 << 9  # you're
        combos[doc[1:][you[:-1] & are[1:] & (doc[1:] == doc[:-1])]] |= 1 << 9
        keys = np.sort((doc << 32) | flat)
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
        return keys & 0xFFFFFFFF, keys >> 32, combos

    def sparse(self, words: np.ndarray, doc: np.ndarray, n_docs: int):
        """(coordinates, values) of each text, its constant last; a value counts the distinct words with the feature."""
        ends = self.ends.values
        bounds = np.searchsorted(doc, np.arange(n_docs + 1))
        for k in range(n_docs):
            own = words[bounds[k]:bounds[k + 1]]
            at = np.concatenate([self.features.values[ends[w]:ends[w + 1]] for w in own]) if len(own) else np.zeros(0, np.int64)
            at, counts = np.unique(at, return_counts=True)
            yield np.append(at, 1 << (64 - self.shift)), np.append(np.minimum(counts, 3), 1.0)


def mined(rows, bound: int = LEXICON, evidence: float = EVIDENCE) -> dict[str, int]:
    """Words and beginnings that favour the toxic rows of (text, label), dealt to their voters in turn."""
    seen: tuple[dict[str, int], dict[str, int]] = ({}, {})
    n = [0, 0]
    for text, label in rows:
        toxic = int(label > 0.5)
        n[toxic] += 1
        found = {r for w in set(text.split()) for r in runs(w)}
        for x in found | {s for r in found for s in starts(r)}:
            seen[toxic][x] = seen[toxic].get(x, 0) + 1
    share = n[1] / max(1, sum(n))
    if not 0 < share < 1:
        return {}
    out = []
    for x, c1 in seen[1].items():
        c = c1 + seen[0].get(x, 0)
        p = c1 / c
        if p > share:
            nats = c * (p * np.log(p / share) + (1 - p) * np.log(max(1 - p, 1e-300) / (1 - share)))
            if nats >= evidence and p > 0.5:
                out.append((-nats, x))
    words = [x for _, x in sorted(out) if not x.endswith("-")][:bound]
    begun = [x for _, x in sorted(out) if x.endswith("-")][:bound]
    return {x: 1 << (2 + k % 3) for k, x in enumerate(words)} | {x: 1 << (5 + k % 2) for k, x in enumerate(begun)}


class LabelModel:
    """Hidden class and votes: log-linear in the votes of each class, with terms for some pairs of voters.

    All combinations are enumerated, so probabilities are exact; the fit alternates posteriors of the class with
    Newton steps on each class's terms.
    """

    def __init__(self, n_voters: int):
        self.votes = (np.arange(1 << n_voters)[:, None] >> np.arange(n_voters) & 1).astype(float)
        self.pairs: list[tuple[int, int]] = []

    def _terms(self) -> np.ndarray:
        return np.column_stack([self.votes, *[self.votes[:, i] * self.votes[:, j] for i, j in self.pairs]])

    def _class(self, weights: np.ndarray) -> np.ndarray:
        x = self._terms() @ weights
        x = np.exp(x - x.max())
        return x / x.sum()

    def _run(self, counts: np.ndarray, rounds: int) -> None:
        terms, total = self._terms(), counts.sum()
        for _ in range(rounds):
            post = self.posterior()
            self.prior = float(np.clip((post * counts).sum() / total, 1e-4, 0.5))
            for y, share in ((0, 1 - post), (1, post)):
                weight = share * counts
                size = weight.sum() + 1e-9
                target = (terms * weight[:, None]).sum(0) / size
                w = self.weights[y]
                for _ in range(3):
                    p = self._class(w)
                    mean = p @ terms
                    cov = (terms * p[:, None]).T @ terms - np.outer(mean, mean)
                    ridge = 2.0 / size  # a weak pull towards the start, which keeps unseen votes finite
                    step = np.linalg.solve(cov + (1e-6 + ridge) * np.eye(len(w)), target - mean - ridge * (w - self.start[y]))
                    w = w + np.clip(step, -2, 2)
                self.weights[y] = np.clip(w, -14, 14)

    def posterior(self) -> np.ndarray:
        p0, p1 = ((1 - self.prior) * self._class(self.weights[0]), self.prior * self._class(self.weights[1]))
        return p1 / (p0 + p1 + 1e-300)

    def fit(self, counts: np.ndarray, rates: np.ndarray, prior: float, edges: int = EDGES, rounds: int = 12) -> LabelModel:
        """counts: of each combination in all documents; rates: first guess of each voter's rate of hits for both classes.

        A pair of voters gets a term where that alone raises the likelihood most, and by more than the term costs.
        """
        clipped = np.clip(rates, 1e-4, 1 - 1e-4)
        logits, prior = np.log(clipped / (1 - clipped)), float(np.clip(prior, 1e-3, 0.5))
        n, total = self.votes.shape[1], counts.sum()
        if not total:
            rounds = 0
        plain = self._fitted(counts, logits, prior, [], rounds)
        gain = {(j, i): self._fitted(counts, logits, prior, [(j, i)], rounds) - plain for i in range(n) for j in range(i)} if rounds else {}
        best = sorted((p for p in gain if gain[p] > np.log(total)), key=gain.get, reverse=True)[:edges]
        self._fitted(counts, logits, prior, best, 2 * rounds)
        return self

    def _fitted(self, counts: np.ndarray, logits: np.ndarray, prior: float, pairs: list[tuple[int, int]], rounds: int) -> float:
        """Fit with these pairs; the log likelihood."""
        self.pairs, self.prior = pairs, prior
        self.start = [np.append(w, np.zeros(len(pairs))) for w in logits]
        self.weights = list(self.start)
        if rounds:
            self._run(counts, rounds)
        p = (1 - self.prior) * self._class(self.weights[0]) + self.prior * self._class(self.weights[1])
        return float(counts @ np.log(p + 1e-300))


def _mine(batches):
    def rows():
        for batch in batches:
            yield from zip(common.texts(batch.column("text")), batch.column("label").to_pylist())
    found = mined(rows())
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["entry", "voter"])


def _vote(lexicon, keep_label: bool):
    def make():
        reader = Reader(lexicon.value)

        def apply(batch):
            combos = pa.array(reader.read(common.texts(batch.column("text")))[2])
            names = ["label"] if keep_label else []
            return common.append(batch.select(names), {"combo": combos})
        return apply
    return common.per_batch(make)


def _learn(lexicon, posterior, bits: int, learning: dict):
    def run(batches):
        reader, leader = Reader(lexicon.value, bits=bits), Leader(bits, **learning)
        for batch in batches:
            words, doc, combos = reader.read(common.texts(batch.column("text")))
            for (at, values), combo in zip(reader.sparse(words, doc, batch.num_rows), combos):
                leader.learn(at, values, float(posterior.value[combo]))
        yield pa.RecordBatch.from_arrays([pa.array([leader.weights(slice(None)).astype(np.float32).tobytes()], pa.binary())], names=["weights"])
    return run


def _score(weights, bits: int):
    def make():
        own = weights.value.astype(float)
        reader = Reader(None, own, bits)

        def apply(batch):
            words, doc, _ = reader.read(common.texts(batch.column("text")))
            sums = np.bincount(doc, weights=reader.scores.values[words], minlength=batch.num_rows) + own[-1]
            return common.append(batch.select(["doc_id"]), {"score": pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))))})
        return apply
    return common.per_batch(make)


def score_toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT, held_out: tuple[int, int] = HELD_OUT, bits: int = BITS,
                   labelled: int = LABELLED, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    The score is the classifier's probability of label 1. Null and empty texts have the constant's score. Without
    labelled rows the public lists and patterns alone vote. Rows of the same text get the same score.
    """
    spark = common.tune(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    context, m = spark.sparkContext, len(VOTERS)
    turn = F.md5(F.col("doc_id").cast("string"))
    chosen = common.staged(labelled_sample(docs, labels, "toxic", held_out, labelled).select("text", "label"), "toxic-labelled")
    entries = chosen.repartition(1).mapInArrow(_mine, "entry string, voter long").collect()
    lexicon = context.broadcast({r.entry: r.voter for r in entries})
    first = chosen.mapInArrow(_vote(lexicon, True), "label double, combo long").groupBy("label", "combo").count().collect()
    rates, sizes = np.full((2, m), 0.01), np.zeros(2)
    rates[1], votes = 0.3, (np.arange(1 << m)[:, None] >> np.arange(m) & 1)
    for y in (0, 1):
        rows = [(r.combo, r["count"]) for r in first if r.label == y]
        sizes[y] = sum(n for _, n in rows)
        if rows:
            rates[y] = (sum(votes[c] * n for c, n in rows) + rates[y] * 4) / (sizes[y] + 4)
    counts = np.zeros(1 << m)
    for r in docs.select("text").mapInArrow(_vote(lexicon, False), "combo long").groupBy("combo").count().collect():  # at most 2^m rows
        counts[r.combo] = r["count"]
    model = LabelModel(m).fit(counts, rates, sizes[1] / sizes.sum() if sizes.sum() else 0.05)
    ids = (docs.where(F.col("doc_id").isNotNull() & (common.fold(docs, "doc_id", held_out[0]) != held_out[1]))
           .select("doc_id").distinct().orderBy(turn, "doc_id").limit(sample))
    learnt = common.one_text(docs.join(F.broadcast(ids), "doc_id"), "doc_id").select("text", turn.alias("turn")).repartition(1).sortWithinPartitions("turn")  # `sample` ids
    rows = learnt.select("text").mapInArrow(_learn(lexicon, context.broadcast(model.posterior()), bits, LEARNING), "weights binary").collect()
    weights = np.frombuffer(rows[0].weights, np.float32) if rows else np.zeros((1 << bits) + 1, np.float32)
    scored = docs.mapInArrow(_score(context.broadcast(weights), bits), "doc_id long, score double")
    return scored.select("doc_id", (common.fold(scored, "doc_id", held_out[0]) == held_out[1]).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLE: dict[str, str] = {}
