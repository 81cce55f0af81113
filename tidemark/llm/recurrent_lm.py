"""Language-model scoring with a small gated recurrent network.

Counts of all words of the training documents come first, summed by Spark. All frequent words are symbols of the
network; every other word is seen as its rest class, told by its last letters. The output is factored: a class, then a
word of the class. Frequent words are dealt by count to classes, few to one where they are very frequent, with a softmax
over their words given the state; within a rest class a word has its count's share, unseen words together that of half a
count. So each text has a proper probability over all words, and the network adds what the words before say about the next.

Training is truncated back-propagation through time in numpy: a first model from a bounded sample, then shards of about
SHARD tokens each go on from it, together over all training documents, and the weights are averaged by the tokens they
saw. A hash of the row says its shard and its turn there, so the weights do not depend on how the input is split, and a
larger corpus has more shards, not shorter ones. Texts are read whole: the state is carried from window to window and
starts anew at each document. Documents of any length are packed into lanes, so a step of all lanes is one matrix product.

Counts of frequent words (at most FREQUENT, those that make up at least that share of all tokens) travel to the tasks;
the others, none of which can be hot, are joined to the documents that use them.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

FREQUENT = 200_000    # a word with at least 1 / FREQUENT of all tokens is frequent, so there are no more than these
REST = 24             # rest classes
STATE = 16            # units
LANES = 512           # documents side by side when scoring
SCORE_BYTES = 6 << 20    # of text read together
TRAIN_LANES = 1024    # documents side by side when training
TRAIN_BYTES = 4 << 20    # of text read together
TOGETHER = 5_000_000  # tokens packed into lanes together, more than a shard has, so that few steps are left to the longest text alone
WINDOW = 24           # steps between truncations
FIRST = 1_500         # documents of the first model's sample, at most; the shards learn from all documents afterwards
SHARD = 4_000_000     # tokens a copy of the model learns from before the copies are averaged
CELLS = 1 << 16       # shares worked out together, so that they stay in a core's cache
BLOCK = 1 << 12       # tokens of these, at most
SCORED = 1 << 15      # tokens whose states are worked out before their shares
PART = 1 << 14        # weights updated together
SAFE = 30.0           # logits within this need no guard against overflow
RATE = 1.6e-2
CHUNK = 1 << 13       # weights sent together
HELD_OUT = (5, 1)
END = b" "            # stands for the end of a text; no word has a space


SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


def tail(word: bytes) -> bytes:
    """The last bytes of a word that are not ASCII punctuation."""
    return word.rstrip(SIGNS.encode())[-2:]


def tails(words: pa.Array) -> pa.Array:
    """`tail` of each of a binary column."""
    return pc.binary_slice(pc.ascii_rtrim(words.view(pa.string()), SIGNS).view(pa.binary()), -2)


class Vocabulary:
    """Counts of frequent words, symbols, rest classes and the totals of those."""

    def __init__(self, counts: dict[bytes, int], total: int, distinct: int, explicit: int | None = None, rest: int = REST):
        explicit = len(counts) + 1 if explicit is None else explicit  # all, and the end of a text
        self.counts, self.total, self.distinct = counts, total, distinct
        ranked = sorted(counts, key=lambda w: (-counts[w], w))
        self.symbol = {w: k for k, w in enumerate(ranked[:explicit])}
        if total and END not in self.symbol:
            self.symbol[END] = min(len(self.symbol), explicit - 1)
            self.symbol = {w: k for w, k in self.symbol.items() if w == END or k != self.symbol[END]}
        self.n_explicit = max(self.symbol.values(), default=-1) + 1
        masses: dict[bytes, int] = {}
        for w in ranked[explicit:]:
            masses[tail(w)] = masses.get(tail(w), 0) + counts[w]
        self.rest = rest
        self.rest_tokens, self.rest_words = np.zeros(rest), np.zeros(rest)
        self._classes(masses)
        self.explicit_counts = np.zeros(self.n_explicit)
        for w, k in self.symbol.items():
            self.explicit_counts[k] = counts.get(w, 0)

    def _classes(self, masses: dict[bytes, int]) -> None:
        """The endings with the most tokens have rest classes of their own."""
        self.tails = {t: k for k, t in enumerate(sorted(masses, key=lambda t: (-masses[t], t))[:self.rest - 1])}

    def set_rest(self, endings: list[tuple[bytes, int, int]]) -> None:
        """(ending, tokens, words) of all words that are no symbols."""
        self._classes({t: n for t, n, _ in endings})
        for t, n, words in endings:
            k = self.tails.get(t, self.rest - 1)
            self.rest_tokens[k] += n
            self.rest_words[k] += words

    def rest_class(self, word: bytes) -> int:
        return self.tails.get(tail(word), self.rest - 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


class Shares:
    """Softmaxes of states, one for each run of columns from `starts[k]` to `starts[k + 1]`, with weights `w` (column, state).

    A bias is a factor of the exponentials, put into their sums, so no pass over the logits is made but the exponential; where
    that might overflow it is added first. `most` is the largest component of a state.
    """

    def __init__(self, w: np.ndarray, b: np.ndarray, starts: list[int], most: float, learn: bool = False):
        self.w, self.b, self.starts = w, b, starts
        bound = most * float(np.abs(w).sum(1).max(initial=0))
        self.plain = bound <= SAFE and float(np.abs(b).max(initial=0)) <= SAFE
        self.factor = np.exp(b) if self.plain else np.ones_like(b)
        self.back = w * self.factor[:, None] if learn else None
        self.sizes = np.diff(starts)
        self.e = np.empty(max(CELLS, int(self.sizes.max(initial=0))), w.dtype)
        self.sums, self.d = np.empty(BLOCK, w.dtype), np.empty((BLOCK, w.shape[1]), w.dtype)

    def blocks(self, softmax: np.ndarray):
        """(first, end) of rows worked out together, and their runs (softmax, first, end from there); rows are sorted by softmax."""
        cells, ends = np.cumsum(self.sizes.take(softmax)), np.searchsorted(softmax, np.arange(1, len(self.sizes) + 1)).tolist()
        i = 0
        while i < len(softmax):
            done = int(cells[i - 1]) if i else 0
            j = min(max(int(np.searchsorted(cells, done + CELLS, side="right")), i + 1), i + BLOCK, len(softmax))
            runs, first = [], i
            for k in range(int(softmax[i]), int(softmax[j - 1]) + 1):
                end = min(ends[k], j)
                if end > first:
                    runs.append((k, first - i, end - i))
                first = max(first, end)
            yield i, j, runs
            i = j

    def of(self, runs: list[tuple[int, int, int]], h: np.ndarray, column: np.ndarray, logp: np.ndarray, d=None, grads=None) -> None:
        """Adds to `logp` the log share of each row's column, to `d` their gradients by state, and to `grads` those by weight and
        bias, less their factors. `runs` are (softmax, first, end) of the rows, one after another."""
        m, used, parts = len(h), 0, []
        total, place = self.sums[:m], np.empty(m, np.intp)
        for k, i, j in runs:
            a, b = self.starts[k], self.starts[k + 1]
            e = self.e[used:used + (j - i) * (b - a)].reshape(j - i, b - a)
            place[i:j] = np.arange(used - a, used - a + e.size, b - a)
            used += e.size
            parts.append((e, a, b, i, j))
            np.matmul(h[i:j], self.w[a:b].T, out=e)
            if not self.plain:
                e += self.b[a:b]
                np.minimum(e, 60, out=e)
        place += column
        every = self.e[:used]
        own = every.take(place)
        if self.plain:
            own += self.b.take(column)
        np.exp(every, out=every)
        for e, a, b, i, j in parts:
            np.matmul(e, self.factor[a:b], out=total[i:j])
        own -= np.log(total)
        logp += own
        if d is not None:  # by logit: what is chosen less its share; here times -total / factor
            every[place] -= total / self.factor.take(column)
            share = 1 / total
            scaled, by_state = h * share[:, None], self.d[:m]
            for e, a, b, i, j in parts:
                np.matmul(e, self.back[a:b], out=by_state[i:j])
                grads[0][a:b] -= e.T @ scaled[i:j]
                grads[1][a:b] -= share[i:j] @ e
            by_state *= share[:, None]
            d -= by_state


def class_starts(words: np.ndarray, total: float) -> list[int]:
    """Where classes of words begin, by counts in descending order, and their end.

    A token costs a column for each class and for each word of its own class. That is least, over all tokens, where each class
    has the same sum of roots of its words' shares, and there are as many classes as those come to (at most the root of the words).
    """
    roots = np.cumsum(np.sqrt(words / total))
    if not len(roots):
        return [0]
    classes = min(math.isqrt(len(words) - 1) + 1, math.ceil(roots[-1]) + 1)
    firsts = np.searchsorted(roots, np.arange(1, classes) * (roots[-1] / classes), side="right")
    return [*np.unique(np.append(0, firsts[firsts < len(words)])).tolist(), len(words)]


class Net:
    """Gated recurrent network with class-factored output; all weights in `p`."""

    def __init__(self, vocabulary: Vocabulary, p: dict[str, np.ndarray] | None = None, state: int = STATE, size: int | None = None):
        n, r = vocabulary.n_explicit, vocabulary.rest
        words = vocabulary.explicit_counts + 0.5
        self.h, self.size, self.n = state, size or max(1, math.isqrt(max(0, n - 1)) + 1), n
        self.starts = [*range(0, n, size), n] if size else class_starts(words, words.sum() + vocabulary.rest_tokens.sum())
        self.classes = len(self.starts) - 1
        self.end = vocabulary.symbol.get(END, 0)
        self.kind = np.min_scalar_type(n + r)  # of a symbol
        own = np.repeat(np.arange(self.classes), np.diff(self.starts))
        self.class_of = np.concatenate([own, self.classes + np.arange(r)]).astype(np.int16)
        if p is None:
            rng = np.random.default_rng(7)
            scale = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
            mass = np.concatenate([np.bincount(own, weights=words, minlength=self.classes), vocabulary.rest_tokens + 0.5])
            most = np.maximum.reduceat(words, self.starts[:-1]) if n else words
            p = {"x": scale(3, n + r, state), "u": scale(3, state, state), "wc": scale(self.classes + r, state), "bc": np.log(mass / mass.max()).astype(np.float32),
                 "wo": scale(n, state), "bo": np.log(words / np.maximum(1, most)[own]).astype(np.float32)}
        self.p = p
        self.grads, self.met = {}, np.zeros(0, np.intp)  # arrays used again by each update, symbols of the last one

    def room(self, tokens: int, lanes: int) -> tuple[np.ndarray, ...]:
        """For steps of so many tokens: gates and new part, states before, their products, states after; products of a step."""
        empty = lambda *shape: np.empty((*shape, self.h), self.p["u"].dtype)
        return empty(3, tokens), empty(tokens), empty(tokens), empty(tokens), empty(2, lanes)

    def step(self, symbols: np.ndarray, h: np.ndarray, keep: tuple[np.ndarray, ...]) -> np.ndarray:
        """State after `symbols`; h is reset where the symbol ends a text. All goes to `keep`, a `room`, gate by gate."""
        (z, r, n), old, hn, out, products = keep
        for own, x in zip((z, r, n), self.p["x"]):
            x.take(symbols, axis=0, out=own, mode="clip")
        old[:] = h
        old[symbols == self.end] = 0
        zr, u = keep[0][:2], self.p["u"]
        zr += np.matmul(old, u[:2], out=products)
        sigmoid(zr)
        np.matmul(old, u[2], out=hn)
        n += np.multiply(r, hn, out=out)
        np.tanh(n, out=n)
        np.subtract(old, n, out=out)
        out *= z
        out += n
        return out

    def steps(self, symbols: np.ndarray, bounds: list[int], h: np.ndarray, room: tuple[np.ndarray, ...]) -> np.ndarray:
        """The last state after `symbols`, a step from each of `bounds` to the next; all states go to `room`."""
        pre, old, hn, out, products = room
        for a, b in zip(bounds[:-1], bounds[1:]):
            h = self.step(symbols[a:b], h[:b - a], (pre[:, a:b], old[a:b], hn[a:b], out[a:b], products[:, :b - a]))
        return h

    def shares(self, most: float = 1.0, learn: bool = False) -> tuple[Shares, Shares]:
        """Of the classes, and of the words within each; components of states that steps make are within 1."""
        p = self.p
        return Shares(p["wc"], p["bc"], [0, len(p["bc"])], most, learn), Shares(p["wo"], p["bo"], self.starts, most, learn)

    def empty(self, name: str) -> np.ndarray:
        """Zeros of the shape of weights `name`."""
        if name not in self.grads or self.grads[name].dtype != self.p[name].dtype:
            self.grads[name] = np.zeros_like(self.p[name])
        else:
            self.grads[name].fill(0)
        return self.grads[name]

    def outputs(self, states: np.ndarray, targets: np.ndarray, learn: bool = False, shares: tuple[Shares, Shares] | None = None):
        """Natural log probability of each target; with `learn` also the gradients of their sum."""
        of_class, of_word = shares or self.shares(float(np.abs(states).max(initial=0)), learn)
        cls = self.class_of[targets]
        order = np.argsort(cls, kind="stable")  # by class: each class's words are then one block
        states, word, cls = states.take(order, axis=0), targets.take(order).astype(np.intp), cls.take(order).astype(np.intp)
        logp, d, by_class, by_word = np.zeros(len(cls), states.dtype), None, None, None
        grads = {k: self.empty(k) for k in ("wc", "bc", "wo", "bo")} if learn else None
        if learn:
            d, by_class, by_word = np.zeros_like(states), (grads["wc"], grads["bc"]), (grads["wo"], grads["bo"])
        explicit = int(np.searchsorted(cls, self.classes))  # rest classes have no words
        for x, softmax, column, own in ((of_class, np.zeros_like(cls), cls, by_class), (of_word, cls[:explicit], word, by_word)):
            for i, j, runs in x.blocks(softmax):
                x.of(runs, states[i:j], column[i:j], logp[i:j], d[i:j] if learn else None, own)
        if learn:
            for (w, b), x in ((by_class, of_class), (by_word, of_word)):
                w *= x.factor[:, None]
                b *= x.factor
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return (logp.take(back), grads, d.take(back, axis=0)) if learn else logp.take(back)

    def lanes(self, symbols: np.ndarray, lengths: np.ndarray, lanes: int):
        """(symbols step after step, the ones before, where steps begin, texts of each lane)"""
        mine, sizes = packed(lengths, lanes)
        busy = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes.max(initial=0))), side="right")
        begun, firsts = np.concatenate(([0], np.cumsum(busy))), np.cumsum(lengths) - lengths
        after, before = np.empty_like(symbols), np.empty_like(symbols)
        for lane, texts in enumerate(mine):
            own = np.concatenate([symbols[firsts[k]:firsts[k] + lengths[k]] for k in texts.tolist()])
            place = begun[:len(own)] + lane
            after[place] = own
            before[place[1:]] = own[:-1]
            before[place[np.cumsum(lengths[texts]) - lengths[texts]]] = self.end
        return after, before, begun.tolist(), mine

    def score(self, symbols: np.ndarray, lengths: np.ndarray, lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
        """Natural log probability of each text of `symbols` (its end included)."""
        if not len(symbols):
            return np.zeros(len(lengths))
        flat, before, begun, mine = self.lanes(symbols, lengths, lanes)
        parts, shares = list(blocks(begun, window, SCORED)), self.shares()
        room = self.room(max(begun[t1] - begun[t0] for t0, t1 in parts), begun[1])
        logp, h = np.zeros(len(flat), np.float32), np.zeros((begun[1], self.h), np.float32)
        for t0, t1 in parts:
            a, b = begun[t0], begun[t1]
            h = self.steps(before[a:b], [t - a for t in begun[t0:t1 + 1]], h, room).copy()
            logp[a:b] = self.outputs(room[3][:b - a], flat[a:b], shares=shares)
        out, firsts = np.empty(len(lengths)), np.array(begun)
        for lane, texts in enumerate(mine):
            ends = np.cumsum(lengths[texts])
            out[texts] = np.add.reduceat(logp.take(firsts[:ends[-1]] + lane), ends - lengths[texts], dtype=np.float64)
        return out

    def train(self, symbols: np.ndarray, lengths: np.ndarray, adam: dict, lanes: int = TRAIN_LANES, window: int = WINDOW, rate: float = RATE) -> None:
        """One pass over whole texts, an update after each window of all lanes; where few lanes are left, after several."""
        if not len(symbols):
            return
        flat, before, begun, _ = self.lanes(symbols, lengths, lanes)
        s, n_lanes, dtype = self.h, begun[1], self.p["u"].dtype
        parts = list(blocks(begun, window, n_lanes * window // 2))
        most = max(begun[t1] - begun[t0] for t0, t1 in parts)
        room, h = self.room(most, n_lanes), np.zeros((n_lanes, s), dtype)
        d_pre, d_n, products, back = np.empty((3, most, s), dtype), np.empty((most, s), dtype), np.empty((3, n_lanes, s), dtype), np.empty((n_lanes, s), dtype)
        for t0, t1 in parts:
            a0, size = begun[t0], begun[t1] - begun[t0]
            seen, bounds = before[a0:a0 + size], [t - a0 for t in begun[t0:t1 + 1]]
            h = self.steps(seen, bounds, h, room).copy()
            (z, r, n), old, hn, states = room[0][:, :size], *(x[:size] for x in room[1:4])
            _, grads, d_out = self.outputs(states, flat[a0:a0 + size], learn=True)
            by_n, by_z, by_r = 1 - n * n, 1 - z, 1 - r
            by_n *= by_z
            by_z *= z
            by_z *= np.subtract(old, n, out=n)
            by_r *= r
            by_r *= hn
            dz, dr, dh = d_pre[:, :size]  # of the gates' inputs, and of what the state gives to the new part
            dn, ut = d_n[:size], np.ascontiguousarray(self.p["u"].transpose(0, 2, 1))
            back[:] = 0
            for k in range(len(bounds) - 2, -1, -1):
                at, m = slice(bounds[k], bounds[k + 1]), bounds[k + 1] - bounds[k]
                if (k + 1) % window == 0:
                    back[:] = 0
                d, own = back[:m], dn[at]
                d += d_out[at]
                np.multiply(d, by_n[at], out=own)
                np.multiply(d, by_z[at], out=dz[at])
                np.multiply(own, by_r[at], out=dr[at])
                np.multiply(own, r[at], out=dh[at])
                d *= z[at]
                for x in np.matmul(d_pre[:, at], ut, out=products[:, :m]):
                    d += x
                d[seen[at] == self.end] = 0
            grads["u"] = np.matmul(old.T, d_pre[:, :size])
            order, grads["x"] = np.argsort(seen, kind="stable"), self._empty_rows()
            own = seen.take(order)
            firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            self.met = own[firsts].astype(np.intp)
            for own, x in zip(grads["x"], (dz, dr, dn)):
                own[self.met] = np.add.reduceat(x.take(order, axis=0), firsts, axis=0)
            self._update(grads, size, adam, rate, self.met)

    def _empty_rows(self) -> np.ndarray:
        """`empty` of "x", of which only the rows met by the last update are filled."""
        if "x" not in self.grads or self.grads["x"].dtype != self.p["x"].dtype:
            return self.empty("x")
        self.grads["x"][:, self.met] = 0
        return self.grads["x"]

    def _update(self, grads: dict, tokens: int, adam: dict, rate: float, met: np.ndarray) -> None:
        """Adam; of the rows of `x` only those met, the others have no gradient. Its means are kept as sums."""
        adam["t"] = t = adam.get("t", 0) + 1
        least = math.sqrt(1 - 0.99 ** t)
        for k, g in grads.items():
            if k not in adam:
                adam[k] = np.zeros_like(g), np.zeros_like(g)
            g, m, v, p = (x.take(met, axis=1) if k == "x" else x for x in (g, *adam[k], self.p[k]))
            flat = [x.reshape(-1) for x in (g, m, v, p)]
            for i in range(0, g.size, PART):
                g_, m_, v_, p_ = (x[i:i + PART] for x in flat)
                g_ *= 1 / tokens
                if k in "xu":  # the others are means of numbers within 1
                    np.clip(g_, -1, 1, out=g_)
                m_ *= 0.9
                m_ += g_
                v_ *= 0.99
                g_ *= g_
                v_ += g_
                np.sqrt(v_, out=g_)
                g_ += 1e-5 * least
                np.divide(m_, g_, out=g_)
                g_ *= rate * least / (1 - 0.9 ** t)
                p_ += g_
            if k == "x":
                for whole, x in zip((*adam[k], self.p[k]), (m, v, p)):
                    whole[:, met] = x


def blocks(begun: list[int], window: int, least: int):
    """(first, end) of the steps between updates: whole windows, as many as it takes to see `least` tokens; steps begin at `begun`."""
    first, steps = 0, len(begun) - 1
    for t in range(0, steps, window):
        end = min(t + window, steps)
        if begun[end] - begun[first] >= least or end == steps:
            yield first, end
            first = end


def packed(lengths: np.ndarray, lanes: int):
    """(texts of each lane as they come, tokens of each), longest lane first."""
    lanes = max(1, min(lanes, len(lengths)))
    heap, mine = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        size, k = heap[0]
        heapq.heapreplace(heap, (size + int(lengths[doc]), k))
        mine[k].append(doc)
    total = {k: size for size, k in heap}
    by_size = sorted(range(lanes), key=lambda k: -total[k])
    return [np.array(sorted(mine[k]), np.intp) for k in by_size], np.array([total[k] for k in by_size], np.int64)


def _found(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Places of words among `known`, -1 where there is none."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


class Symbols:
    """Texts as symbols and counts, each distinct word of the texts looked up once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.known = pa.array(list(v.counts), pa.binary())
        self.known_symbol = np.array([v.symbol.get(w, -1) for w in v.counts] + [-1], np.int32)  # at -1: of words without a count
        self.known_count = np.array([*v.counts.values(), -1], np.int64)                        # -1: to be joined
        self.tails = pa.array(list(v.tails), pa.binary())
        self.of_tail = np.array([*v.tails.values(), v.rest - 1], np.int32)

    def read(self, texts: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers with an end after each text, tokens of each text); the words are in `words`, what is known of them in
        `symbol`, `count` and `in_rest`"""
        words, codes, lengths = common.split_words(common.binary(texts), lower=True)
        end, lengths = len(words), lengths + 1
        self.words = pa.concat_arrays([words, pa.array([END], pa.binary())])
        at = _found(self.words, self.known)
        self.count, self.symbol = self.known_count[at], self.known_symbol[at]
        self.in_rest = self.symbol < 0
        rest = np.flatnonzero(self.in_rest)
        self.symbol[rest] = self.v.n_explicit + self.of_tail[_found(tails(self.words.take(pa.array(rest))), self.tails)]
        self.symbol[end] = self.v.symbol.get(END, self.symbol[end])
        self.in_rest[end] = END not in self.v.symbol
        flat, word = np.full(int(lengths.sum()), end, codes.dtype), np.ones(int(lengths.sum()), bool)
        word[np.cumsum(lengths) - 1] = False
        flat[word] = codes
        return flat, lengths


def _count(batches):
    for batch in gathered(batches):
        words, codes, lengths = common.split_words(common.binary(batch.column("text")), lower=True)
        counts = np.append(np.bincount(codes, minlength=len(words)), len(lengths))
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array([END], pa.binary())]), pa.array(counts, pa.int64())], names=["word", "n"])


def _endings(shared):
    def run(batches):
        symbols = pa.array(list(shared.value.symbol), pa.binary())
        sums: dict[bytes, list[int]] = {}  # by at most two bytes
        for batch in batches:
            rest = pa.array(np.flatnonzero(_found(batch.column("word"), symbols) < 0))
            ends = tails(batch.column("word").take(rest)).dictionary_encode()
            code, n = ends.indices.to_numpy(), batch.column("n").take(rest).to_numpy()
            tokens = np.zeros(len(ends.dictionary), np.int64)
            np.add.at(tokens, code, n)
            for t, n, words in zip(ends.dictionary.to_pylist(), tokens.tolist(), np.bincount(code, minlength=len(tokens)).tolist()):
                own = sums.setdefault(t, [0, 0])
                own[0] += n
                own[1] += words
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array([x for x, _ in sums.values()], pa.int64()),
                                          pa.array([x for _, x in sums.values()], pa.int64())], names=["ending", "tokens", "words"])
    return run


def _train(shared, start, key: str):
    """Weights times tokens, summed over the shards of a task; a shard's rows come one after the other."""
    def run(batches):
        v = shared.value
        symbols, sums, shard, net, adam, tokens, waiting = Symbols(v), {}, None, None, None, 0, []

        def learn():
            if waiting:
                flat, lengths = (np.concatenate(x) for x in zip(*waiting))
                waiting.clear()
                net.train(flat, lengths, adam)

        def close():
            learn()
            for k, w in net.p.items() if net is not None and tokens else ():
                sums[k] = sums.get(k, 0) + w.astype(np.float64) * tokens
            sums[""] = sums.get("", 0) + tokens

        for number, texts in pieces(batches, TRAIN_BYTES):
            if net is None or number != shard:
                close()
                shard, adam, tokens = number, {}, 0
                net = Net(v, None if start is None else {k: w.copy() for k, w in start.value.items()})
            flat, lengths = symbols.read(texts)
            if sum(len(x) for x, _ in waiting) + len(flat) > TOGETHER:
                learn()
            waiting.append((symbols.symbol.astype(net.kind)[flat], lengths))
            tokens += len(flat)
        close()
        total = sums.pop("")
        for k, w in sums.items():
            w = w.reshape(-1).astype(np.float32)
            for i in range(0, len(w), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([f"{k} {i}"]), pa.array([w[i:i + CHUNK].tobytes()], pa.binary())], names=[key, "w"])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([np.array([float(total)]).tobytes()], pa.binary())], names=[key, "w"])
    return run


def pieces(batches, size: int):
    """(shard, texts) of up to `size` bytes and one shard each, the same for the same rows however they are batched."""
    shard, held, waiting = None, 0, []
    for batch in batches:
        for number, text in zip(batch.column("shard").to_pylist(), common.texts(batch.column("text"))):
            if waiting and (number != shard or held + len(text) > size):
                yield shard, waiting
                held, waiting = 0, []
            shard, held = number, held + len(text)
            waiting.append(text)
    if waiting:
        yield shard, waiting


def _sum(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = np.frombuffer(w, np.float32 if name else np.float64).astype(np.float64)
            sums[name] = sums[name] + w if name in sums else w
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([w.tobytes() for w in sums.values()], pa.binary())], names=["name", "w"])


def sharded(training: DataFrame, tokens: int, rows: int, shard: int = SHARD) -> DataFrame:
    """(text, shard) of all rows of `training`, dealt by a hash of the row and in the order of another.

    A row repeated so often that it would fill a shard (no more rows than there are shards can) goes round them instead.
    """
    n = max(1, round(tokens / shard))
    keyed = training.select("text", F.xxhash64("doc_id", "text").alias("key"))
    if n > 1:
        hot = keyed.groupBy("key").count().where(F.col("count") * n > rows).select("key", F.lit(True).alias("hot"))
        keyed = keyed.join(F.broadcast(hot), "key", "left")  # fewer than `n` keys
        number = F.pmod(F.when(F.col("hot"), F.monotonically_increasing_id()).otherwise(F.col("key")), F.lit(n))
    else:
        number = F.lit(0).cast("long")
    return (keyed.select("text", "key", number.alias("shard")).repartition(n, "shard")
            .sortWithinPartitions("shard", F.xxhash64(F.col("key"), F.lit(1)), "key").select("text", "shard"))


def averaged(rows: DataFrame, like: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
    """Weights averaged by tokens over all splits; only their sums reach the driver."""
    sums = {r.name: np.frombuffer(r.w) for r in rows.repartition("name").mapInArrow(_sum, "name string, w binary").collect()}
    whole = lambda k, size: np.concatenate([sums[f"{k} {i}"] for i in range(0, size, CHUNK)] or [np.zeros(0)])
    return {k: (whole(k, w.size) / sums[""][0]).reshape(w.shape).astype(np.float32) for k, w in like.items()} if "" in sums else None


def gathered(batches, size: int = SCORE_BYTES):
    """Batches put together up to `size` bytes."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if waiting and sum(b.nbytes for b in waiting) + batch.nbytes > size:
            yield pa.concat_batches(waiting)
            waiting = []
        if batch.num_rows:
            waiting.append(batch)
    if waiting:
        yield pa.concat_batches(waiting)


RARE = "array<struct<word: binary, found: array<struct<rid: bigint, times: bigint>>>>"


def _joined(words: pa.Array, flat: np.ndarray, lengths: np.ndarray, joined: np.ndarray, number: int) -> pa.Array:
    """The words that are `joined` with their rows (from `number` on) and times there, each in the list of the first of these (an end in that of the last)."""
    n_docs = len(lengths)
    at = np.flatnonzero(joined[flat])
    pairs, times = np.unique(flat[at].astype(np.int64) * n_docs + np.repeat(np.arange(n_docs), lengths)[at], return_counts=True)
    word, doc = np.divmod(pairs, n_docs)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    owner = np.maximum.accumulate(doc[first])  # words are numbered as they come, the end is the last, so first rows are in order
    found = pa.StructArray.from_arrays([pa.array(number + doc), pa.array(times.astype(np.int64))], names=["rid", "times"])
    found = pa.ListArray.from_arrays(pa.array(np.append(first, len(pairs)), pa.int32()), found)
    rows = pa.StructArray.from_arrays([words.take(pa.array(word[first])), found], names=["word", "found"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n_docs + 1)), pa.int32()), rows)


def _read(shared, weights):
    def run(batches):
        v, number = shared.value, TaskContext.get().partitionId() << 36
        symbols, net = Symbols(v), Net(v, weights.value) if weights is not None else None
        held, waiting, read = 0, [], []  # tokens; columns, the rest words' part of the scores; symbols

        def scored():
            lengths = np.concatenate([columns[2] for columns, _ in waiting])
            lm = np.zeros(len(lengths))
            if net is not None:
                flat = np.concatenate(read)
                read.clear()
                lm = net.score(flat, lengths) / np.log(10)
            for (ids, rids, n, known, logs, rare), more in waiting:
                own, lm = lm[:len(n)], lm[len(n):]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (rids, n, known, logs, own + more)), rare],
                                                 names=["doc_id", "rid", "n_tokens", "known", "logs", "lm", "rare"])
            waiting.clear()

        for batch in gathered(batches):
            flat, lengths = symbols.read(batch.column("text"))
            n_docs, starts = batch.num_rows, np.cumsum(lengths) - lengths
            count, rest = symbols.count, symbols.in_rest  # of each distinct word
            logs = np.where(count >= 0, np.log10(np.maximum(count, 0) + 0.5), 0.0)
            sums = lambda x: np.add.reduceat(x[flat], starts)
            more = np.zeros(n_docs)
            if net is not None:
                rest_size = np.log10(v.rest_tokens + 0.5 * (v.rest_words + 1))
                # counts of joined words are added later; what they are divided by is known here
                more = sums(np.where(rest, logs - rest_size[np.maximum(symbols.symbol - v.n_explicit, 0)], 0.0))
            if waiting and held + len(flat) > TOGETHER:
                yield from scored()
                held = 0
            held += len(flat)
            waiting.append(((batch.column("doc_id"), np.arange(number, number + n_docs), lengths, sums((count > 0).astype(np.int64)), sums(logs),
                             _joined(symbols.words, flat, lengths, count < 0, number)), more))
            if net is not None:
                read.append(symbols.symbol.astype(net.kind)[flat])
            number += n_docs
        if waiting:
            yield from scored()
    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of `docs` (text) and their ends, staged."""
    return common.staged(docs.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def score_texts(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT, frequent: int = FREQUENT, first: int = FIRST,
                shard: int = SHARD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs` (doc_id, text).

    A null or empty text is its end alone. Rows with the same text get the same scores; repeated ids stay apart, and all
    their rows are learnt from (the first model takes one text of an id). Scores do not depend on how `docs` is split.
    Where nothing may be learnt from, every score is that of the counts, 0.
    """
    spark = common.tune(docs.sparkSession)
    context = spark.sparkContext
    docs = docs.select("doc_id", "text")
    held = lambda d: common.fold(d, "doc_id", held_out[0]) == held_out[1]
    training = docs.where(~held(docs))
    counts = word_counts(training)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common_words = counts.where(F.col("n") * frequent >= total) if total else counts.where("false")  # at most `frequent`
    v = Vocabulary({bytes(r.word): r.n for r in common_words.collect()}, total, distinct)
    weights = None
    if total:
        endings = counts.mapInArrow(_endings(context.broadcast(v)), "ending binary, tokens long, words long")
        endings = endings.groupBy("ending").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"))
        v.set_rest([(bytes(r.ending), r.tokens, r.words) for r in endings.collect()])  # at most 65,793
        shared = context.broadcast(v)
        turn = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        ids = training.where("doc_id is not null").select("doc_id", turn.alias("turn")).distinct().orderBy("turn").limit(first)
        sample = common.one_text(docs.join(F.broadcast(ids), "doc_id"), "doc_id", "turn")  # `first` ids, a row each
        sample = sample.select("text", "turn", F.lit(0).cast("long").alias("shard")).repartition(1).sortWithinPartitions("turn")
        like = Net(v).p
        start = averaged(sample.select("text", "shard").mapInArrow(_train(shared, None, "name"), "name string, w binary"), like) or like
        more = averaged(sharded(training, total, v.counts.get(END, 0) or total, shard).mapInArrow(
            _train(shared, context.broadcast(start), "name"), "name string, w binary"), like)
        weights = context.broadcast(more or start)
    shared = context.broadcast(v)
    rows = common.staged(docs.mapInArrow(_read(shared, weights), "doc_id long, rid long, n_tokens long, known long, logs double, lm double, rare " + RARE),
                         "lm-rows")
    rare = rows.select(F.explode("rare").alias("r")).select("r.word", "r.found").join(counts.hint("shuffle_hash"), "word", "left")
    rare = rare.select(F.explode("found").alias("f"), F.coalesce("n", F.lit(0)).alias("n"))
    sums = rare.groupBy(F.col("f.rid").alias("_rid")).agg(F.sum(F.col("f.times") * F.log10(F.col("n") + 0.5)).alias("more"),
                                                          F.sum(F.when(F.col("n") > 0, F.col("f.times")).otherwise(0)).alias("more_known"))
    out = rows.drop("rare").join(sums, F.col("rid") == F.col("_rid"), "left").withColumn("more", F.coalesce("more", F.lit(0.0)))
    base = F.col("logs") + F.col("more") - F.col("n_tokens") * F.lit(float(np.log10(total + 0.5 * (distinct + 1))))
    score = F.col("lm") + F.col("more") if weights is not None else base
    return out.select("doc_id", held(out).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def op9_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(common.read(spark, sf_dir, "documents"))


QUERIES = {"op9_recurrent_lm": op9_recurrent_lm}
ORACLE: dict[str, str] = {}
