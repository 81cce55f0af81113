"""Nearest neighbours by learned partitions.

A bounded sample is fitted in one task: the graph of its nearest neighbours is cut into equally large parts with few
neighbours apart (halved again and again along a slow direction of the graph, then pairs are swapped while that brings
neighbours together), and a small network with one hidden layer learns to tell the parts of a vector's neighbours from
the vector alone. Every row of the table is filed under its most probable part; a query is routed to its most probable
parts and meets all rows filed there, in blocks, with exact cosines.

How many parts a query visits is measured, not set: sampled vectors that the graph has not seen look for their
neighbours among the sample, and the least number of parts that finds the asked share of them is taken. Where nothing
tells parts apart, that number nears all of them and the search stays right.

Rows are dealt out by their hash within a part into as many blocks as it fills, so a part that holds a third of all rows
(one vector copied, say) is many blocks. What a query finds in the blocks of a part is brought down to its nearest before
it is sent on, so the rows sent follow the queries and the parts they visit, not the blocks. Copies of a vector within a block beyond those a query could return are left
out, as equal cosines go to smaller ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from . import common

SAMPLE = 8_192      # vectors the parts are learned from
UNSEEN = 512        # more vectors, to measure recall with
PARTS = 64
HIDDEN = 96
DEGREE = 10         # neighbours of a vector in the graph
RECALL = 0.96       # asked of the unseen vectors
BLOCK_ROWS = 4_096  # vectors of a block
HELD = 1 << 19      # rows found that a task holds before it sends them


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; each is brought near 1 by a power of two first, so that squares neither overflow nor vanish."""
    x = np.asarray(x, np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision, the same for the same pair wherever it is worked out."""
    x, y = (np.ldexp(z, -np.frexp(np.abs(z).max(1, keepdims=True))[1]) for z in (np.asarray(x, np.float64), np.asarray(y, np.float64)))
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The `degree` nearest others of each row of unit vectors (fewer where there are no more)."""
    degree = min(degree, len(x) - 1)
    out = np.empty((len(x), degree), np.int64)
    for k in range(0, len(x), 1024):
        near = x[k:k + 1024] @ x.T
        near[np.arange(len(near)), np.arange(k, k + len(near))] = -np.inf
        out[k:k + 1024] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return out


def _halves(members: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, rng) -> np.ndarray:
    """Which of `members` go into the second of two equal halves; a and b are the ends of edges among them, as positions."""
    n = len(members)
    weight = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-9
    # power iteration on the lazy random walk, away from its constant direction: neighbours get near values
    value = (x[members] - x[members].mean(0)) @ rng.standard_normal(x.shape[1])
    for _ in range(30):
        spread = np.bincount(a, value[b], n) + np.bincount(b, value[a], n)
        value = value + spread / weight
        value -= (value * weight).sum() / weight.sum()
        value /= np.abs(value).max() + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(value, kind="stable")[n // 2:]] = True
    for _ in range(12):  # swap the members that would gain most, equally many from either side
        across = np.bincount(a, side[b] != side[a], n) + np.bincount(b, side[b] != side[a], n)
        gain = 2 * across - weight
        left, right = (np.flatnonzero(side == s) for s in (False, True))
        left, right = (m[np.argsort(-gain[m], kind="stable")] for m in (left, right))
        m = min(len(left), len(right))
        better = np.cumprod(gain[left[:m]] + gain[right[:m]] > 1e-6).sum()
        k = -(-int(better) // 2)  # half of them: what the first swaps bring together changes the gain of the others
        if not k:
            break
        before = int((side[a] != side[b]).sum())
        side[left[:k]], side[right[:k]] = True, False
        if int((side[a] != side[b]).sum()) >= before:
            side[left[:k]], side[right[:k]] = False, True
            break
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng) -> np.ndarray:
    """The part of each row: `parts` (a power of two) of equal size, halved along the neighbour graph."""
    part = np.zeros(len(x), np.int64)
    a, b = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    place = np.empty(len(x), np.int64)
    for _ in range(int(math.log2(parts))):
        nxt = 2 * part
        inside = part[a] == part[b]
        ia, ib, of = a[inside], b[inside], part[a[inside]]
        order = np.argsort(of, kind="stable")
        ia, ib = ia[order], ib[order]
        bounds = np.searchsorted(of[order], np.arange(part.max() + 2))
        for p in range(part.max() + 1):
            members = np.flatnonzero(part == p)
            place[members] = np.arange(len(members))
            cut = slice(bounds[p], bounds[p + 1])
            nxt[members] += _halves(members, x, place[ia[cut]], place[ib[cut]], rng)
        part = nxt
    return part


class Router:
    """A network that tells from a unit vector how probable each part is."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    @classmethod
    def train(cls, x: np.ndarray, target: np.ndarray, hidden: int, rng, rounds: int = 12, batch: int = 128, rate: float = 4e-3) -> "Router":
        dim, parts = x.shape[1], target.shape[1]
        w = [rng.standard_normal((dim, hidden)), np.zeros(hidden), rng.standard_normal((hidden, parts)) / math.sqrt(hidden), np.zeros(parts)]
        m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for turn in range(rounds):
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                rows = order[k:k + batch]
                inner = np.maximum(x[rows] @ w[0] + w[1], 0)
                out = inner @ w[2] + w[3]
                out = np.exp(out - out.max(1, keepdims=True))
                out = (out / out.sum(1, keepdims=True) - target[rows]) / len(rows)
                back = (out @ w[2].T) * (inner > 0)
                step += 1
                pace = rate * (1 - turn / rounds) + 1e-5
                for p, g, mk, vk in zip(w, (x[rows].T @ back, back.sum(0), inner.T @ out, out.sum(0)), m, v):
                    mk += 0.1 * (g - mk)
                    vk += 0.01 * (g * g - vk)
                    p -= pace * (mk / (1 - 0.9 ** step)) / (np.sqrt(vk / (1 - 0.99 ** step)) + 1e-8)
        return cls(w)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.weights[0] + self.weights[1], 0) @ self.weights[2] + self.weights[3]


def probes_for(router: Router, unseen: np.ndarray, sample: np.ndarray, recall: float, near: int) -> int:
    """The least number of parts in which `unseen` vectors find that share of their nearest vectors of the sample."""
    filed = router.scores(sample).argmax(1)
    routes = np.argsort(-router.scores(unseen), axis=1, kind="stable")
    rank = np.empty_like(routes)
    np.put_along_axis(rank, routes, np.arange(routes.shape[1])[None, :], 1)
    near = min(near, len(sample))
    nearest = np.argpartition(-(unseen @ sample.T), near - 1, axis=1)[:, :near]
    needed = np.sort(np.take_along_axis(rank, filed[nearest], 1).ravel())
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1


def learn(x: np.ndarray, unseen: np.ndarray, parts: int, hidden: int, degree: int, recall: float, near: int) -> tuple[Router, int]:
    """A router fitted to unit vectors, and how many parts queries visit. Parts hold eight sampled vectors or more."""
    rng = np.random.default_rng(11)
    parts = 1 << int(math.log2(max(1, min(parts, len(x) // 8))))
    if parts == 1 or not len(unseen):
        return Router([np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]), 1
    graph = neighbour_graph(x, degree)
    part = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1 / graph.shape[1])
    target[np.arange(len(x)), part] += 1
    router = Router.train(x, target / 2, hidden, rng)
    return router, probes_for(router, unseen, x, recall, near)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fit(unseen: int, **options):
    def run(batches):
        found = [_vectors(b.column("vector")) for b in batches if b.num_rows]
        if found:
            x = unit(np.concatenate(found))
            held = min(unseen, len(x) // 8)
            router, probes = learn(x[held:], x[:held], **options)
            yield pa.RecordBatch.from_pydict({"probes": pa.array([probes], pa.int32()), "weights": pa.array([[w.astype("<f8").tobytes() for w in router.weights]]),
                                              "shapes": pa.array([[list(w.shape) for w in router.weights]], pa.list_(pa.list_(pa.int32())))})
    return run


def _route(shared, many: bool):
    """File rows under their most probable part, or send queries to all parts they visit."""
    def run(batches):
        router, probes = Router(shared.value[0]), shared.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = router.scores(unit(_vectors(batch.column("vector"))))
            parts = np.argsort(-scores, axis=1, kind="stable")[:, :probes] if many else scores.argmax(1)[:, None]
            rows = np.repeat(np.arange(batch.num_rows), parts.shape[1])
            for k in range(0, len(rows), 16_384):
                cut = pa.array(rows[k:k + 16_384])
                yield pa.RecordBatch.from_arrays([pa.array(parts.ravel()[k:k + 16_384], pa.int32()), batch.column("id").take(cut), batch.column("vector").take(cut)],
                                                 names=["part", "id", "vector"])
    return run


def _packed(rows: int, keep: int | None):
    """Blocks of up to `rows` vectors of one part, from rows in order of part and id; of equal vectors the first `keep` ids stay."""
    def close(part, ids, vectors):
        ids, vectors = np.concatenate(ids), np.ascontiguousarray(np.concatenate(vectors))
        if keep is not None:
            _, same = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)
            order = np.lexsort((ids, same))
            begin = np.concatenate(([True], np.diff(same[order]) != 0))
            rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
            stay = np.sort(order[rank < keep])
            ids, vectors = ids[stay], vectors[stay]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ids.astype("<i8").tobytes()]), pa.array([vectors.astype("<f8").tobytes()])],
                                          names=["part", "ids", "vectors"])

    def run(batches):
        now, ids, vectors, held = None, [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, own, x = batch.column("part").to_numpy(), batch.column("id").to_numpy(), _vectors(batch.column("vector"))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if held and parts[a] != now:
                    yield close(now, ids, vectors)
                    ids, vectors, held = [], [], 0
                now = int(parts[a])
                while a < b:
                    take = min(b - a, rows - held)
                    ids, vectors, held, a = [*ids, own[a:a + take]], [*vectors, x[a:a + take]], held + take, a + take
                    if held == rows:
                        yield close(now, ids, vectors)
                        ids, vectors, held = [], [], 0
        if held:
            yield close(now, ids, vectors)
    return run


def _nearest_first(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows found, the k nearest of each query, equal ones by smaller id."""
    order = np.lexsort((ids, -scores, queries))
    queries, ids, scores = queries[order], ids[order], scores[order]
    stay = np.arange(len(queries)) - np.searchsorted(queries, queries) < k
    return queries[stay], ids[stay], scores[stay]


def _found(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query ids, ids, cosines) of the k nearest of a block's rows to each query of a block."""
    ux = unit(x)
    for a in range(0, len(queries), 512):
        near = unit(q[a:a + 512]) @ ux.T
        near[queries[a:a + 512, None] == ids[None, :]] = -np.inf
        kth = np.partition(near, max(0, near.shape[1] - k), axis=1)[:, max(0, near.shape[1] - k)]
        # rounding differs with a vector's place in a block: what is as near as that is measured alike for all
        i, j = np.nonzero((near >= kth[:, None] - 1e-9) & (near > -2))
        score = np.concatenate([cosines(q[a + i[c:c + 65_536]], x[j[c:c + 65_536]]) for c in range(0, len(i), 65_536)] or [np.zeros(0)])
        yield _nearest_first(queries[a + i], ids[j], score, k)


def _search(k: int):
    """The k nearest to each query in the blocks of a part that come one after the other."""
    def run(batches):
        part, held, size = None, [], 0

        def nearest_held():
            return _nearest_first(*(np.concatenate(column) for column in zip(*held)), k)

        def sent(rows):
            for c in range(0, len(rows[0]), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(column[c:c + 65_536]) for column in rows], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                ids, queries = (np.frombuffer(row[c], "<i8") for c in ("ids", "query_ids"))
                x, q = np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1), np.frombuffer(row["query_vectors"], "<f8").reshape(len(queries), -1)
                if x.shape[1] != q.shape[1]:
                    continue
                if held and row["part"] != part:
                    yield from sent(nearest_held())
                    held, size = [], 0
                part = row["part"]
                for rows in _found(queries, q, ids, x, k):
                    held.append(rows)
                    size += len(rows[0])
                if size > HELD:
                    held = [nearest_held()]
                    size = len(held[0][0])
                    if size > HELD // 2:  # too many queries to be held at once
                        yield from sent(held[0])
                        held, size = [], 0
        if held:
            yield from sent(nearest_held())
    return run


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, one for each id: those of the commonest length, finite, not all zero.

    Rows of one id are one item, with the smallest of their vectors.
    """
    v = F.col("vector")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda c: c != 0))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    common_length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    return rows.join(F.broadcast(common_length.select("length")), F.size("vector") == F.col("length")).drop("length")


def _sample(rows: DataFrame, size: int) -> DataFrame:
    """Up to `size` distinct vectors, chosen by their hashes: copies count once, and only hashes in range are told apart."""
    hashed = rows.select("vector", F.xxhash64("vector").alias("h"))
    distinct = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    share = min(1.0, 1.2 * size / max(1, distinct))
    return hashed.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).distinct().orderBy("h").limit(size).select("vector")


def nearest(df: DataFrame, queries, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 5, parts: int = PARTS,
            sample: int = SAMPLE, unseen: int = UNSEEN, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine, of all rows but its own, to each row where `queries` holds.

    `queries` is a condition on the column `id`. All rows are filed under learned parts; a query meets every row of the
    parts it visits, which find about `recall` of the true neighbours or more. Equal scores go to the smaller id. Vectors that
    are null, zero, of an uncommon length or hold null or non-finite numbers take no part, nor do rows without an id;
    rows of one id count as one, with the smallest vector. With fewer than k candidates met, all are returned. An empty
    table gives no rows. Other columns of `df` are not read.
    """
    spark = common.tune(df.sparkSession)
    rows = common.staged(usable(df, id_column, vector_column), "neighbours-rows")
    fitted = _sample(rows, sample + unseen).repartition(1).mapInArrow(_fit(unseen, parts=parts, hidden=HIDDEN, degree=DEGREE, recall=recall, near=k),
                                              "probes int, weights array<binary>, shapes array<array<int>>").first()
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
                           T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if fitted is None:
        return spark.createDataFrame([], result)
    model = [np.frombuffer(w, "<f8").reshape(s) for w, s in zip(fitted["weights"], fitted["shapes"])], fitted["probes"]
    shared, routed, blocked = spark.sparkContext.broadcast(model), "part int, id long, vector array<double>", "part int, ids binary, vectors binary"
    n_parts = model[0][3].shape[0]

    def blocks(some: DataFrame, many: bool, keep: int | None, name: str) -> DataFrame:
        filed = common.staged(some.mapInArrow(_route(shared, many), routed), "neighbours-filed")
        sizes = {r.part: r.n for r in filed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each part
        full = F.array(*[F.lit(-(-sizes.get(p, 1) // BLOCK_ROWS)) for p in range(n_parts)])
        salt = F.pmod(F.xxhash64("id"), F.get(full, F.col("part")))
        dealt = filed.withColumn("salt", salt).repartition("part", "salt").drop("salt").sortWithinPartitions("part", "id")
        out = common.staged(dealt.mapInArrow(_packed(BLOCK_ROWS, keep), blocked), name)
        common.remove(spark, filed)
        return out
    there = blocks(rows, False, k + 1, "neighbours-index")
    asked = blocks(rows.where(queries), True, None, "neighbours-queries")
    met = there.join(asked.select("part", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")), "part")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(common.read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES = {"op13_learned_partitions": op13_learned_partitions}
ORACLE: dict[str, str] = {}
