"""Spelling variants, tokenizer alignment and nearest neighbours against brute-force versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import alignment, neighbours, spelling


# ---- spelling variants -----------------------------------------------------------------------------
def near(a, b):
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def variants(counts):
    out = {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(w, v)]
        m, form = min(others, default=(0, None))
        out[w] = [n, len(others), form if -m >= 2 * n else None, -m if -m >= 2 * n else None]
    for w in counts:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def counted(rows):
    words = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += len(run) >= 5
    return {w: n for w, n in words.items() if n >= 3}


def found(df, **options):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df, **options).collect()}


def test_spelling_variants(spark):
    r = random.Random(1)
    stems = ["".join(r.choice("abceéÖ") for _ in range(r.randint(4, 8))) for _ in range(60)]

    def bent(w):
        k = r.randrange(len(w))
        return r.choice([w, w, w, w[:k] + w[k + 1:], w[:k] + r.choice("abcé") + w[k:], w[:k] + "b" + w[k + 1:], w.upper()])
    rows = [(k, ", ".join(bent(r.choice(stems)) for _ in range(60))) for k in range(120)] + [(7, "abcab " * 9), (7, "abcab " * 9), (None, "abcab"), (8, None), (9, "")]
    rows += [(10, "x" * 2_000_000 + " 12 " + "abcab " * 4), (11, "kkkkkk " * 40 + "kkkkke " * 12 + "kkkkee " * 4)]  # the last a chain of forms
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    want = variants(counted(rows))
    assert found(df) == want
    assert sum(v[2] is not None for v in want.values()) > 50 and want["kkkkee"][2:] == ("kkkkke", 12, "kkkkkk")


def test_a_common_chunk_is_cut_again(spark):
    r = random.Random(2)
    words = {"interna" + "".join(r.choice("abcd") for _ in range(r.randint(5, 8))): r.randint(3, 40) for _ in range(1500)}
    words |= {"".join(r.choice("abcd") for _ in range(r.randint(5, 8))) + "ization": r.randint(3, 40) for _ in range(500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    for limit in (1, 40, 10 ** 9):
        got = [frozenset((p.x, p.y)) for p in spelling.near_pairs(df, pairs=limit).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_spelling_of_an_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == {}
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string"), ratio=1)


# ---- tokenizer alignment ---------------------------------------------------------------------------
def aligned(texts):
    voc, out, held, links_of = alignment.vocabularies(), [], collections.Counter(), []
    for t in texts:
        a = voc.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = voc.b.encode(t) if t else []
        sides = [[table[i] for i in ids] for table, ids in ((voc.a_bytes, a), (voc.b_bytes, b))]
        groups, links = [], []
        if t and b"".join(sides[0]) == b"".join(sides[1]) == f" {t}".encode():
            ends = [np.cumsum([len(x) for x in side]).tolist() for side in sides]
            i = j = 0
            for cut in sorted(set(ends[0]) & set(ends[1])):
                x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
                groups.append((a[i:x], b[j:y]))
                links += [(p, q) for p in a[i:x] for q in b[j:y]]
                i, j = x, y
        else:
            a, b = [], []
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        held.update(set(links))
        links_of.append(links)
        out.append((len(a), len(b), len(groups), len(links), written))
    most = collections.Counter()
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    return [(*o[:4], sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), o[4]) for o, links in zip(out, links_of)]


LETTERS = [*"abcdefghijklmnopqrstuvwxyztheTHE    \n\n\t '’éßñ中文한글abв١½ⅷ🤦‍♂️́​\xa0\x85\x1c\x00!?#$_", "<|endoftext|>", "'s", "  ", "aaaa", "▁", "<s>", "<0x0A>", "the ", "ing "]


@pytest.mark.parametrize("pieces", [(400_000, 2_000_000), (300, 20)])
def test_alignment(spark, monkeypatch, pieces):
    monkeypatch.setattr(alignment, "PIECE_TOKENS", pieces[0])
    monkeypatch.setattr(alignment, "PIECE_PAIRS", pieces[1])
    r = random.Random(5)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(600)]
    texts += [None, "", " ", "\n", "a" * 5000, "the end", "the end", "<|endoftext|>"] + ["hot text of many copies"] * 300
    want = aligned(texts)
    own = alignment.Batch(alignment.Stretches(alignment.vocabularies()), [(t or "").encode() for t in texts], keep_groups=True)
    assert [";".join(g) for g in own.groups] == [w[6] for w in want]
    assert own.n_links.tolist() == [w[3] for w in want]
    if pieces[0] < 1000:
        return  # the workers have settings of their own
    df = spark.createDataFrame([(k, t, "x", 5) for k, t in enumerate(texts)], "doc_id long, text string, block string, n_a int").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_tokenizers(df).collect()}
    assert got == {k: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for k, w in enumerate(want)}
    assert sum(w[0] == 0 for w in want) > 20  # texts that a side does not give back
    groups = {r.doc_id: r.groups for r in alignment.aligned_groups(df).collect()}
    assert groups == {k: w[6] for k, w in enumerate(want)}


def test_alignment_of_a_long_text_repeated_ids_and_no_rows(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefg") for _ in range(r.randint(1, 9))) for _ in range(500)]
    long = " ".join(r.choice(words) for _ in range(400_000))
    rows = [(1, long), (1, "abc def"), (None, "abc def"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((str(x.doc_id), x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, x.groups_sha256) for x in alignment.align_tokenizers(df).collect())
    want = aligned([t for _, t in rows])
    assert got == sorted((str(d), *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for (d, _), w in zip(rows, want))
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ---- nearest neighbours ----------------------------------------------------------------------------
def exact(rows, query, k):
    q, found = np.array(dict(rows)[query], float), []
    for d, v in rows:
        if d != query:
            x = np.array(v, float)
            found.append((-float((q * x).sum() / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum()))), d))
    return [(d, -s) for s, d in sorted(found)[:k]]


def asked(df, **options):
    out = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(df, "id % 50 = 0", **options).collect()):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_neighbours_with_ties_nulls_and_copies(spark):
    r = random.Random(7)
    rows = [(k, [r.gauss(0, 1) for _ in range(6)]) for k in range(120)]
    rows += [(200 + k, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for k in range(80)] + [(300, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0])]
    bad = [(400, None), (401, [0.0] * 6), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] + [1.0] * 5), (404, [float("inf")] + [1.0] * 5),
           (450, [1.0, 2.0]), (None, [1.0] * 6), (500, [])]
    again = [rows[3], rows[200], rows[200]]
    df = spark.createDataFrame([(d, v, 1, "x") for d, v in rows + bad + again], "vec_id long, embedding array<double>, id int, rank string").repartition(5)
    got = asked(df, recall=1.0, unseen=32)
    assert set(got) == {d for d, _ in rows if d % 50 == 0}
    for q, want in got.items():
        truth = exact(rows, q, 5)
        assert [d for d, _ in want] == [d for d, _ in truth]
        assert np.allclose([s for _, s in want], [s for _, s in truth], rtol=0, atol=1e-15)
    assert [d for d, _ in got[200]] == [201, 202, 203, 204, 205]  # ties to smaller ids


def test_neighbours_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [2.0 ** 1000] * 2), (4, [2.0 ** -1000, -(2.0 ** -1000)])], "vec_id long, embedding array<double>")
    got = asked(df)
    assert [d for d, _ in got[0]] == [3, 4, 50] and [d for d, _ in got[50]] == [3, 0, 4]
    assert asked(df.limit(0)) == {}
    assert asked(df.where("vec_id = 3")) == {}


def test_neighbours_recall_and_balance(spark):
    rng = np.random.default_rng(3)
    centres = neighbours.unit(rng.standard_normal((40, 16)))
    x = neighbours.unit(centres[np.arange(6000) % 40] + 0.35 * rng.standard_normal((6000, 16)))
    graph = neighbours.neighbour_graph(x[:2048], 10)
    part = neighbours.balanced_parts(x[:2048], graph, 16, rng)
    assert np.bincount(part).tolist() == [128] * 16
    chance = rng.permutation(part)
    assert (part[:, None] != part[graph]).mean() < 0.6 * (chance[:, None] != chance[graph]).mean()
    router, probes = neighbours.learn(x[256:2304], x[:256], 16, 64, 10, 0.95, 5)
    assert probes <= 8  # clusters: queries visit few parts
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    got = asked(df, parts=16)
    sims = x[::50] @ x.T
    sims[np.arange(120), np.arange(0, 6000, 50)] = -2
    truth = np.argsort(-sims, axis=1)[:, :5]
    hits = sum(len({d for d, _ in got[50 * k]} & set(t.tolist())) for k, t in enumerate(truth))
    assert hits >= 0.9 * truth.size


def test_blocks_keep_the_smallest_ids_of_copies():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"part": pa.array([0] * 9 + [1], pa.int32()), "id": pa.array([*range(9, 0, -1), 20], pa.int64()),
                                        "vector": pa.array([[1.0, 2.0]] * 8 + [[3.0, 4.0]] * 2)})
    blocks = list(neighbours._packed(100, 3)([batch]))
    assert [sorted(np.frombuffer(b.column("ids")[0].as_py(), "<i8").tolist()) for b in blocks] == [[1, 2, 3, 4], [20]]
