"""The language model learns from all training documents, read whole."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import recurrent_lm


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    def counted(shared, start, key):
        def run(batches):
            n = float(sum(b.num_rows for b in batches))
            yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([np.array([n]).tobytes()], pa.binary())], names=[key, "w"])
        return run

    learnt = []
    monkeypatch.setattr(recurrent_lm, "_train", counted)
    monkeypatch.setattr(recurrent_lm, "averaged", lambda rows, like: learnt.append(sum(np.frombuffer(r.w)[0] for r in rows.collect())))
    docs = spark.createDataFrame([(d, f"word{d} of many") for d in range(200)], "doc_id long, text string")
    recurrent_lm.score_texts(docs, first=10)
    assert learnt == [10, sum(zlib.crc32(str(d).encode()) % 5 != 1 for d in range(200))]


def test_training_carries_the_state_through_a_long_text():
    v = recurrent_lm.Vocabulary({recurrent_lm.END: 2, b"a": 900, b"b": 500}, 1402, 3)
    net, fed = recurrent_lm.Net(v), []
    step = net.step
    net.step = lambda symbols, h, keep=False: fed.append(symbols.copy()) or step(symbols, h, keep)
    lengths = np.array([1301, 101])
    symbols = np.random.default_rng(5).integers(1, 3, lengths.sum()) % v.n_explicit
    symbols[symbols == net.end] = (net.end + 1) % v.n_explicit
    symbols[np.cumsum(lengths) - 1] = net.end
    net.train(symbols, lengths, {})
    fed = np.concatenate(fed)
    assert len(fed) == lengths.sum() and (fed == net.end).sum() == 2  # once before each text
    assert all(np.isfinite(w).all() for w in net.p.values())


def test_every_frequent_word_has_a_softmax_entry_that_context_moves():
    counts = {b"w%d" % k: 4000 - k for k in range(3000)} | {recurrent_lm.END: 50}
    v = recurrent_lm.Vocabulary(counts, sum(counts.values()), len(counts) + 3)
    v.set_rest([(b"ly", 4, 2), (b"", 1, 1)])
    net = recurrent_lm.Net(v)
    assert all(v.symbol[w] < v.n_explicit for w in counts) and v.n_explicit == len(counts)
    assert net.classes * net.size >= v.n_explicit and net.classes <= net.size == 55  # about the root
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    states, symbols = np.random.default_rng(3).normal(size=(2, net.h)), np.arange(v.n_explicit + v.rest)
    one, two = (net.outputs(np.repeat(s[None], len(symbols), 0), symbols) for s in states)
    assert abs(np.exp(one).sum() - 1) < 1e-9 and abs(np.exp(two).sum() - 1) < 1e-9
    word = v.symbol[b"w2500"]
    block = symbols[:v.n_explicit][net.class_of[:v.n_explicit] == net.class_of[word]]
    share = lambda logp: logp[word] - np.log(np.exp(logp[block]).sum())
    assert abs(share(one) - share(two)) > 1e-3  # within its class, too
    assert v.rest_class(b"early") == 0 and v.rest_tokens[0] == 4 and v.rest_tokens.sum() == 5


def test_scores_do_not_depend_on_how_the_input_is_split(spark):
    r = np.random.default_rng(11)
    rows = [(d, " ".join("w%d" % k for k in (r.zipf(1.6, r.integers(0, 60)) % 300))) for d in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = ({x.doc_id: x.score for x in recurrent_lm.score_texts(docs.repartition(n), first=20, shard=2_000).collect()} for n in (4, 32))
    assert len(one) == 600 and max(abs(one[d] - two[d]) / (1 + abs(one[d])) for d in one) < 1e-4


def test_a_row_repeated_many_times_goes_round_the_shards_and_none_is_lost(spark):
    docs = spark.createDataFrame([(7, "the same row again")] * 400 + [(d, f"text number {d}") for d in range(100, 300)], "doc_id long, text string").repartition(5)
    dealt = recurrent_lm.sharded(docs, 10_000, 600, 1_000)
    sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    assert sum(sizes.values()) == 600 and len(sizes) == 10 and max(sizes.values()) < 150
    assert dealt.where("text = 'the same row again'").count() == 400


def test_pieces_are_the_same_however_rows_are_batched():
    rows = [(s, "x" * (k % 7)) for s in (3, 8) for k in range(50)]
    table = pa.table({"shard": pa.array([s for s, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})
    cuts = [list(recurrent_lm.pieces(table.to_batches(max_chunksize=n), 20)) for n in (3, 100)]
    assert cuts[0] == cuts[1] and all(sum(map(len, t)) <= 20 for _, t in cuts[0])
    assert [t for _, ts in cuts[0] for t in ts] == [t.encode() for _, t in rows]


def test_a_rare_word_of_a_piece_is_joined_once_with_its_rows_and_times():
    shared = type("Shared", (), {"value": recurrent_lm.Vocabulary({recurrent_lm.END: 2, b"a": 9}, 11, 2)})
    texts = ["Rare a rare\x0brare", None, "a other", " rare\n", "\x1cother a"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    context = type("Context", (), {"partitionId": lambda self: 0})
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(recurrent_lm, "TaskContext", type("Task", (), {"get": staticmethod(context)}))
        out, = recurrent_lm._read(shared, None)(iter([batch]))
    assert out.column("n_tokens").to_pylist() == [5, 1, 3, 2, 3] and out.column("known").to_pylist() == [2, 1, 2, 1, 2]
    found = [(r["word"], [(f["rid"], f["times"]) for f in r["found"]]) for rows in out.column("rare").to_pylist() for r in rows]
    assert found == [(b"rare", [(0, 3), (3, 1)]), (b"other", [(2, 1)]), (b"\x1cother", [(4, 1)])]


def test_words_are_read_as_their_symbols_counts_and_rest_classes():
    v = recurrent_lm.Vocabulary({recurrent_lm.END: 4, b"a": 9, "été".encode(): 5, b"b,": 3}, 40, 9, explicit=3, rest=4)
    v.set_rest([(b"ng", 6, 2), (b"b", 3, 1), (b"", 2, 2), (b"zz", 1, 1)])
    texts = [b"A \xc3\xa9t\xc3\xa9  sing17\tB, 42", b"", b"\n \r", b"\x85 Song fuzz.\x0c"]
    own = recurrent_lm.Symbols(v)
    flat, lengths = own.read(texts)
    words = [w for t in texts for w in [*t.lower().split(), recurrent_lm.END]]
    assert [own.words[k].as_py() for k in flat.tolist()] == words and lengths.tolist() == [6, 1, 1, 4]
    assert own.symbol[flat].tolist() == [v.symbol.get(w, v.n_explicit + v.rest_class(w)) for w in words]
    assert own.count[flat].tolist() == [v.counts.get(w, -1) for w in words]
    assert own.in_rest[flat].tolist() == [w not in v.symbol for w in words]


def test_large_logits_give_the_shares_that_small_ones_give():
    r = np.random.default_rng(3)
    w, b, h = r.normal(size=(7, 4)), r.normal(size=7), r.normal(size=(9, 4))
    column, runs = np.array([0, 2, 1, 0, 3, 6, 4, 5, 6]), [(0, 0, 4), (1, 4, 9)]
    found = []
    for most in (5.0, 1e9):  # the second guards against overflow
        shares, logp, d, grads = recurrent_lm.Shares(w, b, [0, 3, 7], most, True), np.zeros(9), np.zeros((9, 4)), (np.zeros((7, 4)), np.zeros(7))
        assert shares.plain == (most == 5.0) or np.abs(w).sum(1).max() * 5 > recurrent_lm.SAFE
        shares.of(runs, h, column, logp, d, grads)
        found.append((logp, d, grads[0] * shares.factor[:, None], grads[1] * shares.factor))
    assert all(np.allclose(x, y) for x, y in zip(*found))
    logits = h @ w.T + b
    assert np.allclose(found[0][0], [logits[k, c] - np.log(np.exp(logits[k, :3] if k < 4 else logits[k, 3:]).sum()) for k, c in enumerate(column)])


def test_pieces_are_walked_together_so_that_a_long_text_does_not_stand_alone_in_each(monkeypatch):
    v = recurrent_lm.Vocabulary({recurrent_lm.END: 90, b"a": 900, b"b": 500}, 1490, 3)
    texts = [t for _ in range(6) for t in [" ".join(["a b"] * 100), *["b a a"] * 20]]  # 201 tokens at most, in each piece
    batches = pa.table({"shard": pa.array([3] * len(texts), pa.int64()), "text": texts, "doc_id": range(len(texts))}).to_batches(max_chunksize=21)
    shared, net, steps = type("Shared", (), {"value": v}), recurrent_lm.Net(v), []
    step = recurrent_lm.Net.step
    alone = [net.score(np.array([v.symbol[w.encode()] for w in t.split()] + [net.end]), np.array([len(t.split()) + 1]))[0] for t in texts]
    monkeypatch.setattr(recurrent_lm.Net, "step", lambda self, symbols, *rest: steps.append(len(symbols)) or step(self, symbols, *rest))
    monkeypatch.setattr(recurrent_lm, "TRAIN_BYTES", 500)
    list(recurrent_lm._train(shared, None, "name")(iter(batches)))
    assert len(steps) == 201 and sum(steps) == 6 * 281
    steps.clear()
    monkeypatch.setattr(recurrent_lm, "gathered", lambda batches: batches)
    monkeypatch.setattr(recurrent_lm, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 0})())}))
    out = list(recurrent_lm._read(shared, type("Weights", (), {"value": net.p}))(iter(batches)))
    assert len(steps) == 201 and sum(steps) == 6 * 281
    assert [d for x in out for d in x.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert np.allclose(np.concatenate([x.column("lm").to_numpy() for x in out]), np.array(alone) / np.log(10), rtol=1e-5)


def test_classes_of_words_cost_a_token_few_columns():
    counts = (1e6 / np.arange(1, 10_001)).astype(int)
    v = recurrent_lm.Vocabulary({b"w%d" % k: int(n) for k, n in enumerate(counts)} | {recurrent_lm.END: 50_000}, int(counts.sum()) + 50_000, 10_001)
    net = recurrent_lm.Net(v)
    sizes, mass = np.bincount(net.class_of[:v.n_explicit]), np.bincount(net.class_of[:v.n_explicit], weights=v.explicit_counts)
    assert (np.diff(net.class_of) >= 0).all() and sizes.sum() == v.n_explicit and len(sizes) == net.classes <= net.size
    assert net.classes + sizes @ mass / v.total < 0.75 * (100 + 101)  # of a hundred classes with a hundred words each
    assert recurrent_lm.class_starts(np.array([3.5]), 3.5) == [0, 1] and recurrent_lm.class_starts(np.zeros(0), 0) == [0]


def test_blocks_of_shares_hold_all_rows_once_within_their_bounds(monkeypatch):
    monkeypatch.setattr(recurrent_lm, "CELLS", 40)
    monkeypatch.setattr(recurrent_lm, "BLOCK", 6)
    shares = recurrent_lm.Shares(np.zeros((60, 2)), np.zeros(60), [0, 2, 5, 55, 60], 1.0)
    softmax = np.repeat([0, 2, 3], [15, 2, 20])
    seen = []
    for i, j, runs in shares.blocks(softmax):
        assert j - i <= 6 and (j - i == 1 or sum((b - a) * shares.sizes[k] for k, a, b in runs) <= 40)
        assert [k for k, a, b in runs for _ in range(b - a)] == softmax[i:j].tolist() and runs[0][1] == 0 and runs[-1][2] == j - i
        seen += range(i, j)
    assert seen == list(range(37))
