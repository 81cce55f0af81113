"""Operators on texts against brute-force versions on small tables with nulls, empty texts, ties and clashing names."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import public_tokenizers
from tidemark.llm import bpe, common, exact_dedup, mixing, ngram_join, quality_classifier, quality_rules, recurrent_lm, token_files, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = random.Random(3)
VOCAB = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def near(text, seed, edits):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = r.choice(VOCAB)
    return " ".join(words)


BASE = [prose(n, n) for n in (12, 40, 90, 150, 400)]
TEXTS = BASE + [near(BASE[3], k, 1) for k in range(6)] + [near(BASE[4], k, 3) for k in range(6)] + [BASE[1].upper(), BASE[2].replace(" ", "\n\t ")] * 2
TEXTS += [None, "", None, " ", "\t\n", "one", "one two", "ONE two", "a b c", "x " * 30, "éü 日本 <|endoftext|> 'll  \r\n end", "w" * 3000]
ROWS = [(k, t, "en" if k % 3 else None, f"s{k % 3}" if k % 5 else None, 1, "kept", 7) for k, t in enumerate(TEXTS)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_tokens long"


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


@pytest.fixture(scope="module")
def docs(spark):
    common.tune(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def groups(rows, n, percent):
    sets = {}
    for d, t in rows:
        w = WORD.findall(low(t or ""))
        sets[d] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                a1, b1 = sorted((find(a), find(b)))
                root[b1] = a1
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_similar_groups(docs, n, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs, n=n, percent=percent, counters=1 << 14).collect()}
    want = groups([(r[0], r[1]) for r in ROWS], n, percent)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 8


def test_similar_groups_links_across_ids_and_nulls(spark):
    a, b = BASE[3], BASE[4]
    rows = [(1, a), (2, b), (2, near(a, 1, 1)), (None, a), (None, None)]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=90).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("1", "1"), ("2", "1"), ("2", "1"), ("None", "None"), ("None", "None")]


def test_large_group_of_near_copies_is_one_component(spark):
    rows = [(k, near(BASE[4], k, k % 3)) for k in range(300)]
    found = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n=3, percent=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(rows, 3, 90)


def test_keep_one_keeps_columns(docs):
    out = ngram_join.keep_one(docs.drop("n_chars"))
    want = groups([(r[0], r[1]) for r in ROWS], 5, 80)
    assert out.columns == docs.drop("n_chars").columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def plain(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("budgets", [{}, {"absorb_bytes": 1, "table_bytes": 1}])
def test_exact_dedup(docs, budgets):
    out = exact_dedup.exact_dedup(docs, **budgets)
    assert [c for c in out.columns if c == "kept"] == ["kept"]
    got = collected(out)
    members = collections.defaultdict(list)
    for d, t, *_ in ROWS:
        members[plain(t)].append(d)
    assert len(got) == len(ROWS)
    for d, t, *_ in ROWS:
        own = members[plain(t)]
        assert (got[d].keep_id, got[d].group_size, got[d].kept) == (min(own), len(own), d == min(own))
        assert got[d].text_sha256 == hashlib.sha256(plain(t).encode()).hexdigest()


def test_exact_dedup_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(5, "x  y"), (5, "x y"), (None, "x y"), (None, None)], "doc_id long, text string")
    got = exact_dedup.exact_dedup(rows).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == [("5", "5", 3), ("5", "5", 3), ("None", "5", 3), ("None", "None", 1)]
    assert sum(r.kept for r in got) == 2
    assert len(exact_dedup.keep_first(rows).collect()) == 2


def test_grace_groups_with_equal_hashes():
    records = [(7, bytes([k % 50]) * 40, k) for k in range(400)]
    got = dict(exact_dedup.grace_groups(records, budget=300))
    assert len(got) == 400 and all(got[k] % 50 == k % 50 for k in got)
    assert len(set(got.values())) == 50


def test_quality_counts(docs):
    got = collected(quality_rules.quality_rules(docs, carry_text=False))
    for d, t, *_ in ROWS:
        w = WORD.findall(t or "")
        win = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if win[tuple(w[k:k + 5])] >= 2 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_bands_reject_noise(spark):
    good = [(k, prose(120, 1000 + k), "en") for k in range(200)]
    bad = [(1000 + k, " ".join(w + r for w, r in zip(prose(120, k).split(), ["#*$%&", "$$$###", "%&<>|"] * 40)), "en") for k in range(10)]
    bad += [(2000 + k, " | ".join(prose(120, 5000 + k).split()), "en") for k in range(10)]
    got = collected(quality_rules.quality_rules(spark.createDataFrame(good + bad, "doc_id long, text string, lang string")))
    assert not any(got[d].kept for d, _, _ in bad)
    assert sum(got[d].kept for d, _, _ in good) >= 199


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    library.no_truncation()
    library.no_padding()
    letters = [*"abcdefghijklmnopqrstuvwxyztheTHE  \n\n\t '’éßñ中文한글абв١٢½²ⅷ🤦‍♂️\u0301\u200b\xa0\x85\x1c\x00!?#$_", "<|endoftext|>", "'s", "  ", "aaaa"]
    own, r = bpe.codec(), random.Random(5)
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 25)))
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids).decode() == text
    got = collected(bpe.encode_texts(docs, keep_text=True))
    for d, t, *_ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[d].ids == ids and got[d].n_tokens == len(ids) and got[d].decoded == (t or "")
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].kept == "kept"


def test_bpe_incompatible_merge_tables_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges({"a": 0, "b": 1, "ab": 2, "aba": 3, "ba": 4}, [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")])


def test_token_files(docs, spark, tmp_path):
    library = token_files.tokenizer()
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, layout={"parquet.page.row.count.limit": "5"})
    got, start = collected(token_files.checksums(spark, path)), 0
    rows = collected(token_files.read_token_files(spark, path))
    for d, t, *_ in sorted(ROWS):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert rows[d].ids == ids and rows[d].start == start
        start += len(ids)
    narrow = token_files.read_token_files(spark, path, ids=False)
    assert "ids" not in narrow.columns and "ids:array" not in narrow._jdf.queryExecution().executedPlan().toString()
    found = [pq.ParquetFile(f).metadata for f in (tmp_path / "ids").glob("*.parquet")]
    column = next(m for m in found if m.num_rows).row_group(0).column(4)
    assert column.has_offset_index and column.compression == "ZSTD"


def test_token_files_read_by_id_skip_pages_and_say_their_encodings(spark, tmp_path, empty):
    path = str(tmp_path / "ids")
    rows = [(k, prose(60, k)) for k in range(4000)]
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, layout={"parquet.page.row.count.limit": "100"})
    files = [f for f in (tmp_path / "ids").glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows]
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        ids, doc = group.column(4), group.column(0)
        assert any("DICTIONARY" in e for e in ids.encodings) and doc.has_column_index and doc.has_offset_index
        assert any("DELTA" in e or "DICTIONARY" in e for e in doc.encodings)
    one = spark.read.schema(token_files.COLUMNS).parquet(path).where("doc_id = 1234")
    assert one.collect()[0].n_tokens == len(token_files.tokenizer().encode(rows[1234][1], add_special_tokens=False).ids) + 1
    # rows that the reader hands on: those of the id's page, not of its row group
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert 1 <= scan.metrics().apply("numOutputRows").value() <= 100
    assert token_files.checksums(spark, _written(spark, empty, tmp_path / "none")).collect() == []


def _written(spark, df, path):
    token_files.write_token_files(df, str(path))
    return str(path)


def test_token_memo_is_bounded_in_bytes(monkeypatch):
    own = token_files.WordEncoder()
    monkeypatch.setattr(token_files, "MEMO_BYTES", 10_000)
    for k in range(5):
        own.encode([" ".join(f"w{k}x{j}" for j in range(200)).encode()], 2)
        assert own.held < 100_000
    own.encode([b"q" * 50_000], 2)
    assert own.held > 10_000
    own.encode([b"a"], 2)
    assert own.held < 1_000


def test_mixing_rates_and_order(spark):
    rows = [(k, prose(5, k), "big" if k % 4 else "small") for k in range(2000)] + [(5000, None, None), (5001, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(frame, weights={"big": 1.0, "small": 1.0}).collect()
    counts = collections.Counter(r.source for r in out)
    assert 850 < counts["big"] < 1150 and 850 < counts["small"] < 1150 and counts[None] == 0
    many = collections.Counter((r.doc_id, r.n_copies) for r in out)
    assert all(n == copies for (_, copies), n in many.items())
    keys = [r.shuffle_key for r in out]
    assert len(set(keys)) == len(keys)
    spread = collections.Counter(r.n_copies for r in {r.doc_id: r for r in out}.values() if r.source == "small")
    assert abs(spread[2] / 500 - math.exp(-2) * 2) < 0.08  # Poisson with mean 2
    large = mixing.mix_sources(frame.where("source = 'small'").limit(100), epochs=90.0)  # a mean drawn in parts
    assert abs(large.count() / 9000 - 1) < 0.05


def test_classifier_learns_and_keeps_the_fold_out(spark):
    texts = [(k, prose(30, k) if k % 3 else " ".join(w + "###" for w in prose(30, k).split())) for k in range(400)]
    docs = spark.createDataFrame(texts + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(400)], "doc_id long, quality int")
    got = collected(quality_classifier.score_quality(docs, labels))
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in got)
    held = [d for d, _ in texts if got[d].held_out]
    assert held and all(got[d].predicted == int(d % 3 > 0) for d in held)
    assert 0 <= got[900].score <= 1 and got[900].score == got[901].score
    flipped = labels.select("doc_id", quality_classifier.F.expr("if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) AS quality"))
    again = collected(quality_classifier.score_quality(docs, flipped))
    assert {d: r.score for d, r in got.items()} == {d: r.score for d, r in again.items()}
    none = collected(quality_classifier.score_quality(docs, labels.where("false")))
    assert {r.score for r in none.values()} == {0.5}


def test_toxicity_finds_mined_and_listed_words(spark):
    r = random.Random(8)
    bad = ["zorkol", "zorkad", "zorkum", "idiot", "moron", "blivet", "gronx", "scum"]

    def text(k):
        words = prose(60, 7000 + k).split()
        if k % 4 == 0:
            for _ in range(5):
                words[r.randrange(60)] = r.choice(bad)
        return " ".join(words)
    texts = [(k, text(k)) for k in range(800)]
    docs = spark.createDataFrame(texts + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(600)], "doc_id long, toxic int")
    got = collected(toxicity.score_toxicity(docs, labels))
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    right = [got[d].predicted == int(d % 4 == 0) for d in range(800) if got[d].held_out or d >= 600]
    assert sum(right) >= 0.97 * len(right)
    assert got[9000].score == got[9001].score < 0.5
    assert len(toxicity.score_toxicity(docs, labels.where("false")).collect()) == 802


def test_label_model_recovers_accuracies():
    r = np.random.default_rng(1)
    y = r.random(40_000) < 0.2
    hit = np.array([[0.02, 0.8], [0.1, 0.7], [0.01, 0.5], [0.3, 0.3]])
    votes = np.array([r.random(40_000) < np.where(y, p1, p0) for p0, p1 in hit])
    votes = np.vstack([votes, votes[1] ^ (r.random(40_000) < 0.02)])  # a voter that copies another
    counts = np.bincount((votes.T * (1 << np.arange(5))).sum(1), minlength=32).astype(float)
    few = slice(0, 800)  # labelled rows give the first guess
    model = toxicity.LabelModel(5).fit(counts, np.array([votes[:, few][:, y[few] == k].mean(1) for k in (False, True)]), y[few].mean(), edges=1)
    assert (1, 4) in model.pairs and abs(model.prior - 0.2) < 0.03
    post = model.posterior()[(votes.T * (1 << np.arange(5))).sum(1)]
    assert ((post > 0.5) == y).mean() > 0.93


def test_language_model(docs):
    got = collected(recurrent_lm.score_texts(docs, frequent=20))
    tokens = {d: [*WORD.findall(low(t or "")), " "] for d, t, *_ in ROWS}
    counts = collections.Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0


def test_network_probabilities_sum_to_one_and_gradients_hold():
    v = recurrent_lm.Vocabulary({recurrent_lm.END: 5, b"a": 9, b"b": 7, b"cc": 4, b"dd": 3}, 28, 5, explicit=4, rest=3)
    v.rest_tokens[:] = [3, 0, 1]
    net = recurrent_lm.Net(v, state=4, size=2)
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    states = np.random.default_rng(2).normal(size=(1, 4))
    all_symbols = np.arange(v.n_explicit + v.rest)
    logp = net.outputs(np.repeat(states, len(all_symbols), 0), all_symbols)
    assert abs(np.exp(logp).sum() - 1) < 1e-9
    symbols, lengths = np.array([1, 2, 0, 5, 1, 1, 0, 3, 0, 0]), np.array([3, 4, 2, 1])
    kept = {}
    net._update = lambda grads, *rest: kept.update(grads)
    net.train(symbols, lengths, {}, lanes=2, window=50)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for k in range(0, len(flat), 5):
            if abs(flat[k]) > 1e3:
                continue
            old, ends = flat[k], []
            for step in (1e-4, -1e-4):
                flat[k] = old + step
                ends.append(net.score(symbols, lengths, lanes=2).sum())
            flat[k] = old
            assert abs((ends[0] - ends[1]) / 2e-4 - kept[name].reshape(-1)[k]) < 2e-2, name


def test_scores_do_not_depend_on_packing():
    v = recurrent_lm.Vocabulary({recurrent_lm.END: 5, b"a": 9, b"b": 7}, 21, 3, explicit=3, rest=2)
    net, r = recurrent_lm.Net(v), np.random.default_rng(4)
    lengths = r.integers(1, 90, 37)
    symbols = r.integers(0, 5, lengths.sum())
    one = net.score(symbols, lengths, lanes=1, window=7)
    assert np.allclose(one, net.score(symbols, lengths, lanes=16, window=24), atol=1e-3)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (exact_dedup.exact_dedup(empty), exact_dedup.keep_first(empty), ngram_join.similar_groups(empty), ngram_join.keep_one(empty),
                quality_rules.quality_rules(empty), mixing.mix_sources(empty), bpe.encode_texts(empty), quality_classifier.score_quality(empty, labels),
                toxicity.score_toxicity(empty, labels), recurrent_lm.score_texts(empty)):
        assert out.count() == 0


def test_json_vocabulary_is_read_from_a_path(tmp_path):
    path = tmp_path / "copy.json"
    with open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8") as f:
        spec = json.load(f)
    path.write_text(json.dumps(spec), encoding="utf-8")
    assert bpe.Codec(str(path)).encode("hello there") == bpe.codec().encode("hello there")


def test_near_copies_around_several_centres_make_few_pairs(spark, monkeypatch):
    centres = [near(BASE[4], 50 + c, 30) for c in range(5)]
    rows = [(k, near(centres[k % 5], 1000 + k, 1 + k % 4)) for k in range(2000)]
    made, untested = [], ngram_join._Join.untested

    def counted(self, met):
        pairs = untested(self, met)
        made.append(pairs.count())
        return pairs
    monkeypatch.setattr(ngram_join._Join, "untested", counted)
    found = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n=3, percent=90).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: k % 5 for k, _ in rows}
    assert sum(made) <= 20 * len(rows)  # all pairs of a centre's copies would be 400,000


def test_similar_groups_of_no_rows_and_a_long_text(spark, empty):
    assert ngram_join.similar_groups(empty, n=3, percent=90).collect() == []
    long = prose(300_000, 9)
    got = ngram_join.similar_groups(spark.createDataFrame([(1, long), (2, long + " end"), (3, "short text here")], "doc_id long, text string"), n=3, percent=90)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]
