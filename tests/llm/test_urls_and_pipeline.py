"""URL filter against a brute-force reading of its rules; the pipeline against its parts."""

import pytest

import __spark_entry__
import corpus_pipeline
from tidemark.llm import bpe, common, exact_dedup, ngram_join, url_filter

from .test_text_operators import BASE, near, prose

URLS = [None, "", "no host", "http://", "https://A.Example.NET/en/1?x=1&y=2#z", "http://example.net", "http://b.example.com/de/2", "http://example.com/De/2",
        "http://myexample.com/de/2", "ftp://x.org/fr/", "http://x.org/fr", "http://org/fr/x", "http://ÄB.net/é", "http://free-bets.example.com/en/1",
        "http://casino-win.example.org/es/3", "http://a.net?q=://b.org/fr/", "http://x.com#/fr/", "http://spam-farm.example.com/it/9", "x://y://z.net/"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_rules(spark):
    rows = [(k, u, "mine") for k, u in enumerate(URLS * 2)]
    out = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, Verdict string")).collect()}
    assert len(out) == len(rows)
    for k, u, _ in rows:
        host, path, rule, verdict = judged(u)
        assert (out[k].host, out[k].path, out[k].rule) == (host, path, rule)
        assert out[k].verdict == verdict if verdict else out[k].verdict in ("allow", "block")
    assert out[URLS.index("http://free-bets.example.com/en/1")].verdict == "block"


def test_one_label_and_empty(spark):
    rows = spark.createDataFrame([(1, "http://good.example.com/en/1"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.filter_urls(rows).collect()} == {"allow"}
    assert url_filter.filter_urls(rows.where("false")).count() == 0


def test_url_plan_has_no_python(spark):
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    plan = url_filter.filter_urls(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    good = [prose(60 + k % 90, 300 + k) for k in range(120)]
    texts = good + [good[k].replace(" ", " \n") for k in range(10)] + [near(good[k], k, 1) for k in range(20, 40)] + [" | ".join(prose(80, k).split()) for k in range(5)]
    texts += [None, "", "short text", BASE[4]]
    rows = [(k, t, "en" if k % 7 else None, f"s{k % 3}", len(t or ""), "extra", k, True) for k, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rid string, entry long, kept boolean")
    frame.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, corpus):
    docs = common.read(spark, corpus, "documents")
    columns, quality = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mixing", "bpe_encoding"]
    kept = quality["quality_rules"](spark, docs, corpus)
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids >= set(range(115)) and not ids & set(range(150, 158))
    copies = quality["exact_dedup"](spark, docs, corpus)
    firsts = {r.doc_id for r in exact_dedup.exact_dedup(docs).where("kept").collect()}
    assert copies.columns == columns and {r.doc_id for r in copies.collect()} == firsts and not firsts & set(range(120, 130))
    lone = quality["ngram_jaccard_join"](spark, docs, corpus)
    gone = {r.doc_id for r in ngram_join.similar_groups(docs, n=5, percent=80).where("component_id < doc_id").collect()}
    assert lone.columns == columns and {r.doc_id for r in lone.collect()} == {r.doc_id for r in docs.collect()} - gone and gone >= set(range(120, 130))
    mixed = quality["mixing"](spark, docs, corpus)
    assert mixed.columns == columns and mixed.where("doc_id is null").count() == 0


def test_run(spark, corpus):
    out = __spark_entry__.queries()["pipeline"](spark, corpus)
    rows = out.collect()
    texts = {r.doc_id: r.text for r in common.read(spark, corpus, "documents").collect()}
    assert rows and not {r.doc_id for r in rows} & set(range(120, 158))
    own = bpe.codec()
    assert all(own.decode(bpe.np.array(r.ids, "<u4").tobytes()).decode() == texts[r.doc_id] for r in rows)


def test_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
