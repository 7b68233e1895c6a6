"""The operators on pages and vectors, and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest

from quernstone.llm import neighbours, queries, toxicity, url_reputation


def test_urls(spark):
    urls = ["https://A.Example.COM/en/7?x#y", "http://example.com/en/1", "ftp://x.net/de/1", "http://example.net/de/8x", "http://notexample.net/de/8", "http://q.org/es", "http://q.org/es/", "no url", None, "", "://", "http://10.0.0.1:80/a", "http://com/en/", "x://h?q://z/y", "http://a.co.uk/#f", "http://h\u00dc.com/en/\n"]
    pages = spark.createDataFrame([(k, u, "html", "x") for k, u in enumerate(urls * 2)] + [(None, urls[0], "", "x")], "page_id long, url string, html string, host string")
    got = url_reputation.judge(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 2 * len(urls) + 1
    assert [(by[k].host, by[k].path, by[k].rule) for k in range(4)] == [("a.example.com", "/en/7", "example.com/en/7"), ("example.com", "/en/1", "com/en/"), ("x.net", "/de/1", "net/de/"), ("example.net", "/de/8x", "example.net/de/8")]
    assert by[4].rule == "net/de/" and by[5].rule is None and by[6].rule == "org/es/" and by[0].verdict == "allow" and by[3].verdict == "block"
    assert all((by[k].host, by[k].path) == ("", "") for k in (7, 8, 9)) and by[13].host == "h"
    assert all(r.verdict in ("allow", "block") for r in got)
    duckdb = __import__("duckdb").connect()
    duckdb.register("pages", pages.toPandas())
    expected = duckdb.sql(url_reputation.oracle()).fetchall()
    cols = ("page_id", "host", "path", "rule", "verdict")
    assert Counter(tuple(r[c] for c in cols) for r in got) == Counter(expected)
    assert url_reputation.judge(pages.where("false")).collect() == []


def test_rules_are_those_of_the_contract(spark):
    said = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    assert {rule: verdict for verdict, rule in url_reputation.RULES} == said
    pages = spark.createDataFrame([(k, f"http://a.{rule}x") for k, rule in enumerate(said)], "page_id long, url string")
    assert {r.rule: r.verdict for r in url_reputation.judge(pages).collect()} == said


def test_reputation_shrinks_towards_parents(spark):
    outcomes = [("bad.site.com", 1)] * 40 + [("new.site.com", None)] + [("good.org", 0)] * 200 + [("one.net", 1)] + [(f"x{k}.org", 0) for k in range(50)]
    got = {r.host: r for r in url_reputation.reputation(spark.createDataFrame(outcomes, "host string, bad int")).collect()}
    assert got["bad.site.com"].bound > 0.5
    assert got["good.org"].mean < got["new.site.com"].mean < 1
    assert got["one.net"].bound < got["bad.site.com"].bound


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(1, 16)) + 0.6 * rng.normal(size=(60, 16)) for _ in range(8)]).astype(np.float32)
    x = np.concatenate((x, np.repeat(x[:1], 130, axis=0)))
    data = [(int(k), [float(c) for c in v], "x") for k, v in enumerate(x)]
    odd = [(9001, None, "x"), (9002, [0.0] * 16, "x"), (9020, [float("nan")] * 16, "x"), (9040, [float("inf")] * 16, "x"), (9060, [1.0, 2.0], "x"), (9080, [None] * 16, "x"), (None, [1.0] * 16, "x")]
    d = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, node string")
    got = neighbours.search(d).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {k for k in range(len(x)) if k % 20 == 0}
    hit = total = 0
    full = x.astype(np.float64)
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21)) and q not in {r.vec_id for r in rs}
        s = full @ full[q]
        assert all(abs(r.score - s[r.vec_id]) < 1e-9 for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
        s[q] = -np.inf
        best = set(np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:20].tolist())
        hit += len(best & {r.vec_id for r in rs})
        total += 20
    assert hit / total >= 0.9


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 1.0], 1), (2, [1.0, 0.0], 1)], schema)
    assert [tuple(r) for r in neighbours.search(few).orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]
    assert neighbours.search(spark.createDataFrame([], schema)).collect() == []


def test_every_query_is_registered():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{k}" for k in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    from .test_documents import labelled, prose

    d, labels, _ = labelled(spark, 200)
    twin = prose(rng, 80)
    d = d.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame([(900 + k, f"{twin} end{k} of it now", "en", "t", 0) for k in range(3)], "doc_id long, text string, lang string, source string, n_chars long"))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "SentencePiece"]
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        assert k == 4 or docs.columns == columns
        assert docs.count() > 0
    assert docs.columns == ["doc_id", "n_tokens", "ids"]
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole) == Counter((r.doc_id, tuple(r.ids)) for r in docs.collect())


def test_hosts_that_agree_in_the_rest_give_one_row_a_page(spark):
    hosts = ["0.1", "a.0.1", ".", "x..", "b.0.1", "..", "1.2.3.4:80", "localhost", ""]
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, h in enumerate(hosts)], "page_id long, url string")
    got = url_reputation.judge(pages).collect()
    assert sorted((r.page_id, r.host) for r in got) == list(enumerate(hosts))


def test_repeated_ids_are_queries_and_candidates_of_their_own(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist(), 1) for k in range(30)] + [(0, rng.normal(size=8).tolist(), 1)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), every=30).collect()
    x = np.array([r[1] for r in rows])
    expected = []
    for q in (0, 30):
        s = sorted((-float(np.dot(x[q], x[j])), rows[j][0]) for j in range(31) if j != q)[:20]
        expected += [(0, k + 1, i, pytest.approx(-v)) for k, (v, i) in enumerate(s)]
    got = sorted(tuple(r) for r in got)
    assert len(got) == 40
    for e in expected:
        assert any(e == g for g in got)


@pytest.mark.parametrize("lengths", [{7: 1e9}, {7: 1e25, 8: 1e-25}, {k: 10.0 ** (k % 51 - 25) for k in range(600)}])
def test_lengths_of_some_vectors_spoil_no_other(spark, lengths):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16))
    for k, length in lengths.items():
        x[k] *= length
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    hit = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-s)[:20].tolist()))
    assert hit >= 0.9 * 600


def test_stages_on_empty_tables_with_extra_columns(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, h string, kind string"
    none = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(1, None, None, None, None, 1, "a", "b"), (1, None, None, None, None, 1, "a", "b"), (None, "one two\nthree", "en", None, 3, None, None, None), (2, "", "en", "s", 0, 2, "x", "y")], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for docs in (none, odd):
        for name, stage in corpus_pipeline.STAGES:
            args = (spark, docs, "") if name != "toxicity" else None
            out = stage(*args) if args else toxicity.clean_documents(docs, toxicity.fit(docs, labels))
            assert name == "SentencePiece" or out.columns == docs.columns
            assert (out.count() > 0) == (docs is odd), name
