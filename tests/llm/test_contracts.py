"""The registered queries themselves: against their SQL, and on tables with nulls, empty and very long texts, ties, repeated
rows, extra columns with clashing names, and no rows at all."""

import hashlib
import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chartsift.llm import queries, suffix_dedup, token_rollup, url_filter

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, n int, copy int, words string, size long, score double, component long, v string"


def written(spark, path, rows, pages=(), vectors=(), labels=(), items=()):
    os.mkdir(path)
    full = [(i, t, "en", s, len(t or ""), 5, "k", 1, 9, "w", 3, 0.5, 1, "x") for i, t, s in rows]
    for name, schema, own in (
        ("documents", DOCS, full),
        ("pages", "page_id long, url string, html string, node string, host string", [(*r, "n", "h") for r in pages]),
        ("embeddings", "vec_id long, embedding array<float>, id long, v string", [(*r, 1, "v") for r in vectors]),
        ("labels", "doc_id long, quality int, toxic int, score double", [(*r, 0.1) for r in labels]),
        ("benchmark", "item_id long, text string, words string, key long", [(*r, "w", 1) for r in items]),
    ):
        spark.createDataFrame(own, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    rnd = random.Random(4)
    w = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    item, long = prose(30), "lorem " + prose(40_000) * 20
    rows = [(i, prose(80), f"s{i % 3}") for i in range(60)]
    rows += [(60, rows[0][1], "s0"), (61, rows[0][1], None), (5, rows[5][1], "s2"), (5, rows[5][1], "s2"), (6, "another text of the same id", "s1")]
    rows += [(70, None, "s1"), (71, "", "s1"), (72, " \t\n", "s2"), (None, prose(50), None), (None, None, None), (73, long, "s0"), (74, f"{prose(20)} {item} {prose(20)}", "s0"), (75, "jo@mail.example.com +1 (826) 555-4081", None)]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)]
    pages = [(1, "http://a.com/de/", None), (2, "http://b.net/x/y", '<link rel="canonical" href="../../a"><link href="http://a.com/de" rel=canonical>'), (2, None, ""), (None, "http://b.net/a", "<p>" * 100_000)]
    vectors = [(i, [float(i % 5), 1.0, -0.5]) for i in range(230)] + [(100, [1.0, 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (300, None), (301, [None, 1.0, 1.0]), (302, [float("inf"), 1.0, 1.0])]
    return written(spark, tmp_path_factory.mktemp("odd") / "t", rows, pages, vectors, labels, [(1, item), (2, None), (3, "too short"), (None, item)]), rows


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("none") / "t", [])


@pytest.mark.parametrize("name", ["op2_token_rollup", "op5_decontamination", "op6_url_filter", "op8_exact_topk"])
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.queries()[name](spark, SMALL)
    want = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert set(names) == set(df.columns)
    assert rows_of(df.select(*names)) == sorted((tuple(r) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_of_no_rows(spark, none, name):
    assert queries.queries()[name](spark, none).count() == 0


@pytest.mark.parametrize("name", [n for n in sorted(queries.queries()) if n.split("_")[0] in ("op1", "op3", "op4", "op7", "op9", "op10")])
def test_queries_give_a_row_for_each_odd_document(spark, odd, name):
    path, rows = odd
    out = queries.queries()[name](spark, path)
    assert len(set(out.columns)) == len(out.columns)
    got = out.collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in rows), key=repr)
    if name == "op1_toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    if name == "op3_suffix_array_dedup":
        raw = [(t or "").encode() for _, t, _ in rows]
        seen = {}
        for b in raw:
            for s in range(len(b) - 399):
                seen[b[s : s + 400]] = seen.get(b[s : s + 400], 0) + 1
        want = []
        for (i, _, _), b in zip(rows, raw):
            spans = suffix_dedup.merge([(s, s + 400) for s in range(len(b) - 399) if seen[b[s : s + 400]] > 1])
            kept = b"".join(b[x:y] for x, y in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(b)]))
            want.append((i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        assert sorted(want, key=repr) == sorted((tuple(r) for r in got), key=repr)
    if name == "op10_source_mixing":
        sizes = {}
        for r in got:
            sizes.setdefault(r.source_size, [0, 0, r.target])
            sizes[r.source_size][0] += r.size
            sizes[r.source_size][1] += r.taken
            assert r.taken <= 3 * r.size
        assert all(total == size for size, (total, _, _) in sizes.items())
        assert {tuple(r) for r in got} == {tuple(r) for r in queries.queries()[name](spark, path).collect()}


def test_stages_keep_columns_and_clean_odd_documents(spark, odd):
    path, rows = odd
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "mixing":
            assert out.columns == docs.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert ids.count(None) == 2 or name == "mixing"
        if name == "near_dedup":
            assert 60 not in ids and 61 not in ids and {*range(60)} <= set(ids) and 73 in ids
        if name == "decontamination":
            assert 74 not in ids and len(ids) == len(rows) - 1
        if name == "pii":
            assert out.where("doc_id = 75").first().text == "[EMAIL] [PHONE]" and out.where("doc_id = 73").first().text == rows[-3][1]


def test_lost_commits_are_made_again(spark, tmp_path):
    r = token_rollup.Rollup(spark, f"file://{tmp_path}/r")
    one = spark.createDataFrame([("s", "en", "words-1", 1, 7)], r.SCHEMA)
    os.makedirs(tmp_path / "r")
    (tmp_path / "r/commit-1").write_bytes(b"")  # lost between creating and writing its marker
    one.write.parquet(f"file://{tmp_path}/r/rows-lost")
    assert not r.committed("1") and r.totals().count() == 0
    assert r.commit("1", one) and not r.commit("1", one)
    assert [x.n_tokens for x in r.totals().collect()] == [7]


def test_links_are_resolved_beside_their_page(spark):
    rows = [("/c/d.html", "http://h.net/c/d.html"), ("../e", "http://h.net/e"), ("./f?x=../y", "http://h.net/a/f?x=../y"), ("..", "http://h.net/"), ("?q=1", "http://h.net/a/b?q=1"), ("#top", None), ("//k.org/z", "http://k.org/z"), ("../../../g", "http://h.net/g"), ("https://o.com/p", "https://o.com/p")]
    df = spark.createDataFrame([(t, "http://h.net/a/b?old=1", w) for t, w in rows], "target string, url string, want string")
    for r in df.select("target", "want", url_filter.absolute(F.col("target"), F.col("url")).alias("got")).collect():
        assert r.got == r.want, r
