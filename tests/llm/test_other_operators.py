"""URLs, pages, vectors, the queries with SQL twins, the pipeline, and plans of native operators."""

from __future__ import annotations

import math
import sys
import time
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_queries import TABLES, compare

import __spark_entry__ as entry
import corpus_pipeline
from shopstrata.llm import html_blocks, layouts, outliers, queries, reputation, topk
from shopstrata.llm.common import cut

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert compare(spark, con, name, SF)[2] == "ok"


def test_all_queries_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_native_operators_run_no_python(spark, docs):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (reputation.judge(pages, queries.URL_RULES), outliers.judge(docs)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# ---- URLs ---------------------------------------------------------------------------------


def pages_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "7 rate", "8 host", "9 n")


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://org/q",
        "http://xorg/q", "http://b.com?q/fr/", "http://b.com/fr/#/x", "https://b.com/de/://x", "http://É.Com/DE/",
        "http://b.com/de/1\nsecond",
    ]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in reputation.judge(pages_of(spark, urls), queries.URL_RULES).collect()}
    assert found[0][:3] == found[1][:3] == found[2][:3] == found[3][:3] == ("", "", None)
    assert found[4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[5][2:] == ("example.org/en/1", "block") and found[6][2:] == ("org/", "allow")
    assert found[7][2] is None and found[8][:3] == ("b.com", "", None)
    assert found[9][2:] == ("com/fr/", "allow") and found[10][1:] == ("/de/://x", "com/de/", "block")
    assert found[11][0] == "É.com" and found[12][1] == "/de/1\nsecond"
    assert reputation.judge(pages_of(spark, []), queries.URL_RULES).collect() == []


def test_reputation_blocks_bad_hosts_only(spark):
    rows = [("bad.x.com", 1)] * 40 + [("good.x.com", 0)] * 40 + [("bad.x.com", None)] * 5 + [("new.x.com", None)]
    rows += [(f"h{i}.y.com", i % 2) for i in range(20) for _ in range(10)]
    found = {r.host: r for r in reputation.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert found["bad.x.com"].bound > 0.5 > found["good.x.com"].bound
    assert found["good.x.com"].rate < found["new.x.com"].rate < found["bad.x.com"].rate
    assert found["new.x.com"].bound < 0.5


def test_reputation_without_labels(spark):
    judged = reputation.judge(pages_of(spark, ["http://a.net/", "http://b.net/"]), queries.URL_RULES).collect()
    assert {r.verdict for r in judged} == {"allow"}


# ---- pages --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def net():
    return html_blocks.fit()


def test_blocks_of_broken_markup():
    page = "<p>a &amp; b<br>c<p>d <b>e<div>f<script>x='</p>'</script>g</div><!-- h --><li>i<li>j</nope>k<textarea>l"
    assert [b.text for b in html_blocks.blocks(page)] == ["a & b c", "d e", "fg", "i", "jk"]
    for odd in ("", "<", "</", "<p", "<!--", "<a href='", "<script>", "&#x110000; &bogus; &lt;p&gt;", "</p></p></div>"):
        html_blocks.blocks(odd)


def test_net_gradient():
    r = np.random.default_rng(1)
    net = html_blocks.Net.fresh(r)
    pages = [r.normal(size=(n, html_blocks.INPUT)).astype(np.float32) for n in (3, 5)]
    truth = [r.integers(0, 2, n).astype(float) for n in (3, 5)]

    def loss():
        p, _ = net.run(pages)
        return -sum(np.log(np.where(t == 1, p[: len(t), k], 1 - p[: len(t), k])).sum() for k, t in enumerate(truth)) / 8

    for part, g in zip(net.parts, net.gradients(pages, truth), strict=True):
        at = tuple(r.integers(0, s) for s in part.shape)
        part[at] += 1e-4
        above = loss()
        part[at] -= 2e-4
        below = loss()
        part[at] += 1e-4
        assert abs((above - below) / 2e-4 - g[at]) < 1e-3


def test_labels_of_unseen_layouts(net):
    r = np.random.default_rng(4321)
    right = total = 0
    for _ in range(150):
        found = html_blocks.blocks(layouts.page(r))
        truth = np.array([layouts.MARK in b.text for b in found])
        for b in found:
            b.text = b.text.replace(layouts.MARK, "").strip() or "."
        right += int((net.main([html_blocks.vectors(found)])[0] == truth).sum())
        total += len(found)
    assert right / total > 0.98


def test_main_text_of_given_pages(spark, net):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_blocks.extract(pages, net).join(pages.select("page_id", "html"), "page_id").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert r.text == "\n".join(b.text for b in html_blocks.blocks(article)) and r.n_chars == len(r.text)


def test_odd_pages(spark, net):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, None, "<p>" + "word " * 50_000), (4, "u", "<div>" * 3000 + "x")]
    found = html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), net).collect()
    assert len(found) == 5 and [r.text for r in found][:3] == ["", "", ""]


def texts(html):
    return [b.text for b in html_blocks.blocks(html)]


def test_broken_markup():
    assert texts('<p>a</p><a title="x>broken') == ["a", "broken"]
    assert texts('<p title="a>b">in</p> <i>x</i> 1 < 2 <b') == ["in", "x 1 < 2 <b"]
    assert texts("<p id='one\">two</p><p>three</p>") == ["two", "three"]
    assert texts("<!-- a > b --><p>c<!-- d") == ["c"] and texts("<script>if (a < b) x()</script ><p>t") == ["t"]
    assert texts("<div></ div>a</div ><!doctype x><?y?>b") == ["ab"]


@pytest.mark.parametrize("unit", ['<a "', "<div>y", "<b>", "</script", "<a '\">", "<p id='", "<!--", "< ", "</b>x<i>", "<script>"])
def test_long_broken_pages_take_time_in_proportion(unit):
    started = time.process_time()
    html_blocks.blocks(unit * (1_000_000 // len(unit)))
    assert time.process_time() - started < 30


# ---- vectors ------------------------------------------------------------------------------


def brute_top(rows, k):
    valid = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in valid if i % 50 == 0}):
        own = min((tuple(v) for i, v in valid if i == q))
        scored = [
            (-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(own, v, strict=True)))), i)
            for i, v in valid if i != q and len(v) == len(own)
        ]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 2])
def test_top_k(spark, block):
    from pyspark.sql import functions as F

    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(260)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(300, 420)]  # a frequent vector: ties
    rows += [(7, rows[7][1]), (100, rows[100][1]), (None, [1.0] * 4), (500, None), (501, [1.0, None, 1.0, 1.0])]
    rows += [(502, [float("nan")] * 4), (503, [float("inf")] * 4), (550, [1.0, 2.0]), (551, []), (600, [9.0, 1.0, 3.0])]
    rows += [(650, [3e5, 1.0, 0.0, 2.0]), (651, [-3e5, 1e30, 0.0, 0.0]), (700, [1e30, 0.0, 0.0, 1.0]), (701, [1e300] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 rank", "2 score", "3 v")
    found = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0, block=block)
    assert sorted(tuple(x) for x in found.collect()) == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# ---- pipeline -----------------------------------------------------------------------------


def test_pipeline_on_odd_rows(spark, odd):
    docs, counts = odd, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF))
        assert docs.columns == odd.columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= counts[-1]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_pipeline_decisions(spark, docs):
    from shopstrata.llm import language_id, near_copies, simhash, substrings

    stages = dict(corpus_pipeline.STAGES)
    first = cut(stages["language ID"](spark, docs, SF))
    labelled = language_id.identify(docs).where("lang_pred <> 'und' AND score >= 0.5")
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in labelled.collect()}
    second = cut(stages["quality rules"](spark, first, SF))
    assert {r.doc_id for r in second.collect()} == {r.doc_id for r in outliers.judge(first).where("kept").collect()}
    third = cut(stages["SimHash near-dedup"](spark, second, SF))
    leasts = {r.component_id for r in simhash.near_duplicates(second).collect()}
    similar = near_copies.near_copies(second.where(F.col("doc_id").isin(*leasts)))
    copies = {r.doc_id for r in similar.where("doc_id <> component_id").collect()}
    assert {r.doc_id for r in third.collect()} == leasts - copies
    fourth = {r.doc_id: r.text for r in stages["substring dedup"](spark, third, SF).collect()}
    for r in substrings.removal_digest(third).collect():
        assert len(fourth.get(r.doc_id, "").split()) == r.n_words - r.n_removed
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.collect()} == set(fourth)


def test_language_stage_rejects_texts_of_no_one_language(spark, docs):
    from pyspark.sql import functions as F

    longest = F.max_by("text", F.struct(F.length("text"), "doc_id")).alias("text")
    parts = {r.lang: " ".join(r.text.split()[:60]) for r in docs.groupBy("lang").agg(longest).collect()}
    mixed = "\n".join(parts[lang] for lang in ("de", "en", "es", "fr"))
    added = {10_000_000 + i: text for i, text in enumerate([mixed, *parts.values()])}
    rows = spark.createDataFrame(list(added.items()), "doc_id long, text string")
    whole = docs.unionByName(rows, allowMissingColumns=True)
    kept = dict(corpus_pipeline.STAGES)["language ID"](spark, whole, SF)
    assert {r.doc_id for r in kept.where("doc_id >= 10000000").collect()} == set(added) - {10_000_000}


def test_language_stage_without_labels_keeps_lettered_texts(spark, odd, odd_rows):
    from pyspark.sql import functions as F

    stage = dict(corpus_pipeline.STAGES)["language ID"]
    kept = stage(spark, odd.withColumn("lang", F.lit(None).cast("string")), SF)
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in odd_rows)
