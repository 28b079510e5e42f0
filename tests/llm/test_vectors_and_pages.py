"""Nearest neighbours against a full scan, main text of pages, and the pipeline."""

from __future__ import annotations

import html
import re

import numpy as np
import pytest
from fixtures import jaccard, shingles, stable

import corpus_pipeline
from goldthread.llm import neighbours
from goldthread.llm.main_text import extract_main_text, main_text
from goldthread.llm.neighbours import nearest_neighbours
from goldthread.llm.queries import op7_nearest_neighbours, op9_main_text


def exact(ids, vectors, k=20, every=20):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (vectors * vectors[i]).sum(1)
        other = ids != ids[i]
        order = np.lexsort((ids[other], -score[other]))[:k]
        out[ids[i]] = list(zip(ids[other][order].tolist(), score[other][order].tolist()))
    return out


def recall(got, want):
    hits = sum(len({v for v, _ in w} & set(got.get(q, {}))) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").filter("embedding IS NOT NULL").toPandas()
    ok = [np.isfinite(np.array(e, float)).all() and np.any(e) for e in table.embedding]
    table = table[ok]
    want = exact(table.vec_id.to_numpy(), np.stack([np.array(e, float) for e in table.embedding]))
    rows = op7_nearest_neighbours(spark, folder).collect()
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert all(len(g) == 20 and list(g.values()) == sorted(g.values(), reverse=True) for g in got.values())
    assert set(got) == set(want) and recall(got, want) >= 0.9
    exact_scores = {(q, v): s for q, w in want.items() for v, s in w}
    assert all(got[q][v] == s for (q, v), s in exact_scores.items() if v in got[q])


@pytest.mark.parametrize("block", [4096, 64])
def test_unequal_lengths_copies_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", block)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 16)
    random = np.random.default_rng(3)
    vectors = random.standard_normal((900, 12)) * random.uniform(0.1, 5, (900, 1))
    vectors[300:600] = vectors[300]  # a third are copies
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    odd = [(1000, None, "n"), (1020, [0.0] * 12, "z"), (1040, [float("nan")] + [1.0] * 11, "f"), (1060, [1.0] * 5, "s"),
           (1080, [None] + [1.0] * 11, "h"), (None, [1.0] * 12, "i"), (1100, [float("inf")] + [1.0] * 11, "g")]
    table = stable(spark, spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string"))
    got: dict = {}
    for r in sorted(nearest_neighbours(table, covered=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {q: [v for v, _ in w] for q, w in exact(np.arange(900), vectors).items()}
    assert set(got) == set(want)
    assert sum(got[q] == want[q] for q in want) >= 0.95 * len(want)
    few = nearest_neighbours(stable(spark, table.filter("vec_id < 3")))
    assert sorted((r.query_id, r.vec_id) for r in few.collect()) == [(0, 1), (0, 2)]
    assert nearest_neighbours(stable(spark, table.filter("vec_id = 0"))).count() == 0
    assert nearest_neighbours(table.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head>
<body class="with-sidebar"><div id="top" class="site-header"><h2>Site</h2></div><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies, and more. Do you agree? Yes, sure.</div>{article}
<aside><p>Aside text, that is longer than one would think, and has commas, too.</p></aside>
<form><p>Write to us, please, as soon as you can.</p></form>
<section id="comments"><div class="comment"><p>{comment}</p></div></section><footer>&copy; 2024, all of it.</footer></body></html>"""
PARTS = ["Caf&eacute; &amp; bar", "First paragraph, with <b>bold</b> and a <a href='x'>link</a>; it is long enough.",
         "Second&nbsp;one<br>with a break, a comma, and more   space.", "Short."]
TEXT = "Café & bar First paragraph, with bold and a link; it is long enough. Second one with a break, a comma, and more space. Short."


@pytest.mark.parametrize("wrap", ["<article><h1>{0}</h1><p>{1}</p><p>{2}<p>{3}</article>",
                                  "<main><div><h1>{0}</h1><div>{1}</div><p>{2}</p><p>{3}</p></div></main>",
                                  "<div class='post'><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p></div>"])
def test_main_text(wrap):
    page = PAGE.format(article=wrap.format(*PARTS), comment="I, for one, do not agree. " * 3)
    assert main_text(page) == TEXT


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<html></html>", ""), ("plain words, no markup", "plain words, no markup"), ("<p>open", "open"),
    ("<article><p>a < b & c</p></article>", "a < b & c"), ("<article><!-- x <p>y</p> --><p>z</p>", "z"),
    ("<article><p title='a>b'>t</p></article></article></div>", "t"), ("<nav>only</nav>", ""), ("<script>x", "")])
def test_odd_pages(page, text):
    assert main_text(page) == text


LONG = "A sentence, with commas, and words enough to be the text of a page; so it goes on. "


@pytest.mark.parametrize("page", [
    "<div id=content><h1>Head</h1><section><p>{0}1</p><p>{0}2</p></section><section><p>{0}3</p></section></div>",
    "<div><h1>Head</h1><section><p>{0}1</p></section><section><p>{0}2</p></section><section><p>{0}3</p></section></div>",
    "<div><h1>Head</h1><p>{0}1 <svg width='9'/></p><p>{0}2</p><p>{0}3</p></div>",
    "<div><h1>Head</h1><p>{0}1</p><p><math/>{0}2</p><p>{0}3 <svg><g><svg>x</svg></g></svg></p></div>",
    "<div><h1>Head</h1><p>{0}1 <svg><g></p><p>{0}2 <svg>x</svg></p><p>{0}3</p></div>"])
def test_whole_article(page):
    page = "<body><div class=nav><svg/></div>" + page.format(LONG) + "</body>"
    assert main_text(page) == f"Head {LONG}1 {LONG}2 {LONG}3"


@pytest.mark.parametrize("page", [
    "<div><article class=part><h1>Head</h1><p>{0}1</p></article><article class=part><p>{0}2</p><p>{0}3</p></article></div><article class=card>Teaser.</article>",
    "<article><h1>Head</h1><p>{0}1</p></article><article><p>{0}2</p></article><article><p>{0}3</p></article>",
    "<article><h1>Head</h1><p>{0}1</p><p>{0}2</p><p>{0}3</p></article><article><p><a href=x>More</a></p></article>"])
def test_article_in_parts(page):
    assert main_text("<body>" + page.format(LONG) + "</body>") == f"Head {LONG}1 {LONG}2 {LONG}3"


def test_pages(spark):
    folder = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        inner = re.sub(r"</?(p|h1|br)[^>]*>", " ", inner[1]) if inner else ""
        want[r.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())
    assert {r.page_id: r.text for r in op9_main_text(spark, folder).collect()} == want
    odd = spark.createDataFrame([(1, None, None, "e"), (None, "u", "<p>é" + "a" * 300_000, "x"), (1, None, None, "e")],
                                "page_id long, url string, html string, text string")
    got = extract_main_text(odd)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, 300_001), (1, 0), (1, 0)]
    assert extract_main_text(odd.limit(0)).count() == 0


def test_pipeline(spark):
    """Every stage keeps the columns, drops or changes what it should, and leaves the rest."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stable(spark, stage(spark, docs, folder))
        assert out.columns == docs.columns, name
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
        assert set(after) <= set(before) and len(after) > 0.5 * len(before)
        if name == "MinHash near-dedup":
            sets = [shingles(t) for t in after.values() if shingles(t)]
            assert not any(jaccard(a, b) >= 0.8 for i, a in enumerate(sets) for b in sets[:i])
        if name == "benchmark decontamination":
            items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert not any(i in (t or "") for i in items for t in after.values())
            assert all(any(len(shingles(i) & shingles(before[d])) >= 0.8 * len(shingles(i)) for i in items) for d in set(before) - set(after))
        if name == "secret scan":
            assert set(after) == set(before) and not any(re.search("[0-9a-f]{32}", t or "") for t in after.values())
        docs = out
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.collect()}
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()
