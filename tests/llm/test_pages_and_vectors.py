"""Main text of pages, nearest neighbours, and the whole pipeline."""

from __future__ import annotations

import html as entities
import re

import brute
import numpy as np
import pytest
from test_token_operators import BYTE, covered, library, packed_rows

import corpus_pipeline
from viewpulse.llm import ann, html_extract, queries

SF = "/root/testdata/sf0.001"


def plain_article(page: str) -> str:
    """Blocks of the one article of the given pages, by patterns."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    parts = [re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
    texts = [" ".join(entities.unescape(p).split()) for p in parts]
    return "\n\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_articles_of_the_given_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    found = queries.op2_style_tree(spark, f"/root/testdata/{sf}").collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == plain_article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_noise_that_says_so():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>Site<nav><ul><li>Menu</ul></nav></header>
      <div class="layout left-sidebar"><main><article class="post comments-open"><header><h1>A &lt;title&gt;</h1><span class="byline">By me</span></header>
      <p>One  <b>bold</b><br>line &amp; more<p>Two<script>var x = "<p>no</p>";</script><aside>Aside</aside><div class="adBanner">Buy</div>
      <ul><li>first<li>second</ul><table><tr><td>a<td>b</table><form><input value=x>Form</form></article>
      <section id="comments"><article class="comment"><p>Reader</p></article></section></main></div>
      <div class="cookie-notice">Cookies</div><div role="complementary">Side</div><p hidden>Hidden</p><footer>Foot</footer></body></html>"""
    assert html_extract.main_text(page) == "A <title>\n\nOne bold line & more\n\nTwo\n\nfirst\n\nsecond\n\na b"


def test_style_tree_cuts_what_a_site_repeats(spark):
    """A box without a telling name, the same on every page of a site, goes; on another site where it varies it stays."""
    def page(i: int, box: str) -> str:
        return f"<body><div class='x1'>{box}</div><div class='x2'><h1>Title {i}</h1><p>Text {i} of the page.</p><p>Shared passage.</p></div></body>"

    rows = [(i, f"http://a.org/{i}", page(i, "All rights. Imprint")) for i in range(8)]
    rows += [(100 + i, f"http://b.org/{i}", page(i, f"Lead {i}")) for i in range(8)]
    # Copies of one page are no evidence.
    rows += [(200 + i, "http://c.org/", page(1, "Box")) for i in range(8)]
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "Title 3\n\nText 3 of the page.\n\nShared passage."
    assert found[103] == "Lead 3\n\nTitle 3\n\nText 3 of the page.\n\nShared passage."
    assert found[203].startswith("Box\n\n")


def test_text_outside_of_articles_stays(spark):
    """An <article> that is a teaser or an introduction, or a <main> with a part of the text, does not stand for the page."""
    def body(i: int) -> str:
        return f"<div class='story'><h1>Title {i}</h1><p>Text {i} of the page.</p><p>More {i}.</p></div>"

    def intro(i: int) -> str:
        return f"<article><h1>Title {i}</h1><p>Intro {i}.</p></article><div class='rest'><p>Text {i} of the page.</p></div>"

    rows = [(i, f"http://a.org/{i}", f"<body><article class='card'><p>Read our offer</p></article>{body(i)}</body>") for i in range(8)]
    rows += [(100 + i, f"http://b.org/{i}", f"<body>{intro(i)}</body>") for i in range(8)]
    rows += [(200 + i, f"http://c.org/{i}", f"<body><main><p>Lead {i}</p></main>{body(i)}</body>") for i in range(8)]
    rows.append((300, "http://d.org/", f"<body><main>{body(1)}<article class='card'><p>Offer</p></article></main></body>"))
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "Title 3\n\nText 3 of the page.\n\nMore 3."
    assert found[103] == "Title 3\n\nIntro 3.\n\nText 3 of the page."
    assert found[203] == "Lead 3\n\nTitle 3\n\nText 3 of the page.\n\nMore 3."
    assert found[300] == "Title 1\n\nText 1 of the page.\n\nMore 1.\n\nOffer"


def test_importance_is_relative_entropy(spark):
    rows = [("h", t, 7, c, s) for t, (c, s) in enumerate([(1, 5), (1, 5), (2, 5), (3, 6)])]
    nodes = spark.createDataFrame(rows, "host string, text bigint, path bigint, content bigint, shape bigint")
    (r,) = html_extract.importance(nodes).collect()
    entropy = lambda ps: -sum(p * np.log(p) for p in ps) / np.log(4)
    assert r.pages == 4 and np.isclose(r.importance, 0.8 * entropy([0.5, 0.25, 0.25]) + 0.2 * entropy([0.75, 0.25]))


def test_awkward_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [
        (1, None, None), (2, "http://x.org", ""), (None, "nonsense", "<p>a</p>"), (3, "http://x.org", "<p>same"), (3, "http://x.org", "<p>same"),
        (4, "http://x.org", deep), (5, "http://x.org", "no markup &amp &#x41;&nbsp;b"), (6, "http://x.org", "</p></div><p>stray</i></p><<>"), (7, "http://x.org", "<p>" + "word " * 100000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS low", "'x' AS host", "'x' AS text", "1 AS _id")
    found = html_extract.extract(pages).collect()
    by = {r.page_id: r for r in found}
    assert len(found) == len(rows) and by[1].text == by[2].text == "" and by[None].text == "a" and by[3].text == "same"
    assert by[4].text == "deep" and by[5].text == "no markup & A b" and by[6].text.startswith("stray") and by[7].n_chars == 499999
    assert html_extract.extract(pages.filter("false")).count() == 0


def exact(rows: list[tuple], k: int = 20) -> dict:
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    scores = np.array([[float((a * b).sum()) for b in x] for a in x[ids % 20 == 0]])
    scores[ids[ids % 20 == 0][:, None] == ids[None]] = -np.inf
    out = {}
    for q, s in zip(ids[ids % 20 == 0], scores, strict=True):
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def neighbours(df) -> dict:
    by: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(by[r.query_id])
    return by


def same(found: dict, want: dict) -> None:
    assert {q: [i for i, _ in n] for q, n in found.items()} == {q: [i for i, _ in n] for q, n in want.items()}
    assert all(np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=0, atol=1e-12) for q in want)


def test_neighbours_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(neighbours(queries.op8_hilbert_ann(spark, SF)), exact(rows))


def test_windows_alone_find_near_vectors(spark):
    """On clustered vectors the curves need no completion: recall against brute force."""
    r = np.random.default_rng(1)
    centres = r.standard_normal((150, 16)) * 3
    rows = [(i, (centres[i % 150] + 0.1 * r.standard_normal(16)).tolist()) for i in range(4500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = exact(rows, 10)
    found = neighbours(ann.nearest(df, k=10, complete=False, window_rows=128))
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert recall > 0.9


def test_many_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 7)
    r = np.random.default_rng(2)
    base = r.standard_normal((900, 8))
    base[300:700] = base[5]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    same(neighbours(ann.nearest(df, window_rows=50)), exact(rows))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (20, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
        (7, [1.0, 1.0, 1.0]), (8, []), (1, [0.5, 0.5]), (40, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS key", "1 AS curve", "1 AS rank", "1 AS score")
    assert neighbours(ann.nearest(df)) == {0: [(1, 0.5), (2, 0.5), (40, -1.0)], 40: [(1, -0.5), (2, -0.5), (0, -1.0)]}
    assert ann.nearest(df.filter("false")).count() == 0
    assert ann.nearest(df.filter("vec_id = 0")).count() == 0


def test_hilbert_curve_visits_every_cell_by_single_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_pipeline_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    scored = {r.doc_id: r.predicted for r in queries.op1_toxicity(spark, SF).collect()}
    docs = [(i, t) for i, t in docs if not scored[i]]
    kept = {r.doc_id for r in queries.op7_repetition_rules(spark, SF).collect() if r.kept}
    docs = [(i, t) for i, t in docs if i in kept and not brute.repetition(t)[5]]
    docs = [(i, out[2]) for i, out in brute.dedup_lines(docs).items()]
    group = brute.similar(docs)
    docs = [(i, t) for i, t in docs if group[i] == i]
    pieces = corpus_pipeline.run(spark, SF).collect()
    packed_rows(pieces)
    covered(pieces, dict(zip([i for i, _ in docs], library(BYTE, [t for _, t in docs]), strict=True)))


def test_stages_keep_the_columns(spark):
    docs = brute.awkward_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == brute.awkward_documents(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    none = brute.empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0
