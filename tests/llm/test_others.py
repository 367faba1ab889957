"""Pages, vectors, components and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import html, neighbours
from tarmac.llm.common import stored, table
from tarmac.llm.components import components

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return html.fit(table(spark, "/root/testdata/sf0.01", "pages"))


CASES = [
    ("<html><body><nav><a href=/>Menu</a></nav><article><h1>A &amp; B</h1><p>One  two<br>three, four and more words of text.<p>Five"
     " <b>si</b>x and quite a few more words, to be read.</article><footer>Foot</footer>",
     "A & B One two three, four and more words of text. Five six and quite a few more words, to be read."),
    ("<body><div id=menu><ul><li><a href=a>x</a><li><a href=b>y</a></ul></div><div class='post-content'><p>The first part is long"
     " enough, with commas, to be read.</p><div class=ad>Buy now</div><p>The second part goes on, and on, for long.</p></div>"
     "<div id=comments><div class=comment><p>I like it, said a reader, very much so.</p></div></div><script>p('<p>no</p>')</script>",
     "The first part is long enough, with commas, to be read. The second part goes on, and on, for long."),
]


@pytest.mark.parametrize("source,text", CASES)
def test_main_text(model, source, text):
    assert html.extract([source], model) == [text]


@pytest.mark.parametrize("tag", ["svg", "select", "template", "noscript", "math"])
def test_unclosed_elements_hide_nothing(model, tag):
    page = CASES[0][0].replace("<p>Five", f"<{tag}><p>Five")
    assert html.extract([page], model) == [CASES[0][1]]
    if tag == "math":
        formula = CASES[0][0].replace("three,", "<math><mi>x</mi><mo>=</mo><mn>3</mn></math> three,")
        assert html.extract([formula], model) == [CASES[0][1].replace("three,", "x=3 three,")]
    else:
        closed = CASES[0][0].replace("<p>Five", f"<{tag}><i>hidden</i></{tag}><p>Five")
        assert html.extract([closed], model) == [CASES[0][1]]


def test_pages(spark, model):
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "v", "<", 3), (4, "w", "<p <b>> &#x41;&bogus; <!-- open", 4), (None, "x", CASES[0][0], 5),
            (5, "y", "<div>" * 3000 + "deep", 6), (6, "z", "<article><p>" + "long text, " * 40000, 7)]
    out = html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, text long"), model).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    got = {r.page_id: r.text for r in out}
    assert got[1] == got[2] == "" and got[None] == CASES[0][1] and got[6] == ("long text, " * 40000).strip()
    none = spark.createDataFrame(rows, "page_id long, url string, html string, text long").where("false")
    assert html.main_texts(none, html.fit(none)).count() == 0


def test_smoke_pages(spark, model):
    """Every page of the smoke table marks its article; the rest is menus, adverts and footers."""
    import html as entities
    import re
    for r in html.main_texts(table(spark, SMOKE, "pages"), model).join(table(spark, SMOKE, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        inner = re.sub(r"<[^>]*>", lambda m: "" if m.group(0) in ("<b>", "</b>") else " ", inner)
        assert r.text == " ".join(entities.unescape(inner).split())


def brute(ids, x, q, k):
    s = x @ x[q]
    s[q] = -np.inf
    return ids[np.lexsort((ids, -s))[:k]].tolist()


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)) + 2 * rng.normal(size=(12, 16))[rng.integers(0, 12, 3000)]
    x[100:140] = x[100]                                       # ties
    x = x.astype(np.float32).astype(float)
    ids = np.arange(3000)
    odd = [(9000, None), (9020, []), (9040, [0.0] * 16), (9060, [float("nan")] + [1.0] * 15), (9080, [None] + [1.0] * 15),
           (None, x[0].tolist()), (9100, [float("inf")] + [1.0] * 15), (9120, [1.0, 2.0]), (5, x[5].tolist())]
    rows = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, x, strict=True)] + [(i, v, 1) for i, v in odd],
                                 "vec_id long, embedding array<double>, score int")
    out = neighbours.search(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == list(range(0, 3000, 20)) and all([r.rank for r in v] == list(range(1, 21)) for v in got.values())
    hits = sum(len(set(brute(ids, x, q, 20)) & {r.vec_id for r in v}) for q, v in got.items())
    assert hits >= 0.9 * 20 * len(got)
    assert [r.vec_id for r in got[120]] == brute(ids, x, 120, 20) and {*range(100, 119)} <= {r.vec_id for r in got[120]}
    assert all(r.score == pytest.approx(x[q] @ x[r.vec_id]) for q, v in got.items() for r in v)
    few = neighbours.search(rows.where("vec_id < 4"), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [r.vec_id for r in few] == brute(ids[:4], x[:4], 0, 3)
    assert neighbours.search(rows.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_steps_are_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    path = cells[np.argsort(neighbours.hilbert(cells, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(int(a), int(b)) for a, b in rng.integers(100, 300, (120, 2))]
    group = {x: x for e in edges for x in e}
    for _ in range(len(group)):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: g for x, g in group.items() if x in got} and all(x in got for x, g in group.items() if g != x)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    docs = table(spark, SMOKE, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMOKE), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMOKE).count() == 0
