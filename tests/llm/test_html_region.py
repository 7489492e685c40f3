"""Region extraction on the labelled pages themselves (against a plain cut at their markup) and on pages without labels."""

import html
import re

import pytest
from pyspark.sql import functions as F

from relink.llm import html_region as h

PAGES = "page_id long, url string, html string, text string, n_chars int"


def marked(page):
    """The article by its own markup; right for the given pages, whose articles hold headings, paragraphs, `b` and `br` only."""
    inside = re.search("<article>(.*)</article>", page, re.S)[1]
    out = [" ".join(html.unescape(re.sub("</?b>", "", z)).split()) for z in re.split("</?p>|</?h1>|<br>", inside)]
    return "\n".join(z for z in out if z)


@pytest.fixture(scope="module")
def weights(spark):
    return h.learned(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: marked(r.html) for r in pages.collect()}
    got = h.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_region_is_the_best_one():
    """The scan against all stretches."""
    import random
    rng = random.Random(5)
    for _ in range(300):
        line = []
        for _ in range(rng.randint(0, 25)):
            line.append(("text", "w " * rng.randint(0, 4), rng.random() < 0.2, 0) if rng.random() < 0.5 else ("tag", rng.choice(["p", "div", "ul", "nav.ad"]), rng.random() < 0.2, 0))
        weights = {"p": 0.5, "div": 2.0, "ul": 1.0, "nav.ad": 9.0}

        def total(a, b):
            return sum(0 if s else len(v.split()) if k == "text" else -h.cost(v, weights) for k, v, s, _ in line[a:b])

        a, b = h.region(line, weights)
        best = max([0] + [total(i, j) for i in range(len(line)) for j in range(i + 1, len(line) + 1)])
        assert abs(total(a, b) - best) < 1e-9 and (best > 0) == (b > a)


PROSE = "This paragraph has quite some words in it, so that its score is well above that of the tags around it. "


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<div><nav><a>x y z</a></nav></div>", ""), ("just words", "just words"),
    (f"<body><div class='menu'>{PROSE}</div><p>{PROSE}</p><p>{PROSE}", f"{PROSE.strip()}\n{PROSE.strip()}"),
    (f"<p>{PROSE}<div id=sidebar-2><p>{PROSE}</p></div><p>Some more words at the tail", f"{PROSE.strip()}\nSome more words at the tail"),
    (f"<main><h1>Head &amp; <b>b</b>old&#33;</h1><p>{PROSE}<p class=ad>buy this<p>a\n b&nbsp;&lt;p&gt;</main><section id='comments'><p>{PROSE * 9}</p></section>",
     f"Head & bold!\n{PROSE.strip()}\na b <p>"),
    (f"<article><header><h1>Title here</h1></header><p>{PROSE}</p><form><p>{PROSE}</p></form><ul><li>one</li><li>two</li></ul><p>{PROSE}</p></article>",
     f"Title here\n{PROSE.strip()}\none\ntwo\n{PROSE.strip()}"),
    (f"<div class='has-sidebar'><main><div>{PROSE}</div><div class=ad>{PROSE * 5}</div><section><div><div><a href=x>Z</a></div></div></section></main></div><div>{PROSE * 3}</div>",
     f"{PROSE.strip()}\nZ"),
    (f"<article class=post><p>{PROSE}</p></article><section class=comments><article class=comment><p>{PROSE}</p></article></section>", PROSE.strip()),
    (f"<form><article><p>{PROSE}</p></article></form><footer>{PROSE * 3}</footer>", PROSE.strip()),
    (f"<p>{PROSE}</p><script>if (a < b) {{ document.write('<p>no</p>') }}</script><!-- <p>no</p> --><p>1 < 2 and 3 > 2</p>", f"{PROSE.strip()}\n1 < 2 and 3 > 2"),
    (f"<p title=\"a > b\">{PROSE}</p><p hidden>no</p><p style='display: none'>no</p><p>{PROSE}</p><script>never closed <p>x", f"{PROSE.strip()}\n{PROSE.strip()}"),
    ("<p>" + PROSE * 2 + "</p>" + "<p>same line of words</p>" * 3, PROSE.strip() + " " + PROSE.strip() + "\nsame line of words" * 3),
])
def test_pages_by_hand(weights, page, want):
    assert h.main_text(page, weights) == want


def test_edges(spark):
    long = "<article>" + "<p>some words of a very long page</p>" * 60_000 + "</article>"
    deep = "<div>" * 50_000 + PROSE + "</b>" * 50_000
    broken = "<a \"" * 20_000 + PROSE
    rows = [(1, "u", None, "t", 1), (2, None, "", "t", 1), (3, "u", long, "t", 1), (3, "u", long, "t", 1), (None, "u", deep, "t", 1), (4, "u", broken, "t", 1)]
    df = spark.createDataFrame(rows, PAGES).withColumn("tag", F.lit("clash"))
    got = sorted(((r.page_id or 0, r.url, r.n_chars) for r in h.extract(df).collect()), key=str)
    size = 60_000 * len("some words of a very long page") + 59_999
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "u", 0), (2, None, 0), (3, "u", size), (3, "u", size)] and len(got) == 6
    assert h.extract(spark.createDataFrame([], PAGES)).count() == 0
    assert h.extract(spark.createDataFrame([(1, "u", f"<div>{PROSE}</div>", None, None)], PAGES)).first().text == PROSE.strip()
