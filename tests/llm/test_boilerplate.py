"""Main text of pages against pages made of known parts."""

import html
import random
import re

import pytest

from crownledger.llm import boilerplate as B

FOLDER = "/root/testdata/sf0.01"
LONG = "A sentence of the article that goes on for a while, so that it counts for something."

BEFORE = [
    "<header><a href='/'>Site</a> <h2>The daily page</h2></header>", "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>",
    f"<div class='cookie-notice'><p>We use cookies. {LONG}</p><button>OK</button></div>", "<!-- <p>comment</p> --><script>var x = '<p>no</p>';</script>",
    "<style>p > b { color: red }</style>", "<form action='/s'><label>Search</label><input name=q><select><option>All</select></form>",
    "<div id=ad-top><p>Buy this now, it is the very best that you can buy for your money these days.</p></div>",
]
AFTER = [
    f"<aside><h3>More</h3><p>{LONG} {LONG}</p></aside>", f"<section id='comments'><h3>2 comments</h3><article class='comment'><p>{LONG}</p></article></section>",
    f"<footer><p>&copy; the page. {LONG}</p></footer>", f"<div class='sidebar'><p>{LONG}</p></div>", f"<p hidden>{LONG}</p>",
]
PARTS = [
    (f"<h1>Title &amp; more</h1><p>{LONG}</p>", ["Title & more", LONG]), ("<p>Short.<p>Shorter.", ["Short.", "Shorter."]),
    (f"<p>Two\n  lines and <b>bold</b>&nbsp;text<br>here. {LONG}</p>", [f"Two lines and bold text here. {LONG}"]),
    ("<ul><li>first item<li>second <a href='/x'>item</a></ul>", ["first item", "second item"]),
    ("<div class='ad'>Sponsored words that should be gone, although they are long enough to be counted as text.</div>", []),
    (f"<blockquote>{LONG}</blockquote><table><tr><td>1<td>2</table>", [LONG, "1", "2"]), (f"<p>a &lt; b &#x41;&#66; {LONG}", [f"a < b AB {LONG}"]),
]


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main class='has-sidebar'>{}</main>", "<div class='content'>{}</div>", "<form><div>{}</div></form>"])
def test_article_between_boilerplate(seed, frame):
    rng = random.Random(seed)
    parts = [PARTS[0], *rng.choices(PARTS[1:], k=rng.randrange(6)), (f"<p>{LONG}</p>", [LONG])]
    page = "".join(
        ["<!DOCTYPE html><html><head><title>T</title></head><body class='no-sidebar'>", *rng.sample(BEFORE, rng.randrange(len(BEFORE))),
         frame.format("".join(p for p, _ in parts)), *rng.sample(AFTER, rng.randrange(len(AFTER))), "</body></html>"]
    )
    assert B.main_text(page) == "\n\n".join(t for _, texts in parts for t in texts)


def test_regions():
    assert B.regions([0, 5, 90, 0, 5, 0, 0, 0, 7, 0]) == [(1, 5)]
    assert B.regions([100, 0, 0, 0, 100]) == [(0, 1), (4, 5)]
    assert B.regions([3, 0, 0, 0, 9, 1]) == [(4, 6)]  # no surge: the heaviest
    assert B.regions([]) == [] and B.regions([0, 0, 0]) == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("<", "<"), ("plain", "plain"), ("<p>cut <b", "cut"), ("<p>x</p><!-- never ends <p>y", "x"), ("<script>x", ""),
        ("<article>only a title</article><footer>f</footer>", "only a title"), ("<nav>all of it</nav>", ""), ("<p>&amp;lt; &nosuch;", "&lt; &nosuch;"),
        ("<div class=ad>never closed <p>but text", "never closed\n\nbut text"), ("</p></div>x", "x"), ("<p>a</p><p></p><p> \n </p><p>b</p>", "a\n\nb"),
    ],
)
def test_odd_pages(page, text):
    assert B.main_text(page) == text


@pytest.mark.parametrize("page", ["<b " * 100_000, "<p>" * 50_000 + "x", '<a "' * 100_000, "<!--" * 100_000, "<noscript>" * 50_000, "<div><nav>" * 50_000, "x" * 10**7])
def test_time_grows_with_the_page(page):
    B.main_text(page)


def test_query_equals_the_articles(spark):
    """On the test pages the article is everything between two tags; cut out by patterns here."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html or "<article></article>", re.DOTALL)[1]
        blocks = [" ".join(html.unescape(b.replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1|b)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        want[r.page_id] = (r.url, text, len(text))
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in B.op12_boilerplate(pages).collect()} == want


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    page = "<article><p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, "u", "<p>a", "x", "y"), (1, "u", "<p>a", "x", "y"), (None, None, None, None, None), (2, None, "", "x", "y"), (3, "v", page, "x", "y")]
    out = B.op12_boilerplate(spark.createDataFrame(rows, schema).repartition(2))
    assert sorted(map(repr, ((r.page_id, r.url, r.text[:9], r.n_chars) for r in out.collect()))) == sorted(
        map(repr, [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, "", 0), (3, "v", "word word", 999_999)])
    )
    assert B.op12_boilerplate(spark.createDataFrame([], schema)).collect() == []
