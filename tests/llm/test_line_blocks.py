"""Main text of pages: declared articles, pages of plain divisions, broken and odd ones."""

from __future__ import annotations

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from roadflow.llm import lineblocks, queries

P = "Some words of a paragraph that is long enough to be text, and then a few more words to make it longer."


def test_query_keeps_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.op12_line_blocks(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


DECLARED = f"""<html><head><title>T</title><style>p {{}}</style></head><body><header>Site<ul><li><a href=/>Home</a></ul></header><div class="cookie-notice"><p>{P}</p></div>
<article><header><h1>A &lt;title&gt;</h1></header><p>Sh.<aside>{P}</aside><p>{P} <a href=x>{P}</a></p><div class="ad">{P}</div><form><label>Mail</label><input></form>
<ul><li>one<li>two&nbsp;  x</ul><p>c<br>d <b>e</b>f</p><script>var x = "</p>{P}";</script><section class="comments"><article><p>{P}{P}{P}{P}{P}{P}</p></article></section></article>
<div id="sidebar">{P}{P}</div><footer>&copy; {P}</footer></body></html>"""
SOUP = f"""<body><div id=top><ul><li>Home<li>About</ul></div><div class="page has-sidebar"><div class=sidebar><p>{P}{P}{P}</div><div id=content><h1>Title</h1><div class=text><p>{P}<p>Short.
<ul><li>one<li>two</ul><p>{P}<div class=ad><p>Buy {P}</div><p>Last {P}</div></div><div class=links><a href=1>{P}</a> <a href=2>{P}</a></div><h3>Comments (3)</h3><div><p>Nice {P}{P}{P}{P}{P}</div></div>
<div class=footer>{P}</div>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (DECLARED, f"A <title>\nSh.\n{P} {P}\none\ntwo x\nc d ef"),
        (SOUP, f"Title\n{P}\nShort.\none\ntwo\n{P}\nLast {P}"),
        ("just text", "just text"), ("", ""), ("<p>Tiny</p>", "Tiny"), ("<nav><a href=x>a</a></nav>", ""), ("<script>x", ""), ("a < b > c <3 &amp <p", "a < b > c <3 &"),
        (f"<main><h1>A</h1><p>B</p></main><div>{P}</div>", "A\nB"),
        (f"<div class='post-content'><p>{P}<p>B</div><div id='user-comments'><p>{P}{P}{P}</div>", f"{P}\nB"),
        (f"<article><p>short</article><article><p>{P}</article>", P),
        (f"<!-- <article>{P}</article> --><article>x<!-- y --></article>", "x"),
    ],
)
def test_pages(page, text):
    assert lineblocks.main_text(page) == text


def test_a_stretch_begins_at_the_surge_and_ends_at_the_dive():
    weights = [5, 5, 0, 0, 0, 90, 0, 10, 40, 0, 0, 0, 7]
    assert lineblocks.stretches(weights, 80) == [(3, 8)] and lineblocks.stretches([3, 0], 80) == [(0, 0)] and lineblocks.stretches([], 80) == []


def test_the_distribution_finds_the_ends_of_a_declared_article(monkeypatch):
    """Lines before and after the article stay in the distribution: without surge and dive they would be text."""
    page = f"<p>Before {P}<p>Short<article><h1>A</h1><div class=ad>{P}</div><p>B</article><p>After {P}<footer>{P}</footer>"
    assert lineblocks.main_text(page) == "A\nB"
    monkeypatch.setattr(lineblocks, "stretches", lambda weights, surge: [(0, len(weights) - 1)])
    assert lineblocks.main_text(page) == f"A\nB\nAfter {P}\n{P}"
    monkeypatch.setattr(lineblocks, "stretches", lambda weights, surge: [])
    assert lineblocks.main_text(page) == ""


def test_long_and_broken_pages_take_their_length():
    began = time.time()
    for piece in ("<p>x", "<div>", '<a href="', "<", "<!--", "<p class='a", "&amp;", "<script>", "<li>", "<b>"):
        lineblocks.main_text(piece * 50_000)
    assert time.time() - began < 30
    assert lineblocks.main_text(f"<article><p>{P * 20_000}</article>") == " ".join((P * 20_000).split())


def test_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>a"), (1, "u", "<p>a"), (2, "", "")], "page_id long, url string, html string").withColumns({"text": F.lit(5), "a.b": F.lit(1)})
    got = lineblocks.extract(pages)
    assert sorted((str(r.page_id), r.text) for r in got.collect()) == [("1", ""), ("1", "a"), ("2", ""), ("None", "a")]
    assert got.columns == ["page_id", "url", "html", "a.b", "text"] and lineblocks.extract(pages.limit(0)).count() == 0
