"""HTML extraction: the article of real and odd pages, and edge cases."""

import random
import re
import time
import tracemalloc
from html import unescape

import duckdb
import pytest

from tallyspan.llm import pages
from tallyspan.llm.pages import extract, extract_pages, leaves, path_ratios
from tallyspan.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string"

ODD = [
    ("<p>Hello <b>world</b>. This &amp; that.</p>", ["Hello world. This & that."]),
    ("", []), ("plain text only", ["plain text only"]), ("<br><br>", []), ("<article></article>", []),
    ("<p>1 < 2 & 3 > 2 &lt;b&gt;</p>", ["1 < 2 & 3 > 2 <b>"]),
    ("<article><h1>T</h1><p>a <i>b</i>\n\t c&nbsp;d<p>e</article><footer>no</footer>", ["T", "a b c d", "e"]),
    ("<body><nav><a href=x>menu</a></nav><main><p>Short.</p><ul><li>a<li>b</ul></main><aside>x</aside>", ["Short.", "a", "b"]),
    ("<article><p>a<script>if (a < b) {x('</p>')}</script>b<!-- c <p> --> d</p><style>p{}</style></article>", ["ab d"]),
    ("<article><p>x</p><div class='comments'><p>Great post, really!</p></div><div id=\"cookie-notice\">ok</div></article>", ["x"]),
    ("<article><form><input value=a><button>Send</button></form><p title='a>b'>kept</p></article>", ["kept"]),
    ("<article><p>one<br>two <a href=y>link</a>, three</p><table><tr><td>c1<td>c2</table></article>", ["one two link, three", "c1", "c2"]),
    ("<ARTICLE><P>Upper &eacute; &#233; &#xe9; &unknown;</P></ARTICLE>", ["Upper é é é &unknown;"]),
    ("<article><p>never closed <b>bold", ["never closed bold"]),
    ("<article><p>before</p><!-- never closed <p>x</p>", ["before"]),
    ("</div></p></article>stray", ["stray"]),
    ("<div class='menu'><a href=x>Home</a></div><div id=content><h2>Title</h2><p>One, two. Three, four and five.</p><p>Six.</p></div>"
     "<div class='reader-comments'><p>Nice, thanks.</p></div>", ["Title", "One, two. Three, four and five.", "Six."]),
    ('<p>a</p><svg class="i"/><p>b <svg viewBox=">" />c</p><svg/><math/><p>d</p><svg><path d=""/><text>no</text></svg><p>e</p>', ["a", "b c", "d", "e"]),
]


@pytest.mark.parametrize("page,expected", ODD)
def test_odd_pages(page, expected):
    assert extract(page) == expected


def test_without_names_the_ratios_choose_the_text():
    links = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(30))
    text = "".join(f"<p>Sentence {i}, which is long enough to be text. It has points; and more of them.</p>" for i in range(8))
    page = f"<body><div><ul>{links}</ul></div><div><div>{text}</div></div><div><span>Terms</span> <a href=x>Privacy</a></div>"
    got = extract(page)
    assert len(got) == 8 and all(x.startswith("Sentence") for x in got)


def test_the_ratios_choose_between_an_article_and_a_longer_text():
    text = "".join(f"<p>Sentence {i}, which is long enough to be text. It has points; and more of them.</p>" for i in range(8))
    teaser = "<article><h3>Next</h3><p>Read on, soon.</p></article>"
    got = extract(f"<html><body><div>{teaser}</div><div><div>{text}</div></div></body></html>")
    assert len(got) == 8 and all(x.startswith("Sentence") for x in got)
    got = extract(f"<html><body><article>{text}<p>Short.</p><p><a href=x>Link</a></p></article><div><p>Terms, of use.</p></div></body></html>")
    assert len(got) == 10 and got[-2:] == ["Short.", "Link"]


def test_ratios_add_text_and_punctuation_and_ignore_what_is_no_content():
    paths, found = leaves(
        "<body><p>Long text, with points. And more.</p><pre>Long text with points And more</pre>"
        "<nav><p>Long text, with points. And more.</p></nav><ul><li><a href=x>Long text, with points.</a></ul>")
    (prose, _, _), (bare, _, _), (menu, _, _), (link, _, _) = found
    ratios = path_ratios(found, paths.out, spread=0.01)
    assert ratios[prose] > ratios[bare] > ratios[link] == ratios[menu] == 0.0 and paths.out[menu]
    assert all(0 <= x < 1 for x in ratios.values())


def test_the_ratios_decide_on_the_given_pages(sf_dir, monkeypatch):
    given = [x for x, in duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet'").fetchall()]
    before = [extract(x) for x in given]
    monkeypatch.setattr(pages, "path_ratios", lambda found, out: {p: 0.0 for p, _, _ in found})
    assert sum(extract(x) != y for x, y in zip(given, before, strict=True)) > 0.9 * len(given)
    draw = random.Random(2)
    monkeypatch.setattr(pages, "path_ratios", lambda found, out: {p: draw.random() for p, _, _ in found})
    assert sum(extract(x) != y for x, y in zip(given, before, strict=True)) > 0.1 * len(given)


def test_a_poor_ratio_outvotes_an_article():
    text = "".join(f"<p>Sentence {i}, which is long enough to be text. It has points; and more of them.</p>" for i in range(8))
    links = "".join(f"<div><a href=/{i}>Item {i} of the list</a></div>" for i in range(9))
    got = extract(f"<body><article>{text}<section>{links}</section></article></body>")
    assert len(got) < 8 + 9 and got[:8] == [x for x in got if x.startswith("Sentence")]


LONG = {
    "quotes": '<a "' * 250_000, "two quotes": "<a '\">\"" * 160_000, "nested": "<div>" * 100_000 + "deep",
    "nested texts": "<div>x " * 100_000, "signs": "<" * 1_000_000, "tags": "<a" * 400_000, "comments": "<!--" * 250_000,
    "ends": "<p>" * 1000 + "</x>" * 200_000, "cells": "<p><td>" + "<div><p>" * 60_000,
    "names": "<div class=main>" * 60_000, "scripts": "<script>" * 120_000, "closed": "<p>" * 100_000 + "</p>" * 100_000}


@pytest.mark.parametrize("name", LONG)
def test_broken_and_deep_markup_takes_time_and_memory_as_its_length(name):
    tracemalloc.start()
    start = time.perf_counter()
    extract(LONG[name])
    took, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 30 and peak < 300e6


def test_articles_of_the_given_pages(spark, sf_dir):
    got = {r["page_id"]: r for r in QUERIES["op8_html"](spark, sf_dir).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{sf_dir}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url, page in rows:
        article = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub("</?b>", "", x))).strip() for x in re.split("</?p>|<br>|</?h1>", article)]
        expected = "\n".join(x for x in blocks if x)
        assert tuple(got[i]) == (i, url, expected, len(expected))


def test_nulls_repeated_rows_long_pages_clashing_columns_and_no_rows(frame):
    long = "<article>" + "<p>words here.</p>" * 20_000 + "</article>"
    deep = "<div>" * 5000 + "deep"
    rows = [(None, None, None, 1), (1, "u", "", 1), (2, "u", "<p>a</p>", 1), (2, "u", "<p>a</p>", 1), (3, "u", long, 1), (4, "u", deep, 1)]
    got = extract_pages(frame(rows, PAGES + ", text int"))
    assert got.columns == ["page_id", "url", "text"]
    found = sorted((str(r["page_id"]), r["text"]) for r in got.collect())
    assert found == [("1", ""), ("2", "a"), ("2", "a"), ("3", "\n".join(["words here."] * 20_000)), ("4", "deep"), ("None", "")]
    assert extract_pages(frame([], PAGES)).collect() == []
