from __future__ import annotations

import random
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from pulsegrain.llm.html_text import blocks_of, common_lines, lines_of, main_text
from tests.conftest import SMALL

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use <b>cookies</b></div>
<article class="post"><header><h1>Title &amp; more</h1></header><p>First
  line<script>var a = "</p>";</script> &eacute;&#8364;</p><form><p>Search</p></form><div class="ads">Buy</div>
<aside>See also</aside><p>Second <i>one</i></p><table><tr><td>a</td><td>b</td></tr></table>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></article>
<footer>&copy;</footer></body></html>"""


def test_markup_decides():
    assert blocks_of(PAGE) == (["Title & more", "First line é€", "Second one", "a b"], True)
    assert blocks_of("") == ([], False)
    assert blocks_of("plain <3 text &lt;b&gt;") == (["plain <3 text <b>"], False)
    assert blocks_of("<nav>open<article><p>a<p>b") == (["a", "b"], True)
    assert blocks_of("<p>a<!-- x --><br>b</p><footer>cut <p>off") == (["a b"], False)


def test_wrappers_stay_and_names_count_as_wholes():
    story = "<p>" + "The story goes on here. " * 5 + "</p>"
    text = ("The story goes on here. " * 5).strip()
    for page in (f'<div class="layout has-sidebar"><article>{story}</article></div>',
                 f'<div id="page-header-menu-wrapper"><main>{story}</main></div>',
                 f'<form id="aspnet"><div class="sidebar-left"><article>{story}</article></div></form>',
                 f'<article>{story}<div class="ad">buy</div><p style="display: none">unseen</p></article>',
                 f'<div class="related"><article>short teaser</article></div><article>{story}</article>',
                 f'<article>short teaser</article><div class="story">{story}</div>'.replace("short teaser", "")):
        assert blocks_of(page)[0] == [text], page
    kept = f'<article>{story}<p class="share-price">5 up</p><p class="related-work">Earlier</p><p class="responses">Nine</p></article>'
    assert blocks_of(kept)[0] == [text, "5 up", "Earlier", "Nine"]
    assert blocks_of(f"<article>teaser</article><div>{story}</div>") == (["teaser", text], False)


def test_a_short_text_in_a_long_template_loses_the_template(spark):
    menu = "".join(f"<div>entry {i} of the site</div>" for i in range(12))
    rows = [(i, f"http://t.org/{i}", f"{menu}<p>only sentence {i}</p>") for i in range(4)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: f"only sentence {i}" for i in range(4)}


def test_common_lines_are_longest():
    pick = random.Random(2)
    for _ in range(500):
        a, b = ([pick.randrange(4) for _ in range(pick.randrange(14))] for _ in range(2))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
        found, rest = common_lines(a, b), iter(b)
        assert len(found) == length[-1][-1] and all(any(y == a[i] for y in rest) for i in found)


def test_shared_lines_of_neighbours_go(spark):
    rows = [(h * 100 + i, f"http://h{h}.org/a/{i}?x=1", f"<div>Site {h} of all</div><p>text {h} {i}</p><p>more {i * 7 + h}"
             "</p><div>Contact us</div>") for h in range(3) for i in range(20)]
    rows += [(5, "http://h0.org/a/5.html#z", rows[5][2]), (900, None, None), (901, "http://one.org/", "<p>alone"),
             (None, "http://h1.org/zz", "<p>no id</p><div>Contact us</div>"), (902, "http://h0.org/b", ""), rows[7]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {n: F.lit("clash") for n in ("text", "host", "path", "lines", "shared", "page", "id", "of")}).repartition(5)
    found = main_text(df).collect()
    assert len(found) == len(rows)
    texts = {(r.page_id, r.url): r.text for r in found}
    for page, url, _ in rows[:60]:
        h, i = divmod(page, 100)
        assert texts[page, url] == f"text {h} {i}\nmore {i * 7 + h}"
    assert texts[5, "http://h0.org/a/5.html#z"] == "text 0 5\nmore 35"
    assert (texts[900, None], texts[901, "http://one.org/"], texts[902, "http://h0.org/b"]) == ("", "alone", "")
    assert texts[None, "http://h1.org/zz"] == "no id"
    assert all(r.n_chars == len(r.text) for r in found)


def test_marked_pages_are_differenced_too(spark):
    """Menu, advert and footer are what a page shares with its pair; a sentence of both articles stays."""
    def page(i: int) -> str:
        return (f"<head><title>Site</title></head><nav><ul><li>Home</li><li>News<script>var a = 1</script></li></ul></nav>"
                f"<div class='ad'>Buy {i}</div><article><p>Article {i}</p><p>In both.</p><aside>See also</aside></article>"
                "<footer>Imprint <p>All rights</footer>")
    rows = [(i, f"https://d.org/{i}", page(i)) for i in range(6)] + [(9, "https://e.org/9", page(9))]
    assert lines_of(page(1)) == (["Home", "News", "Buy 1", "Article 1", "In both.", "See also", "Imprint",
                                  "All rights"], [3, 4], True)
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: f"Article {i}\nIn both." for i, *_ in rows}
    assert {r.page_id: r.n_shared for r in found} == {i: 6 if i < 6 else 0 for i, *_ in rows}


def test_copies_of_a_page_stay_whole(spark):
    page = "<p>" + "</p><p>".join(f"line {i}" for i in range(30)) + "</p>"
    rows = [(1, "http://a.org/x", page), (2, "http://a.org/y", page)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text.count("\n") for r in found} == {29}


def test_articles_of_the_given_pages(spark):
    """The article is the document that the page's address names, behind its title."""
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    found = main_text(spark.read.parquet(str(Path(SMALL, "pages.parquet")))).collect()
    named = 0
    for r in found:
        number = int(r.url.split("?")[0].split("#")[0].rstrip("/").removesuffix(".html").rpartition("/")[2])
        if number in texts:
            named += 1
            lines = [" ".join(x.split()) for x in texts[number].split("\n")]
            assert r.text.split("\n")[1:] == [x for x in lines if x]
    assert named == len(found) > 0
    assert main_text(spark.read.parquet(str(Path(SMALL, "pages.parquet"))).where("false")).count() == 0
