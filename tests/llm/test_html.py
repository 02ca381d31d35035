from __future__ import annotations

import itertools

import pytest

from sieveworks.llm import html

NAV = "<nav><ul><li><a href=/>Home</a></li><li>About us and more words here</li></ul></nav>"
CASES = [
    (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{NAV}<div class=ad>buy this now please</div><article><h1>Head &amp; shoulders</h1><p>One <b>bo</b>ld\n two<br>three</article><footer>foot</footer></body></html>", "Head & shoulders One bold two three"),
    (f"<body>{NAV}<main><p>Caf&eacute; &#x263A; &lt;tag&gt;</p><aside>side</aside><form>Name <input></form><div class='comments'><p>nice</p></div><p>end</p></main></body>", "Café ☺ <tag> end"),
    ("<article><header>menu</header><p>a</p><!-- no --><p>b</p></article>", "a b"),
    ("<div id=cookie-notice>we use cookies</div><div><p>the long text of a page without a mark that goes on</p><p>and on for a while</p></div>", "the long text of a page without a mark that goes on and on for a while"),
    ("<article class='post with-sidebar'><p>the text</p></article><article class='comment'><p>me too</p></article>", "the text"),
    ("plain words only", "plain words only"),
    ("", ""),
    (None, ""),
    ("<p></p><br>", ""),
    ("<article>open <b>never closed <p>still here", "open never closed still here"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    (f"{NAV}<div class='col with-sidebar'><h2>Title</h2><p>the whole article of a page</p><p>goes on here</p></div>", "Title the whole article of a page goes on here"),
    (f"{NAV}<div class='sidebar-layout'><h2>Title</h2><p>the whole article of a page</p><p>goes on here</p></div>", "Title the whole article of a page goes on here"),
    ("<head><title>never closed<article><p>the text of it</p></article>", "the text of it"),
    ("<article><p>prices</p><table class='share-price-table'><tr><td>one</td><td>2.5</td></tr></table><section class='related-work'><h2>Related work</h2><p>others did it</p></section></article>", "prices one 2.5 Related work others did it"),
    ("<article><p>text</p><div class='related'><a href=1>another post</a> <a href=2>and one</a></div><div class='share-buttons'><a>send it</a></div><p>end</p></article>", "text end"),
    ("<article><p>before</p><iframe src=x><p>after the frame</p></article>", "before after the frame"),
    ("<div id=page><div class='sidebar'><article>another one</article></div><article><p>the one that counts</p></article></div>", "the one that counts"),
    ("<article><p>short</p></article><section id=comments><article><p>a long remark of a reader</p></article><p>and many more words of them here</p></section>", "short"),
    ("<div class=comment>only words of the page</div>", "only words of the page"),
    ("<article><p>text</p><div hidden>secret</div><div style='display: none'>too</div><p>end", "text end"),
    ("<article><div class='post-header'><h1>A title</h1></div><p>body</p></article>", "A title body"),
    ("<script>if (a < b) { document.write('<p>x</p>') }</script><p>all that is left</p>", "all that is left"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert html.extract(page, html.DEFAULT) == text


def test_best_run_against_all_runs():
    for scores in itertools.product((-2.0, -1.0, 1.0, 2.0), repeat=5):
        a, b = html.best_run(list(scores))
        best = max((sum(scores[i:j]) for i in range(5) for j in range(i + 1, 6)), default=0)
        assert sum(scores[a:b]) == max(best, 0)


def test_all_pages(spark, tmp_path):
    rows = [(i, None if i % 3 else "u", c[0], 1) for i, c in enumerate(CASES)] * 2
    spark.createDataFrame(rows, "page_id long, url string, html string, text int").write.parquet(str(tmp_path / "pages.parquet"))
    got = html.query(spark, str(tmp_path)).collect()
    assert len(got) == 2 * len(CASES) and all(r["text"] == CASES[r["page_id"]][1] and r["n_chars"] == len(r["text"]) for r in got)


def test_long_page():
    page = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert html.extract(page, html.DEFAULT) == " ".join(["word word"] * 20_000)


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.train(empty) == html.DEFAULT and html.main_text(empty, html.DEFAULT).count() == 0


WORDS = "an ordinary sentence of the article with more than a few words"


@pytest.mark.parametrize("tail", ['<a class="x" href="/p" rel="nofollow" target="_blank" title="cut', "<div class=main id=content role=main data-x=1", "<a " + "x" * 50, "<img src='a.png", '<img src="https://example.com/a.png', "<", "<!-- no end", "<!doctype", "</arti", "<a b='c"])
def test_a_page_cut_in_a_tag(tail):
    """The tag is markup: it is dropped, and what came before is kept."""
    assert html.extract(f"<p>{WORDS}</p>{tail}", html.DEFAULT) == WORDS
    assert html.extract(f"<article><p>{WORDS}</p>{tail}", html.DEFAULT) == WORDS


def test_quotes_in_and_outside_of_values():
    page = """<article><p title="a > b">one</p><p title='"'>two</p><p it's>three</p><p x = "a value>up to the next quote</p><p =">five</p><p y="never closed>six</p></article>"""
    assert html.extract(page, html.DEFAULT) == "one two three five six"


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<a x='y\"", "<!", "<script>", "<script><p>", "<div class=menu>", "<div></b>", "<b><div>", "<style>a<p >", "<head>", "<a =", "<td>a"])
def test_time_grows_with_the_page(unit):
    """Pages of one repeated piece, cut anywhere: twice the page takes about twice the time."""
    import time

    def best(n):
        took = []
        for _ in range(3):
            began = time.process_time()
            html.extract(unit * n + "<p", html.DEFAULT)
            took.append(time.process_time() - began)
        return min(took)

    n = 100_000 // len(unit)
    assert best(4 * n) < 8 * best(n) + 0.1


def test_every_cut_of_a_page():
    page = CASES[0][0] + CASES[14][0]
    for i in range(len(page)):
        text = html.extract(page[:i], html.DEFAULT)
        assert "</" not in text and "class=" not in text and "href" not in text


@pytest.mark.parametrize("cells", ["<table>" + "<tr><td>ab</td><td>12</td></tr>" * 40 + "</table>", "<ul>" + "<li><b>x</b></li>" * 50 + "</ul>", "<table><tbody>" + "<tr><th>k</th></tr>" * 9 + "</tbody></table>"])
def test_unmarked_pages_keep_tables_and_lists(cells):
    page = f"{NAV}<p>{WORDS}</p>{cells}<p>{WORDS}</p>"
    inner = html.extract(f"<article>{cells}</article>", html.DEFAULT)
    assert html.extract(page, html.DEFAULT) == f"{WORDS} {inner} {WORDS}"


def test_pages_with_their_marks_taken_off(spark):
    """The given pages as plain divisions give the text that their marks delimit."""
    import os
    import re

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html.train(pages)
    for r in pages.collect():
        bare = re.sub(r"<(/?)(article|main)\b", r"<\1div", r["html"], flags=re.I)
        assert html.extract(bare, weights) == html.extract(r["html"], weights)
