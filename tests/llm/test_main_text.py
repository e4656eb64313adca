"""Main text of pages, against a plain reading of the given pages and pages of other shapes."""

import html
import re

import duckdb
import pytest

from tidemark.llm.main_text import extract, main_text

TEXT = [
    "The committee met on Tuesday, as planned, and heard three reports; none was long.",
    "It adjourned at noon. Its members will meet again in May, unless the council objects.",
    "No.",
    "A list of open questions follows, with the names of those who asked them, in order.",
]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in TEXT)
AROUND = (
    "<header><h2>Site name</h2><a href=/>Home</a></header><nav><a href=/a>One</a> <a href=/b>Two</a></nav>",
    "<aside><p>Other stories, many of them, that nobody asked for; read on.</p></aside><div class='ad-box'>Buy now, pay later.</div>"
    "<section id=comments><article class=comment><p>I agree, wholly, with all of this, and more. Really.</p></article></section>"
    "<div class='cookie-notice'>We use cookies, sorry.</div><form><p>Your name, please.</p><input><button>Send</button></form><footer>Imprint, 2020.</footer>",
)


def plain(page):
    """The article element read by splitting it at its block tags."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(sf):
    pages = duckdb.sql(f"SELECT html FROM '/root/testdata/{sf}/pages.parquet'").fetchall()
    assert [main_text(h) for (h,) in pages] == [plain(h) for (h,) in pages]


@pytest.mark.parametrize(
    "before,after",
    [("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"), ("<div class=content>", "</div>"),
     ("<div><div id=story>", "</div></div>"), ("<section class='post no-sidebar'>", "</section>"), ("", "")],
)
def test_what_stands_around_goes(before, after):
    page = f"<html><head><title>t</title></head><body>{AROUND[0]}{before}<h1>A title</h1>{PARAGRAPHS}{after}{AROUND[1]}</body></html>"
    assert main_text(page) == "\n".join(["A title", *TEXT])


def test_unlabelled_links_around_a_plain_body_go():
    links = "<div>" + " ".join(f"<a href=/{i}>Link {i}</a>" for i in range(9)) + "</div>"
    assert main_text(f"<body>{links}<h1>A title</h1>{PARAGRAPHS}{links}</body>") == "\n".join(["A title", *TEXT])
    assert main_text(f"<body>{links}<h1>A title</h1><div>{PARAGRAPHS}</div>{links}</body>") == "\n".join(["A title", *TEXT])


def test_parts_of_an_article_stay():
    inner = "<h1>T</h1><p>One,<br>two&nbsp;three.</p><ul><li>a<li><b>b</b>c</ul><table><tr><td>1<td>2</table><pre>x\n  y</pre><blockquote>He said: yes.</blockquote>"
    want = "T\nOne, two three.\na\nbc\n1\n2\nx y\nHe said: yes."
    assert main_text(f"<body><nav>menu</nav><article>{inner}<script>if (a < b) p('</p>')</script><style>p{{}}</style></article></body>") == want


@pytest.mark.parametrize(
    "source,want",
    [
        (None, ""),
        ("", ""),
        ("<p></p><!-- only this -->", ""),
        ("no markup, 1 < 2 &amp; 3 > 2", "no markup, 1 < 2 & 3 > 2"),
        ("<p>cut &ampere; &am", "cut &ere; &am"),
        ("<p>a<!-- <p>b --> c<p title='>'>d</p", "a c\nd"),
        ("<p>x</p><script>never closed <p>y", "x"),
        ("<p>x</div></b></article>y</p>", "xy"),
        ("<p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d</p>", "d"),
    ],
)
def test_defined_cases(source, want):
    assert main_text(source) == want


def test_long_and_deep_pages():
    words = " ".join(["word, and word."] * 50_000)
    assert main_text(f"<article><p>{words}</p></article>") == words
    assert main_text("<div>" * 20_000 + "deep." + "</div>" * 20_000) == "deep."
    assert main_text("<b><i>" * 20_000 + "deep.") == "deep."
    assert main_text("<a \"" * 5_000 + ">end.") == "end."


def test_extract(spark):
    shape = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", "<p>Ä b</p>", "clash", 1), (1, "u", "<p>Ä b</p>", "clash", 1), (None, None, None, None, None)]
    table = spark.createDataFrame(rows, shape)
    got = sorted(map(tuple, extract(table).collect()), key=str)
    assert got == [(1, "u", "Ä b", 3), (1, "u", "Ä b", 3), (None, None, "", 0)]
    assert extract(table).columns == ["page_id", "url", "text", "n_chars"]
    assert extract(table.limit(0)).count() == 0
