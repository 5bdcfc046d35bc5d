"""Main text of pages: layouts built by hand with their articles."""

import time

import pytest

from orestrata.llm.main_text import extract_main_text, main_text

LONG = "A sentence with commas, clauses, and enough words to look like prose to any reader of it. " * 3
PROSE = " ".join(LONG.split())
NAV = '<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("just words", "just words"),
        (f"<body>{NAV}</body>", ""),
        # Blocks part words, inline tags do not; references are decoded; blanks become one.
        ("<article><h1>T&eacute;t</h1><p>a<b>b</b> &amp;amp; \n\t c&nbsp;d<br>e</p>f</article>", "Tét ab &amp; c d e f"),
        ("<article><p><b>open<br><p>next<p>last</article><footer>no</footer>", "open next last"),
        # Everything that is no article, inside and outside of it.
        (
            f"<header><h1>Site</h1></header>{NAV}<main><article><header><h1>Title</h1></header><p>{LONG}</p>"
            f"<aside>side</aside><form><input><p>form</p></form><div class='share-buttons'>share</div><p>End.</p></article>"
            f"<section id='comments'><article class='comment'><p>{LONG}{LONG}</p></article></section></main><footer>f</footer>",
            f"Title {PROSE} End.",
        ),
        (f"<script>var a='<p>no</p>';</script><style>p{{}}</style><noscript>no</noscript><p>{LONG}</p><!-- <p>no</p> -->", PROSE),
        # No article element: the best container, and siblings that hold prose.
        (
            f"<body class='has-sidebar'><div id='top'>{NAV}</div><div class='wrap'><h1>Head</h1><div class='text'><p>{LONG}</p><p>{LONG}</p></div>"
            f"<div class='more'><p>{LONG}</p></div><div class='sidebar'><p>{LONG}</p></div><ul><li><a href=x>l</a><li><a href=y>m</a></ul></div>",
            f"Head {PROSE} {PROSE} {PROSE}",
        ),
        # Old layouts: tables, and a page that is one form.
        (f"<table><tr><td><a href=x>l</a><br><a href=y>m</a><td><p>{LONG}<p>{LONG}</table>", f"{PROSE} {PROSE}"),
        (f"<form id=aspnet><div class=menu>m</div><article><p>{LONG}</p></article></form>", PROSE),
        (f"<article><p>{LONG}</p><div class='cookieNotice'>We use cookies.</div><div style='display: none'>x</div><p hidden>y</p></article>", PROSE),
        (f"<article><p>{LONG}</p><ul><li><a href=1>a b</a><li><a href=2>c d</a><li><a href=3>e f</a></ul></article>", PROSE),
        # Lists and quotes of the article stay; links in prose too.
        (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><p>See <a href=x>this</a>.</p></article>", f"{PROSE} one two See this."),
        # Broken marks: stray brackets, quotes without end, tags cut off.
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ('<article><p class="x>a</p><p>b</p></article>', "a b"),
        ("<article><p>text</p></artic", "text </artic"),
        ("<p>你好，世界，这是一个段落，用来测试。</p>", "你好，世界，这是一个段落，用来测试。"),
    ],
)
def test_layouts(html, text):
    assert main_text(html or "") == text


def test_columns_nulls_and_repeated_rows(spark):
    rows = [(1, "u", "<p>Some text, here.</p>", "old", 5), (1, "u", "<p>Some text, here.</p>", "old", 5), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, place int")
    got = extract_main_text(pages)
    assert got.columns == ["page_id", "url", "place", "text"]
    expected = [(1, "u", 5, "Some text, here.")] * 2 + [(None, None, None, "")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert extract_main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<p>word, ", "<div>", "</div>", '<a href="', "<svg>", "<!--", "<td>x", "<li>x", "<", "&amp", "x"])
def test_long_pages_take_time_in_proportion(piece):
    start = time.perf_counter()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 10


def test_nothing_of_a_long_article_is_cut():
    words = [f"word{i}" for i in range(60_000)]
    html = f"{NAV}<article>" + "".join(f"<p>{' '.join(words[i : i + 20])}." for i in range(0, len(words), 20)) + "</article>"
    assert main_text(html).replace(".", "").split() == words
