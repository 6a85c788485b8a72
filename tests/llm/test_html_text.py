"""Main text of pages: tree rules, boilerplate, and the whole table by a plainer reading."""

from __future__ import annotations

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from keystar.llm.html_text import blocks, build, extract, main_text
from keystar.llm.queries import QUERIES
from tests.conftest import rows

LONG = "A sentence, with commas, that is long enough to earn points as a paragraph of text."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("<html><head><title>t</title></head><body></body></html>", ""),
        ("plain text &amp; no markup", "plain text & no markup"),
        (f"<div><p>{LONG}<p>Second &lt;b&gt;\n\t one</div>", f"{LONG}\n\nSecond <b> one"),
        (f"<article><h1>T</h1><p>{LONG}<br>x</p></article><p>c</p>", f"T\n\n{LONG} x"),
        (f"<nav>a, b, c</nav><main><p>{LONG}</p><aside>{LONG}</aside></main>", LONG),
        (f"<div class='comment-list'><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div>", LONG),
        (f"<div id=cookieNotice><p>{LONG}</p></div><div><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p><script>var a='<p>x</p>'</script><style>p{{}}</style></article>", LONG),
        (f"<article><p>{LONG}</p><form><p>{LONG}</p></form><!-- <p>no</p> --></article>", LONG),
        (f"<article><p>{LONG}</p><ul><li>one<li>two</ul></article>", f"{LONG}\n\none\n\ntwo"),
        (f"<p>{LONG}</p><ul>" + "<li><a href=x>link, link</a></li>" * 30 + "</ul>", None),
        (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p></article>", LONG),
        (f"<article><p>{LONG} <b>bold <i>both</b> tail</i></p></article>", f"{LONG} bold both tail"),
        ("<article><p>unclosed " + "x" * 100_000, "unclosed " + "x" * 100_000),
        (f"<article><p>{LONG}</p><table><tr><td>a<td>b<tr><td>c</table></article>", f"{LONG}\n\na\n\nb\n\nc"),
        ("<div>" * 5000 + LONG, LONG),
        (f"<article><p>{LONG}</p></article", LONG),
    ],
)
def test_pages(page, want):
    if want is None:
        assert main_text(page).startswith(LONG)
    else:
        assert main_text(page) == want


def test_siblings_of_the_container_are_kept():
    part = f"<div class=part><p>{LONG}</p><p>{LONG}</p></div>"
    page = f"<body><div id=wrap>{part}{part}<div class=part><a href=x>{LONG}</a></div></div>"
    assert main_text(page) == "\n\n".join([LONG] * 4)


def test_blocks_of_odd_markup():
    assert blocks(build("a<p>b</div>c<br/>d<hr>e &am f &amp g &#233;")) == ["a", "bc d", "e &am f & g é"]


def test_odd_rows(spark):
    data = [
        (1, None, None, 5),
        (1, None, None, 5),
        (None, "u", f"<p>{LONG}</p>", 5),
        (2, "u", "", None),
    ]
    frame = spark.createDataFrame(data, "page_id long, url string, html string, n_chars int")
    want = [(1, None, "", 0), (1, None, "", 0), (None, "u", LONG, len(LONG)), (2, "u", "", 0)]
    assert rows(extract(frame)) == sorted(want, key=repr)
    assert rows(extract(frame.limit(0))) == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for page in pq.read_table(f"{sf}/pages.parquet").to_pylist():
        article = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        plain = [html.unescape(re.sub(r"<[^>]*>", "", p)) for p in parts]
        text = "\n\n".join(t for t in (" ".join(p.split()) for p in plain) if t)
        want.append((page["page_id"], page["url"], text, len(text)))
    assert rows(QUERIES["op7_html_extraction"](spark, sf)) == sorted(want, key=repr)


@pytest.mark.parametrize(
    "wrapper",
    ["site no-sidebar", "content-sidebar-wrap", "elementor-widget-container", "has-social", "sidebar"],
)
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_with_unwanted_names(wrapper, inner):
    text = f"<h2 id=related-work>Related work</h2><p>{LONG}</p><p>{LONG}</p>"
    page = f"<body><div class='{wrapper}'><{inner}>{text}</{inner}></div><p class=ad>ad</p></body>"
    assert main_text(page) == f"Related work\n\n{LONG}\n\n{LONG}"


@pytest.mark.parametrize("slug", ["related-work", "social-impact", "comments-on-method", "menu-planning"])
def test_slugs_are_no_verdict(slug):
    part = f"<section id={slug}><h2 id={slug}>T</h2><p>{LONG}</p></section>"
    page = f"<article><p>{LONG}</p>{part}<section id=comments><p>{LONG}</p></section></article>"
    assert main_text(page) == f"{LONG}\n\nT\n\n{LONG}"


def test_cards_and_widgets():
    card = f"<article><p>{LONG}</p></article>"
    page = f"<article><p>{LONG} own</p></article><section class=related>{card}{card}{card}</section>"
    assert main_text(page) == f"{LONG} own"
    widget = f"<div class='elementor-widget text'><p>{LONG}</p></div>"
    assert main_text(f"<div>{widget * 3}</div>") == "\n\n".join([LONG] * 3)


LEAD, ITEMS = "<p>A short lead.</p>", "".join(f"<li>Item {i}, of a list, with commas</li>" for i in range(20))


@pytest.mark.parametrize("outer", ["article", "main", "div class=post", "div"])
@pytest.mark.parametrize(
    "parts",
    [
        [LEAD, "<section>" + f"<p>{LONG}</p>" * 10 + "</section>", f"<section><h3>S</h3><p>{LONG}</p></section>",
         "<ul><li>one<li>two</ul>", "<table><tr><td>a<td>b</table>", "<figure><figcaption>F</figcaption></figure>",
         "<h3>Late</h3>", "<div>tail</div>", "<p>End.</p>"],
        [LEAD, f"<ul>{ITEMS}</ul>", "<p>Short.</p>"],
        [LEAD, f"<table><tr><td>{LONG}<tr><td>{LONG}<tr><td>{LONG}</table>", "loose text", "<p>Short.</p>"],
    ],
)
def test_nothing_of_an_article_is_lost(outer, parts):
    links = "<ul>" + "<li><a href=x>other, page</a></li>" * 5 + "</ul>"
    page = f"<body><{outer}>{''.join(parts)}</{outer.split()[0]}>{links}</body>"
    want = [t for p in parts for t in blocks(build(p))]
    assert main_text(page) == "\n\n".join(want)


def test_link_lists_beside_the_text_go():
    links = "<ul>" + "<li><a href=x>other, page</a></li>" * 5 + "</ul>"
    text = "<div>" + f"<p>{LONG}</p>" * 5 + "</div>"
    page = f"<div>{LEAD}{text}{links}<ul><li>own item</ul></div>"
    assert main_text(page) == "\n\n".join(["A short lead.", *[LONG] * 5, "own item"])


BODY = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
WANT = f"T\n\n{LONG}\n\n{LONG}"
FIELDS = "<input type=hidden name=state value=x><label>Find</label><input name=q><button>Go</button>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form>{FIELDS}<main>{BODY}</main></form></body>",
        f"<body><form><article>{BODY}</article></form><footer>f</footer></body>",
        f"<body><form id=content>{BODY}{FIELDS}</form></body>",
        f"<body><form id=aspnetForm><nav>n, n, n</nav><div id=content>{BODY}</div></form></body>",
        f"<body><div role=form><div>{BODY}</div></div></body>",
        f"<article><h1>T</h1><section data-role=form><p>{LONG}</p></section><p>{LONG}</p></article>",
        f"<article>{BODY}<form class=poll><p>Which, of these?</p>{FIELDS}</form></article>",
        f"<body><div>{BODY}</div><form><p>Write to us, please.</p>{FIELDS * 3}</form></body>",
    ],
)
def test_forms(page):
    assert main_text(page) == WANT


def test_a_page_that_is_a_form_of_fields_has_no_article():
    assert main_text(f"<body><form><p>Name <input></p><p>Mail <input></p>{FIELDS * 4}</form></body>") == ""


COMMENT = f"<li><p>{LONG} A reader.</p></li>"


@pytest.mark.parametrize(
    "area",
    [
        f"<ol class=commentlist>{COMMENT * 30}</ol>",
        f"<ol class=usercomments>{COMMENT * 3}</ol>",
        f"<section class='user-reviews discussion-thread'><h2>Said</h2>{COMMENT * 9}</section>",
        f"<section class=reviews>{COMMENT * 3}</section><div class=newsletter><p>{LONG}</p></div>",
        f"<div class=reader-responses>{COMMENT}</div>",
    ],
)
@pytest.mark.parametrize("outer", ["article", "main", "div class=post"])
def test_comment_areas(outer, area):
    page = f"<body><{outer}>{BODY}{area}</{outer.split()[0]}></body>"
    assert main_text(page) == WANT


@pytest.mark.parametrize(
    "name",
    ["class=review-body", "class=commentary", "id=discussion", "class=reviews", "class=user-reviews"],
)
def test_own_sections_with_such_names_stay(name):
    page = f"<main><h1>T</h1><section {name}><p>{LONG}</p></section><p>{LONG}</p></main>"
    assert main_text(page) == WANT


@pytest.mark.parametrize("name", ["", "class=entry-header", "class=header"])
def test_an_articles_own_header(name):
    header = f"<header {name}><h1>T</h1><p>{LONG}</p></header>"
    assert main_text(f"<header><h1>Site</h1></header><article>{header}<p>{LONG}</p></article>") == WANT
    links = "<header><div><a href=x>Home</a></div></header>"
    assert main_text(f"<article>{links}<h1>T</h1><p>{LONG}</p><p>{LONG}</p></article>") == WANT


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + LONG,
        "<span>" * 50_000 + f"<p>{LONG}" * 1000,
        "<span>" * 30_000 + "<p>x" * 30_000,
        "<div>text, " * 50_000,
        "<ul>" + "<li><b>" * 50_000,
        "<thead>" * 30_000 + "<tr>" * 30_000,
        "<p><div>" + "<span>" * 30_000 + "</p></b>" * 30_000,
        "<a x=' " * 50_000 + "'",
        "<a <b " * 50_000 + "\"",
        "<div class='user-reviews'><p>a, b" * 20_000,
        "<form><header><article>" * 20_000 + LONG,
    ],
)
def test_work_grows_with_the_page(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 8
