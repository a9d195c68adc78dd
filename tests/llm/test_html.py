from __future__ import annotations

import itertools
import random

import pytest

from tidemark.llm.html import extract, main_text, min_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>x="</p>";</script></head>
<body class="post"><header><h1>Site</h1><p>A long site header that reads like prose. It has sentences.</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy this now. It is very good for you.</div>
<div id="cookie-notice">We use cookies. Please accept them all, they are good for you.</div>
<main><article><header><h1>Head&amp;line</h1></header><p>First <b>para</b>
with&nbsp;a <a href="x">link</a>.<br>Second line.<p>Unclosed<div>Loose &lt;text&gt;</div>
<ul><li>one<li>two</ul><aside>Related stuff that is long. A sentence.</aside>
<form>Subscribe <input></form><p>End.</p></article>
<section class="comments"><article class="comment"><p>I disagree with all of this entirely. So there.</p></article></section></main>
<div class="sidebar"><p>Sidebar text that reads like prose. It does.</p></div><footer>&copy; us</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert main_text(PAGE).split("\n\n") == [
        "Head&line", "First para with a link. Second line.", "Unclosed", "Loose <text>", "one",
        "two", "End.",
    ]


@pytest.mark.parametrize("page,text", [
    ("plain text", "plain text"), ("a < b &amp; c", "a < b & c"), ("<p>x</p><p>y z.", "x\n\ny z."),
    ("<script>only", ""), ("<div hidden>no</div><p>yes.</p>", "yes."), ("<!-- open", ""),
    ("<div>" * 30000 + "deep text.", "deep text."), ('<a "' * 5000, ""),
])
def test_odd_markup(page, text):
    assert main_text(page) == text


STORY = [f"Paragraph {n} tells at some length what there is to tell, {'and more, ' * 8}and ends." for n in range(4)]
PROSE = "<h1>Story</h1>" + "".join(f"<p>{p}</p>" for p in STORY)
COMMENTS = "<div class='comments'>" + "<p>I say that I do not think so, not at all. So there.</p>" * 30 + "</div>"


@pytest.mark.parametrize("page", [
    f"<div class='content has-sidebar'>{PROSE}</div>",
    f"<article class='post no-comments'><header><h1>Story</h1></header>{PROSE[14:]}</article>",
    f"<div id='layout-with-sidebar'><main>{PROSE}</main></div>",
    f"<form id='aspnetForm'>{PROSE}</form>",
    f"<form id='aspnetForm'><div class='sidebar-right'><div>{PROSE}</div>{COMMENTS}</div></form>",
    f"<div class='search-page'><article>{PROSE}</article></div>{COMMENTS}",
    f"<div class='social'><form><main>{PROSE}</main>{COMMENTS}</form></div>",
    f"<main>{PROSE}{COMMENTS}</main>",
])
def test_marks_around_the_whole_text(page):
    menu = "<nav><a href='/'>Home</a></nav><div class='newsletter'>Write to us. We answer.</div>"
    foot = "<div class='sidebar'><p>Sidebar text that reads like prose. It does.</p></div>"
    text = "\n\n".join(["Story", *STORY])
    assert main_text(f"<body>{menu}{page}{foot}</body>") == text
    assert main_text(f"<div class='no-widgets modal-page'>{menu}{page}{foot}</div>") == text


TALK = "".join(f"<p>Reader {n} writes at great length about this, {'and more of it, ' * 18}and ends here.</p>" for n in range(40))
SHORT = "<h1>Story</h1><p>A short piece that tells what there is to tell in a few words.</p>"
SHORT_TEXT = "Story\n\nA short piece that tells what there is to tell in a few words."


@pytest.mark.parametrize("page", [
    f"<article>{SHORT}</article><div id='comments'>{TALK}</div>",
    f"<main>{SHORT}</main><section class='replies'>{TALK}</section>",
    f"<div>{SHORT}</div><div id='comments'>{TALK}</div>",
    f"<div>{SHORT}</div><ol class='commentlist'>{TALK.replace('<p>', '<li><article><p>')}</ol>",
    f"<main>{SHORT}<div class='comments'>{TALK}</div></main>",
    f"<article>{SHORT}</article><div class='sidebar'>{TALK}</div>",
    f"<div class='comments-page'><main>{SHORT.replace('few', 'plain ' * 60 + 'few')}</main></div>",
])
def test_long_comments_beside_a_short_text(page):
    got = main_text(f"<body><nav><a href='/'>Home</a></nav>{page}</body>")
    assert got.replace("plain ", "") == SHORT_TEXT


@pytest.mark.parametrize("attributes", [
    "style=\"overflow:hidden\"", "data-id='comments'", "title=\"my class=ad here\"", "alt='id=sidebar'",
    "data-role=navigation", "aria-label=\"role='dialog'\"", "onclick=\"a('hidden')\" data-hidden", "hidden=until-found",
    "class=story class=ad", "CLASS='Story'", "data-x=a/b id=x", "hidden-x",
])
def test_nothing_is_looked_for_in_values(attributes):
    assert main_text(f"<div {attributes}><article>{SHORT}</article></div>") == SHORT_TEXT
    assert main_text(f"<article {attributes}>{SHORT}</article>") == SHORT_TEXT
    inner = f"<article><header {attributes}>{SHORT[:14]}</header>{SHORT[14:]}</article>"
    assert main_text(inner) == SHORT_TEXT


@pytest.mark.parametrize("attributes", [
    "hidden", "hidden class='x'", "hidden='hidden'", "class=x hidden", "HIDDEN=''", "hidden=\"true\" id=x",
    "class = 'ad'", "id=sidebar", "CLASS=\"x AD\"", "role='navigation'", "data-x='>' class='ad'",
])
def test_attributes_that_count(attributes):
    assert main_text(f"<div {attributes}><p>Buy this. It is good.</p></div><article>{SHORT}</article>") == SHORT_TEXT


def test_many_marks_take_time_in_proportion():
    """Nested forms, and marked comments with prose, by the thousand."""
    import time

    start = time.process_time()
    for n in (4_000, 8_000):
        page = "".join(f"<form><p>Field {k} is here and says something. </p>" for k in range(n))
        assert main_text(page) is not None
        said = "We say so at some length, " * 8
        page = "".join(f"<div class='comment'><p>{said}{k}.</p></div>" for k in range(n))
        assert main_text(f"<article>{SHORT}</article>{page}") == SHORT_TEXT
    assert time.process_time() - start < 20


def test_very_long_page_and_clashing_columns(spark):
    """Nothing is cut; columns besides the three are left out, whatever their names."""
    paragraphs = [f"Paragraph {n} tells what there is to tell and ends." for n in range(20_000)]
    page = "<article>" + "".join(f"<p>{p}" for p in paragraphs) + "</article>"
    table = spark.createDataFrame(
        [(1, "u", page, "x", 3), (None, None, "", "y", 4)],
        "page_id long, url string, html string, text string, n_chars long",
    )
    got = {r["page_id"]: tuple(r) for r in extract(table).collect()}
    text = "\n\n".join(paragraphs)
    assert got == {1: (1, "u", text, len(text)), None: (None, None, "", 0)}


def test_cut_is_least():
    rng = random.Random(0)
    for _ in range(300):
        n = rng.randint(1, 8)
        prefer = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 5)) for _ in range(2 * n)]
        edges = [(i, j, w) for i, j, w in edges if i != j]

        def cost(labels, prefer=prefer, edges=edges):
            own = sum(abs(p) for p, x in zip(prefer, labels, strict=True) if p and x != (p > 0))
            return own + sum(w for i, j, w in edges if labels[i] != labels[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(min_cut(prefer, edges)) == best


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r["page_id"], r["url"], r["n_chars"]) for r in got] == [
        (1, "u", len(main_text(PAGE))), (1, "u", len(main_text(PAGE))), (None, None, 0), (2, "v", 0),
    ]
