"""Main text of pages: built pages with known content, marks that mislead, markup that breaks off, time."""

from __future__ import annotations

import random
import time

import pytest
from hypothesis import given, settings, strategies as st

from plumbline.llm.html_text import main_text, marked, MARKS

PROSE = [f"Paragraph {i} with some words of prose that go on for a while, as articles do." for i in range(6)]
ARTICLE = "<h1>Title of it</h1>" + "".join(f"<p>{p}</p>" for p in PROSE)
TEXT = "\n".join(["Title of it", *PROSE])
NAV, FOOT = "<nav><a href=/>Home</a> <a href=/a>About</a></nav>", "<footer>All rights reserved</footer>"
CHAT = "<p>Nice post, thanks for all of this.</p>"


@pytest.mark.parametrize(
    "html",
    [
        f"<body class='page no-sidebar'>{NAV}<article>{ARTICLE}</article>{FOOT}</body>",
        f"<html class='has-navbar-fixed-top'><body>{NAV}<article>{ARTICLE}</article></body></html>",
        f"<body class=sidebar role=navigation>{NAV}<article>{ARTICLE}</article></body>",
        f"<body>{NAV}<article class='post comments-open'>{ARTICLE}</article></body>",
        f"<body>{NAV}<main class='content with-sidebar'>{ARTICLE}</main></body>",
        f"<body><form id=aspnetForm>{NAV}<article>{ARTICLE}</article><input name=q></form></body>",
        f"<body><form id=aspnetForm><div>{ARTICLE}</div></form></body>",
        f"<body><div class='page-widget'><div>{ARTICLE}</div></div>{FOOT}</body>",
        f"<body><article>{ARTICLE}</article><div class=comment-list>{CHAT * 200}</div></body>",
        f"<body><article>{ARTICLE}</article><div class='sidebar-left'>{CHAT * 20}</div></body>",
        f"<body><article>{ARTICLE}<form><p>Subscribe to our list</p><input></form></article></body>",
        f"<body><article>{ARTICLE}<div class='ad-slot'>Buy now</div><div id=adContainer>Buy</div></article></body>",
    ],
)
def test_marks_do_not_empty_pages_and_still_mark(html):
    assert main_text(html) == TEXT


def test_a_described_paragraph_stays():
    html = f"<article>{ARTICLE}<p class='share-price'>The share price fell.</p></article>"
    assert main_text(html) == TEXT + "\nThe share price fell."


@pytest.mark.parametrize(
    "name, found",
    [
        ("sidebar", True), ("left-sidebar", True), ("sidebar-left", True), ("comment-list", True), ("commentList", True),
        ("cookie_notice", True), ("no-sidebar", False), ("has-navbar-fixed-top", False), ("comments-open", False),
        ("share-price", False), ("download", False), ("", False), ("123", False), ("ADBanner", True),
    ],
)
def test_names(name, found):
    assert marked(name, MARKS) == found


BLOCKS = st.lists(
    st.sampled_from(["p", "h2", "ul", "quote", "ad", "nav", "script", "comments", "hidden", "table", "style"]), max_size=12
)


@settings(max_examples=150, deadline=None)
@given(BLOCKS, st.integers(0, 10**6))
def test_built_articles(blocks, seed):
    """Whatever blocks an article is made of, its text is that of the content blocks, in order."""
    rnd, html, want = random.Random(seed), [ARTICLE], TEXT.split("\n")
    word = lambda n: " ".join(rnd.choice("some words of plain prose here & there".split()) for _ in range(n))
    for kind in blocks:
        t = word(rnd.randint(1, 30))
        code = t.replace("&", "&amp;")
        if kind in ("p", "h2"):
            html.append(f"<{kind}>\n {code.replace(' ', '  ', 1)}</{kind}>"), want.append(t)
        elif kind == "ul":
            html.append(f"<ul><li>{code}<li><b>{code}</b></ul>"), want.extend([t, t])
        elif kind == "quote":
            html.append(f"<blockquote><p>{code}</blockquote>"), want.append(t)
        elif kind == "table":
            html.append(f"<table><tr><td>{code}<td>x</table>"), want.append(f"{t} x")
        else:
            html.append(
                {
                    "ad": f"<div class='advert'>{code}</div>", "nav": f"<nav>{code}</nav>", "script": f"<script>{t}</script>",
                    "comments": f"<section id=comments>{code}</section>", "hidden": f"<p hidden>{code}</p>",
                    "style": f"<style>{t}</style>",
                }[kind]
            )
    assert main_text(f"<html><body>{NAV}<article>{''.join(html)}</article>{FOOT}</body></html>") == "\n".join(want)


TOKENS = (
    "< > ! [ ] - -- / a div p CDATA \" ' = & amp; # x ? % if script style article <! <![ <!-- --> </ <p> </p> <form> "
    "<ul><li> <svg> <title> <textarea> <main> </main> <h1> class=ad <![foo[x]]> <![%x["
).split() + [" ", "\n", "ñ", "\0"]


def test_no_markup_raises():
    rnd = random.Random(11)
    for _ in range(30_000):
        assert isinstance(main_text("".join(rnd.choices(TOKENS, k=rnd.randint(1, 40)))), str)


@pytest.mark.parametrize("html", ["<![foo[x]]>", "<![ x", "<![%x[", "<!", "<!DOCTYPE", "<a href='", "<!-- x", "</p"])
def test_broken_off_declarations_leave_the_text_before(html):
    assert main_text(f"<p>Some text before.</p>{html}") == "Some text before."


@pytest.mark.parametrize(
    "piece",
    ["<b>x</i>", "<i><div><b>x</i>", "<![foo[", "<!--", "</x", "<a ", "<a href=\"", "<", "&#", "<div>", "<main>", "<li>", "<form>", "<div class=ad>"],
)
def test_time_is_linear(piece):
    began = time.perf_counter()
    main_text("<p>hello</p>" + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - began < 6
