"""Extraction on pages whose main text is known."""

import random

import pytest

from millrace.llm.html_extract import main_stretches, main_text, strip_markup

CASES = {
    "markup and references": ("<article><p>a &amp;amp; b &lt;i&gt; &#233;&nbsp;x</p></article>", "a &amp; b <i> é x"),
    "white space inside a block": ("<main><p>one\n\t two   three</p>\n<p> four </p></main>", "one two three four"),
    "inline elements": ("<article><p>f<b>oo</b>b<a href='x'>ar</a> end</p></article>", "foobar end"),
    "unclosed paragraphs": ("<article><h1>T</h1><p><b>one<br><p>two<p>three", "T one two three"),
    "raw text elements": (
        "<head><title>t</title><style>p{}</style></head><script>var t='</p>';</script><article><p>x</p></article>", "x"),
    "comments": ("<article><!-- <p>no</p> --><p>yes</p></article>", "yes"),
    "menus, notices, adverts, forms, reader comments": (
        "<nav><ul><li><a href=x>menu</a></li></ul></nav><div class='cookie-notice'>we use</div><div class=ad>buy</div>"
        "<header><h1>Site</h1></header><aside>aside</aside><div id='sidebar'>side</div>"
        "<article><header><h1>Title</h1></header><p>Body.</p><div class='ad'>buy</div><form><input>send</form>"
        "<section class='comments'><article><p>first!</p></article></section></article><footer>&copy; x</footer>",
        "Title Body."),
    "layout words": ("<body class='has-sidebar'><div class='page-with-menu'><article><p>x</p></article></div>", "x"),
    "short paragraphs stay": ("<article><p>As.</p><p>" + "w " * 100 + "</p><p>It.</p></article>", "As. " + "w " * 100 + "It."),
    "no marked article": (
        "<div><a href=a>home</a></div><div><p>" + "word " * 40 + "</p></div><div><a href=b>next page</a></div>",
        ("word " * 40).strip()),
    "nothing but boilerplate": ("<nav>menu</nav><footer>foot</footer>", ""),
    "an advert that is never closed": ("<div class=ad>x<article><p>text</p></article>", "text"),
    "quotes in attributes": ("<article><p title='a > b' data-x=\"c > d\">x</p></article>", "x"),
    "elements without text of the page": (
        "<article><p>a</p><select><option>x<option>y</select><svg><text>z</text></svg><iframe><p>b</p></article>", "a b"),
    "truncated": ("<article><p>one two <b", "one two"),
}


@pytest.mark.parametrize("name", list(CASES))
def test_main_text(name):
    html, text = CASES[name]
    assert main_text(html)[0] == text


def test_surge_and_dive():
    weights = [0, 0, 0, 50, 0, 90, 80, 0, 0, 0, 0, 30, 0, 0, 0]
    lines = [("x" * w, w) for w in weights]
    # The window of three looks ahead, so a stretch begins two lines before its first text.
    assert main_stretches(lines, marked=False) == [(1, 7)]
    assert main_stretches(lines, marked=True) == [(1, 7), (9, 12)]
    assert main_stretches([("x", 0)], marked=False) == []


def test_boilerplate_parts_stretches():
    lines = strip_markup("<p>a</p><nav>menu</nav><p>b</p>")
    assert [t for t, _ in lines if t] == ["a", "b"]
    assert len(lines) > 4


def test_header_of_an_article_with_a_long_image():
    image = "<img src='data:image/png;base64," + "A" * 5_000 + "'>"
    page = f"<article><header>{image}<h1>Title</h1></HEADER><p>Body.</p></article>"
    assert main_text(page)[0] == "Title Body."
    # A heading after the end of the header is not its own.
    assert main_text(f"<article><header>by x {image}</header><h2>Part</h2><p>Body.</p></article>")[0] == "Part Body."


LONG = ("word " * 60).strip()
PROBES = {
    "a mark in a comment": (f"<!-- <article> --><div><p>{LONG}</p></div>", LONG),
    "a mark in a script": (f"<script>var t = '<main>';</script><div><p>{LONG}</p></div>", LONG),
    "an article without text": (f"<article><nav>menu</nav></article><div><p>{LONG}</p></div>", LONG),
    "a title before a menu": (
        f"<body><h1>Title</h1><ul><li><a href=a>one menu</a><li><a href=b>two</a><li><a href=c>six</a></ul>"
        f"<div><p>{LONG}</p></div></body>", f"Title {LONG}"),
    "a last paragraph after an advert": (f"<div><p>{LONG}</p><div class=ad>buy</div><p>The end.</p></div>", f"{LONG} The end."),
    "short text of another element": (
        f"<div><div><p>{LONG}</p></div><div class=ad>buy</div><div><p>Imprint</p></div></div>", LONG),
    "a class of real text": (
        f"<article><p>Intro.</p><div class='search-results-study'><p>{LONG}</p><div class=share>share</div></div></article>",
        f"Intro. {LONG}"),
    "a class around the article": (f"<div class='social-history'><article><p>{LONG}</p></article></div>", LONG),
    "reader comments": (f"<article><p>{LONG}</p><div class='user-feedback'><p>first!</p></div></article>", LONG),
    "a header by class": (f"<article><div class='entry-header'><h1>T</h1></div><p>{LONG}</p></article>", f"T {LONG}"),
    "cards beside the article": (
        f"<article><p>As.</p><div class=ad>buy</div><p>{LONG}</p></article><div class=ad>buy</div>"
        "<article><h2>Card</h2></article>", f"As. {LONG}"),
}


@pytest.mark.parametrize("name", list(PROBES))
def test_pages_of_the_review(name):
    html, text = PROBES[name]
    assert main_text(html)[0] == text


def test_windows_decide(monkeypatch):
    """Without windows that are high enough, the same cards and asides come along."""
    marked, plain = PROBES["cards beside the article"][0], PROBES["short text of another element"][0]
    monkeypatch.setattr("millrace.llm.html_extract.PEAK", 0)
    assert main_text(marked)[0] == f"As. {LONG} Card"
    assert main_text(plain)[0] == f"{LONG} Imprint"


def test_stretches_against_brute_force():
    """Maximal runs of lines whose window, cut off at the end, has any weight."""
    rng = random.Random(1)
    for _ in range(2_000):
        weights = [rng.choice([0, 0, 0, rng.randint(1, 150)]) for _ in range(rng.randint(0, 40))]
        lines = [("x" * w, w) for w in weights]
        live = [i for i in range(len(weights)) if any(weights[j] for j in range(i, min(i + 3, len(weights))))]
        runs = [(a, next(b for b in range(a, len(weights) + 1) if b not in live)) for a in live if a - 1 not in live]
        assert main_stretches(lines, marked=True) == runs
        high = [r for r in runs if max(sum(weights[i : i + 3]) for i in range(*r)) >= 120]
        want = high or sorted(runs, key=lambda r: (-sum(weights[slice(*r)]), r))[:1]
        assert main_stretches(lines, marked=False) == want
