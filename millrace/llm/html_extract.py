"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of the page. A line weighs as
much as its text, or nothing where it lies in a menu, notice or other boilerplate,
is mostly links, or lies outside the articles where the page marks some with text
in them. Lengths are summed over windows of ``WINDOW`` lines. The sum surges where it
leaves zero and dives where it comes back, and text between such a pair of points is a
stretch. A stretch is kept if the sum gets to ``PEAK`` in it (if none does, the heaviest
one), or if it belongs to the article, or the containing element on a page without marks,
that most of such a high stretch is in; so is a first-level heading of an element around it.
So short paragraphs between adverts stay, and short cards beside the article go.

Some class names (``_VOTED_WORDS``) occur on boilerplate and on real text: such an element
is boilerplate unless it holds more than half of the text.

Defined results: null or empty html, or a page of boilerplate only, gives an empty
text; unclosed and truncated elements end where an enclosing element ends, or the page;
marks in comments and scripts are none; repeated rows are repeated.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.common import batched

#: Lines to a window, and the window sum that makes a stretch main text by itself.
WINDOW = 3
PEAK = 120

# Element and attribute names of HTML.
_RAW = "script style textarea title xmp".split()
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_BOILER_TAGS = set(
    "nav footer aside form menu dialog button fieldset head noscript template svg math iframe select object "
    "canvas".split()
)
_BOILER_ROLES = set(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
    "toolbar tablist".split()
)
_BOILER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs sidebar sidenav footer masthead topbar comment comments disqus cookie cookies "
    "consent gdpr popup newsletter subscribe subscription signup login pagination pager".split()
)
_VOTED_WORDS = set(
    "alert copyright feedback header modal notice notices overlay promo promotion recommendations recommended "
    "related replies reply respond search share sharing social teaser toolbar widget widgets".split()
)
_TEXT_BLOCKS = set(
    "p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption address ul ol dl table tr tbody thead tfoot "
    "caption figure".split()
)
_LAYOUT_WORDS = set("has with no without wrapper container layout page main content article post body".split())
_KEPT_TAGS = {"html", "body", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^>]*?)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTR = re.compile(r"([a-z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HEADING = re.compile(r"<h[1-6]\b", re.I)
_END = re.compile(r"</([a-z][^\s/>]*)", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D\xa0]+")
_WORD = re.compile(r"[a-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text and "hidden" not in text:
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)}


def _has_heading(name: str, html: str, at: int) -> bool:
    """Whether a heading comes before the next end tag of this name."""
    heading = _HEADING.search(html, at)
    end = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
    return bool(heading and (end is None or heading.start() < end.start()))


#: What an element is by its tag and attributes.
_TEXT, _VOTED, _BOILER = range(3)


def _standing(name: str, attrs: dict[str, str], in_article: bool, html: str, at: int) -> int:
    if name in _KEPT_TAGS:
        return _TEXT
    if name in _BOILER_TAGS:
        return _BOILER
    if name == "header":
        # The heading of an article is part of it; the banner of a page is not.
        return _TEXT if in_article and _has_heading(name, html, at) else _BOILER
    if not attrs:
        return _TEXT
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in _BOILER_ROLES:
        return _BOILER
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return _BOILER
    words = set(_WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    if words & _LAYOUT_WORDS:
        return _TEXT
    if words & _BOILER_WORDS:
        return _BOILER
    voted = words & _VOTED_WORDS
    if voted == {"header"} and in_article and _has_heading(name, html, at):
        return _TEXT
    return _VOTED if voted else _TEXT


class Line(NamedTuple):
    """A block's text, its characters in links, and the numbers of elements around it (0: none)."""

    text: str
    linked: int = 0
    article: int = 0  # the outermost marked article
    container: int = 0  # the innermost element that holds blocks
    voted: tuple[int, ...] = ()
    heading: bool = False  # of the first level


class _Open(NamedTuple):
    name: str
    skipped: bool = False
    article: int = 0
    container: int = 0
    voted: tuple[int, ...] = ()


def parse(html: str) -> tuple[list[Line], dict[int, int]]:
    """Lines in page order, boilerplate ones empty, and of each container the one around it."""
    lines: list[Line] = []
    parts: list[str] = []
    around: dict[int, int] = {}
    linked = 0  # characters of the line inside links
    last_end = {m[1].lower(): m.start() for m in _END.finditer(html)}
    stack: list[_Open] = []
    root = _Open("")

    def close_line() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip(" ")
        parts.clear()
        if text:
            e = stack[-1] if stack else root
            lines.append(Line(text, linked, e.article, e.container, e.voted, any(o.name == "h1" for o in stack)))
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1].skipped):
            decoded = entities.unescape(text)
            parts.append(decoded)
            if any(e.name == "a" for e in stack):
                linked += len(decoded)

    at = 0
    for number, m in enumerate(_TOKEN.finditer(html), 1):
        take(html[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name not in _INLINE:
            close_line()
        if m["end"]:
            # An end tag also ends what it encloses; one without a start is ignored.
            if any(e.name == name for e in stack):
                while stack.pop().name != name:
                    pass
            continue
        if name in _VOID or m["attrs"].endswith("/"):
            continue
        if name not in _INLINE and stack and stack[-1].name == "p":
            stack.pop()  # a block ends an open paragraph
        attrs = _attributes(m["attrs"])
        outer = stack[-1] if stack else root
        standing = _BOILER if outer.skipped else _standing(name, attrs, bool(outer.article), html, at)
        if not outer.skipped and standing != _TEXT:
            # An element that is never closed must not swallow the rest of the page.
            if last_end.get(name, -1) >= at:
                close_line()
                lines.extend([Line("")] * WINDOW)
            else:
                standing = _TEXT
        if name in _INLINE and name != "a" and (outer.skipped or standing == _TEXT):
            continue  # unclosed inline elements are common and change nothing
        marks = name in ("article", "main") or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody"
        container = outer.container
        if name not in _INLINE and name not in _TEXT_BLOCKS:
            around[number] = container
            container = number
        skipped = standing == _BOILER
        article = outer.article or (number if marks and not skipped else 0)
        voted = (*outer.voted, number) if standing == _VOTED else outer.voted
        stack.append(_Open(name, skipped, article, container, voted))
    take(html[at:])
    close_line()
    return lines, around


def weigh(lines: list[Line]) -> tuple[list[tuple[str, int]], bool]:
    """The lines as (text, weight), and whether they go by marked articles."""
    marked = any(line.article for line in lines)
    counted = [line for line in lines if line.article or not marked]
    plain = Counter()
    for line in counted:
        plain.update(dict.fromkeys((0, *line.voted), len(line.text) - min(line.linked, len(line.text))))
    out = []
    for line in lines:
        n = len(line.text)
        heavy = bool(line.article) if marked else 2 * line.linked <= n
        by_vote = all(2 * plain[v] > plain[0] for v in line.voted)
        out.append((line.text, n) if heavy and by_vote else (line.text if by_vote else "", 0))
    return out, marked


def strip_markup(html: str) -> list[tuple[str, int]]:
    """The page as (text, weight) lines in page order; boilerplate lines are empty."""
    return weigh(parse(html)[0])[0]


def main_stretches(lines: list[tuple[str, int]], marked: bool) -> list[tuple[int, int]]:
    """Pairs of surge and dive points, the latter exclusive, between which text is kept."""
    weights = [w for _, w in lines]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    found: list[tuple[int, int, int, int]] = []
    start = None
    for i, total in enumerate([*sums, 0]):
        if total and start is None:
            start = i
        elif not total and start is not None:
            found.append((start, i, max(sums[start:i]), sum(weights[start:i])))
            start = None
    if not found:
        return []
    high = [f for f in found if marked or f[2] >= PEAK] or [max(found, key=lambda f: (f[3], -f[0]))]
    return [(f[0], f[1]) for f in high]


def kept_stretches(lines: list[Line], around: dict[int, int]) -> tuple[list[tuple[str, int]], list[tuple[int, int]]]:
    """The weighed lines, and the stretches of main text among them."""
    weighed, marked = weigh(lines)
    high = main_stretches(weighed, marked=False)

    def home(stretch: tuple[int, int]) -> int:
        """The article or container that most of a stretch is in."""
        held = Counter()
        for line, (_, weight) in zip(lines[slice(*stretch)], weighed[slice(*stretch)]):
            held[line.article if marked else line.container] += weight
        return max(held, key=lambda place: (held[place], -place))

    homes = {home(stretch) for stretch in high}
    enclosing = set(homes)
    if not marked:
        for place in homes:
            while place:
                place = around[place]
                enclosing.add(place)

    def belongs(stretch: tuple[int, int]) -> bool:
        titles = (line for line, (_, w) in zip(lines[slice(*stretch)], weighed[slice(*stretch)]) if w and line.heading)
        return stretch in high or home(stretch) in homes or (
            not marked and any(line.container in enclosing for line in titles)
        )

    return weighed, [stretch for stretch in main_stretches(weighed, marked=True) if belongs(stretch)]


def main_text(html: str | None) -> tuple[str, int, int]:
    """The main text, and the lines of its first surge and last dive (-1 without text)."""
    if not html:
        return "", -1, -1
    weighed, stretches = kept_stretches(*parse(html))
    kept = [weighed[i][0] for a, b in stretches for i in range(a, b) if weighed[i][1]]
    if not kept:
        return "", -1, -1
    return " ".join(kept), stretches[0][0], stretches[-1][1]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, surge_line, dive_line`` for each row of ``pages``."""
    rows = batched(pages.select(page_id, url, html).toDF("page_id", "url", "html"))
    schema = StructType(
        [
            StructField("page_id", rows.schema["page_id"].dataType),
            StructField("url", rows.schema["url"].dataType),
            StructField("text", StringType()),
            StructField("n_chars", LongType()),
            StructField("surge_line", IntegerType()),
            StructField("dive_line", IntegerType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": [f[0] for f in found],
                    "n_chars": [len(f[0]) for f in found],
                    "surge_line": [f[1] for f in found],
                    "dive_line": [f[2] for f in found],
                }
            )

    return rows.mapInPandas(run, schema)
