"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of the page, in page order. Elements
that are never article text (scripts, menus, forms, adverts, reader comments and
the like, by element or by a word of their class or id) and the borders of the
article element leave blank lines; a dropped element ends with its own end tag,
that of an element around it, or a start tag that implies its end. The text length of a line counts without
white space and without link text; over it slides a window of ``BLOCK`` lines.
Where the windows' sums surge from nothing and where they dive back to nothing
bound a region; regions whose peak reaches the surge level are main text, and so
are lesser ones between the first and the last of these. Where the lines in
article (or main) elements hold most of the page's length, the element is a
weight: its lines count double, link text too, none of its regions is too low,
and a region outside must reach a share of the page's highest peak. Before the
first and after the last high region a lower one is kept if it stands in the same
element as a line of a high one.

A class or id is only a hint: an element that was dropped for its name (or a form)
and holds nearly all of the page's text is a plain block after all.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

#: Lines of a window; blank lines that a border leaves.
BLOCK = 3
#: A region counts from a peak of this many characters, or the page's highest peak if that is less; beside an article
#: that dominates also from this share of the highest peak, and the article's lines count so many times.
SURGE, SHARE, WEIGHT = 60, 0.25, 2

# Elements by their part in a page, and words of class or id names.
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
DROPPED = frozenset("head nav header footer aside form button select dialog menu svg math canvas object fieldset".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "header masthead footer comment comments commentlist respond disqus cookie cookies consent gdpr notice banner popup modal "
    "newsletter subscribe signup login share sharing social related recommended widget pagination skip".split())
ARTICLE = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN = frozenset(("svg", "math"))  # may close themselves
IN_HEAD = frozenset("base link meta".split()) | RAW

# An open element of the first set ends where a start tag has the name, unless one of the second was opened in between.
_LISTS, _TABLE = frozenset(("ul", "ol", "menu")), frozenset(("table",))
_ROWS = frozenset(("tr", "thead", "tbody", "tfoot"))
_IMPLIED = {
    "li": (frozenset(("li",)), _LISTS), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (frozenset(("td", "th")), _TABLE), "th": (frozenset(("td", "th")), _TABLE), "tr": (frozenset(("tr", "td", "th")), _TABLE),
    **{t: (_ROWS | {"td", "th", "caption", "colgroup"}, _TABLE) for t in ("thead", "tbody", "tfoot")},
    "option": (frozenset(("option",)), frozenset(("select",))), "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",)))}
#: An end tag looks no further than these for its element, unless it is of their own kind.
_WALLS = frozenset("table td th caption".split())
_P = frozenset("p")
_OPEN = 512  # levels of nesting that are told apart, as in browsers

#: An element dropped for its name is a plain block if it holds so many characters, and so many times what is kept besides.
SPARED, TIMES = 200, 4
# Words before a name that make it say something about the page, not about the element.
ABOUT = frozenset("no has have with without hide hidden is category tag layout".split())
COMMENTS = frozenset("comment comments commentlist respond disqus".split())

_START = re.compile(r"<(?=[a-zA-Z/!?])")
#: A tag without angle brackets in its quotes: it ends before the next bracket, so no part of a page is read twice.
_PLAIN = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^'"<>]|"[^"<>]*"|'[^'<>]*')*+)>""")
_WORD = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*+)")
_STOP = re.compile(r"""["'>]""")
_NAME = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLOSE = {t: re.compile(rf"</{t}\b[^>]*>|\Z", re.I) for t in RAW}


def _tag(html: str, at: int, last: int) -> tuple[int, int, bool, str, str] | None:
    """The next tag or comment from ``at``: start, end, whether an end tag, name (empty for comments and the like),
    attributes. ``last``: place of the page's last ``>``; what opens after it is text."""
    while (m := _START.search(html, at)) and m.start() < last:
        at = m.start()
        if plain := _PLAIN.match(html, at):
            return at, plain.end(), bool(plain[1]), plain[2].lower(), plain[3]
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            return at, len(html) if end < 0 else end + 3, False, "", ""
        name = _WORD.match(html, at)
        if not name:
            return at, html.find(">", at) + 1, False, "", ""
        i = name.end()
        while True:  # quoted values may hold brackets; a quote that is not closed before the last one is a character
            stop = _STOP.search(html, i)
            if stop[0] == ">":
                return at, stop.end(), html[at + 1] == "/", name[1].lower(), html[name.end():stop.start()]
            i = html.find(stop[0], stop.end(), last) + 1 or stop.end()
    if m and html.startswith("<!--", m.start()):
        return m.start(), len(html), False, "", ""
    return None


def _unwanted(tag: str, attributes: str) -> int:
    """0: wanted; 1: dropped for its name, or a form; 2: reader comments by name; 3: dropped for what it is."""
    if tag in DROPPED:
        return 1 if tag == "form" else 3
    if "=" not in attributes or tag in ("html", "body"):
        return 0
    found = 0
    for a, b, c in _NAME.findall(attributes):
        for name in (a or b or c).lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if not words or words[0] in ABOUT or NAMES.isdisjoint(words) or tag in ARTICLE and len(words) > 1:
                continue
            found = max(found, 1 if COMMENTS.isdisjoint(words) else 2)
    return found


Line = tuple[str, int, bool, int]


def lines(html: str) -> list[Line]:
    """(text, length without links and white space, inside an article, element around the block) of each line; borders
    as blank lines. Where a dropped element turns out to hold nearly all text, the page is read again with it."""
    spared: set[int] = set()
    while True:
        out, held = _lines(html, spared)
        kept = sum(n for _, n, *_ in out)
        best = max(((n, at) for at, (n, kind) in held.items() if kind == 1 or kind == 2 and not kept), default=(0, 0))
        if best[0] < SPARED or best[0] < TIMES * kept:
            return out
        spared.add(best[1])


def _lines(html: str, spared: set[int]) -> tuple[list[Line], dict[int, tuple[int, int]]]:
    """Lines, and of each element dropped for its name: by place in the page, its text's length and why it was dropped."""
    out: list[Line] = []
    held: dict[int, tuple[int, int]] = {}
    last, number, inner, why = html.rfind(">"), 0, 0, (0, 0)
    parts: list[str] = []
    linked = article = links = 0
    around: int | None = None  # element around the block that the line's first text stands in
    dropped = 0  # place on the stack of the dropped element, counted from 1
    stack: list[str] = []
    numbers: list[int] = []  # of the open elements
    opened: Counter[str] = Counter()

    def home() -> int:
        """The element around the innermost open block."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in BLOCKS:
                return numbers[i - 1] if i else 0
        return 0

    def flush(border: bool = False) -> None:
        nonlocal linked, around
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((text, max(0, len(text) - text.count(" ") - linked), article > 0, around or 0))
            parts.clear()
            linked, around = 0, None
        if border:
            out.extend([("", 0, False, -1)] * BLOCK)

    def end(size: int) -> None:
        """Closes the elements above the first ``size`` of the stack."""
        nonlocal dropped, article, inner
        while len(stack) > size:
            gone = stack.pop()
            numbers.pop()
            opened[gone] -= 1
            if dropped > len(stack):
                dropped = 0
                if why[1] < 3:
                    held[why[0]] = (inner, why[1])
                inner = 0
            elif gone in ARTICLE and not dropped:
                flush(True)
                article -= 1

    def place(names: frozenset[str], walls: frozenset[str]) -> int | None:
        """Place of the last open element with one of the names, if no wall is inside it."""
        if not any(opened[t] for t in names):
            return None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in names:
                return i
            if stack[i] in walls:
                return None
        return None

    at = 0
    while True:
        m = _tag(html, at, last)
        piece = html[at:m[0] if m else len(html)]
        if dropped and stack[dropped - 1] == "head" and not piece.isspace() and piece and len(stack) == dropped:
            end(dropped - 1)  # text is the first content of the body
        if dropped:
            if piece and not links and why[1] < 3:
                inner += len(piece) - sum(map(piece.count, " \n\t"))
        else:
            if piece:
                if around is None and not piece.isspace():
                    around = home()
                parts.append(piece)
                if links:
                    linked += len(piece) - piece.count(" ")
        if not m:
            break
        begin, at, close, tag, attributes = m
        if not tag:
            continue
        if tag in RAW:
            if not close:
                at = _CLOSE[tag].search(html, at).end()
                if not dropped and tag not in ("noscript", "textarea"):
                    continue
            continue
        if close:
            far = tag in _WALLS or tag in ARTICLE or tag in _ROWS or tag in ("body", "html")
            i = place(frozenset((tag,)), frozenset() if far else _WALLS if dropped else _WALLS | ARTICLE)
            if i is not None:
                if not dropped and tag in BLOCKS:
                    flush()
                end(i)
        else:
            if dropped and (tag == "body" or tag in ARTICLE and stack[dropped - 1] not in ARTICLE):
                end(dropped - 1)
            if opened["head"] and tag not in IN_HEAD and tag not in ("head", "html"):
                end(stack.index("head"))
            if tag in _IMPLIED:
                names, walls = _IMPLIED[tag]
                while (i := place(names, walls)) is not None:
                    end(i)
            elif tag in BLOCKS and (i := place(_P, _WALLS | {"button", "object"})) is not None:
                end(i)
        single = tag in VOID or attributes.rstrip().endswith("/") and (tag in FOREIGN or any(opened[t] for t in FOREIGN))
        if dropped:
            if not close and not single and len(stack) < _OPEN:
                number += 1
                stack.append(tag)
                numbers.append(number)
                opened[tag] += 1
            if tag == "a":
                links = 0 if close else 1
            continue
        if not close and not single:
            unwanted = 0 if begin in spared else _unwanted(tag, attributes)
            if tag in ARTICLE or unwanted and (tag in BLOCKS or tag in DROPPED):
                flush(True)
            if len(stack) >= _OPEN:
                end(_OPEN - 1)
            number += 1
            stack.append(tag)
            numbers.append(number)
            opened[tag] += 1
            if unwanted:
                dropped, why, inner, links = len(stack), (begin, unwanted), 0, 0
                continue
            if tag in ARTICLE:
                article += 1
        if tag in ARTICLE:
            links = 0
        elif tag in BLOCKS:
            flush()
            links = 0
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if close else 1
    flush()
    end(0)
    return out, held


def main_text(html: str | None) -> str:
    """The main text of a whole page; empty for a page that is null, empty or without text."""
    page = lines(html or "")
    marked = sum(n for _, n, *_ in page) <= 2 * sum(n for _, n, inside, _ in page if inside)
    lengths = [WEIGHT * (len(text) - text.count(" ")) if marked and inside else n for text, n, inside, _ in page]
    sums, total = [], 0
    for i, n in enumerate(lengths):
        total += n - (lengths[i - BLOCK] if i >= BLOCK else 0)
        sums.append(total)
    peak = max(sums, default=0)
    level = min(peak, max(SURGE, SHARE * peak) if marked else SURGE)
    regions, i = [], 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        surge = i
        while i < len(sums) and sums[i]:
            i += 1
        high = max(sums[surge:i]) >= level or marked and any(inside for _, _, inside, _ in page[surge:i])
        regions.append((surge, i, high))
    high = [k for k, r in enumerate(regions) if r[2]]
    if not high:
        return ""
    homes = {page[i][3] for k in high for i in range(*regions[k][:2]) if page[i][0]}
    kept = [text for k, (surge, dive, _) in enumerate(regions) for text, _, _, home in page[surge:dive]
            if text and (high[0] <= k <= high[-1] or home in homes)]
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (blocks joined by line breaks) and ``n_chars`` (its code points).

    Character references are decoded, white space inside a block becomes one
    space; nothing else is changed, dropped or cut. A null page counts as empty
    and has an empty text. Rows, repeated ones too, and further columns stay;
    columns of the two names are replaced. An empty table gives an empty one.
    """
    prepare(pages.sparkSession)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(h) for h in b], dtype="object")

    return (pages.withColumn("text", F.pandas_udf(work, "string")(F.col(html_col).cast("string")))
            .withColumn("n_chars", F.length("text").cast("long")))
