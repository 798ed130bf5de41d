"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines: block elements and ``<br>`` end a line, everything else
runs on. A line inside a boilerplate element (menus, page headers, footers, sidebars,
notices, adverts, forms, reader comments, scripts, styles) has no weight; the others weigh
their characters, without those of links. Elements are boilerplate by tag, by role, or by any word of
their class or id (``noise_kind``), whatever their length, unless the word tells about a state of the page or
is around the page's whole main article; reader comments always are. The weights of each window of ``WINDOW`` lines are
summed. A surge point is where the sum rises above ``SURGE``, or above half of the page's
largest sum if that is less; a dive point is where it falls to 0 again. The lines with weight
between surge and dive are kept, as are lines of link text among them.

Article and main elements only change weights. Where they hold at least half of the page's
text, their lines weigh ``MARKED`` times as much, link text included, and run on across the
boilerplate inside them. Articles with less than half of it (teasers, "read more" cards) weigh
a third, each by itself. Text outside them always keeps its weight.

Edge cases: null or empty html, and pages without text, give ''; unclosed elements end
with their parent; an unclosed comment, script or style runs to the page's end; character
references are decoded as HTML5 does; text is never cut.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from visitline.llm.common import only

WINDOW, SURGE, MARKED = 3, 80, 8

# Fixed lists: HTML element names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
NOISE = frozenset("head title nav footer aside form menu dialog button select textarea noscript template iframe object svg canvas".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
# Words of class and id names. What is named by one of the first two never is article text; the third kind is layout.
_COMMENTS = re.compile(r"comment(?!ar(?:y|ies)$)\w*|\w*comments|disqus\w*|repl(?:y|ies)|respond|discussion|reactions?")
_ASIDE = re.compile(
    r"ads?|ads?(?:slot|box|unit|block|banner|wrap\w*|space|zone|vert\w*|sense)|adv|advert\w*|sponsor\w*|promo\w*|banners?|cookies?\w*|consent|gdpr|"
    r"notices?|notifications?|alerts?|popups?|popover|modal|lightbox|overlay|toast|newsletters?|subscri\w*|signup|paywall|shar(?:e|ing)\w*|"
    r"social\w*|breadcrumbs?|related|recommended|recommendations|teasers?|footer|foot|colophon"
)
_LAYOUT = re.compile(r"\w*sidebars?|side|menus?|\w*menu|nav\w*|header|masthead|topbar|toolbar|widgets?|forms?|login|search\w*")
#: Words that make a name tell about something else: a state of the page, or a part of the article itself.
_STATE = frozenset("with without has no is not open opened closed shown visible enabled active loaded ready hide layout".split())
_CONTENT = frozenset("article entry post story content body title headline text".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
COMMENTS, ASIDE, LAYOUT = 3, 2, 1
_KINDS: dict[tuple[str, bool], int] = {}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def noise_kind(names: str, in_article: bool = False) -> int:
    """What a class or id value says about its element: ``COMMENTS``, ``ASIDE``, ``LAYOUT``, or 0."""
    known = _KINDS.get((names, in_article))
    if known is not None:
        return known
    kind = 0
    for token in names.split():
        parts = [p.lower() for p in _PARTS.findall(token)]
        words = [*parts, "".join(parts)]
        if _STATE.intersection(parts):
            continue
        if any(_COMMENTS.fullmatch(w) for w in words):
            kind = max(kind, COMMENTS)
        elif any(_ASIDE.fullmatch(w) for w in words):
            kind = max(kind, ASIDE)
        elif any(_LAYOUT.fullmatch(w) for w in words):
            # The header of an entry is its title.
            heading = not {"header", "masthead"}.isdisjoint(parts) and (in_article or not _CONTENT.isdisjoint(parts))
            kind = max(kind, 0 if heading else LAYOUT)
    if len(_KINDS) > 10_000:
        _KINDS.clear()
    _KINDS[names, in_article] = kind
    return kind


def _is_noise(tag: str, attrs: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is noise by its tag or role, or else what its class or id says of it."""
    kind = 0
    if tag in NOISE or (tag == "header" and not in_article):
        return True, 0
    if attrs and tag not in ("html", "body"):
        for name, a, b, c in _ATTR.findall(attrs):
            value = a or b or c
            if name.lower() != "role":
                kind = max(kind, noise_kind(value, in_article))
            elif value.lower() in NOISE_ROLES:
                return True, 0
    # An article or main element is one, whatever its name, unless it is a comment.
    return False, kind if tag not in ("article", "main") or kind == COMMENTS else 0


class Line(NamedTuple):
    text: str
    plain: int  # characters outside links
    full: int
    noise: bool
    article: int  # the number of the outermost article around it, or 0
    main: bool


def lines(page: str) -> list[Line]:
    """Each line with text."""
    out: list[Line] = []
    stack: list[tuple[str, bool, int]] = []  # tag, noise, number of an element named like noise
    named: list[int] = []  # those that are open
    kinds: list[int] = [0]  # what the name of each says
    within: list[tuple[int, ...]] = []  # those around each line
    noise = links = articles = mains = number = names = 0
    text: list[str] = []
    plain = full = 0

    def end_line() -> None:
        nonlocal plain, full
        if text:
            joined = " ".join(_html.unescape("".join(text)).split())
            if joined:
                out.append(Line(joined, plain, full, bool(noise), number if articles else 0, mains > 0))
                within.append(tuple(named))
            text.clear()
            plain = full = 0

    def pop_to(i: int) -> None:
        nonlocal noise, links, articles, mains
        while len(stack) > i:
            tag, bad, name = stack[-1]
            if bad or name:  # inline ones end a line too
                end_line()
            stack.pop()
            noise -= bad
            if name:
                named.pop()
            links -= tag == "a"
            articles -= tag == "article"
            mains -= tag == "main"

    at = 0
    for m in [*_TOKEN.finditer(page), None]:
        piece = page[at : m.start() if m else len(page)]
        if piece:
            text.append(piece)
            full += len(piece.strip())
            if not links:
                plain += len(piece.strip())
        if m is None:
            break
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            end_line()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in VOID or m[4].endswith("/"):
            continue
        if tag == "body":
            pop_to(0)
        elif tag in BLOCK:  # an open paragraph or item ends where the next block or item begins
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] == tag == "li":
                    pop_to(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        bad, by_name = _is_noise(tag, m[4], articles + mains > 0)
        if bad or by_name:
            end_line()
        if by_name:
            kinds.append(by_name)
            names += 1
            named.append(names)
        stack.append((tag, bad, names if by_name else 0))
        noise += bad
        links += tag == "a"
        number += tag == "article" and not articles
        articles += tag == "article"
        mains += tag == "main"
    end_line()
    noisy = _noise_names(out, within, kinds)
    return [line._replace(noise=line.noise or not noisy.isdisjoint(around)) for line, around in zip(out, within, strict=True)]


def _noise_names(rows: list[Line], within: list[tuple[int, ...]], kinds: list[int]) -> set[int]:
    """The elements named like noise that are noise.

    Comments always are. The others are not if they are around the whole of the page's main article. Without
    an article or main element, layout names are not noise around over half of the text that is left.
    """
    held: Counter[int] = Counter()
    leads: dict[tuple[int, bool], int] = {}
    total = 0
    for line, around in zip(rows, within, strict=True):
        found = [kinds[n] for n in around]
        if line.noise or COMMENTS in found:
            continue
        if line.article or line.main:
            key = (line.article, line.main)
            # An article that only stands inside an advert or a list of teasers does not lead where there is another.
            leads[key] = leads.get(key, 0) + line.plain * (1 if ASIDE in found else 1000)
        if ASIDE not in found:
            total += line.plain
            held.update(dict.fromkeys(around, line.plain))
    noisy = set(range(1, len(kinds)))
    if leads:
        lead = max(leads, key=leads.get)
        around = [set(w) for line, w in zip(rows, within, strict=True) if (line.article, line.main) == lead and not line.noise]
        return noisy - {n for n in set.intersection(*around) if kinds[n] != COMMENTS}
    return noisy - {n for n in noisy if kinds[n] == LAYOUT and 2 * held[n] > total}


def _weighed(rows: list[Line]) -> list[list[tuple[int, float]]]:
    """``(line, weight)`` of each sequence of lines that windows run over."""
    in_article = sum(r.plain for r in rows if not r.noise and r.article)
    in_main = sum(r.plain for r in rows if not r.noise and r.main and not r.article)
    outside = sum(r.plain for r in rows if not r.noise and not r.main and not r.article)
    articles_lead, mains_lead = in_article >= in_main + outside, in_article + in_main >= outside
    parts: dict[int, list[tuple[int, float]]] = {}
    for i, r in enumerate(rows):
        if articles_lead if r.article else r.main and mains_lead:
            if not r.noise:
                parts.setdefault(-1, []).append((i, MARKED * r.full))
        else:
            parts.setdefault(r.article, []).append((i, 0 if r.noise else r.plain / 3 if r.article else r.plain))
    return list(parts.values())


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    rows = lines(page or "")
    parts = []
    for part in _weighed(rows):
        weights = [w for _, w in part]
        parts.append((part, weights, [sum(weights[i : i + window]) for i in range(len(part))]))
    surge = min(surge, max((s for _, _, sums in parts for s in sums), default=0) / 2)
    kept: list[int] = []
    for part, weights, sums in parts:
        i, n = 0, len(part)
        while i < n:
            if sums[i] <= surge:
                i += 1
                continue
            start = i  # surge
            while start > 0 and weights[start - 1] > 0:
                start -= 1
            while not weights[start]:  # the window looks ahead: the text itself begins with its first weight
                start += 1
            while i < n and sums[i] > 0:
                i += 1
            kept += [at for at, _ in part[start:i] if not rows[at].noise]  # dive
    return " ".join(rows[at].text for at in sorted(kept))


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extract(html: Column) -> Column:
    return _main_text(F.coalesce(html, F.lit("")))


def page_texts(pages: DataFrame) -> DataFrame:
    """The registered result: one row per page."""
    pages = only(pages, "page_id", "url", "html")
    texts = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


__all__ = ["extract", "main_text", "page_texts"]
