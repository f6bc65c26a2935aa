"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one for each run of text between block-level
tags, in page order, with character references decoded and white space
turned into single spaces.  A line's weight is its text length; it is zero
inside scripts, styles, hidden elements, menus, site headers, footers,
sidebars, notices, adverts, forms and reader comments.  Such a part is an
element of that kind (``nav``, ``footer``), or one with a whole class, id,
role or itemprop token that names it (``sidebar``, ``social-share``; not
``has-sidebar``).  By its name alone no
element is a part that holds the only marked article, or, unless another is
marked outside, more than ``PART_SHARE`` of the text (what is left of it after
the parts inside; inside an article of its text); reader comments are parts
whatever their share.  A section whose name says what it is about
(``related-work``) is none.  If the page
marks its article (``article``, else ``main`` or an element named as content),
the one with most text counts, with its siblings of that kind; if an area
around them has more text beside them than they hold (links aside), that area
counts instead.  Lines outside weigh zero.

Weights are summed over a sliding window of ``WINDOW`` lines.  Where the sums
rise above the threshold is a surge point, where they fall to it a dive
point.  The text between a surge and its dive is kept; inside a marked
article the threshold is zero, so that short paragraphs and headings stay,
else it is a share of the page's highest sum, lines of mostly links weigh
zero, and short lines in the kept lines' own containers, next to them, stay.
For the threshold a line weighs ``CAP`` times the median of the longer lines at most, so that
a huge paragraph does not hide others.  Of the ranges above it, the one with
most text is kept and all that share its container (or the one around, if its
lines are all of one).

A null or empty html gives an empty text.  Texts are read whole, repeated
rows are extracted each by itself, and all input columns are passed through
(an input column named as a result is replaced).  An empty table gives none.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import in_arrow, ship

WINDOW = 3
THRESHOLD_SHARE = 0.2
#: An element with more of the page's text than that is no part by its name alone.
PART_SHARE = 0.5
#: Lines of that many characters have the median that a line's weight is capped at ``CAP`` times of.
PROSE, CAP = 40, 4

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")

#: HTML's own element classes (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}}

#: Elements whose text is never the article's.
DROPPED = frozenset("nav aside footer form button select option input dialog menu noscript template svg math canvas "
                    "audio video object applet head iframe textarea title script style".split())
#: Tokens of class, id, role or itemprop that name such parts, alone or in a token of ``PART_FRAME`` words and these.
PART_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead banner header footer sidebar aside widget "
    "related recommended recommendations teaser teasers share sharing social cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond "
    "pagination pager toolbar search complementary contentinfo".split())
PART_FRAME = frozenset("site page global main top bottom left right primary secondary box block bar list area section container wrapper "
                       "wrap inner outer links link buttons button form icons post article entry user reader social media post posts "
                       "articles stories items item my the js in text google cross module group row col panel".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
CONTENT_WORDS = frozenset("article articlebody content maincontent main post postbody entry story body text".split())
CONTENT_PHRASES = ("articlebody", "article-body", "article-content", "post-content", "post-body", "entry-content",
                   "main-content", "story-body", "page-content")


def _named(attributes: dict[str, str]) -> tuple[set[str], str]:
    name = " ".join(attributes.get(k, "") for k in ("class", "id", "role", "itemprop"))
    words = re.sub(r"([a-z])([A-Z])", r"\1 \2", name)
    return set(re.findall(r"[a-z]+", words.lower())), name.lower()


def _names_part(attributes: dict[str, str], inside: bool) -> bool:
    """Whether a whole token names a part: part words, and frame words beside them, no others."""
    for key in ("class", "id", "role", "itemprop"):
        for token in attributes.get(key, "").split():
            words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            # An article's own header is no part.
            if any(w in PART_WORDS and not (inside and w == "header") for w in words) and all(w in PART_WORDS or w in PART_FRAME for w in words):
                return True
    return False


class _Line(NamedTuple):
    """A line, the text in links, and the innermost container, area and part around it (0: none)."""

    text: str
    links: int
    box: int
    area: int
    part: int


@dataclass
class _Page:
    """Lines of a page, and of its elements' numbers the next one around it; an element's number is below those inside it."""

    lines: list[_Line] = field(default_factory=list)
    boxes: dict[int, int] = field(default_factory=dict)
    areas: dict[int, int] = field(default_factory=dict)
    parts: dict[int, int] = field(default_factory=dict)
    #: Marked areas: 2 (article) or 1 (other), the container and the part around each.
    ranks: dict[int, int] = field(default_factory=dict)
    area_boxes: dict[int, int] = field(default_factory=dict)
    area_parts: dict[int, int] = field(default_factory=dict)
    #: Of elements that may be parts: the article around (0: none), whether it is of reader comments.
    around: dict[int, tuple[int, bool]] = field(default_factory=dict)


class _Element(NamedTuple):
    name: str
    dropped: bool
    box: int
    area: int
    link: bool
    part: int


def _summed(own: dict[int, int], outer: dict[int, int]) -> dict[int, int]:
    """Of each element its own sum with those of all elements inside."""
    out = dict.fromkeys(outer, 0) | own
    for number in sorted(outer, reverse=True):
        if outer[number]:
            out[outer[number]] += out[number]
    return out


def _within(chosen: set[int], outer: dict[int, int]) -> set[int]:
    """The chosen elements and all inside them."""
    out = set(chosen)
    for number in sorted(outer):
        if outer[number] in out:
            out.add(number)
    return out


def _by(lines: list[_Line], key: Callable[[_Line], int]) -> dict[int, int]:
    """Text lengths by the element that ``key`` gives."""
    out: dict[int, int] = {}
    for line in lines:
        out[key(line)] = out.get(key(line), 0) + len(line.text)
    out.pop(0, None)
    return out


def lines_of(page: str) -> _Page:
    """The lines that may be the article's and the elements around them, in time linear in the page's length and depth.

    Elements that are parts by their names alone are decided on at the end.
    """
    out = _Page()
    stack = [_Element("", False, 0, 0, False, 0)]
    # Where the stack has open elements of a name, and such that are not inline; open areas, articles and parts.
    places: dict[str, list[int]] = defaultdict(list)
    blocks, areas, articles, parts = [0], [0], [0], [0]
    dropped = links = linked = number = 0
    held: list[str] = []

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.lines.append(_Line(text, linked, stack[-1].box, areas[-1], parts[-1]))
            held.clear()
        linked = 0

    def pop(down_to: int) -> None:
        nonlocal dropped, links
        while len(stack) > down_to:
            element = stack.pop()
            places[element.name].pop()
            if element.name not in INLINE:
                blocks.pop()
            dropped -= element.dropped
            links -= element.link
            if element.part:
                parts.pop()
            if element.area:
                areas.pop()
                if out.ranks[element.area] == 2:
                    articles.pop()

    at = 0
    size = len(page)
    while at < size:
        found = _TAG.search(page, at)
        end = found.start() if found else size
        if end > at and not dropped:
            text = entities.unescape(page[at:end])
            held.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            if name not in INLINE:
                flush()
            # An inline element's end tag ends none beyond the block it is in.
            if places[name] and (name not in INLINE or places[name][-1] > blocks[-1]):
                pop(places[name][-1])
            continue
        if name == "br":
            held.append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in CLOSES_P:
            if stack[blocks[-1]].name == "p":
                pop(blocks[-1])
        elif name in SIBLINGS:
            scope = max((places[x][-1] for x in SCOPES[name] if places[x]), default=0)
            open_ones = [places[x][k] for x in SIBLINGS[name] if (k := bisect(places[x], scope)) < len(places[x])]
            if open_ones:
                pop(min(open_ones))
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else size
            if close:
                stop = page.find(">", at)
                at = stop + 1 if stop >= 0 else size
            continue
        if name in VOID or found.group().endswith("/>") and name not in INLINE and name in DROPPED:
            continue
        attributes = {}
        raw = found["attributes"] or found["attributes2"]
        if raw and raw.strip(" /"):
            attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)}
        words, whole = _named(attributes) if attributes else (set(), "")
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
        inside = len(areas) > 1
        drop = name in DROPPED or hidden or name == "header" and not inside
        part = not drop and bool(words & PART_WORDS) and name not in ("html", "body", "main") and _names_part(attributes, inside) and not (
            name in ("article", "header", "h1", "h2", "hgroup") and (inside or name == "article") and not (
                name == "article" and words & {"comment", "comments", "reply", "teaser", "related", "ad", "ads", "advert"}))
        rank = 0 if drop or dropped or part else 2 if name == "article" or "articlebody" in words else 1 if (
            name == "main" or attributes.get("role") == "main" or any(p in whole for p in CONTENT_PHRASES)
            or name in ("div", "section", "td") and words and words <= CONTENT_WORDS) else 0
        number += 1
        if rank:
            out.ranks[number], out.areas[number] = rank, areas[-1]
            out.area_parts[number], out.area_boxes[number] = parts[-1], stack[-1].box
            areas.append(number)
            if rank == 2:
                articles.append(number)
        if part:
            out.parts[number], out.around[number] = parts[-1], (articles[-1], bool(words & COMMENT_WORDS))
            parts.append(number)
        dropped += drop
        links += name == "a"
        box = stack[-1].box
        if name not in INLINE and name not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6"):
            out.boxes[number] = box
            box = number
        places[name].append(len(stack))
        if name not in INLINE:
            blocks.append(len(stack))
        stack.append(_Element(name, drop, box, number if rank else 0, name == "a", number if part else 0))
    flush()
    return _without_parts(out)


def _without_parts(page: _Page) -> _Page:
    """Lines and areas outside the elements that are parts after all; outer elements are decided on last."""
    if not page.around:
        return page
    own = dict.fromkeys(page.around, 0) | _by(page.lines, lambda x: x.part)
    texts = _summed(_by(page.lines, lambda x: x.area), page.areas)
    total = sum(len(x.text) for x in page.lines)
    marked = [a for a, rank in page.ranks.items() if rank == 2 and texts[a]]
    outside = any(not page.area_parts[a] for a in marked)
    holding = {page.area_parts[a] for a in marked if page.area_parts[a]} if not outside else set()
    real: set[int] = set()
    for part in sorted(page.around, reverse=True):
        outer, (article, comments) = page.parts[part], page.around[part]
        most = texts[article] if article else 0 if outside else total
        if comments or not (part in holding or most and own[part] > PART_SHARE * most):
            real.add(part)
        elif outer:
            own[outer] += own[part]
            if part in holding:
                holding.add(outer)
    gone = _within(real, page.parts)
    page.lines = [x for x in page.lines if x.part not in gone]
    page.ranks = {a: rank for a, rank in page.ranks.items() if page.area_parts[a] not in gone}
    return page


def between_surge_and_dive(weights: list[int], threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Ranges of lines from a surge point of the window sums to its dive point, trimmed to lines with weight."""
    ranges, begin = [], None
    sums = [sum(weights[k:k + window]) for k in range(len(weights))]
    for k, total in enumerate([*sums, 0]):
        if begin is None and total > threshold:
            begin = k
        elif begin is not None and total <= threshold:
            last = min(k + window - 1, len(weights))
            inside = [j for j in range(begin, last) if weights[j]]
            if inside:
                ranges.append((inside[0], inside[-1] + 1))
            begin = None
    return ranges


def extract(page: str | None, window: int = WINDOW, threshold_share: float = THRESHOLD_SHARE) -> str:
    """The page's main text: its blocks, one a line."""
    if not page:
        return ""
    found = lines_of(page)
    lines = found.lines
    if not lines:
        return ""
    texts = _summed(_by(lines, lambda x: x.area), found.areas)
    areas = [a for a in texts if texts[a]]
    if areas:
        best = max(areas, key=lambda a: (found.ranks[a], texts[a], -a))
        chosen = {a for a in areas if found.ranks[a] == found.ranks[best] and found.area_boxes[a] == found.area_boxes[best]}
        inside = _within(chosen, found.areas)
        most = sum(len(x.text) for x in lines if x.area in inside)
        free = [x for x in lines if 2 * x.links <= len(x.text)]
        whole = _summed(_by(free, lambda x: x.area), found.areas)
        beside = _summed(_by([x for x in free if x.area not in inside], lambda x: x.area), found.areas)
        outer, taken = found.areas[best], None
        while outer:
            if (beside[outer] if taken is None else whole[outer] - whole[taken]) > most:
                taken, most = outer, texts[outer]
            outer = found.areas[outer]
        if taken is not None:
            inside = _within({taken}, found.areas)
        weights = [len(x.text) if x.area in inside else 0 for x in lines]
        ranges = between_surge_and_dive(weights, 0, window)
        return "\n".join(lines[k].text for a, b in ranges for k in range(a, b) if weights[k])
    weights = [0 if 2 * x.links > len(x.text) else len(x.text) for x in lines]
    held = sorted(w for w in weights if w)
    if not held:
        return ""
    prose = [w for w in held if w >= PROSE] or held
    most = CAP * prose[len(prose) // 2]
    peak = max(sum(min(w, most) for w in weights[k:k + window]) for k in range(len(weights)))
    ranges = between_surge_and_dive(weights, threshold_share * peak, window)
    if not ranges:
        return ""
    # The range with most text, those under its common container, and the lines of the same containers.
    kept = max(ranges, key=lambda r: (sum(weights[r[0]:r[1]]), -r[0]))
    own = {lines[k].box for k in range(*kept) if weights[k]}
    above, last = min(own), max(own)
    if len(own) == 1:
        above = found.boxes.get(above, 0)
    else:  # what the first and the last container share
        while above != last:
            above, last = min(above, last), found.boxes[max(above, last)]
    under = _within({above}, found.boxes)
    keep = {k for a, b in ranges for k in range(a, b) if weights[k] and lines[k].box in under} | {k for k in range(*kept) if weights[k]}
    boxes = {lines[k].box for k in keep}
    keep |= {k for k, x in enumerate(lines) if weights[k] and x.box in boxes}
    return "\n".join(lines[k].text for k in sorted(keep))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (main text, never null) and ``n_chars`` (its code points)."""
    ship(pages.sparkSession)
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    kept = pages.select(*keep) if html in keep else pages.select(*keep, html)
    names = [c for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in names)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(x.as_py()) for x in part.column(part.schema.get_field_index(html))]
                out = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*out, pa.array(texts, pa.string())], names=[*names, "text"])

    return in_arrow(kept, run, f"{schema}, text string").withColumn("n_chars", F.length("text").cast("long"))
