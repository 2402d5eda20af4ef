"""HTML extraction: flat text blocks, classified by a decision tree.

A page is read once from left to right.  Text between block-level tags is a block; inline
tags stay inside.  Scripts, styles and form controls are skipped; an element of theirs without an
end tag hides nothing but itself, save a script or style.  A block is described by its number of words, its link density, the same of
its neighbours, whether it is a heading, and what the nearest telling element around it is: an
article or main element, or one that by tag or class holds menus, notices, adverts, comments
and the like.  A decision tree, grown from the small labelled table ``LABELLED``, decides.

Defined results
  null, empty html   empty text, 0 characters
  no main text       empty text
  null id or url     passed through
  repeated rows      equal results
  empty table        empty result
  extra columns      are ignored
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.text import texts

# A comment, a declaration, or a tag with quoted attributes; else a tag up to the next ">".
MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?""",
    re.DOTALL,
)
MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)

# Their content is no text of the page, or part of a form.
UNREAD = frozenset(
    "head script style noscript template svg math iframe object audio video canvas select textarea button option datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Blocks that end when the next one of their kind begins; they are not kept on the stack.
OPEN_ENDED = frozenset("p li dt dd tr td th thead tbody tfoot option h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset(("article", "main"))
ASIDE_TAGS = frozenset("nav footer aside form menu dialog address".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer header masthead cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond related recommended share sharing social widget toolbar pagination pager tags "
    "copyright legal disclaimer form search skip complementary contentinfo".split()
)
MAIN_WORDS = frozenset("article content main story post entry body articlebody maincontent".split())
# Parts of a layout: an article inside a wrapper of such a name is the article all the same.
LAYOUT_WORDS = frozenset("sidebar header masthead footer nav navbar navigation menu toolbar search social share widget banner tags skip".split())
# A class like "has-sidebar" tells what is beside the content, not what it is.
MODIFIERS = frozenset("has have with without no not show hide hidden toggle is on off enable disable contains".split())
CUT_TO_THE_END = frozenset(("script", "style"))
NEITHER, MAIN, ASIDE, WRAPPER = 0, 1, 2, 3


class Block(NamedTuple):
    text: str
    words: int
    links: float  # share of the words inside links
    heading: int
    place: int


# What the tree learns from, one block a row: words, link density; the same of the block before
# and of the block after; heading; place (0 neither, 1 in the article, 2 aside); main text or not.
LABELLED = [
    (62, 0.00, 48, 0.00, 71, 0.00, 0, 1, 1),
    (40, 0.00, 9, 0.00, 55, 0.00, 0, 1, 1),
    (3, 0.00, 40, 0.00, 35, 0.00, 0, 1, 1),
    (1, 0.00, 30, 0.00, 1, 0.00, 0, 1, 1),
    (2, 0.00, 2, 0.00, 3, 0.00, 0, 1, 1),
    (8, 0.00, 6, 1.00, 45, 0.00, 1, 1, 1),
    (9, 0.00, 10, 0.00, 66, 0.00, 1, 1, 1),
    (5, 0.00, 70, 0.00, 58, 0.00, 1, 1, 1),
    (120, 0.05, 80, 0.00, 12, 0.20, 0, 1, 1),
    (35, 0.20, 50, 0.00, 44, 0.00, 0, 1, 1),
    (12, 0.33, 60, 0.00, 90, 0.00, 0, 1, 1),
    (7, 0.00, 88, 0.00, 14, 0.00, 0, 1, 1),
    (15, 0.00, 0, 0.00, 0, 0.00, 0, 1, 1),
    (4, 0.00, 3, 1.00, 6, 0.00, 0, 1, 1),
    (60, 0.00, 40, 0.00, 5, 1.00, 0, 1, 1),
    (18, 0.00, 33, 0.00, 7, 1.00, 0, 1, 1),
    (6, 0.00, 21, 0.00, 12, 0.80, 0, 1, 1),
    (2, 0.00, 4, 1.00, 3, 1.00, 0, 1, 1),
    (9, 0.00, 5, 1.00, 30, 0.40, 1, 1, 1),
    (30, 0.40, 12, 0.00, 41, 0.60, 0, 1, 1),
    (26, 0.00, 6, 1.00, 0, 0.00, 0, 1, 1),
    (6, 1.00, 40, 0.00, 5, 1.00, 0, 1, 0),
    (5, 0.80, 40, 0.00, 55, 0.00, 0, 1, 0),
    (4, 1.00, 6, 1.00, 7, 1.00, 0, 1, 0),
    (9, 0.90, 52, 0.00, 8, 0.90, 0, 1, 0),
    (3, 1.00, 25, 0.00, 0, 0.00, 0, 1, 0),
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 2, 0),
    (2, 1.00, 1, 1.00, 2, 1.00, 0, 2, 0),
    (8, 0.00, 1, 1.00, 9, 0.00, 0, 2, 0),
    (22, 0.00, 2, 1.00, 60, 0.00, 0, 2, 0),
    (45, 0.02, 50, 0.00, 30, 0.00, 0, 2, 0),
    (90, 0.00, 40, 0.00, 75, 0.00, 0, 2, 0),
    (14, 0.10, 70, 0.00, 0, 0.00, 0, 2, 0),
    (6, 0.00, 12, 0.00, 20, 0.00, 1, 2, 0),
    (3, 0.00, 0, 0.00, 5, 1.00, 1, 2, 0),
    (24, 0.00, 40, 0.00, 52, 0.00, 0, 2, 0),
    (66, 0.00, 7, 0.00, 61, 0.00, 0, 2, 0),
    (5, 0.00, 55, 0.00, 80, 0.00, 0, 2, 0),
    (31, 0.00, 6, 1.00, 4, 1.00, 0, 2, 0),
    (55, 0.00, 61, 0.00, 47, 0.00, 0, 0, 1),
    (44, 0.00, 6, 1.00, 5, 1.00, 0, 0, 1),
    (29, 0.00, 40, 0.00, 3, 1.00, 0, 0, 1),
    (48, 0.30, 5, 1.00, 66, 0.40, 0, 0, 1),
    (38, 0.03, 8, 0.00, 52, 0.00, 0, 0, 1),
    (25, 0.00, 44, 0.00, 31, 0.00, 0, 0, 1),
    (70, 0.12, 33, 0.00, 28, 0.00, 0, 0, 1),
    (16, 0.00, 58, 0.00, 64, 0.00, 0, 0, 1),
    (7, 0.00, 49, 0.00, 53, 0.00, 0, 0, 1),
    (9, 0.00, 4, 1.00, 57, 0.00, 1, 0, 1),
    (6, 0.00, 42, 0.00, 68, 0.00, 1, 0, 1),
    (11, 0.00, 40, 0.00, 36, 0.00, 0, 0, 1),
    (5, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0),
    (4, 0.00, 1, 1.00, 6, 0.00, 0, 0, 0),
    (7, 0.00, 3, 0.00, 2, 0.50, 0, 0, 0),
    (3, 1.00, 2, 1.00, 2, 1.00, 0, 0, 0),
    (12, 0.80, 10, 0.90, 9, 1.00, 0, 0, 0),
    (20, 0.75, 45, 0.00, 18, 0.80, 0, 0, 0),
    (10, 0.60, 5, 1.00, 4, 1.00, 0, 0, 0),
    (8, 0.25, 50, 0.00, 3, 1.00, 0, 0, 0),
    (6, 0.00, 4, 0.50, 0, 0.00, 0, 0, 0),
    (2, 0.00, 0, 0.00, 4, 1.00, 1, 0, 0),
    (4, 0.00, 6, 1.00, 5, 1.00, 1, 0, 0),
]
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "in_main", "aside"]

Tree = tuple | int


def _row(values: tuple) -> list[float]:
    *measures, place = values
    return [*measures, float(place == MAIN), float(place == ASIDE)]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Tree:
    """A tree of (feature, limit, at most, above) nodes by the Gini index; leaves are 0 or 1."""
    vote = int(2 * y.sum() >= len(y))
    if depth == 0 or len(set(y.tolist())) < 2:
        return vote
    best = (1.0, 0, 0.0)
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, feature] <= limit
            shares = [(part.mean(), len(part)) for part in (y[low], y[~low])]
            gini = sum(2 * p * (1 - p) * n for p, n in shares) / len(y)
            best = min(best, (gini, feature, float(limit)))
    if best[0] == 1.0:
        return vote
    _, feature, limit = best
    low = x[:, feature] <= limit
    return feature, limit, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


@functools.cache
def tree() -> Tree:
    x = np.array([_row(row[:-1]) for row in LABELLED])
    return grow(x, np.array([row[-1] for row in LABELLED], dtype=float))


def classify(node: Tree, features: list[float]) -> int:
    while not isinstance(node, int):
        feature, limit, low, high = node
        node = low if features[feature] <= limit else high
    return node


@functools.cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE)


def _roles(value: str) -> Iterator[list[str]]:
    """The words of each class name that tells a role of its own."""
    for name in value.split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if words and words[0] not in MODIFIERS:
            yield words


def _place(tag: str, attributes: str, inside: int) -> int:
    """What an element says about its content; ``inside`` is what is known from around it.

    ``WRAPPER`` is an aside by the name of a part of the layout: an article in it counts as one.
    """
    named = NEITHER
    if attributes and tag not in ("html", "body"):
        for found in MARK.findall(attributes):
            for words in _roles("".join(found)):
                aside = ASIDE_WORDS.intersection(words)
                # A "post header" or "entry footer" in the article belongs to it only as a header.
                if aside and not (inside == MAIN and aside == {"header"}):
                    named = WRAPPER if aside <= LAYOUT_WORDS and named != ASIDE else ASIDE
                elif named == NEITHER and not MAIN_WORDS.isdisjoint(words):
                    named = MAIN
    if tag in MAIN_TAGS:
        return inside if inside == ASIDE else ASIDE if named == ASIDE else MAIN
    if tag in ASIDE_TAGS or tag == "header" and inside != MAIN:
        return ASIDE
    if named in (ASIDE, WRAPPER):
        return ASIDE if named == ASIDE or inside == ASIDE else WRAPPER
    return MAIN if named == MAIN and inside == NEITHER else inside


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    found: list[Block] = []
    stack: list[tuple[str, int]] = []
    depth: Counter[str] = Counter()  # open elements by tag, so that stray ends cost nothing
    parts: list[str] = []
    linked: list[str] = []
    place, heading, link, at, n = NEITHER, 0, 0, 0, len(page)
    endless: set[str] = set()  # tags of which no end is left, so that they are searched once
    asides: list[tuple[str, int]] = []  # open-ended elements that are asides, with the depth they stand at

    def leave(tag: str, level: int) -> None:
        """An open-ended element ends: at its end tag, at the next of its kind, or with what it stands in."""
        asides[:] = [(name, at_level) for name, at_level in asides if at_level < level or at_level == level and name != tag]

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                words = text.count(" ") + 1
                inside = len(html.unescape(" ".join(linked)).split())
                where = ASIDE if asides or place == WRAPPER else place
                found.append(Block(text, words, min(1.0, inside / words), heading, where))
            parts.clear()
            linked.clear()

    def keep(text: str) -> None:
        parts.append(text)
        if link:
            linked.append(text)

    while at < n:
        match = MARKUP.search(page, at)
        if match is None:
            keep(page[at:])
            break
        if match.start() > at:
            keep(page[at : match.start()])
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in UNREAD and not closing:
            if not attributes.endswith("/"):
                flush()
                end = None if tag in endless else _end_of(tag).search(page, at)
                if end is not None:
                    at = end.end()
                elif tag in CUT_TO_THE_END:
                    at = n
                else:  # what follows an element that never ends is read
                    endless.add(tag)
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                keep(" ")
            continue
        flush()
        link = 0
        if tag in OPEN_ENDED:
            heading = int(tag in HEADINGS and not closing)
            leave(tag, len(stack))
            if not closing and attributes and _place(tag, attributes, place) in (ASIDE, WRAPPER) and place != ASIDE:
                asides.append((tag, len(stack)))
        elif closing:
            heading = 0
            while depth[tag]:
                name, place = stack.pop()
                depth[name] -= 1
                if name == tag:
                    break
            asides[:] = [(name, level) for name, level in asides if level <= len(stack)]
        elif tag not in VOID and not attributes.endswith("/"):
            heading = 0
            leave("p", len(stack))
            stack.append((tag, place))
            depth[tag] += 1
            place = _place(tag, attributes, place)
    flush()
    return found


def main_text(page: str) -> str:
    """The blocks that the tree takes for main text, one a line."""
    found = blocks(page)
    node = tree()
    outside = Block("", 0, 0.0, 0, NEITHER)
    lines = []
    for before, block, after in zip([outside, *found], found, [*found[1:], outside], strict=False):
        around = (before.words, before.links, after.words, after.links)
        if classify(node, _row((block.words, block.links, *around, block.heading, block.place))):
            lines.append(block.text)
    return "\n".join(lines)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(page.decode("utf-8", "replace")) for page in texts(batch, "html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    chosen = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    kinds = [pages.schema[name].dataType.simpleString() for name in (id_column, url_column)]
    found = chosen.mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
