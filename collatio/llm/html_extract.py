"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags; inline elements, whatever their attributes, cut nothing. A block's
features are its word count and link density, those of the blocks before and after it, and three about where it stands:
whether its tags name furniture (navigation, adverts, comments and so on), whether it lies in the page's main region,
and whether the page has one. The main region is what is named as the article if that holds most of the page's words
outside lists of links, else the innermost element that holds most of them, whatever its name. A decision tree, grown on
the small labelled table below, keeps or drops the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What is no tag, then a tag's start. A quote opens a value only after "="; all parts are possessive, so a page is scanned once.
_OTHER = r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"""
TAG = re.compile(_OTHER + r"""((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)(>|\Z)""", re.S)
#: Tags that end at the first ">", for the rest of a page whose quotes leave a tag open to the page's end.
BROKEN = re.compile(_OTHER + r"([^>]*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg iframe object head title textarea select button canvas audio video map datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, roles, and words of classes and ids that name furniture; those of the second set don't inside the article.
FURNITURE = frozenset("nav aside form menu dialog".split())
FURNITURE_ROLES = frozenset("navigation complementary search dialog alert alertdialog menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert aside banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "gdpr login menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
#: Of these, words of frames that may stand around an article too; the others are furniture whatever they hold.
FRAMES = frozenset("alert banner login menu modal nav navbar navigation notice notices notification overlay popup search share sharing sidebar signup skip social toolbar widget".split())
#: Parts of compound names that say nothing of what is inside ("comments-area", "nav-left"), and those that say it is not that.
HOLDERS = frozenset("area bar block body box button buttons col column container content entries group holder inner items item left links list main outer panel posts region right row section slot stories top bottom unit wrap wrapper zone".split())
NEGATIONS = frozenset("has is no not with without".split())
OUTER = frozenset("header footer".split())
OUTER_WORDS = frozenset("header footer masthead copyright legal".split())
ARTICLE = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article articlebody post story entry maincontent".split())
#: Elements whose shares of the page's words say where its text is.
CONTAINERS = frozenset("article aside blockquote center details div dl fieldset footer form header main nav ol section table td ul".split())
#: What an element is: no furniture, furniture, a form (furniture unless it holds most of the page), a frame by name only.
FREE, FIRM, FORM, FRAME = range(4)

FEATURES = ("furniture", "in_region", "page_has_region", "words", "links", "words_before", "links_before", "words_after", "links_after")
#: The labelled table: FEATURES, then 1 for main text. Link densities are shares of words inside links.
LABELLED = (
    # In the region that holds most of the page's words: all but links among links.
    (0, 1, 1, 12, 0.0, 0, 0.0, 80, 0.0, 1),
    (0, 1, 1, 1, 0.0, 60, 0.0, 70, 0.0, 1),
    (0, 1, 1, 120, 0.02, 12, 0.0, 40, 0.0, 1),
    (0, 1, 1, 45, 0.1, 90, 0.0, 6, 1.0, 1),
    (0, 1, 1, 5, 1.0, 60, 0.0, 70, 0.0, 1),
    (0, 1, 1, 8, 0.4, 40, 0.1, 0, 0.0, 1),
    (0, 1, 1, 2, 0.0, 1, 0.0, 1, 0.0, 1),
    (0, 1, 1, 300, 0.0, 2, 1.0, 12, 0.0, 1),
    (0, 1, 1, 20, 0.0, 9, 0.0, 10, 0.0, 1),
    (0, 1, 1, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (0, 1, 1, 3, 1.0, 4, 1.0, 2, 1.0, 0),
    (0, 1, 1, 6, 0.9, 5, 1.0, 7, 0.9, 0),
    (0, 1, 1, 3, 1.0, 8, 0.0, 4, 1.0, 1),
    (0, 1, 1, 3, 1.0, 4, 1.0, 30, 0.0, 1),
    (0, 1, 1, 3, 0.0, 0, 0.0, 2, 0.0, 1),
    (0, 1, 1, 90, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 1, 1, 15, 0.0, 0, 0.0, 20, 0.0, 1),
    (0, 1, 1, 30, 0.0, 15, 0.0, 0, 0.0, 1),
    (0, 1, 1, 200, 0.0, 150, 0.0, 180, 0.0, 1),
    (0, 1, 1, 10, 0.0, 12, 1.0, 9, 0.0, 1),
    (0, 1, 1, 25, 0.0, 4, 1.0, 30, 0.0, 1),
    (0, 1, 1, 60, 0.0, 1, 1.0, 5, 0.0, 1),
    (0, 1, 1, 7, 0.0, 8, 0.0, 6, 0.0, 1),
    (0, 1, 1, 4, 0.0, 200, 0.0, 2, 1.0, 1),
    (0, 1, 1, 18, 0.0, 9, 0.0, 3, 1.0, 1),
    (0, 1, 1, 2, 0.0, 5, 0.0, 120, 0.0, 1),
    (0, 1, 1, 75, 0.0, 85, 0.0, 95, 0.0, 1),
    (0, 1, 1, 4, 1.0, 90, 0.0, 5, 1.0, 1),
    (0, 1, 1, 12, 0.9, 9, 0.8, 40, 0.0, 1),
    (0, 1, 1, 6, 0.0, 3, 1.0, 0, 0.0, 1),
    # In a region of article, main or their roles that holds less than most.
    (0, 1, 0, 4, 0.0, 0, 0.0, 15, 0.0, 1),
    (0, 1, 0, 12, 0.0, 4, 0.0, 6, 0.0, 1),
    (0, 1, 0, 40, 0.0, 3, 0.0, 5, 0.0, 1),
    (0, 1, 0, 90, 0.05, 2, 1.0, 4, 1.0, 1),
    (0, 1, 0, 80, 0.0, 80, 0.0, 1, 0.0, 1),
    (0, 1, 0, 60, 0.0, 2, 0.0, 1, 1.0, 1),
    (0, 1, 0, 25, 0.0, 30, 0.0, 0, 0.0, 1),
    (0, 1, 0, 3, 0.0, 20, 0.0, 0, 0.0, 1),
    (0, 1, 0, 12, 0.0, 3, 1.0, 2, 1.0, 0),
    (0, 1, 0, 6, 0.0, 1, 1.0, 1, 1.0, 0),
    (0, 1, 0, 4, 0.0, 3, 1.0, 5, 1.0, 0),
    (0, 1, 0, 5, 1.0, 4, 1.0, 6, 1.0, 0),
    (0, 1, 0, 3, 1.0, 12, 0.0, 5, 1.0, 0),
    (0, 1, 1, 8, 0.0, 3, 0.0, 4, 1.0, 1),
    (0, 1, 1, 2, 0.0, 1, 0.0, 3, 1.0, 1),
    (0, 1, 1, 20, 0.0, 5, 0.0, 6, 1.0, 1),
    (0, 1, 1, 5, 0.0, 2, 1.0, 6, 1.0, 1),
    (0, 1, 1, 2, 1.0, 6, 0.9, 3, 1.0, 0),
    (0, 1, 1, 9, 0.8, 2, 1.0, 4, 0.7, 0),
    (0, 1, 1, 40, 0.7, 50, 0.8, 45, 0.9, 0),
    # Furniture, wherever it stands and however much it looks like text.
    (1, 0, 1, 150, 0.0, 80, 0.0, 90, 0.0, 0),
    (1, 0, 0, 200, 0.0, 3, 1.0, 150, 0.0, 0),
    (1, 0, 1, 300, 0.0, 200, 0.0, 250, 0.0, 0),
    (1, 0, 0, 130, 0.0, 120, 0.0, 4, 1.0, 0),
    (1, 0, 1, 180, 0.1, 5, 0.0, 8, 0.0, 0),
    (1, 1, 1, 160, 0.0, 90, 0.0, 70, 0.0, 0),
    (1, 1, 0, 140, 0.0, 2, 0.0, 9, 0.0, 0),
    (1, 1, 1, 60, 0.0, 80, 0.0, 30, 0.0, 0),
    (1, 1, 1, 8, 0.0, 40, 0.0, 50, 0.0, 0),
    (1, 1, 1, 10, 1.0, 40, 0.0, 50, 0.0, 0),
    (1, 0, 1, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (1, 0, 1, 12, 0.0, 1, 1.0, 12, 0.0, 0),
    (1, 0, 1, 70, 0.0, 50, 0.0, 60, 0.0, 0),
    (1, 0, 0, 40, 0.0, 60, 0.0, 80, 0.0, 0),
    (1, 0, 0, 3, 1.0, 3, 1.0, 3, 1.0, 0),
    (1, 0, 0, 90, 0.05, 70, 0.0, 0, 0.0, 0),
    (1, 0, 0, 15, 0.0, 2, 1.0, 30, 0.0, 0),
    # Outside a region that holds most: long blocks without links, and those among their like, are text all the same.
    (0, 0, 1, 9, 0.0, 200, 0.0, 0, 0.0, 0),
    (0, 0, 1, 40, 0.0, 1, 1.0, 60, 0.0, 0),
    (0, 0, 1, 15, 0.0, 40, 0.0, 0, 0.0, 0),
    (0, 0, 1, 30, 0.0, 0, 0.0, 2, 1.0, 0),
    (0, 0, 1, 10, 0.0, 0, 0.0, 80, 0.0, 0),
    (0, 0, 1, 60, 0.0, 5, 0.0, 10, 0.0, 0),
    (0, 0, 1, 35, 0.0, 150, 0.0, 3, 0.0, 0),
    (0, 0, 1, 25, 0.0, 20, 0.0, 22, 0.0, 0),
    (0, 0, 1, 6, 0.0, 0, 0.0, 4, 1.0, 0),
    (0, 0, 1, 4, 1.0, 3, 1.0, 5, 1.0, 0),
    (0, 0, 1, 25, 0.3, 90, 0.0, 4, 1.0, 0),
    (0, 0, 1, 70, 0.0, 2, 0.0, 2, 0.0, 0),
    (0, 0, 1, 200, 0.0, 30, 0.0, 20, 0.0, 1),
    (0, 0, 1, 150, 0.0, 1, 1.0, 90, 0.0, 1),
    (0, 0, 1, 130, 0.05, 3, 0.0, 4, 1.0, 1),
    (0, 0, 1, 70, 0.0, 90, 0.0, 80, 0.0, 1),
    (0, 0, 1, 45, 0.0, 120, 0.0, 70, 0.0, 1),
    (0, 0, 1, 120, 0.7, 60, 0.0, 50, 0.0, 0),
    (0, 0, 1, 8, 0.0, 60, 0.0, 50, 0.0, 0),
    (0, 0, 1, 12, 0.0, 3, 1.0, 2, 1.0, 0),
    (0, 0, 1, 20, 0.0, 8, 0.0, 9, 0.0, 0),
    (0, 0, 1, 3, 0.0, 150, 0.0, 4, 1.0, 0),
    (0, 0, 1, 5, 0.0, 4, 1.0, 90, 0.0, 0),
    (0, 0, 1, 3, 1.0, 80, 0.0, 90, 0.0, 0),
    (0, 0, 1, 30, 0.0, 90, 0.0, 4, 1.0, 0),
    (0, 0, 1, 45, 0.0, 60, 0.0, 0, 0.0, 0),
    (0, 0, 1, 160, 0.0, 1, 0.0, 2, 1.0, 1),
    (0, 0, 1, 130, 0.0, 2, 1.0, 0, 0.0, 1),
    # Pages that name none, or only by words of classes around a small part: length and links of the block and its neighbours have to do.
    (0, 0, 0, 60, 0.0, 10, 0.0, 50, 0.0, 1),
    (0, 0, 0, 35, 0.05, 2, 1.0, 45, 0.0, 1),
    (0, 0, 0, 25, 0.0, 40, 0.0, 2, 1.0, 1),
    (0, 0, 0, 150, 0.1, 3, 1.0, 4, 1.0, 1),
    (0, 0, 0, 18, 0.0, 30, 0.0, 35, 0.0, 1),
    (0, 0, 0, 90, 0.0, 2, 0.0, 3, 1.0, 1),
    (0, 0, 0, 160, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 50, 0.0, 1, 1.0, 2, 1.0, 1),
    (0, 0, 0, 35, 0.0, 60, 0.0, 3, 1.0, 1),
    (0, 0, 0, 42, 0.0, 50, 0.0, 10, 0.0, 1),
    (0, 0, 0, 30, 0.0, 5, 0.0, 0, 0.0, 1),
    (0, 0, 0, 16, 0.0, 40, 0.0, 12, 0.0, 1),
    (0, 0, 0, 6, 0.0, 50, 0.0, 60, 0.0, 1),
    (0, 0, 0, 2, 0.0, 30, 0.0, 45, 0.0, 1),
    (0, 0, 0, 9, 0.0, 1, 1.0, 70, 0.0, 1),
    (0, 0, 0, 5, 0.0, 0, 0.0, 80, 0.0, 1),
    (0, 0, 0, 12, 0.2, 45, 0.0, 30, 0.0, 1),
    (0, 0, 0, 3, 1.0, 2, 1.0, 4, 1.0, 0),
    (0, 0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (0, 0, 0, 12, 0.9, 9, 0.8, 10, 1.0, 0),
    (0, 0, 0, 30, 0.8, 4, 1.0, 20, 0.9, 0),
    (0, 0, 0, 40, 0.6, 60, 0.0, 30, 0.7, 0),
    (0, 0, 0, 5, 0.0, 3, 1.0, 4, 1.0, 0),
    (0, 0, 0, 8, 0.0, 40, 0.0, 0, 0.0, 0),
    (0, 0, 0, 7, 0.1, 1, 1.0, 6, 0.5, 0),
    (0, 0, 0, 4, 0.0, 5, 0.0, 6, 0.0, 0),
    (0, 0, 0, 2, 0.5, 3, 1.0, 50, 0.0, 0),
    (0, 0, 0, 10, 0.0, 2, 0.0, 3, 1.0, 0),
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 10) -> tuple | float:
    """A decision tree by Gini impurity: (feature, cut, tree for <= cut, tree for > cut), or the share of 1 at a leaf."""
    if depth == 0 or labels.min() == labels.max():
        return float(labels.mean())
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= cut
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    if best is None:
        return float(labels.mean())
    _, f, cut, low = best
    return f, cut, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def decide(tree: tuple | float, row: tuple) -> bool:
    while type(tree) is tuple:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


def trained_tree() -> tuple | float:
    table = np.array(LABELLED, dtype=float)
    return grow(table[:, :-1], table[:, -1])


def named_words(value: str) -> set[str]:
    """What the names of a class or id say: each whole, and of a compound the last part that is no HOLDER, unless a part before it negates it."""
    out: set[str] = set()
    for token in value.split():
        out.add(token)
        parts = [x for x in re.split(r"[^a-z0-9]+", token) if x]
        while len(parts) > 1 and parts[-1] in HOLDERS:
            parts.pop()
        if parts and not NEGATIONS & set(parts[:-1]):
            out.add(parts[-1])
    return out


def _region(name: str, attributes: str, furniture: int, article: int) -> tuple[int, int]:
    """What an element's content is (FREE, ...) and whether it is the article's (2 by tag or role, 1 by a word only), given the same of its parent."""
    words: set[str] = set()
    role = ""
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id"):
            words |= named_words(value)
        elif key == "role":
            role = value.strip()
        elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return FIRM, article
    if name in ("html", "body"):
        return FREE, article
    named = name in ARTICLE or role in ("main", "article")
    if furniture == FIRM or (furniture and not named):
        return furniture, article
    if named:  # an article in a form or in a frame that only a name makes furniture
        return FREE, 2
    if name in FURNITURE and name != "form" or role in FURNITURE_ROLES or words & FURNITURE_WORDS - FRAMES:
        return FIRM, article
    if not article and (name in OUTER or role in ("banner", "contentinfo") or words & OUTER_WORDS):
        return FIRM, article
    if words & FRAMES:
        return FRAME, article
    if name == "form":
        return FORM, article
    return FREE, article or int(bool(words & ARTICLE_WORDS))


class Block(NamedTuple):
    """A flat block: its text, words, words in links, furniture and article as of _region, the container it stands in, and whether it is a heading."""

    text: str
    words: int
    linked: int
    furniture: int
    article: int
    container: int
    heading: bool


def blocks(html: str) -> tuple[list[Block], list[int]]:
    """The flat blocks that have a word, in page order, and the container around each container (the page itself is 0, in -1)."""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    stack: list[tuple[str, int, int, int]] = []  # open elements
    around = [-1]
    state = (FREE, 0, 0)  # furniture, article, container
    begun, heading = state, False  # where the block began
    link = False
    at, n = 0, len(html)
    tags, endless = TAG, set()

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                linked = sum(len(p.split()) for p, is_link in pieces if is_link)
                out.append(Block(text, text.count(" ") + 1, linked, *begun, heading))
            pieces.clear()

    while at < n:
        found = tags.search(html, at)
        if found and found[4] == "":
            if tags is TAG:
                tags = BROKEN
                continue
            found = None  # no ">" is left: the rest is text
        plain = html[at : found.start()] if found else html[at:]
        # Furniture inside a line is left out of its block and doesn't end it.
        if plain and not (state[0] and stack and stack[-1][0] not in BLOCKS):
            if not pieces:
                begun = state
            pieces.append((unescape(plain) if "&" in plain else plain, link))
        if not found:
            break
        at = found.end()
        closing, name, attributes, _ = found.groups()
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
            heading = not closing and name in ("h1", "h2", "h3")
        if name == "br":
            pieces.append((" ", link))
        elif name == "a":
            link = not closing
        elif closing:
            if any(x[0] == name for x in stack):
                if name not in BLOCKS and any(x[0] in BLOCKS for x in stack[max(i for i, x in enumerate(stack) if x[0] == name) :]):
                    continue  # an inline element that ends outside the block it began in
                while stack.pop()[0] != name:
                    pass
                state = stack[-1][1:] if stack else (FREE, 0, 0)
                if name in BLOCKS:
                    link = False
        elif name in SILENT:
            end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            if not end:
                endless.add(name)
            # A head or select that is never closed must not take the page with it.
            at = end.end() if end else n if name in ("script", "style") else at
        elif name not in VOID and not attributes.endswith("/"):
            if name in BLOCKS and stack and stack[-1][0] == "p":  # a paragraph ends where the next block starts
                stack.pop()
                state = stack[-1][1:] if stack else (FREE, 0, 0)
            inside = _region(name, attributes, *state[:2]) if attributes or name in FURNITURE or name in OUTER or name in ARTICLE else state[:2]
            if name in BLOCKS or inside[0] != state[0]:
                container = state[2]
                if name in CONTAINERS:
                    container = len(around)
                    around.append(state[2])
                stack.append((name, *inside, container))
                state = (*inside, container)
    flush()
    return out, around


def main_container(found: list[Block], around: list[int]) -> set[int]:
    """The innermost container that holds most words of blocks that are neither furniture nor mostly links, and all containers in it.

    None if that is the page itself, unless the page has no link lists and no furniture at all.
    """
    words = [0] * len(around)
    for b in found:
        if not b.furniture and 2 * b.linked < b.words:
            words[b.container] += b.words
    for c in range(len(around) - 1, 0, -1):  # an inner container has a larger number
        words[around[c]] += words[c]
    # At most one container beside another holds more than half, so the holders are one inside the other.
    main = max((c for c in range(len(around)) if 2 * words[c] > words[0]), default=0)
    if not main and any(b.furniture or 2 * b.linked >= b.words for b in found):
        return set()
    inside = {main}
    for c in range(main + 1, len(around)):
        if around[c] in inside:
            inside.add(c)
    return inside


def features(html: str) -> tuple[list[Block], list[tuple]]:
    """The blocks of a page and the FEATURES of each."""
    found, around = blocks(html)
    # A form around most of the page's text, as some servers put it, is none of its furniture.
    plain = [b for b in found if 2 * b.linked < b.words]
    free = FREE if sum(b.words for b in plain if b.furniture == FORM) > sum(b.words for b in plain if b.furniture == FREE) else FORM
    found = [b._replace(furniture=free) if b.furniture == FORM else b for b in found]
    texts = [b for b in found if not b.furniture and 2 * b.linked < b.words]
    if any(b.article and not b.furniture for b in found) and 2 * sum(b.words for b in texts if b.article) >= sum(b.words for b in texts):
        has_region, in_region = True, [b.article > 0 for b in found]
    else:
        region = main_container(found, around)
        has_region, in_region = bool(region), [b.container in region for b in found]
    for i in range(len(found) - 2, -1, -1):  # a heading that stands right above the region belongs to it
        in_region[i] = in_region[i] or has_region and found[i].heading and in_region[i + 1]
    near = [(0, 0.0), *((b.words, b.linked / b.words) for b in found), (0, 0.0)]
    # An article by tag or role outside the region that holds most counts as the region of a page that has none.
    named = [b.article == 2 and not x for b, x in zip(found, in_region, strict=True)]
    return found, [(int(b.furniture > 0), int(x or named[i]), int(has_region and not named[i]), *near[i + 1], *near[i], *near[i + 2]) for i, (b, x) in enumerate(zip(found, in_region, strict=True))]


def main_text(html: str, tree: tuple | float) -> tuple[str, int, int]:
    """The kept blocks joined by blank lines, how many blocks there are and how many are kept."""
    found, rows = features(html)
    kept = [b.text for b, row in zip(found, rows, strict=True) if decide(tree, row)]
    return "\n\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars, n_blocks, n_kept.

    Whole pages are read; null html, and html without main text, give an empty text. Repeated rows are extracted each.
    Inline elements don't end a block; those that are named as furniture or hidden are left out of it. Other columns are
    ignored, whatever their names.
    """
    tree = trained_tree()
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h.as_py(), tree) for h in batch.column(2)]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([len(x[0]) for x in found], pa.int64())]
            columns += [pa.array([x[i] for x in found], pa.int32()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int")
