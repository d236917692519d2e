"""What selectors find on catalogue pages: HTM-01, HTM-02, HTM-05. A page becomes an element tree inside an Arrow UDF.

Selectors are of the usual form: tag, .class, #id, [attribute], [attribute=value], [attribute*=part], :has(...) and
:not(...) of one element, descendants by a blank, children by `>`, alternatives by a comma.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What an opening tag closes if it is open, and the element beyond which it closes nothing.
CLOSES = {"tr": ({"tr", "td", "th"}, "table"), "td": ({"td", "th"}, "tr"), "th": ({"td", "th"}, "tr"), "li": ({"li"}, "ul ol"), "dt": ({"dt", "dd"}, "dl"), "dd": ({"dt", "dd"}, "dl"), "option": ({"option"}, "select"), "p": ({"p"}, "div td th li body")}


#: Elements whose content is no markup, or not only; pages with them, comments or stray `<` are read by the library's parser.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
#: A tag that is read the same way wherever it stands.
_TAG = re.compile(r"""<(?:/[a-zA-Z][a-zA-Z0-9]*|[a-zA-Z][a-zA-Z0-9]*(?:[ \t\r\n]+[a-zA-Z][a-zA-Z0-9_-]*(?:="[^"<>]*"|='[^'<>]*'|=[^\s"'<>=`/]+(?=[\s>]))?)*[ \t\r\n]*/?)>""")
_PARTS = re.compile("(<[^<>]*>)")
#: Different tags that a worker remembers; when it has more it forgets them.
REMEMBERED = 20_000


class Mark:
    """An opening tag as it is written: what all elements with it have in common, and which tests they pass."""

    __slots__ = ("attrs", "bound", "closes", "passed", "tag", "void")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.void, self.passed = tag, attrs, tag in VOID, {}
        self.closes, bound = CLOSES.get(tag, ((), ""))
        self.bound = bound.split()


class Element:
    """One element: tag, attributes, children (elements and texts) and parent.

    nodes and all list what stands on the page, and its elements, in page order; what stands in this element is a range of both.
    """

    __slots__ = ("all", "all_at", "all_end", "at", "children", "end", "mark", "nodes", "parent")

    def __init__(self, mark: Mark, parent: Element | None, nodes: list[Element | str], elements: list[Element]):
        self.mark = mark
        self.parent = parent
        self.children = []
        self.nodes = nodes
        self.all = elements
        self.at = len(nodes) + 1
        self.all_at = len(elements) + 1
        self.end = self.all_end = None

    @property
    def tag(self) -> str:
        return self.mark.tag

    @property
    def attrs(self) -> dict[str, str]:
        return self.mark.attrs

    def walk(self, without: Element | None = None) -> list[Element | str]:
        """What stands in this element, in page order, but for one element."""
        if without is None or not self.at <= without.at - 1 < (len(self.nodes) if self.end is None else self.end):
            return self.nodes[self.at : self.end]
        return self.nodes[self.at : without.at - 1] + ([] if without.end is None else self.nodes[without.end : self.end])

    def elements(self, tag: str | None = None) -> list[Element]:
        found = self.all[self.all_at : self.all_end]
        return found if tag is None else [x for x in found if x.mark.tag == tag]

    def up(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent

    def text(self, without: Element | None = None) -> str:
        """Its text, br as a new line, runs of white space within a line as one blank; without: a part left out."""
        said = "".join([x if type(x) is str else "\n" for x in self.walk(without) if type(x) is str or x.mark.tag == "br"])
        if "\n" not in said:
            return " ".join(said.split())
        return "\n".join([" ".join(x.split()) for x in said.split("\n")]).strip()

    def stripped(self) -> str:
        """Its texts, each without white space around it, one behind the other."""
        return "".join([x.strip() for x in self.walk() if type(x) is str])

    def alts(self) -> list[str]:
        return [x.attrs["alt"] for x in self.elements("img") if x.attrs.get("alt")]


class _Builder:
    """The tree of a page, by its tags and texts one after the other."""

    def __init__(self):
        self.nodes: list[Element | str] = []
        self.all: list[Element] = []
        self.root = self.at = Element(Mark("", {}), None, self.nodes, self.all)
        self.root.at = self.root.all_at = 0

    def leave(self, until: Element) -> None:
        """Close what is open below an element."""
        at, n, m = self.at, len(self.nodes), len(self.all)
        while at is not until:
            at.end, at.all_end = n, m
            at = at.parent
        self.at = until

    def start(self, mark: Mark) -> None:
        if mark.closes:
            at, found = self.at, None
            while at.parent is not None and at.mark.tag not in mark.bound:
                found = at if at.mark.tag in mark.closes else found
                at = at.parent
            if found is not None:
                self.leave(found.parent)
        parent = self.at
        new = Element(mark, parent, self.nodes, self.all)
        parent.children.append(new)
        self.nodes.append(new)
        self.all.append(new)
        if mark.void:
            new.end, new.all_end = new.at, new.all_at
        else:
            self.at = new

    def close(self, tag: str) -> None:
        at = self.at
        while at is not None:
            if at.mark.tag == tag:
                self.leave(at.parent or at)
                return
            if at.mark.tag == "table" and tag in ("td", "th", "tr"):
                return  # of a table around this one, which is still open
            at = at.parent

    def say(self, text: str) -> None:
        if self.at.mark.tag not in ("script", "style"):
            self.at.children.append(text)
            self.nodes.append(text)


class _Reader(HTMLParser):
    """Tags and texts as the library's parser reads them, for a builder."""

    def __init__(self, builder: _Builder):
        super().__init__(convert_charrefs=True)
        self.builder = builder

    def handle_starttag(self, tag, attrs):
        self.builder.start(Mark(tag, {k: v or "" for k, v in attrs}))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.builder.close(tag)

    def handle_endtag(self, tag):
        self.builder.close(tag)

    def handle_data(self, data):
        self.builder.say(data)


def _read(html: str) -> _Builder:
    builder = _Builder()
    reader = _Reader(builder)
    reader.feed(html)
    reader.close()
    return builder


@lru_cache(REMEMBERED)
def _mark(written: str) -> tuple[Mark | None, str | None]:
    """What a tag opens and what it closes; nothing at all for one that only the library's parser reads rightly."""
    if not _TAG.fullmatch(written):
        return None, None
    if written[1] == "/":
        tag = written[2:-1].lower()
        return None, None if tag in RAW else tag
    mark = _read(written).all[0].mark
    return (None, None) if mark.tag in RAW else (mark, mark.tag if written.endswith("/>") and not mark.void else None)


def tree(html: str) -> Element:
    builder = _Builder()
    start, close, say = builder.start, builder.close, builder.say
    parts = _PARTS.split(html)
    for text, written in zip(parts[::2], [*parts[1::2], ""], strict=True):
        if text:
            if "<" in text:
                return _read(html).root
            say(unescape(text) if "&" in text else text)
        if written:
            opened, closed = _mark(written)
            if opened is not None:
                start(opened)
            elif closed is None:
                return _read(html).root
            if closed is not None:
                close(closed)
    return builder.root


Test = Callable[[Element], bool]
_PIECE = re.compile(r"""([\w-]+|\*)|\.([\w-]+)|\#([\w-]+)|\[([\w-]+)(?:(\*?=)["']?([^\]"']*)["']?)?\]|:(has|not)\(((?:[^()"']|"[^"]*"|'[^']*')*)\)""")


@lru_cache(256)
def one(selector: str) -> Test:
    """The test of one element: what stands between blanks in a selector. What its tag says is tested once a tag."""
    tests: list[Callable[[Mark], bool]] = []
    held: list[Test] = []
    at = 0
    while at < len(selector):
        if not (m := _PIECE.match(selector, at)):
            raise ValueError(f"no selector: {selector}")
        tag, cls, ident, attr, how, value, kind, inner = m.groups()
        at = m.end()
        if tag and tag != "*":
            tests.append(lambda e, t=tag.lower(): e.tag == t)
        elif cls:
            tests.append(lambda e, c=cls: c in e.attrs.get("class", "").split())
        elif ident:
            tests.append(lambda e, i=ident: e.attrs.get("id") == i)
        elif attr:
            tests.append(lambda e, a=attr.lower(), h=how, v=value: a in e.attrs and (h is None or (e.attrs[a] == v if h == "=" else v in e.attrs[a])))
        elif kind:
            part = one(inner.strip())
            held.append((lambda e, t=part: any(map(t, e.elements()))) if kind == "has" else (lambda e, t=part: not t(e)))

    def test(element: Element) -> bool:
        passed = element.mark.passed
        if selector in passed:
            found = passed[selector]
        else:
            found = passed[selector] = all(t(element.mark) for t in tests)
        return found and (not held or all(t(element) for t in held))

    return test


@lru_cache(256)
def chain(selector: str) -> tuple[tuple[tuple[str, Test], ...], ...]:
    """Alternatives, each the steps from the wanted element outwards: how the step meets the one before, and its test."""
    found = []
    for way in re.split(r",(?![^(\[]*[)\]])", selector):
        steps = re.findall(r"(>?)\s*((?:[^\s>\[(]|\[[^\]]*\]|\((?:[^()\"']|\"[^\"]*\"|'[^']*')*\))+)", way)
        if not steps:
            raise ValueError(f"no selector: {selector}")
        hows = [how for how, _ in steps[1:]] + [""]
        found.append(tuple((how, one(test)) for how, (_, test) in reversed(list(zip(hows, steps, strict=True)))))
    return tuple(found)


def _meets(element: Element, steps: tuple[tuple[str, Test], ...], top: Element) -> bool:
    if not steps[0][1](element):
        return False
    if len(steps) == 1:
        return True
    for x in element.up():
        if x is top:
            return False
        if _meets(x, steps[1:], top):
            return True
        if steps[1][0] == ">":
            return False
    return False


def select(element: Element, selector: str) -> list[Element]:
    """The elements below this one that a selector means, in page order."""
    ways = chain(selector)
    if len(ways) > 1:
        return [x for x in element.elements() if any(_meets(x, steps, element) for steps in ways)]
    test = ways[0][0][1]
    found = [x for x in element.elements() if test(x)]
    return found if len(ways[0]) == 1 else [x for x in found if _meets(x, ways[0], element)]


def first(element: Element, selector: str) -> Element | None:
    ways = chain(selector)
    if len(ways) == len(ways[0]) == 1:
        test = ways[0][0][1]
        for x in element.elements():
            if test(x):
                return x
        return None
    return next((x for x in element.elements() if any(_meets(x, steps, element) for steps in ways)), None)


def of_pages(read: Callable[[str], object], kind: pa.DataType) -> Callable[[Column], Column]:
    """A UDF over Arrow batches that reads every page; a null page is null."""

    @F.arrow_udf(from_arrow_type(kind))
    def parse(pages: pa.Array) -> pa.Array:
        return pa.array([None if h is None else read(h) for h in pages.to_pylist()], kind)

    return parse


class Boxes(NamedTuple):
    """How a page says its fields: the boxes, and the label and value in each. No value: what a box says besides its label.

    each: a box holds many labels and as many values, which meet by position; else the first of both count. joined: texts
    are put together without what separates them.
    """

    box: str
    label: str
    value: str | None = None
    each: bool = False
    joined: bool = False


def boxed_values(page: Element, layout: Boxes) -> dict[str, tuple[str, list[str]]]:
    """HTM-02: label -> (text, alts of images); of boxes with the same label the last counts, boxes without a label are left out."""
    out: dict[str, tuple[str, list[str]]] = {}
    said = Element.stripped if layout.joined else Element.text
    for box in select(page, layout.box):
        labels = select(box, layout.label)
        values = select(box, layout.value) if layout.value else [box] * len(labels)
        for label, value in list(zip(labels, values, strict=False))[: None if layout.each else 1]:
            if name := said(label):
                text = value.text(label) if layout.value is None else said(value)
                out[name] = text, value.alts()
        if labels and not values and not layout.each and (name := said(labels[0])):
            out[name] = "", []
    return out


def boxes(c: Column, *layouts: Boxes) -> Column:
    """HTM-02: map of label to (text, alts) by one layout or several, the last one that has a label counting; a null page is null."""

    def one_page(html: str) -> list[tuple[str, dict]]:
        page, out = tree(html), {}
        for layout in layouts:
            out |= boxed_values(page, layout)
        return [(k, {"text": t, "alts": a}) for k, (t, a) in out.items()]

    return of_pages(one_page, pa.map_(pa.string(), pa.struct({"text": pa.string(), "alts": pa.list_(pa.string())})))(c)


def cells(row: Element) -> list[Element]:
    """The cells of a row itself, not those of tables in them."""
    return [x for x in row.children if type(x) is Element and x.mark.tag in ("td", "th")]


def label_rows(html: str) -> dict[str, str]:
    """HTM-01: labels and values of rows with two cells, or four (two pairs), and of dt with the dd after it; the last wins.

    Rows of a table inside a cell are rows of their own, and their text belongs to the outer cell too.
    """
    page, out = tree(html), {}
    for row in page.elements("tr"):
        own = cells(row)
        if len(own) in (2, 4):
            out |= {a.text(): b.text() for a, b in zip(own[::2], own[1::2], strict=True)}
    label = None
    for x in (e for e in page.elements() if e.tag in ("dt", "dd")):
        if x.tag == "dt":
            label = x.text()
        elif label is not None:
            out[label] = x.text()
            label = None
    return {k: v for k, v in out.items() if k}


def header_names(header: Element) -> tuple[str, str]:
    """Texts in front of the first br as the English name, the last `small` as the Japanese one: of ruby its rb, of images their alt."""
    english, japanese, after = [], "", False
    for x in header.children:
        if isinstance(x, str):
            english += [x.strip()] if x.strip() and not after else []
        elif x.tag == "br":
            after = True
        elif x.tag == "small":
            parts = []
            for y in x.children:
                if isinstance(y, str):
                    parts.append(y.strip())
                else:
                    parts += [rb.stripped() for rb in y.elements("rb")] if y.tag == "ruby" else [_with_alts(y)]
            japanese = "".join(parts)
        elif said := _with_alts(x):
            english.append(said)
    return " ".join(english).strip(), japanese


def _with_alts(element: Element) -> str:
    if element.tag == "img":
        return element.attrs.get("alt", "").strip()
    return "".join(x.strip() if isinstance(x, str) else x.attrs.get("alt", "").strip() for x in element.walk() if isinstance(x, str) or x.tag == "img")


def header_sections(html: str, names: tuple[str, ...], table: str = "table", header: str = "div[style*='color: white']:has(br)") -> list[dict[str, str]]:
    """HTM-05: a section for each header row of the first such table: name, name_jp and the fields of names that its rows have.

    A header row is one with an element that `header` selects; on pages without any, one with a single cell that says
    something (which then has no name_jp). A row's label counts for the first of names that it holds; of a
    civilization the first link counts. Every header opens one section, however many rows it has.
    """
    page = tree(html)
    top = first(page, table) or page
    rows = list(top.elements("tr"))
    heads = [first(row, header) for row in rows]
    styled = any(heads)
    out: list[dict[str, str]] = []
    for row, head in zip(rows, heads, strict=True):
        own = cells(row)
        if head is not None:
            english, japanese = header_names(head)
            out.append({"name": english, "name_jp": japanese})
        elif not styled and len(own) == 1 and own[0].text():
            out.append({"name": own[0].text()})
        elif len(own) >= 2 and out:
            label = own[0].text()
            field = next((n for n in names if n in label), None)
            if field:
                link = first(own[1], "a") if field == "Civilization" else None
                out[-1][field] = (link or own[1]).text()
    return out


def sections(c: Column, names: tuple[str, ...], table: str = "table", header: str = "div[style*='color: white']:has(br)") -> Column:
    return of_pages(lambda h: [list(x.items()) for x in header_sections(h, names, table, header)], pa.list_(pa.map_(pa.string(), pa.string())))(c)


def texts_of(c: Column, selector: str) -> Column:
    """The texts of the elements that a selector means, in page order."""

    return of_pages(lambda h: [x.text() for x in select(tree(h), selector)], pa.list_(pa.string()))(c)
