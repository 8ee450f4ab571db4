"""Elements of a page by structure: a small tree from the standard library's HTML parser.

Nesting, comments, scripts and character references cannot be told apart by patterns, so this part
runs as Arrow-batched Python; what is done with the elements stays in columns.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without an end tag, and which open elements a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset(("script", "style"))
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "tbody": ({"thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
BLOCKS = frozenset("p div ul ol li table h1 h2 h3 h4 h5 h6 section article header footer nav pre form blockquote".split())

_STEP = re.compile(r"\s*(>?)\s*([\w-]*)((?:[#.][\w-]+|\[[\w-]+(?:=[^\]]*)?\])*)")
_TEST = re.compile(r"([#.])([\w-]+)|\[([\w-]+)(?:=\"?([^\]\"]*)\"?)?\]")


class Element:
    __slots__ = ("tag", "attributes", "parent", "start", "stop", "parts")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None, start: int) -> None:
        self.tag, self.attributes, self.parent, self.start, self.stop = tag, attributes, parent, start, start
        self.parts: list[str | Element] = []

    def text(self) -> str:
        """Text of the element and all in it, white space collapsed."""
        found: list[str] = []
        stack: list[str | Element] = [self]
        while stack:
            part = stack.pop()
            if isinstance(part, str):
                found.append(part)
            elif part.tag == "br":
                found.append(" ")
            elif part.tag not in UNSEEN or part is self:
                stack.extend(reversed(part.parts))
        return " ".join("".join(found).split())

    def children(self, *tags: str) -> list[Element]:
        return [p for p in self.parts if isinstance(p, Element) and p.tag in tags]


class Tree(HTMLParser):
    """All elements of a page in order."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.page = page
        self.lines = [0, *(m.end() for m in re.finditer("\n", page))]
        self.root = self.open = Element("", {}, None, 0)
        self.elements: list[Element] = []
        self.feed(page)
        self.close()
        while self.open is not self.root:
            self._end(len(page))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _end(self, at: int) -> None:
        self.open.stop = at
        self.open = self.open.parent

    def _end_up_to(self, tags: set[str] | frozenset[str], within: set[str] | frozenset[str], at: int) -> None:
        inner, e = None, self.open
        while e is not self.root and e.tag not in within:
            if e.tag in tags:
                inner = e
                break
            e = e.parent
        if inner is not None:
            while self.open is not inner:
                self._end(at)
            self._end(at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = self._at()
        if tag in ENDS:
            self._end_up_to(*ENDS[tag], at)
        elif tag in BLOCKS:
            self._end_up_to({"p"}, BLOCKS - {"p"}, at)
        element = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.open, at + len(self.get_starttag_text() or ""))
        self.open.parts.append(element)
        self.elements.append(element)
        if tag not in VOID:
            self.open = element

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        e = self.open
        while e is not self.root and e.tag != tag:
            e = e.parent
        if e is not self.root:
            at = self._at()
            while self.open is not e:
                self._end(at)
            self._end(at)

    def handle_data(self, data: str) -> None:
        self.open.parts.append(data)


def compiled(selector: str) -> list[tuple[bool, str, list[tuple]]]:
    """Steps of a selector such as ``div#main > ul.list li``: (child of the one before, tag, tests)."""
    steps, at = [], 0
    selector = selector.strip()
    while at < len(selector):
        m = _STEP.match(selector, at)
        if m is None or m.end() == at or not (m[2] or m[3]):
            raise ValueError(f"selector not understood: {selector}")
        tests = [(kind or "[", name or key, value) for kind, name, key, value in _TEST.findall(m[3])]
        steps.append((m[1] == ">", m[2].lower(), [(k, n, v if k == "[" and f"{n}=" in m[3] else None) for k, n, v in tests]))
        at = m.end()
    return steps


def _fits(e: Element, tag: str, tests: list[tuple]) -> bool:
    if tag and e.tag != tag:
        return False
    for kind, name, value in tests:
        if kind == "#" and e.attributes.get("id") != name:
            return False
        if kind == "." and name not in e.attributes.get("class", "").split():
            return False
        if kind == "[" and (name not in e.attributes or value is not None and e.attributes[name] != value):
            return False
    return True


def _ends_at(e: Element, steps: list[tuple], i: int) -> bool:
    """Whether ``e`` meets step ``i`` with the steps before it above."""
    child, tag, tests = steps[i]
    if not _fits(e, tag, tests):
        return False
    if i == 0:
        return True
    above = e.parent
    while above is not None and above.tag:
        if _ends_at(above, steps, i - 1):
            return True
        if child:
            return False
        above = above.parent
    return False


def find(tree: Tree, steps: list[tuple]) -> list[Element]:
    return [e for e in tree.elements if _ends_at(e, steps, len(steps) - 1)]

