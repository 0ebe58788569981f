"""A small document tree on the standard parser, and the selectors that captured pages need."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from operator import attrgetter

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BOUNDARY = frozenset("table ul ol dl select body html div section article".split())
SILENT = frozenset(("script", "style", "noscript", "template"))
BLOCKS = frozenset("p div li tr td th h1 h2 h3 h4 h5 h6 br ul ol dl dt dd table section article header footer nav form option hr pre address".split())


class Node:
    """An element. Nodes are numbered in document order (`at`), so those below one are the numbers from its own to its last one's;
    `index` lists a document's nodes by tag and by class (".name"). A tree isn't changed once parse() returned it, so texts and
    lines are computed once."""

    __slots__ = ("tag", "attrs", "children", "parent", "index", "at", "classes", "_text", "_lines")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.index: dict[str, list[Node]] = {"": []} if parent is None else parent.index
        self.classes = (attrs.get("class") or "").split()
        self._text: str | None = None
        self._lines: list[str] | None = None
        every = self.index[""]
        self.at = len(every)
        for key in ("", tag, *("." + c for c in dict.fromkeys(self.classes))) if tag else ("",):
            self.index.setdefault(key, []).append(self)

    def last(self) -> int:
        """The number of the last node below, or its own."""
        n = self
        while (child := next((c for c in reversed(n.children) if isinstance(c, Node)), None)) is not None:
            n = child
        return n.at

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def strings(self, silent: frozenset[str] = SILENT) -> Iterator[str]:
        stack: list[Node | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in silent:
                stack.extend(reversed(n.children))

    def text(self) -> str:
        """Stripped strings joined by blanks."""
        if self._text is None:
            self._text = " ".join(" ".join(self.strings()).split())
        return self._text

    def lines(self) -> list[str]:
        """Lines as block elements divide them; tabs stand between table cells."""
        if self._lines is None:
            self._lines = self._divided()
        return self._lines

    def _divided(self) -> list[str]:
        out: list[str] = []

        def visit(n: Node) -> None:
            for c in n.children:
                if isinstance(c, str):
                    out.append(re.sub(r"[ \r\n]+", " ", c) if n.tag != "pre" else c)
                elif c.tag not in SILENT:
                    mark = "\t" if c.tag in ("td", "th") else "\n" if c.tag in BLOCKS else ""
                    out.append(mark)
                    visit(c)
                    out.append("" if mark == "\t" else mark)

        visit(self)
        return [s for line in "".join(out).split("\n") if (s := re.sub(r" *\t *", "\t", line).strip(" \t"))]

    def select(self, selector: str) -> list[Node]:
        """Descendants that match any of the comma-separated selectors, in document order."""
        found: dict[int, Node] = {}
        begin, end, several = self.at, -1, 0
        for key, chain in _chains(selector):
            near = self.index.get(key)
            if not near:
                continue
            if end < 0:
                end = len(self.index[""]) if self.parent is None else self.last()
            several += 1
            for n in near[bisect_right(near, begin, key=_number) :] if begin else near:
                if n.at > end:
                    break
                if n is not self and n.at not in found and _matches(n, chain, self):
                    found[n.at] = n
        return [found[i] for i in sorted(found)] if several > 1 else list(found.values())

    def first(self, selector: str) -> Node | None:
        return next(iter(self.select(selector)), None)

    def matches(self, selector: str) -> bool:
        return any(_matches(self, chain, None) for _, chain in _chains(selector))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES:
            n = self.at
            while n.parent is not None and n.tag not in BOUNDARY:
                if n.tag in CLOSES[tag]:
                    self.at = n.parent
                    if tag != "tr" or n.tag == "tr":
                        break
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent or self.root

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"(?P<tag>\*|[A-Za-z][\w-]*)|#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w:-]+)(?:(?P<op>[*^$~|]?=)[\"']?(?P<val>[^\"'\]]*)[\"']?)?\]|:nth-(?:child|of-type)\((?P<nth>\d+)\)")
_cache: dict[str, list] = {}


def _parse(selector: str) -> list:
    """[(combinator, compound)] from right to left."""
    s = selector.strip()
    if s not in _cache:
        parts = re.findall(r"\s*([>+~])\s*|(\s+)|((?:\[[^\]]*\]|:[\w-]+(?:\([^)]*\))?|[^\s>+~\[:])+)", s)
        chain, comb = [], " "
        for mark, blank, compound in parts:
            if mark:
                comb = mark
            elif compound:
                chain.append((comb, [m.groupdict() for m in _SIMPLE.finditer(compound)]))
                comb = " "
        _cache[s] = chain[::-1]
    return _cache[s]


_listed: dict[str, list] = {}
_number = attrgetter("at")


def _chains(selector: str) -> list[tuple[str, list]]:
    """Each of the comma-separated selectors, and the key of the index under which all that can match it are listed: their tag,
    else their class, else all nodes."""
    if selector not in _listed:
        chains = [_parse(s) for s in selector.split(",") if s.strip()]
        keys = [([c["tag"] for c in chain[0][1] if c["tag"] and c["tag"] != "*"] + ["." + c["cls"] for c in chain[0][1] if c["cls"]] + [""])[0] if chain else "" for chain in chains]
        _listed[selector] = list(zip(keys, chains, strict=True))
    return _listed[selector]


def _simple(n: Node, compound: list[dict]) -> bool:
    for c in compound:
        if c["tag"] and c["tag"] not in ("*", n.tag):
            return False
        if c["id"] and n.attrs.get("id") != c["id"] or c["cls"] and c["cls"] not in n.classes:
            return False
        if c["attr"]:
            v = n.attrs.get(c["attr"].lower())
            if v is None:
                return False
            op, want = c["op"], c["val"]
            ok = {None: True, "=": v == want, "*=": bool(want) and want in (v or ""), "^=": bool(want) and v.startswith(want or "\0"), "$=": bool(want) and v.endswith(want or "\0"), "~=": want in v.split(), "|=": v == want or v.startswith(f"{want}-")}[op or None]
            if not ok:
                return False
        if c["nth"]:
            same = [x for x in n.parent.children if isinstance(x, Node)] if n.parent else [n]
            if len(same) < int(c["nth"]) or same[int(c["nth"]) - 1] is not n:
                return False
    return bool(n.tag)


def _matches(n: Node, chain: list, scope: Node | None, i: int = 0) -> bool:
    if not chain or not _simple(n, chain[i][1]):
        return False
    if i + 1 == len(chain):
        return True
    comb, up = chain[i][0], n.parent
    if comb == ">":
        return up is not None and _matches(up, chain, scope, i + 1)
    if comb in "+~":
        before = [c for c in (up.children if up else []) if isinstance(c, Node)]
        before = before[: before.index(n)]
        return any(_matches(x, chain, scope, i + 1) for x in (before[-1:] if comb == "+" else before))
    while up is not None:
        if _matches(up, chain, scope, i + 1):
            return True
        up = up.parent
    return False


def value(node: Node, selector: str) -> str | None:
    """Text of the first match, or an attribute with ::attr(name); an empty selector is the node itself."""
    css, _, attr = selector.partition("::attr(")
    css = css.strip()
    found = node if not css or node.matches(css) else node.first(css)
    if found is None:
        return None
    return found.attrs.get(attr.rstrip(")").strip()) if attr else found.text() or None
