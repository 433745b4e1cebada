"""A forgiving HTML reader that yields block nodes, their features and their text."""

from __future__ import annotations

import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of an article.
SILENT = frozenset("head title script style noscript template form button select option textarea label iframe object svg math canvas audio video datalist".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "xmp"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split())
#: A start tag ends open elements of these kinds.
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"}, "thead": {"tr", "td", "th", "p"}, "tbody": {"tr", "td", "th", "thead", "p"}, "tfoot": {"tr", "td", "th", "tbody", "p"}, "body": {"head"},
}
#: An end is not looked for beyond these.
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}

#: Comments, declarations, tags.  A quoted value may hold ">"; a quote without its partner is an ordinary sign.  What is open at the
#: end of the page swallows the rest, so no part of the page is looked at for a token again.
_TOKEN = re.compile(r"<!--(?:[^-]++|-(?!->))*+(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|data-label)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
#: Numbers of so many digits name no character, and are too long to read as one.
_HUGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_NAME = re.compile(r"[a-z]+")


#: Elements that say what they hold, and names that do not.
_MEANT = frozenset(("nav", "header", "footer", "aside", "article", "main", "dialog", "menu"))
_NEUTRAL = frozenset("wrapper wrap container page layout site root row col column inner outer grid app".split())
_REGIONS = frozenset(("nav", "header", "footer", "aside", "article", "main", "section", "table", "ul", "ol", "figure", "dialog", "menu"))


class Node:
    __slots__ = ("tag", "parent", "names", "label", "silent", "own", "linked", "total", "total_linked", "children", "anc", "plain")

    def __init__(self, tag, parent, names=(), label=None, silent=False):
        self.tag, self.parent, self.names, self.label, self.silent = tag, parent, names, label, silent
        self.own = self.linked = self.total = self.total_linked = self.children = 0
        self.anc = frozenset()
        self.plain = True


def unescape(raw: str) -> str:
    """Text with its character references decoded; numbers beyond all characters are the replacement character."""
    return html.unescape(_HUGE.sub("\ufffd", raw)) if "&" in raw else raw


class _Stack:
    """Open elements, with the places of each tag, so that the innermost one of some tags is found at once."""

    def __init__(self):
        self.open: list[tuple[str, int]] = [("html", 0)]  # (tag, its node)
        self.at: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, tag: str, node: int) -> None:
        self.at.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.blocks.append(len(self.open))
        self.open.append((tag, node))

    def find(self, tags, limit=()) -> int:
        """Place of the innermost of the tags, 0 if there is none or an element of ``limit`` lies within it."""
        last = lambda names: max((self.at[t][-1] for t in names if self.at.get(t)), default=0)
        found = last(tags)
        return found if found and found > last(limit) else 0

    def cut(self, i: int) -> list[tuple[str, int]]:
        """Closes the elements from place i on."""
        gone = self.open[i:]
        for tag, _ in gone:
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
        del self.open[i:]
        return gone


def parse(page: str, labelled: bool = False) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order, parents first, and the pieces of text as (node, text).

    Inline elements belong to their block unless they carry a name.  Each piece begins a block where its text starts
    with a line feed; ``br`` counts as white space.  Time grows with the length of the page, however it is malformed.
    ``labelled`` reads data-label, which only pages for training have a meaning for.
    """
    nodes = [Node("html", -1)]
    stack = _Stack()
    pieces: list[tuple[int, str]] = []
    links = 0
    at, n = 0, len(page)

    def text(raw: str) -> None:
        k = stack.open[-1][1]
        node = nodes[k]
        if node.silent or not raw:
            return
        raw = unescape(raw)
        pieces.append((k, raw))
        size = len(raw.strip())
        node.own += size
        if links:
            node.linked += size

    def pop(i: int) -> None:
        nonlocal links
        for tag, k in stack.cut(i):
            if tag == "a":
                links -= 1
            if tag not in INLINE and not nodes[k].silent:
                pieces.append((k, "\n"))

    find = stack.find
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                pieces.append((stack.open[-1][1], "\n"))
            elif i := find((tag,), () if tag in INLINE else SCOPE.get(tag, ())):
                if tag not in INLINE or stack.blocks[-1] < i:
                    pop(i)
            continue
        if tag not in INLINE and (i := find(("p",), ("table", "button", "article", "section", "div", "body"))) and tag not in CLOSES:
            pop(i)
        if tag in CLOSES:
            while i := find(CLOSES[tag], SCOPE.get(tag, ())):
                pop(i)
        if tag == "html" or tag == "body" and stack.at.get(tag):
            continue
        names, label = (), None
        if m[3]:
            found = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(m[3])}
            names = tuple(_NAME.findall(" ".join(found.get(x, "") for x in ("class", "id", "role")).lower()))
            label = found.get("data-label") if labelled else None
        k = stack.open[-1][1]
        if tag not in INLINE:
            pieces.append((k, "\n"))
        elif tag == "br":
            pieces.append((k, "\n"))
        if tag in VOID:
            continue
        if tag not in INLINE or names or label:
            parent = nodes[k]
            node = Node(tag, k, names, label if label is not None else parent.label, parent.silent or tag in SILENT)
            node.anc = parent.anc | {parent.tag} if parent.tag in _REGIONS else parent.anc
            node.plain = parent.plain and tag not in _MEANT and _NEUTRAL.issuperset(names)
            parent.children += 1
            nodes.append(node)
            k = len(nodes) - 1
        if m[3].endswith("/") and tag in ("svg", "path"):
            continue
        stack.push(tag, k)
        if tag == "a":
            links += 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            if not nodes[k].silent:
                text(page[at : end.start() if end else n])
            at = end.end() if end else n
            pop(len(stack.open) - 1)
    for k in range(len(nodes) - 1, 0, -1):
        x = nodes[k]
        x.total += x.own
        x.total_linked += x.linked
        nodes[x.parent].total += x.total
        nodes[x.parent].total_linked += x.total_linked
    nodes[0].total += nodes[0].own
    nodes[0].total_linked += nodes[0].linked
    return nodes, pieces




def _step(n: int) -> int:
    return 0 if n == 0 else 1 if n < 25 else 2 if n < 100 else 3 if n < 400 else 4


def features(x: Node) -> list[str]:
    own_share = 4 * x.linked // x.own if x.own else 9
    all_share = 4 * x.total_linked // x.total if x.total else 9
    out = [f"tag {x.tag}", f"own {_step(x.own)} {own_share}", f"all {_step(x.total)} {all_share}", f"links {all_share}"]
    if x.plain:  # neither it nor what it stands in says what it is
        out += [f"plain {x.tag}", f"plain {_step(x.own)} {own_share}", f"plain all {_step(x.total)} {all_share}"]
    out += [f"name {t}" for t in x.names]
    for t in x.anc:
        out += [f"in {t}", f"in {t} {x.tag} {own_share}"] if t in _MEANT else [f"in {t}"]
    return out


def text_of(pieces: list[tuple[int, str]], keep) -> str:
    """Text of the kept nodes: white space is one space, blocks are joined by one space."""
    return " ".join("".join(t if keep[k] else "\n" for k, t in pieces).split())
