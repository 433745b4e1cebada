"""HTML functions: links by region, Markdown and titles, as UDFs of small batches over a reader of linear time."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as c
from ..session import ship
from .text import col, squeeze

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("p div section article main table tr ul ol blockquote pre body html h1 h2 h3 h4 h5 h6 li dl dt dd figure".split())
LINKS = "array<struct<region:string,region_rank:int,pos:int,href:string,anchor_text:string>>"


_REGION_TAGS = ("nav", "header", "footer")


#: Comments, declarations, tags.  A quoted value may hold ">"; what is open at the end of the page swallows the rest, so no part
#: of the page is looked at for a token again.
_TOKEN = re.compile(
    r"<!--(?:[^-]++|-(?!->))*+(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}
#: Numbers of so many digits name no character, and are too long to read as one.
_HUGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")


def _plain(text: str) -> str:
    return unescape(_HUGE.sub("\ufffd", text)) if "&" in text else text


class _Reader:
    """Start tags, end tags and text of a page in order, in time that grows with its length, however malformed it is."""

    def feed(self, page: str | None) -> None:
        page, at = page or "", 0
        while at < len(page):
            m = _TOKEN.search(page, at)
            if not m:
                self.handle_data(_plain(page[at:]))
                return
            if m.start() > at:
                self.handle_data(_plain(page[at : m.start()]))
            at = m.end()
            if not m[2] or not m[4]:
                continue
            tag = m[2].lower()
            if m[1]:
                self.handle_endtag(tag)
                continue
            found: dict[str, str | None] = {}
            for a in _ATTR.finditer(m[3]):
                value = next((v for v in a.groups()[1:] if v is not None), None)
                found.setdefault(a[1].lower(), value and _plain(value))
            self.handle_starttag(tag, found)
            if m[3].endswith("/"):
                self.handle_endtag(tag)
            elif tag in _RAW:
                end = _RAW[tag].search(page, at)
                stop = end.start() if end else len(page)
                if stop > at:
                    self.handle_data(page[at:stop])
                at = stop

    def handle_starttag(self, tag: str, attrs: dict) -> None: ...

    def handle_endtag(self, tag: str) -> None: ...

    def handle_data(self, data: str) -> None: ...


class _Links(_Reader):
    """Anchors with the regions they stand in; the text of an anchor is its stripped pieces, joined.

    Open regions are kept apart from other open tags, and the places of each tag are known, so deep pages take linear time.
    """

    def __init__(self):
        self.open, self.at, self.inside, self.found, self.now = [], {}, [], [], None

    def handle_starttag(self, tag, attrs):
        a = attrs
        if tag == "a":
            self.finish()
            self.now = (a.get("href"), tuple(dict.fromkeys(x for _, x in self.inside)), [])
        if tag not in VOID:
            at = len(self.open)
            # no more kinds than there are, so a page of nested regions stays linear
            for kind in ([tag] if tag in _REGION_TAGS else []) + (["role-nav"] if a.get("role") == "navigation" else []):
                if all(x != kind for _, x in self.inside):
                    self.inside.append((at, kind))
            self.at.setdefault(tag, []).append(at)
            self.open.append((tag, a.get("role")))

    def handle_endtag(self, tag):
        if tag == "a":
            self.finish()
        if self.at.get(tag):
            i = self.at[tag][-1]
            for t, _ in self.open[i:]:
                self.at[t].pop()
            del self.open[i:]
            self.inside = [x for x in self.inside if x[0] < i]

    def handle_data(self, data):
        if self.now and data.strip():
            self.now[2].append(data.strip())

    def finish(self):
        if self.now and self.now[0] is not None:
            self.found.append((self.now[0], self.now[1], "".join(self.now[2])))
        self.now = None


_RANK = {"nav": 0, "header": 0, "role-nav": 1, "footer": 2, "page": 3}


def links_of(page: str | None, whole: bool = False) -> list[dict]:
    """Links of the navigation regions, an anchor once for each kind of region; of the whole page if ``whole``."""
    p = _Links()
    p.feed(page)
    p.finish()
    out = []
    for pos, (href, inside, text) in enumerate(p.found):
        kinds = ["page"] if whole else sorted({("nav" if x == "header" else x) for x in inside}, key=_RANK.get)
        for k in kinds:
            out.append({"region": k, "region_rank": _RANK[k], "pos": pos, "href": href, "anchor_text": text})
    return out


def _all(page: str | None) -> list[dict]:
    return links_of(page, True)


def _each(f, kind: str, x) -> Column:
    """``f`` of each value.  Rows go to Python by the hundred, not by an Arrow batch of 10,000: pages are long, and what a worker
    holds of them and of their links must not grow with the rows of its task."""
    ship()
    return F.udf(f, kind, useArrow=False)(col(x))


def nav_links(x) -> Column:
    return _each(links_of, LINKS, x)


def all_links(x) -> Column:
    return _each(_all, LINKS, x)


#: Lists within lists are indented up to this depth.
DEPTH = 100
#: Elements that a paragraph may hold, and itself.
_SOFT = frozenset(("p", "b", "strong", "i", "em", "span", "a", "code"))


class _Markdown(_Reader):
    def __init__(self, noise_tags, noise_classes):
        self.noise, self.classes = frozenset(noise_tags), tuple(noise_classes)
        self.out, self.open, self.lists, self.cell = [], [], [], 0
        self.quiet, self.at, self.hard = 0, {}, []  # silent elements; places of each tag; those a paragraph does not end beyond

    def push(self, tag: str, quiet: bool) -> None:
        self.at.setdefault(tag, []).append(len(self.open))
        if tag not in _SOFT:
            self.hard.append(len(self.open))
        self.quiet += quiet
        self.open.append((tag, quiet))

    def pop(self) -> None:
        tag, quiet = self.open.pop()
        self.at[tag].pop()
        if tag not in _SOFT:
            self.hard.pop()
        self.quiet -= quiet

    def put(self, s: str) -> None:
        if not self.quiet:
            self.out.append(s)

    def handle_starttag(self, tag, attrs):
        names = (attrs.get("class") or "").lower()
        quiet = tag in self.noise or any(x in names for x in self.classes)
        if tag in VOID:
            if tag == "br":
                self.put("  \n")
            elif tag == "hr":
                self.put("\n\n---\n\n")
            return
        if tag == "p" or (tag in _BLOCKS and tag != "li"):
            self.close_p()
        self.push(tag, quiet)
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.put("\n")
        elif tag == "li":
            depth = min(max(len(self.lists) - 1, 0), DEPTH)
            mark = "-"
            if self.lists:
                self.lists[-1][1] += 1
                mark = f"{self.lists[-1][1]}." if self.lists[-1][0] == "ol" else "-"
            self.put("\n" + "  " * depth + mark + " ")
        elif re.fullmatch("h[1-6]", tag):
            self.put("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "tr":
            self.cell = 0
            self.put("\n")
        elif tag in ("td", "th"):
            self.put("| " if not self.cell else " | ")
            self.cell += 1
        elif tag in ("b", "strong"):
            self.put("**")
        elif tag in ("i", "em"):
            self.put("*")
        elif tag == "code" and not self.inside("pre"):
            self.put("`")
        elif tag == "pre":
            self.put("\n\n```\n")
        elif tag == "blockquote":
            self.put("\n\n> ")
        elif tag in _BLOCKS:
            self.put("\n\n")

    def inside(self, tag) -> bool:
        at = self.at.get(tag)
        return bool(at) and at[0] < len(self.open) - 1

    def close_p(self):
        """Ends the paragraph that only inline elements lie in."""
        if self.at.get("p") and (not self.hard or self.hard[-1] < self.at["p"][-1]):
            i = self.at["p"][-1]
            while len(self.open) > i:
                self.end(self.open[-1][0])

    def end(self, tag):
        if tag in ("b", "strong"):
            self.put("**")
        elif tag in ("i", "em"):
            self.put("*")
        elif tag == "code" and not self.inside("pre"):
            self.put("`")
        elif tag == "pre":
            self.put("\n```\n\n")
        elif tag == "tr":
            self.put(" |")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.put("\n\n")
        elif tag in _BLOCKS and tag != "li":
            self.put("\n\n")
        self.pop()

    def handle_endtag(self, tag):
        if not self.at.get(tag):
            return
        while self.open:
            last = self.open[-1][0]
            self.end(last)
            if last == tag:
                break

    def handle_data(self, data):
        if self.at.get("pre"):
            self.put(data)
        else:
            data = re.sub(r"\s+", " ", data)
            if data == " " and self.out and self.out[-1].endswith("\n"):
                return
            self.put(data)


def to_markdown(page: str | None, tags=c.NOISE_TAGS, classes=c.NOISE_CLASSES) -> str:
    """Markdown without noise: ATX headings, text of links, tables, lists, emphasis; at most one empty line in a row."""
    p = _Markdown(tags, classes)
    p.feed(page)
    while p.open:
        p.end(p.open[-1][0])
    return re.sub(r"\n[ \t]*+\n(?:[ \t]*+\n)++", "\n\n", "".join(p.out)).strip()


def markdown(x, limit: int = c.CONTEXT_CHARS, tags=c.NOISE_TAGS, classes=c.NOISE_CLASSES) -> Column:
    """Markdown cut at ``limit`` characters, with a note where it was cut."""
    md = _each(lambda page: to_markdown(page, tags, classes), "string", x)
    return F.when(F.length(md) > limit, F.concat(F.substr(md, F.lit(1), F.lit(limit)), F.lit(c.TRUNCATED))).otherwise(md)


def _decode(raw: str | None) -> str | None:
    return None if raw is None else " ".join(_plain(raw).split())


def title(x) -> Column:
    """The title as a browser gives it: character references decoded, white space stripped and made one space."""
    raw = F.regexp_extract(col(x), r"(?is)<title[^>]*+>(.*?)</title>", 1)
    return F.when(F.contains(raw, F.lit("&")), _each(_decode, "string", raw)).otherwise(squeeze(raw))
