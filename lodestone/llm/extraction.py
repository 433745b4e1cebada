"""Main text of web pages by a tree-structured graphical model.

Block elements of a page are binary variables, content or not.  Each has a potential from its tag, names, text and links;
each parent and child share a potential that depends on the kind of the child.  One sum-product pass upward and one
downward give the exact marginals on the tree.  Both kinds of potentials are estimated from labelled pages; as no
table of labels exists, the labelled pages are composed here from the layouts that sites commonly use.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, one_column, table
from .dom import Node, features, parse, text_of
from .labelled import sparse_logistic

PAGES, SEED = 1300, 11

# --- labelled pages ---

_SYLLABLES = "ba re to lin mar ve sol ter no dis kan pel ur gra mi sho".split()
_KINDS = {
    "nav": (["nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "main-menu", "pagination", "toc", "skip-link", "tabs"], ["nav", "nav", "div", "ul", "menu"]),
    "header": (["header", "masthead", "site-header", "topbar", "branding", "logo", "banner", "page-header"], ["header", "header", "div"]),
    "footer": (["footer", "site-footer", "bottom", "copyright", "legal", "colophon", "page-footer"], ["footer", "footer", "div"]),
    "side": (["sidebar", "side", "widget", "related", "recommended", "more-stories", "popular", "trending", "tags", "author-box", "rail"], ["aside", "aside", "div", "section"]),
    "ad": (["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot", "promotion", "sponsor"], ["div", "div", "aside", "section", "p"]),
    "notice": (["cookie", "cookie-notice", "consent", "gdpr", "notice", "alert", "modal", "popup", "newsletter", "subscribe", "paywall", "disclaimer"], ["div", "div", "section", "aside", "dialog", "p"]),
    "share": (["share", "social", "social-share", "share-buttons", "follow"], ["div", "ul"]),
    "comments": (["comments", "comment", "comment-list", "disqus", "responses", "replies", "discussion", "reader-comments"], ["section", "div", "ol"]),
}
_MAIN = ["content", "post", "article", "entry", "main", "entry-content", "post-content", "article-body", "story", "text", "body-text", "page-content", "main-content", "blog-post"]


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, a: int, b: int) -> str:
        r = self.r
        w = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(a, b))]
        return " ".join(w).capitalize() + r.choice([".", ".", "", "!"])

    def attr(self, names: list[str], often: float = 0.75) -> str:
        r = self.r
        if r.random() > often:
            return ""
        return f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"'

    def links(self, a: int, b: int) -> str:
        r, n = self.r, self.r.randint(a, b)
        one = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(n)]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in one)}</ul>" if r.random() < 0.6 else r.choice([" ", " | ", ""]).join(one)

    def noise(self, kind: str) -> str:
        r = self.r
        names, tags = _KINDS[kind]
        tag = r.choice(tags)
        often = 0.45 if tag in ("nav", "header", "footer", "aside", "menu", "dialog") else 1.0
        if kind == "comments":
            inner = "".join(f"<{t}{self.attr(['comment', 'comment-body', 'reply'], 0.8)}><p>{self.words(3, 40)}</p></{t}>" for t in ["li" if tag == "ol" else "div"] * r.randint(1, 5))
            inner = f"<h3>{self.words(1, 2)}</h3>{inner}" if tag != "ol" else inner
        elif kind in ("nav", "share"):
            inner = self.links(2, 9)
        elif kind == "header":
            inner = r.choice([f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(1, 6)}</p>", self.words(1, 5), self.links(1, 5)]) + r.choice(["", self.noise("nav")])
        elif kind == "footer":
            inner = f"&copy; {self.words(1, 9)}" + r.choice(["", self.links(1, 6), f"<p>{self.words(3, 20)}</p>"])
        elif kind == "side":
            inner = r.choice(["", f"<h3>{self.words(1, 3)}</h3>"]) + r.choice([self.links(2, 7), f"<p>{self.words(3, 25)}</p>", self.words(2, 12)])
        else:
            inner = r.choice([self.words(2, 20), f"<p>{self.words(3, 25)}</p>", f'<a href="#">{self.words(1, 6)}</a>', f"{self.words(2, 10)} <button>{self.words(1, 2)}</button>"])
        if tag == "p":  # it cannot hold blocks
            inner = re.sub(r"</?p>", "", inner)
        if tag in ("ul", "ol", "menu"):
            inner = inner if inner.startswith("<li") else f"<li>{inner}</li>"
        return f'<{tag}{self.attr(names, often)} data-label="0">{inner}</{tag}>'

    def block(self) -> str:
        r, t = self.r, self.r.random()
        if t < 0.7:
            p = f"<p>{self.words(2, 90)}" + r.choice(["", f' <a href="/x">{self.words(1, 4)}</a> {self.words(1, 9)}', f" <b>{self.words(1, 5)}</b>", f"<br>{self.words(3, 30)}"])
            return p + r.choice(["</p>", "</p>", "</p>", ""])
        if t < 0.8:
            return f"<h{(k := r.randint(2, 4))}>{self.words(1, 7)}</h{k}>"
        if t < 0.87:
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>{''.join(f'<li>{self.words(2, 20)}</li>' for _ in range(r.randint(2, 5)))}</{tag}>"
        if t < 0.91:
            return f"<blockquote>{r.choice(['', '<p>'])}{self.words(5, 40)}</blockquote>"
        if t < 0.94:
            return f"<table>{''.join(f'<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 6)}</td></tr>' for _ in range(r.randint(2, 5)))}</table>"
        if t < 0.96:
            return f"<pre>{self.words(4, 30)}</pre>"
        if t < 0.98:
            return f"<figure><img src='x'><figcaption>{self.words(3, 12)}</figcaption></figure>"
        return f"<div>{self.words(4, 60)}</div>"

    def page(self) -> str:
        r = self.r
        body = [self.block() for _ in range(r.choice([1, 1, 2, 4, 8, 15]))]
        for kind in ("ad", "share", "side", "notice"):
            if r.random() < 0.2:
                body.insert(r.randint(0, len(body)), self.noise(kind))
        title = r.choice([f"<h1>{self.words(1, 9)}</h1>", f"<h1>{self.words(1, 9)}</h1>", f"<h2>{self.words(1, 9)}</h2>", ""])
        inner, own = title + "".join(body), "0"
        wrap = r.choice(["article", "article", "article", "main", "main", "div", "div", "div", "section", "nested", "td", "bare", "bare", "plain", "plain", "old", "linked", "lines"])
        if wrap == "nested":
            inner = f'<main data-label="1"><article data-label="1"><div{self.attr(_MAIN)}>{inner}</div></article></main>'
        elif wrap == "td":
            inner = f'<table><tr><td data-label="0">{self.links(2, 6)}</td><td data-label="1">{inner}</td></tr></table>'
        elif wrap == "bare":  # blocks stand in the body or in a wrapper without a meaning
            inner = "".join(x if "data-label" in x[: x.find(">")] else re.sub(r"^<(\w+)", r'<\1 data-label="1"', x) for x in (title, *body))
        elif wrap == "plain":
            tag = r.choice(["div", "div", "section"])
            inner = f'<{tag} data-label="1">{inner}</{tag}>'
            inner = f'<div data-label="1">{inner}</div>' if r.random() < 0.3 else inner
        elif wrap == "old":
            tag = r.choice(["center", "td", "div align=left", "blockquote"])
            inner = f'<{tag} data-label="1"><font size="2">{inner}</font></{tag.split()[0]}>'
            inner = f"<table><tr>{inner}</tr></table>" if tag == "td" else inner
        elif wrap == "linked":  # an article of few words, each paragraph a link
            tag = r.choice(["article", "main", "section", "div"])
            inner = title + "".join(f'<p><a href="/{k}">{self.words(4, 40)}</a></p>' for k in range(r.randint(1, 5)))
            inner = f'<{tag}{self.attr(_MAIN, 0.4 if tag in ("article", "main") else 1.0)} data-label="1">{inner}</{tag}>'
        elif wrap == "lines":  # text that no block holds
            inner, own = r.choice(["<br>", "<br><br>"]).join(self.words(5, 60) for _ in range(r.randint(2, 8))), "1"
        else:
            inner = f'<{wrap}{self.attr(_MAIN, 0.4 if wrap in ("article", "main") else 1.0)} data-label="1">{inner}</{wrap}>'
        top = [self.noise(k) for k in ("header", "nav", "notice", "ad") if r.random() < 0.5]
        end = [self.noise(k) for k in ("side", "share", "comments", "ad", "footer", "notice") if r.random() < 0.5]
        r.shuffle(top)
        if r.random() < 0.3:
            end = [x for x in end if r.random() < 0.7]
        whole = "".join(top) + inner + "".join(end)
        if own == "0" and r.random() < 0.35:
            whole = f'<div{self.attr(["wrapper", "container", "page", "layout", "site", "root"])}>{whole}</div>'
        return f'<html><head><title>{self.words(1, 6)}</title></head><body data-label="{own}">{whole}</body></html>'


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[str]:
    """Pages whose elements carry data-label 1 (article) or 0, inherited by what is inside."""
    return [_Writer(seed * 100_003 + k).page() for k in range(n)]


# --- the model ---


def _kind(x: Node) -> str:
    return f"plain {x.tag}" if x.plain else f"{x.tag} named" if x.names else x.tag


class TreeModel:
    """Potentials: log odds of features, and a 2 x 2 table for each kind of child."""

    def __init__(self, unary: dict[str, float], bias: float, pair: dict[str, tuple], rest: tuple):
        self.unary, self.bias, self.pair, self.rest = unary, bias, pair, rest

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for each node; silent elements are no evidence and never content."""
        get, n = self.unary.get, len(nodes)
        own = [0.0 if x.silent else self.bias + sum(get(f, 0.0) for f in features(x)) for x in nodes]
        tables = [self.pair.get(_kind(x), self.rest) for x in nodes]
        up = own[:]  # log odds of a node given its subtree
        message = [0.0] * n
        for k in range(n - 1, 0, -1):
            if nodes[k].silent:
                continue
            (p00, p01), (p10, p11) = tables[k]
            e = math.exp(max(-30.0, min(30.0, up[k])))
            message[k] = math.log((p10 + p11 * e) / (p00 + p01 * e))
            up[nodes[k].parent] += message[k]
        belief = up[:]
        for k in range(1, n):
            if nodes[k].silent:
                continue
            (p00, p01), (p10, p11) = tables[k]
            e = math.exp(max(-30.0, min(30.0, belief[nodes[k].parent] - message[k])))
            belief[k] = up[k] + math.log((p01 + p11 * e) / (p00 + p10 * e))
        return [0.0 if x.silent else 1 / (1 + math.exp(-max(-30.0, min(30.0, b)))) for x, b in zip(nodes, belief)]


@functools.lru_cache(maxsize=1)
def train(n: int = PAGES, seed: int = SEED) -> TreeModel:
    """Estimates the potentials; the same model every time for the same arguments."""
    rows, y, names = [], [], {}
    pairs: dict[str, Counter] = {}
    for page in labelled_pages(n, seed):
        nodes, _ = parse(page, labelled=True)
        for x in nodes[1:]:
            if x.silent or x.label is None:
                continue
            rows.append(np.array([names.setdefault(f, len(names)) for f in features(x)], np.int64))
            y.append(int(x.label))
            above = nodes[x.parent].label
            pairs.setdefault(_kind(x), Counter())[int(above or 0), int(x.label)] += 1
    y = np.array(y, float)
    w = sparse_logistic(rows, y, len(names), np.ones(len(y)), l2=0.03)
    seen = np.bincount(np.concatenate(rows), minlength=len(names))
    unary = {f: float(w[i]) for f, i in names.items() if seen[i] >= 2}
    base = y.mean()

    def table_of(c: Counter) -> tuple:
        # ratio of the joint to independence, so that labels' frequencies count once, in the unary potentials
        n1 = [(c[a, 1] + 0.5) / (c[a, 0] + c[a, 1] + 1) for a in (0, 1)]
        own = (c[0, 1] + c[1, 1] + 0.5) / (sum(c.values()) + 1)
        own = 0.5 * own + 0.5 * base
        return tuple(((1 - p) / (1 - own), p / own) for p in n1)

    total = Counter()
    for c in pairs.values():
        total.update(c)
    return TreeModel(unary, float(w[-1]), {k: table_of(c) for k, c in pairs.items() if sum(c.values()) >= 20}, table_of(total))


def main_text(page: str | None, model: TreeModel, least: float = 0.5) -> str:
    """Text of the blocks that are content with at least this probability; empty for null, empty or textless pages."""
    if not page:
        return ""
    nodes, pieces = parse(page)
    return text_of(pieces, [p >= least for p in model.marginals(nodes)])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars for every row.

    Null and empty pages have empty text, an empty table gives an empty result, repeated rows are repeated.  Pages are read whole,
    in time that grows with their length; labels that a page itself carries mean nothing.  Other columns are not read.
    """
    bounded_batches(pages.sparkSession)
    source = pages.select(*keep, html_col)
    kinds = dict(source.dtypes)

    def run(batches):
        model = train()
        for batch in batches:
            texts = [main_text(x.as_py(), model) for x in one_column(batch, html_col)]
            yield pa.RecordBatch.from_arrays(
                [one_column(batch, c) for c in keep] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    schema = "".join(f"{c} {kinds[c]}, " for c in keep)
    return source.mapInArrow(run, f"{schema}text string, n_chars long")


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
