"""Scalar functions by tables of inputs and results."""

import datetime

import pytest
from pyspark.sql import functions as F

from lodestone.functions import html, normalize, urls
from lodestone.sources import web


def one(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("(570) 577-3000", "+1-570-577-3000"), ("1-570-577-3000", "+1-570-577-3000"), ("577-3000", "577-3000"), ("", None), (None, None)])
def test_phone(spark, raw, want):
    assert one(spark, normalize.phone, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("JANUARY 5, 2026", "2026-01-05"), ("1/5/2026", "2026-01-05"), ("2026-02-30", "2026-02-30"), ("September 1st, 2025", "September 1st, 2025"),
    ("Jan. 15", "2027-01-15"), ("Jan. 16", "2026-01-16"), ("Feb 29", "Feb 29"), ("Jan 5, 2026 ", "Jan 5, 2026"), ("", None)])
def test_date(spark, raw, want):
    assert one(spark, lambda c: normalize.date(c, F.lit(datetime.date(2026, 1, 16))), raw) == want


@pytest.mark.parametrize("raw, want", [("$54,890.99", 54890), ("abc", None), ("-1", None), ("1_000", 1000), ("inf", None), ("12d", None)])
def test_cost(spark, raw, want):
    assert one(spark, normalize.cost_text, raw) == want


@pytest.mark.parametrize("raw, want", [(2.5, 2), (3.5, 4), (-0.4, None), (float("nan"), None), (float("inf"), None)])
def test_cost_number(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x double").select(normalize.cost_number("x")).first()[0] == want


@pytest.mark.parametrize("base, ref", [
    ("https://a.edu/x/y?q#f", r) for r in ("z", "../z", "./z/", "/z/../w", "?k=1", "#g", "", "//b.edu/q", "http://c.edu/", "../../../z", "z?u=/a/../b", "mailto:x@y.z")])
def test_resolve(spark, base, ref):
    from urllib.parse import urljoin

    assert one(spark, urls.resolve, base, ref) == urljoin(base, ref)


@pytest.mark.parametrize("raw, url, error", [
    ("bucknell.edu", "https://www.bucknell.edu/", None), ("http://a.b.edu/x?q#f", "https://a.b.edu/x/", None), ("10.0.0.1", None, "address"), ("", None, "empty"),
    ("x.edu:8080", "https://www.x.edu/", None), ("ftp://x.edu", None, "no dot"), (None, None, "empty")])
def test_seed(spark, raw, url, error):
    got = one(spark, urls.seed, raw)
    assert (got.url, got.error) == (url, error)


def test_discovered(spark):
    f = lambda u, s: one(spark, urls.discovered, u, s)
    assert f("/a//b?utm_source=x&k=1#z", "https://www.A.edu/").url == "https://www.a.edu/a/b?k=1"
    assert f("/x.PDF", "https://a.edu/").error == "binary"
    assert f("/login/x", "https://a.edu/").error == "auth"
    assert f("https://b.edu/", "https://a.edu/").error == "other domain"
    assert f("mailto:x@a.edu", "https://a.edu/").error == "scheme"


def test_markdown():
    page = "<body><nav>menu</nav><h2>Fees <b>now</b></h2><p>One<p>Two <a href=x>link</a><script>'</p>'</script><ul><li>a<li>b</ul><div class='cookie-bar'>x</div><table><tr><th>k</th><td>v</td></tr></table></body>"
    md = html.to_markdown(page)
    assert md.startswith("## Fees **now**") and "One\n\nTwo link" in md and "- a" in md and "- b" in md and "| k | v |" in md
    assert "menu" not in md and "cookie" not in md and "</p>" not in md
    assert html.to_markdown(page, classes=()).endswith("|") and "x" in html.to_markdown(page, classes=())
    assert html.to_markdown(None) == "" and html.to_markdown("") == ""


def test_links():
    page = "<nav role=navigation><a href=/a> A <i> b</i></a></nav><footer><a href=/b>B</a></footer><a href=/c>C</a><a>none</a>"
    got = [(x["region"], x["href"], x["anchor_text"]) for x in html.links_of(page)]
    assert got == [("nav", "/a", "Ab"), ("role-nav", "/a", "Ab"), ("footer", "/b", "B")]
    assert [x["href"] for x in html.links_of(page, True)] == ["/a", "/b", "/c"]


def test_sitemap_depth(spark):
    files = spark.createDataFrame([(f"u{i}", 200, f"<sitemapindex><sitemap><loc>u{(i + 1) % 3}</loc></sitemap></sitemapindex>") for i in range(3)] + [("v", 200, "x")], "url string, status int, body string")
    start = spark.createDataFrame([("s", "b", "u0")], "seed string, base string, url string")
    assert web.sitemap_pages(start, files, 5).count() == 0


def test_sitemap_any_depth(spark):
    """Pages seven files down are found, and a cycle back to the first ends."""
    index = "<sitemapindex><sitemap><loc>a.edu/{}</loc></sitemap><sitemap><loc>a.edu/0</loc></sitemap></sitemapindex>"
    rows = [(f"a.edu/{i}", 200, index.format(i + 1)) for i in range(7)] + [("a.edu/7", 200, "<urlset><url><loc>a.edu/deep</loc></url></urlset>")]
    files = spark.createDataFrame(rows, "url string, status int, body string")
    start = spark.createDataFrame([("s", "a.edu", "a.edu/0")], "seed string, base string, url string")
    assert [x.url for x in web.sitemap_pages(start, files).collect()] == ["a.edu/deep"]
    assert web.sitemap_pages(start, files, 6).count() == 0


def test_idempotent(spark):
    for f in (normalize.email, normalize.state, normalize.country, normalize.postal, normalize.fee_type):
        for v in (" Pennsylvania ", "A  b", "usa", "178372005", "X@Y.z "):
            once = one(spark, f, v)
            assert one(spark, f, once) == once
