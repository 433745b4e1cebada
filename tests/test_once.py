"""Markdown once for each content: over URLs, over runs, and again under the same name."""

from lodestone.functions import html
from lodestone.operators import once

SCHEMA = "page_id long, url string, html string, d string, run string"
PAGE = "<html><body><h1>T{0}</h1><p>Text {0}</p></body></html>"
FIRST = [(1, "a", PAGE.format(1)), (2, "b", PAGE.format(1)), (3, "c", PAGE.format(2)), (4, None, PAGE.format(3)), (5, "e", None), (6, "f", ""), (7, "a", PAGE.format(1))]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "x") for r in rows], SCHEMA)


def made(spark, memory):
    return sorted((r.run, r.digest, r.markdown) for r in once.known(spark, next(memory.iterdir()).as_posix()).collect())


def test_once(spark, tmp_path):
    pages = frame(spark, FIRST)
    out = once.markdown_once(pages, tmp_path.as_posix(), "one")
    assert set(pages.columns) < set(out.columns)
    want = {r.page_id: r.m for r in pages.select("page_id", html.markdown("html").alias("m")).collect()}
    got = out.collect()
    assert len(got) == len(FIRST) and {r.page_id: r.markdown for r in got} == want and want[5] == ""
    first = made(spark, tmp_path)
    assert len(first) == 4 and {r for r, _, _ in first} == {"one"}
    grown = frame(spark, FIRST + [(8, "g", PAGE.format(2)), (9, "h", PAGE.format(9)), (10, "i", PAGE.format(9))])
    for _ in range(2):  # a run that is run again under its name writes the same
        got = once.markdown_once(grown, tmp_path.as_posix(), "two").collect()
        assert {r.page_id: r.made_in for r in got} == dict.fromkeys(range(1, 9), "one") | {5: None, 9: "two", 10: "two"}
        after = made(spark, tmp_path)
        assert after[:4] == first and [r for r, _, _ in after[4:]] == ["two"]


def test_once_settings_and_no_rows(spark, tmp_path):
    """Another limit has a table of its own; a table without rows gives none."""
    pages, memory = frame(spark, FIRST), tmp_path.as_posix()
    once.markdown_once(pages, memory, "one")
    short = {r.page_id: r.markdown for r in once.markdown_once(pages, memory, "one", limit=4).collect()}
    assert short[1].startswith("# T1") and len(list(tmp_path.iterdir())) == 2 and "Text" not in short[1]
    assert once.markdown_once(pages.limit(0), memory, "none").count() == 0
