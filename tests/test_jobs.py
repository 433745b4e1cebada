"""Both jobs: growing input, runs that broke off, reruns, odd rows, command lines, and their SQL."""

import json
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import jobs
from jobs import contact_directory, link_frontier
from jobs.common import config

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
WORDS = {"admissions": ["the", "ti"], "tuition": ["on", "er"], "buckets": 5}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = jobs.QUERIES[name](spark, SF)
    cur = con.execute(jobs.ORACLES[name])
    names = [d[0] for d in cur.description]
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)
    assert got and got == sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in cur.fetchall()), key=repr)


def test_frontier_of_growing_pages(spark, tmp_path):
    pages, out, mark = spark.read.parquet(f"{SF}/pages.parquet"), str(tmp_path / "out"), str(tmp_path / "mark")
    settings = config("link_frontier") | WORDS
    at = str(tmp_path / "pages")
    run = lambda: link_frontier.run(spark, at, out, mark, settings)
    pages.where("page_id % 3 = 1").coalesce(1).write.parquet(at)
    first = run()
    assert first["batches"] == 1 and first["pages"] == pages.where("page_id % 3 = 1").count()
    assert run() == {"batches": 0, "pages": 0, "links": 0, "frontier": 0}  # nothing new
    before = rows(link_frontier.frontier(spark, out))
    pages.where("page_id % 3 = 0").coalesce(1).write.mode("append").parquet(at)
    pages.where("page_id % 3 = 2").coalesce(1).write.mode("append").parquet(at)
    assert run()["pages"] == pages.where("page_id % 3 <> 1").count()  # only what is new
    after = rows(link_frontier.frontier(spark, out))
    whole = str(tmp_path / "whole")
    link_frontier.run(spark, f"{SF}/pages.parquet", whole, f"{whole}/mark", settings)
    assert after == rows(link_frontier.frontier(spark, whole)) and after != before


def test_frontier_after_a_broken_run(spark, tmp_path, monkeypatch):
    out, settings = str(tmp_path / "out"), config("link_frontier") | WORDS
    run = lambda: link_frontier.run(spark, f"{SF}/pages.parquet", out, f"{out}/mark", settings)
    whole = link_frontier.ranked
    monkeypatch.setattr(link_frontier, "ranked", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivision|division by zero"):
        run()  # the log of the batch is written, its frontier is not
    monkeypatch.setattr(link_frontier, "ranked", whole)
    assert run()["batches"] == 1
    other = str(tmp_path / "other")
    link_frontier.run(spark, f"{SF}/pages.parquet", other, f"{other}/mark", settings)
    assert rows(link_frontier.frontier(spark, out)) == rows(link_frontier.frontier(spark, other))


def test_frontier_of_odd_pages(spark, tmp_path):
    at, out = str(tmp_path / "pages"), str(tmp_path / "out")
    nav = "<nav><a href='/apply'>Apply</a><a href='/apply'>again</a><a href='/f.pdf'>x</a><a href='https://else.org/apply'>y</a></nav>"
    odd = [(1, "https://www.x.edu/", nav), (1, "https://www.x.edu/", nav), (0, "https://www.x.edu/b", "<nav><a href='apply'>First</a></nav>"), (2, None, nav), (3, "https://y.edu/", None), (4, "no address", nav), (None, "https://z.edu/", "")]
    spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("seed", F.lit("clash")).coalesce(1).write.parquet(at)
    link_frontier.run(spark, at, out, f"{out}/mark")
    got = {(r.seed, r.rank): (r.url, r.category, r.page_id) for r in link_frontier.frontier(spark, out).collect()}
    assert got == {("www.x.edu", 1): ("https://www.x.edu/", None, None), ("www.x.edu", 2): ("https://www.x.edu/apply/", "admissions", 0),
                   ("y.edu", 1): ("https://y.edu/", None, None), ("z.edu", 1): ("https://z.edu/", None, None)}
    empty = str(tmp_path / "none")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(empty)
    assert link_frontier.run(spark, empty, str(tmp_path / "o2"), str(tmp_path / "m2"))["frontier"] == 0


def test_directory(spark, tmp_path):
    at, out = str(tmp_path / "docs"), str(tmp_path / "out")
    docs = [
        (1, "call 570-577-3000 or (570) 577-3000 or +1 570-577-3000, A@X.org", "en", "s"), (2, "a@x.org. b@y", "en", "s"), (2, "a@x.org. b@y", "en", "s"), (3, None, None, None),
        (4, "", "", "t"), (5, "b@y " * 50_000, "de", "t"), (6, "z@z.org a@z.org", "de", "t"), (None, "z@z.org", "de", "t"),
    ]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("kind", F.lit(1)).write.parquet(at)
    done = contact_directory.run(spark, at, out, config("contact_directory") | {"ranks": 1})
    assert done == {"documents": 8, "contacts": 6, "sites": 4}
    got = {(r.lang, r.source, r.value): (r.docs, r.first_doc, r["rank"], r.problem) for r in contact_directory.contacts(spark, out).collect()}
    assert got == {
        ("en", "s", "+1-570-577-3000"): (1, 1, 1, None), ("en", "s", "a@x.org"): (1, 1, 1, None), ("en", "s", "a@x.org."): (2, 2, None, "no address"),
        ("en", "s", "b@y"): (2, 2, None, "no address"), ("de", "t", "b@y"): (1, 5, None, "no address"), ("de", "t", "z@z.org"): (2, 6, 1, None)}
    sites = {(r.lang, r.source): (r.docs, r.with_phone, r.with_email, r.phone, r.email) for r in spark.read.parquet(f"{out}/sites").collect()}
    assert sites == {("en", "s"): (3, 1, 3, "+1-570-577-3000", "a@x.org"), ("de", "t"): (3, 0, 3, None, "z@z.org"), ("und", "t"): (1, 0, 0, None, None), ("und", ""): (1, 0, 0, None, None)}
    before = rows(contact_directory.contacts(spark, out))
    contact_directory.run(spark, at, out, config("contact_directory") | {"ranks": 1})
    assert rows(contact_directory.contacts(spark, out)) == before
    empty = str(tmp_path / "none")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(empty)
    assert contact_directory.run(spark, empty, str(tmp_path / "o2")) == {"documents": 0, "contacts": 0, "sites": 0}


def test_settings(tmp_path):
    own = tmp_path / "own.json"
    own.write_text(json.dumps({"limit": 3}))
    assert config("link_frontier", str(own))["limit"] == 3 and config("link_frontier")["limit"] == 6
    own.write_text(json.dumps({"limits": 3}))
    with pytest.raises(ValueError, match="limits"):
        config("link_frontier", str(own))


def test_command_lines(spark, tmp_path):
    own = tmp_path / "own.json"
    own.write_text(json.dumps({"ranks": 2}))
    done = subprocess.run([sys.executable, "-m", "jobs.contact_directory", "--documents", f"{SF}/documents.parquet", "--out", str(tmp_path / "a"), "--config", str(own)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "read 200 documents" in done.stderr, done.stderr[-2000:]
    done = subprocess.run([sys.executable, "-m", "jobs.link_frontier", "--pages", f"{SF}/pages.parquet", "--out", str(tmp_path / "b"), "--checkpoint", str(tmp_path / "c")], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "rows of" in done.stderr, done.stderr[-2000:]
    assert link_frontier.frontier(spark, str(tmp_path / "b")).count() > 0
