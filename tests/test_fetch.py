"""Fetching with memory: failures, modes and load times over steps and runs; sites side by side; the stream of requests."""

import os
import threading
import time
import uuid
from collections import Counter

from pyspark.sql import functions as F

from lodestone import config as c
from lodestone.operators import extract, fetch
from lodestone.plans import etl
from lodestone.plans.queries import _as_requests
from lodestone.streaming import state

BODY = "<p>" + "words of the page. " * 20 + "</p>"
SITE = {
    "https://www.x.edu/": f"<title>X</title><nav><a href='/admissions'>Apply</a><a href='/tuition'>Costs</a><a href='/apply-gone'>Apply</a></nav>{BODY}",
    "https://www.x.edu/admissions/": f"<title>Adm</title>{BODY}<a href='/deadline-lost'>Dates</a><a href='/apply-gone'>Apply</a>",
    "https://www.x.edu/tuition/": BODY,
}


def noted(folder, site=SITE, ms=5):
    """Notes each call in a file; pages come without title, final address, depth and content type."""

    def get(url, mode, timeout_ms):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{mode} {url} {timeout_ms}")
        if "lost" in url:
            raise TimeoutError(url)
        return site.get(url) and {"status_code": 200, "html": site[url], "fetch_time_ms": ms}

    return get


def calls(folder):
    return [tuple(p.read_text().split()) for p in folder.iterdir()]


def job(spark, get, memory=None, **more):
    answer = extract.Callable(lambda kind, prompt: ('{"university_name": "X"}', "m"))
    robots = spark.createDataFrame([], "seed string, status int, body string")
    maps = spark.createDataFrame([], "url string, status int, body string")
    return etl.Job(fetch.Callable(get, delay=0, tasks=2), answer, robots, maps, "2026-01-16", "t", second=fetch.Callable(get, "alternate", delay=0, tasks=2), memory=memory, **more)


def test_failures_are_asked_once(spark, tmp_path):
    """A homepage and links that fail are asked once in each mode, over all steps, and by no later run with the same memory."""
    seeds = spark.createDataFrame([("x.edu",), ("gone.edu",)], "raw string")
    folders = [tmp_path / x for x in ("first", "second", "later")]
    for f in folders:
        f.mkdir()
    memory = str(tmp_path / "memory")
    first = job(spark, noted(str(folders[0])), memory)
    out = {r.raw: r for r in etl.run(first, seeds).collect()}
    assert out["x.edu"].error is None and out["gone.edu"].error == "no pages" and len(out["x.edu"].page_metadata) == 3
    got = Counter((m, u) for m, u, _ in calls(folders[0]))
    steps = {name: (rows, failed) for name, rows, failed, _ in first.steps}
    assert steps["home-standard"] == (2, 1) and steps["home-alternate"] == (1, 1) and steps["wanted"][0] > 3 and steps["records"] == (1, 0) and steps["responses"] == (3, 0)
    assert all(s >= 0 for *_, s in first.steps) and list(steps)[0] == "seeds"
    assert set(got.values()) == {1}
    bad = {u for _, u in got} - set(SITE)
    assert {"https://www.gone.edu/", "https://www.x.edu/apply-gone/", "https://www.x.edu/deadline-lost/"} <= bad
    assert all(("standard", u) in got and ("alternate", u) in got for u in bad) and not any(m == "alternate" for m, u in got if u in SITE)
    again = {r.raw: r for r in etl.run(job(spark, noted(str(folders[1])), memory), seeds).collect()}
    assert again == out and calls(folders[1]) == []
    # what is older than ``fresh`` is asked again
    etl.run(job(spark, noted(str(folders[2])), memory, fresh="0 seconds"), seeds).collect()
    assert {(m, u) for m, u, _ in calls(folders[2])} == set(got)


def test_absent_keys(spark):
    def get(url, mode):
        return {"a": {"html": "x" * 200, "status_code": 200}, "b": {}, "c": {"html": "y" * 200, "status_code": "odd"}, "d": {"html": "z" * 200, "status_code": 200, "more": 1, "depth": None}}[url[-1]]

    wanted = spark.createDataFrame([(f"https://s.edu/{x}",) for x in "abcd"] + [(None,)], "url string")
    rows = {r.url[-1]: r for r in fetch.Callable(get, delay=0).fetch(wanted).collect()}
    assert set(rows) == set("abcd") and rows["a"].title is None and rows["a"].final_url == "https://s.edu/a" and rows["a"].content_type.startswith("text/html")
    assert rows["b"].html is None and rows["c"].html is None and rows["d"].html and rows["d"].fetch_time_ms >= 0
    assert {r.url[-1] for r in fetch.with_fallback(wanted, fetch.Callable(get, delay=0)).collect()} == {"a", "d"}


def test_sites_side_by_side():
    """A hundred sites take the time of the slowest, each with three pages at most at once, a delay before each."""
    lock, now, most, begun = threading.Lock(), Counter(), Counter(), {}

    def ask(url, domain):
        with lock:
            now[domain] += 1
            most[domain] = max(most[domain], now[domain])
            begun.setdefault(domain, []).append(time.monotonic())
        time.sleep(0.05)
        with lock:
            now[domain] -= 1
        return url

    pages = [(f"{d}/{i}", d) for d in range(100) for i in range(7 if d else 14)]
    start = time.monotonic()
    got = list(fetch.side_by_side(pages, ask, 3, 0.1, 400))
    took = time.monotonic() - start
    assert sorted(got) == sorted(u for u, _ in pages) and max(most.values()) == 3
    assert all(t - start >= 0.1 for ts in begun.values() for t in ts)
    assert all(ts[i + 3] - ts[i] >= 0.14 for ts in begun.values() for i in range(len(ts) - 3))
    assert took < 5 < 100 * 3 * 0.15  # one after the other they would take 45 seconds
    few = list(fetch.side_by_side(pages, ask, 3, 0, 2))  # fewer threads than sites
    assert sorted(few) == sorted(got) and list(fetch.side_by_side([], ask, 3, 0, 2)) == []


def test_times_carry_over(spark, tmp_path):
    """A domain that was slow in one step has the short time-out in the next; loads that led to no page count too."""
    pages = spark.createDataFrame([("https://slow.edu/1", 9000), ("https://slow.edu/2", None), ("https://fast.edu/1", 10), ("https://mixed.edu/1", 15_000), ("https://mixed.edu/2", 500)], "url string, fetch_time_ms int")
    times = fetch.domain_times(pages)
    assert {tuple(r) for r in times.collect()} == {("slow.edu", 1, 9000.0), ("fast.edu", 1, 10.0), ("mixed.edu", 2, 15_500.0)}
    wanted = spark.createDataFrame([(f"https://{d}.edu/9",) for d in ("slow", "fast", "mixed", "new")], "url string")
    fetch.Callable(noted(str(tmp_path)), delay=0).fetch(wanted, times).collect()
    assert {(u.split("/")[2], int(t)) for _, u, t in calls(tmp_path)} == {("slow.edu", c.FAST_TIMEOUT_MS), ("fast.edu", c.TIMEOUT_MS), ("mixed.edu", c.TIMEOUT_MS), ("new.edu", c.TIMEOUT_MS)}


def test_times_carry_over_in_the_job(spark, tmp_path):
    etl.run(job(spark, noted(str(tmp_path), ms=9000)), spark.createDataFrame([("x.edu",)], "raw string")).collect()
    limits = {u: int(t) for m, u, t in calls(tmp_path) if m == "standard"}
    assert limits["https://www.x.edu/"] == c.TIMEOUT_MS and limits["https://www.x.edu/admissions/"] == c.FAST_TIMEOUT_MS


def test_memory_as_stream_and_batch(spark, tmp_path):
    """A stream in three batches gives what the log as a whole does, with every action in it."""
    log = _as_requests(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    log = log.unionByName(log.limit(3).withColumns({"url": F.lit(None).cast("string"), "n": -F.col("n")}))
    want = sorted(map(tuple, fetch.replay(log, slow=3000).collect()))
    assert {r[2] for r in want} == {"fetched", "failed", "cached", "skipped"} and {r[5] for r in want} == {15_000, 30_000, None} and {r[3] for r in want} == {"standard", "alternate", None}
    times = sorted(r.ts for r in log.select("ts").collect())
    a, b = (F.lit(times[len(times) * k // 10]).cast("timestamp_ntz") for k in (4, 7))
    at, key = str(tmp_path / "log"), "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for part in (log.where(F.col("ts") < a), log.where((F.col("ts") >= a) & (F.col("ts") < b)), log.where(F.col("ts") >= b)):
            part.coalesce(1).write.mode("append").parquet(at)
            stream = spark.readStream.schema(log.schema).parquet(at)
            state.crawl_memory(stream, slow=3000).writeStream.option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start(str(tmp_path / "rows")).awaitTermination()
    finally:
        spark.conf.unset(key)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "rows")).collect())) == want


def test_memory_without_requests(spark):
    assert fetch.replay(_as_requests(spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0))).count() == 0
