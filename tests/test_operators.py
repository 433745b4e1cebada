"""Discovery, pool, fetch, extraction, sinks, streaming and the whole job on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lodestone import config as c
from lodestone.operators import discovery, extract, fetch, pool, quality
from lodestone.plans import etl
from lodestone.sources import sinks, web
from lodestone.streaming import state


def greedy(home, adm, tui, every, limit):
    out = [home]
    for a, t in zip(adm, tui):
        for u in (a, t):
            if u not in out and len(out) < limit:
                out.append(u)
    for u in every:
        if u not in out and len(out) < limit:
            out.append(u)
    return out


def test_balanced_top_is_greedy(spark):
    r, rows, want = random.Random(3), [], {}
    for seed in range(60):
        links = [(f"u{i}", r.choice([0.0, 0.2, 0.3, 0.5, 0.8]), r.choice([0.0, 0.3, 0.6, 0.9])) for i in r.sample(range(20), r.randint(0, 12))]
        rows += [(seed, u, a, t) for u, a, t in links]
        by = lambda k: [x[0] for x in sorted((x for x in links if k(x) >= 0.3), key=lambda x: (-k(x), x[0]))]
        want[seed] = greedy("u3", by(lambda x: x[1]), by(lambda x: x[2]), by(lambda x: max(x[1:])), 6)
    df = spark.createDataFrame(rows, "seed int, url string, admissions_score double, tuition_score double")
    seeds = spark.range(60).select(F.col("id").cast("int").alias("seed"), F.lit("u3").alias("homepage"))
    got = {}
    for x in discovery.balanced_top(discovery.classified(df), seeds).orderBy("seed", "rank").collect():
        got.setdefault(x.seed, []).append(x.url)
    assert got == want


def test_balanced_top_is_cut_before_the_shuffle(spark):
    df = discovery.classified(spark.createDataFrame([], "seed int, url string, admissions_score double, tuition_score double"))
    seeds = spark.range(0).select(F.col("id").cast("int").alias("seed"), F.lit("h").alias("homepage"))
    plan = discovery.balanced_top(df.union(df), seeds)._jdf.queryExecution().executedPlan().toString()
    lines = [x.strip(" +-:") for x in plan.splitlines()]
    first = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Partial" in x)
    assert any("Exchange" in x for x in lines[:first]) and sum("WindowGroupLimit" in x and "Partial" in x for x in lines) == 1


def test_scores(spark):
    rows = [("https://x.edu/apply/", "Apply", "nav-nav", 1, 0.8624999999999999), ("https://x.edu/apply/", "", "nav-nav", 1, 0.45999999999999996), ("https://x.edu/", "apply", "nav-depth2", 2, 0.36224999999999996)]
    df = spark.createDataFrame(rows, "url string, anchor_text string, source string, depth int, want double")
    assert all(x.got == x.want for x in df.withColumn("got", discovery.score(c.ADMISSIONS, c.ADMISSIONS_SLUGS)).collect())


def test_pool():
    now, slept = [0.0], []
    p = pool.SlotPool(["k0", "k1"], c.PoolConfig(models=(c.Model("a", 5.0), c.Model("b", 5.0)), rotations=2), lambda: now[0], slept.append)
    seen = []

    def ask(key, model):
        seen.append((key, model))
        if (key, model) == ("k0", "a"):
            raise RuntimeError("429 quota")
        return "ok"

    assert p.call(ask) == ("ok", 1) and p.at == 2 and p.stats[0]["limited"]
    assert p.call(ask) == ("ok", 2) and p.call(ask) == ("ok", 3)
    assert p.call(ask) == ("ok", 1) and slept == [5.0]
    q = pool.SlotPool(["k"], c.PoolConfig(models=(c.Model("a"),)), lambda: 0.0, slept.append)
    assert q.call(lambda *_: 1 / 0) == (None, None) and slept[-1] == 60.0
    assert pool.load_keys("K", {"K_2": "b", "K": "z"}) == ["b"] and pool.load_keys("K", {"K": "z"}) == ["z"]


def test_throttle(spark):
    rows = [(0, "a", "2026-01-01 00:00:00", True), (0, "a", "2026-01-01 00:00:02", False), (0, "a", "2026-01-01 00:00:20", True)]
    df = spark.createDataFrame(rows, "key_index int, model string, ts string, ok boolean").withColumn("ts", F.to_timestamp("ts"))
    assert [x.wait for x in pool.throttle(df, {"a": 5.0}).orderBy("ts").collect()] == [0.0, 3.0, 0.0]


BODY = "<p>" + "words of the page. " * 20 + "</p>"
SITE = {
    "https://www.x.edu/": f"<title>X</title><nav><a href='/admissions'>Apply</a><a href='/tuition'>Costs</a><a href='/a.pdf'>no</a></nav>{BODY}",
    "https://www.x.edu/admissions/": f"<title>Adm</title>{BODY}<a href='/deadline'>Dates</a><a href='/news'>News</a>",
    "https://www.x.edu/tuition/": f"<title>Fees</title>{BODY}",
    "https://www.x.edu/deadline/": f"<title>Dates</title>{BODY}",
    "https://www.x.edu/apply-now": f"<title>Now</title>{BODY}",
}


OVERVIEW = json.dumps({"university_name": " X  U ", "university_name_confidence": "high", "state": "pennsylvania", "email": "bad@", "postal_code": "1"})
TUITION = json.dumps({"items": [{"fee_type": "Tuition ", "cost": 100, "currency": None, "confidence": "high"}, {"fee_type": "Tuition ", "cost": 100}], "overall_confidence": "high"})


def answers():
    known = {"overview": (OVERVIEW, "m"), "tuition": (TUITION, "m")}
    return lambda kind, prompt: known[kind]  # deadlines fail


def job(spark, model):
    fetched = spark.createDataFrame([(u, u, 200, "text/html", h, None, 5, 0) for u, h in SITE.items()], fetch.FETCHED)
    robots = spark.createDataFrame([("https://www.x.edu/", 200, "Sitemap: https://www.x.edu/s.xml")], "seed string, status int, body string")
    maps = spark.createDataFrame([("https://www.x.edu/s.xml", 200, "<urlset><url><loc>https://www.x.edu/apply-now</loc></url></urlset>")], "url string, status int, body string")
    return etl.Job(fetch.Table(fetched), model, robots, maps, "2026-01-16", "2026-01-16T00:00:00+00:00")


def test_job(spark, tmp_path):
    seeds = spark.createDataFrame([("x.edu",), ("x.edu",), ("10.0.0.1",), ("gone.edu",)], "raw string")
    out = etl.run(job(spark, extract.Callable(answers())), seeds).cache()
    rows = {r.raw: r for r in out.collect()}
    assert rows["10.0.0.1"].error == "address" and rows["gone.edu"].error == "no pages" and len(rows) == 3
    r = rows["x.edu"]
    assert r.error is None and r.overview.university_name == "X U" and r.overview.location.state == "PA"
    assert r.overview.contact.email is None and r.overview.location.postal_code is None
    assert [(t.fee_type, t.currency) for t in r.tuition_breakdown] == [("Tuition", "USD")] * 2 and r.admission_deadlines == []
    assert r.quality_report.duplicate_tuition_count == 1 and r.quality_report.total_fields_expected == 10
    assert {x.extraction_type: x.overall_confidence for x in r.extraction_confidence} == {"overview": "medium", "tuition": "high", "deadlines": "low"}
    assert r.page_metadata[0].url == "https://www.x.edu/" and {m.url for m in r.page_metadata} == set(SITE)
    t = etl.totals(out).first()
    assert (t.succeeded, t.failed, t.tuition) == (1, 2, 2)
    sinks.write_files(out.where("error is null"), str(tmp_path / "out"))
    saved = json.loads((tmp_path / "out/www_x_edu.json").read_text())
    assert saved["overview"]["contact"] == {"phone": None, "email": None}
    sinks.write_json(out, str(tmp_path / "lines"))
    assert quality.severities(out.where("error is null")).first().errors == 0


def test_files_are_whole_or_absent(spark, tmp_path):
    """A file that cannot get its name fails the task and leaves no part; writing again replaces whole files."""
    rows = spark.createDataFrame([("https://a.edu/", "x"), ("https://b.edu/", "y")], "seed string, overview string").coalesce(1)
    (tmp_path / "b_edu.json").mkdir()
    with pytest.raises(Exception, match="b_edu.json"):
        sinks.write_files(rows, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {"a_edu.json", "b_edu.json"}
    (tmp_path / "b_edu.json").rmdir()
    for _ in range(2):
        sinks.write_files(rows, str(tmp_path))
    assert {p.name: json.loads(p.read_text())["overview"] for p in tmp_path.iterdir()} == {"a_edu.json": "x", "b_edu.json": "y"}


def counted(folder, blocked=()):
    """A fetch function that notes each call in a file; ``blocked`` pages are refused in the standard mode."""

    def get(url, mode, timeout_ms):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{mode} {url} {timeout_ms}")
        if url not in SITE:
            return None
        return {"final_url": url, "status_code": 403 if url in blocked and mode == "standard" else 200, "content_type": None, "html": SITE[url], "title": None, "depth": 0}

    return get


def test_job_asks_for_each_page_once(spark, tmp_path):
    """Homepages, pages one level down and chosen pages overlap; refused pages and their domain go to the second adapter."""
    seeds = spark.createDataFrame([("x.edu",)], "raw string")
    for name, blocked in (("open", ()), ("refused", ("https://www.x.edu/",))):
        calls = tmp_path / name
        calls.mkdir()
        get = counted(str(calls), blocked)
        j = job(spark, extract.Callable(answers()))
        j.pages, j.second, j.folder = fetch.Callable(get, delay=0, tasks=2), fetch.Callable(get, "alternate", delay=0, tasks=2), str(tmp_path / f"{name}-job")
        assert etl.run(j, seeds).first().error is None
        seen = [f.read_text().split() for f in calls.iterdir()]
        assert len({(m, u) for m, u, _ in seen}) == len(seen) and {u for _, u, _ in seen} == set(SITE)
        assert [m for m, u, _ in seen if u == "https://www.x.edu/"].count("standard") == 1
        assert {m for m, u, _ in seen if u != "https://www.x.edu/"} == ({"alternate"} if blocked else {"standard"})


def test_job_without_navigation(spark):
    j = job(spark, extract.Callable(answers()))
    j.navigate = False
    got = etl.run(j, spark.createDataFrame([("x.edu",)], "raw string")).first()
    assert [m.url for m in got.page_metadata] == ["https://www.x.edu/", "https://www.x.edu/apply-now"]


def test_files(spark):
    """Robots files and sitemaps through an adapter, each level asked for its own files."""
    known = {"https://x.edu/s.xml": (200, "<sitemapindex><sitemap><loc>https://x.edu/t.xml</loc></sitemap></sitemapindex>"), "https://x.edu/t.xml": (200, "<urlset><url><loc>https://x.edu/p</loc></url></urlset>")}
    start = spark.createDataFrame([("s", "x.edu", "https://x.edu/s.xml"), ("s", "x.edu", "https://x.edu/none.xml")], "seed string, base string, url string")
    got = web.sitemap_pages(start, web.Files(lambda u: known.get(u, (404, None)), tasks=2)).collect()
    assert [tuple(r) for r in got] == [("s", "x.edu", "https://x.edu/p")]
    assert web.http_get("http://127.0.0.1:9/robots.txt", timeout=1.0) == (0, None)


def test_deep_sitemaps(spark, tmp_path):
    """Each file is asked for once, at any depth, and the last level's plan is as the first one's."""
    import os
    import uuid

    notes = tmp_path / "notes"
    notes.mkdir()

    def get(url):
        with open(os.path.join(str(notes), uuid.uuid4().hex), "w") as f:
            f.write(url)
        k = int(url.rsplit("/", 1)[1])
        return 200, f"<sitemapindex><sitemap><loc>https://x.edu/{min(k + 1, 8)}</loc></sitemap><sitemap><loc>https://x.edu/0</loc></sitemap><url><loc>https://x.edu/p{k}</loc></url></sitemapindex>"

    start = spark.createDataFrame([("s", "x.edu", "https://x.edu/0")], "seed string, base string, url string")
    got = web.sitemap_pages(start, web.Files(get, tasks=2), folder=str(tmp_path))
    assert sorted(r.url for r in got.collect()) == [f"https://x.edu/p{k}" for k in range(9)] and len(got.collect()) == 9
    assert sorted(f.read_text() for f in notes.iterdir()) == [f"https://x.edu/{k}" for k in range(9)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    few = web.sitemap_pages(start, web.Files(get, tasks=2), 2, str(tmp_path))
    assert sorted(r.url for r in few.collect()) == [f"https://x.edu/p{k}" for k in range(3)]


def test_pooled_model(spark):
    """Prompts go through the slots of their key; limited models are passed over."""

    def ask(key, model, kind, prompt):
        if model == "a" or kind == "bad":
            raise RuntimeError("429 quota")
        return f"{key} {model} {prompt}"

    asked = spark.createDataFrame([(f"s{i}", "bad" if i == 7 else "overview", [], f"p{i}") for i in range(20)], "seed string, extraction_type string, source_urls array<string>, prompt string")
    adapter = extract.Pooled(ask, ["k0", "k1", "k2"], c.PoolConfig(models=(c.Model("a", 0.0), c.Model("b", 0.0)), rotations=1), sleep=lambda s: None)
    got = {r.seed: r for r in adapter.extract(asked).collect()}
    assert len(got) == 20 and got["s7"].error == "no slot answered" and got["s7"].response_json is None
    assert all(got[f"s{i}"].model == "b" and got[f"s{i}"].response_json.endswith(f" b p{i}") for i in range(20) if i != 7 and got[f"s{i}"].error is None)
    assert sum(r.error is None for r in got.values()) >= 10


def test_rounds(spark, tmp_path):
    """Each slot keeps its delay over all tasks; prompts of an exhausted key go to the others, in turn; the rest have no answer."""
    import os
    import time
    import uuid

    notes = tmp_path / "notes"
    notes.mkdir()

    def ask(key, model, kind, prompt):
        with open(os.path.join(str(notes), uuid.uuid4().hex), "w") as f:
            f.write(f"{time.time()} {key} {model} {prompt}")
        if key == "k0":
            raise RuntimeError("429 quota")
        if prompt == "p7" or model == "b" and prompt in ("p1", "p2"):
            raise RuntimeError("broken")
        return f"{key} {model} {prompt}"

    asked = spark.createDataFrame([(f"s{i}", "overview", [], f"p{i}") for i in range(24)], "seed string, extraction_type string, source_urls array<string>, prompt string")
    adapter = extract.Rounds(ask, ["k0", "k1", "k2"], str(tmp_path), c.PoolConfig(models=(c.Model("a", 0.2), c.Model("b", 0.1)), rotations=2, wait=0.0), most=3)
    got = {r.seed: r for r in adapter.extract(asked).collect()}
    assert len(got) == 24 and got["s7"].error == "no slot answered" and got["s7"].model is None
    assert all(r.error is None and r.response_json.split()[0] in ("k1", "k2") and r.response_json.endswith(f" p{s[1:]}") for s, r in got.items() if s != "s7")
    calls = sorted((float(t), k, m, p) for t, k, m, p in (f.read_text().split() for f in notes.iterdir()))
    slots = [(k, m) for m in "ab" for k in ("k0", "k1", "k2")]
    answered = {tuple(r.response_json.split()) for r in got.values() if r.response_json}
    for key, model in slots:
        good = [t for t, k, m, p in calls if (k, m) == (key, model) and (k, m, p) in answered]
        assert all(b - a >= (0.19 if model == "a" else 0.09) for a, b in zip(good, good[1:]))
    # every prompt goes through its slots in turn
    for i in range(24):
        mine = [slots.index((k, m)) for _, k, m, p in calls if p == f"p{i}"]
        steps = [(b - a) % 6 for a, b in zip(mine, mine[1:])]
        assert i == 7 or sum(steps) < 6
    asked7 = [(k, m) for _, k, m, p in calls if p == "p7"]
    assert len(asked7) >= 8 and set(asked7) >= {(k, m) for k in ("k1", "k2") for m in "ab"}  # twice through all that answer
    assert sum(s["requests"] for s in adapter.stats) == 23 and all(s["failures"] for s in adapter.stats[:1])
    assert extract.Rounds(ask, ["k1"], str(tmp_path)).extract(asked.limit(0)).count() == 0


def test_broken_answers(spark):
    """An answer that is no JSON, or does not fit its schema, is a failed one."""
    rows = spark.createDataFrame([("a", "tuition", "{broken"), ("b", "tuition", '{"items": [{"cost": 5}]}'), ("c", "tuition", "")], "seed string, extraction_type string, response_json string")
    assert {r.seed for r in extract.typed(rows, "tuition", extract.TUITION).where("r is not null").collect()} == {"b"}


def test_malformed_html():
    """Broken markup is read in time that grows with its length."""
    import time

    from lodestone.functions import html

    for page in ("<div><a href=x>" * 30_000, "<a" * 200_000, "<a b='" * 60_000, "<!-- -" * 60_000, "<ul><li>" * 30_000):
        took = []
        for part in (page[: len(page) // 2], page):
            start = time.perf_counter()
            html.to_markdown(part)
            took.append(time.perf_counter() - start)
        assert took[1] < 4 * took[0] + 2 and took[1] < 30


def test_fetch(spark):
    calls = {"standard": {"https://a.edu/1": 403, "https://a.edu/2": 200}, "alternate": {"https://a.edu/1": 200}}

    def get(url, mode):
        s = calls[mode].get(url)
        return s and {"final_url": url, "status_code": s, "content_type": "text/html", "html": "x" * 200, "title": None, "fetch_time_ms": 9000, "depth": 0}

    wanted = spark.createDataFrame([("https://a.edu/1",), ("https://a.edu/2",), ("https://a.edu/2",), ("https://a.edu/3",)], "url string")
    got = fetch.with_fallback(wanted, fetch.Callable(get), fetch.Callable(get, "alternate"))
    assert sorted((r.url[-1], r.mode) for r in got.collect()) == [("1", "alternate"), ("2", "standard")]
    s = fetch.domain_state(got).first()
    assert s.slow and s.alternate and s.timeout_ms == c.FAST_TIMEOUT_MS


def test_stream(spark, tmp_path):
    rows = [("https://a.edu/1", "2026-01-01 00:00:00", 10_000), ("https://a.edu/1", "2026-01-01 00:10:00", 9_000), ("https://b.edu/1", "2026-01-01 05:00:00", 1)]
    df = spark.createDataFrame(rows, "url string, ts string, fetch_time_ms int").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = state.domain_latency(stream).writeStream.format("memory").queryName("latency").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.domain, r.n, r.slow) for r in spark.table("latency").collect()} == {("a.edu", 2, True), ("b.edu", 1, False)}
