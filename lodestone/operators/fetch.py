"""Fetching as an adapter, and the checks and bookkeeping around it."""

from __future__ import annotations

import heapq
import inspect
import itertools
import time
from collections import deque
from collections.abc import Callable as Fn
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions import urls
from ..functions.text import col, strip
from ..session import ship

FETCHED = "url string, final_url string, status_code int, content_type string, html string, title string, fetch_time_ms int, depth int"
#: A task hands on what it has fetched from so many bytes on.
HELD_BYTES = 8 << 20


def rejection(content_type="content_type", status="status_code", html="html", least: int = c.MIN_HTML) -> Column:
    """Why a page is not valid; null if it is."""
    return (
        F.when(~F.lower(F.coalesce(col(content_type), F.lit(""))).contains("text/html"), "content_type")
        .when(~F.coalesce(col(status) < 400, F.lit(False)), "status").when(F.length(strip(F.coalesce(col(html), F.lit("")))) < least, "short")
    )


def bot_blocked(html="html", status="status_code", markers=c.BOT_MARKERS) -> Column:
    return F.coalesce(col(status) == 403, F.lit(False)) | F.lower(F.coalesce(col(html), F.lit(""))).rlike(c.any_of(markers, escape=True))


def auth_wall(html="html", url="final_url", paths=c.AUTH_PATHS, patterns=c.AUTH_HTML) -> Column:
    return F.lower(col(url)).rlike(f"/({'|'.join(paths)})") | F.coalesce(col(html), F.lit("")).rlike(f"(?i){c.any_of(patterns)}")


def blocked_request(kind="type", url="url", types=c.BLOCKED_TYPES, parts=c.BLOCKED_URLS) -> Column:
    return col(kind).isin(*types) | F.lower(col(url)).rlike(c.any_of(parts, escape=True))


class Table:
    """Pages from a table of fetched pages.

    Adapters give a row for each distinct URL, with a null page where none can be had, so that failures are known as such.
    """

    def __init__(self, fetched: DataFrame):
        self.fetched = fetched

    def fetch(self, wanted: DataFrame, times: DataFrame | None = None) -> DataFrame:
        return wanted.select("url").distinct().join(self.fetched, "url", "left")


def side_by_side(pages, ask: Fn, parallel: int, delay: float, threads: int, start: Fn = lambda url, domain: ()):
    """Yields ``ask(url, domain, *start(url, domain))`` of (url, domain) pairs as they come in.

    A domain has ``parallel`` places; a place begins ``delay`` seconds after it became free.  A heap of places by the time at
    which each may begin lets all domains of a task go on at once, in ``threads`` threads, so they take as long as the slowest.
    ``start`` is called when a page begins, in the caller's thread.
    """
    todo: dict[str, deque] = {}
    for url, domain in pages:
        todo.setdefault(domain, deque()).append(url)
    order, now = itertools.count(), time.monotonic()
    places = [(now + delay, next(order), domain) for domain, urls_ in todo.items() for _ in range(min(parallel, len(urls_)))]
    heapq.heapify(places)
    running: dict = {}
    with ThreadPoolExecutor(threads) as pool:
        while places or running:
            if places and not todo[places[0][2]]:
                heapq.heappop(places)
                continue
            rest = places[0][0] - time.monotonic() if places and len(running) < threads else None
            if rest is not None and rest <= 0:
                domain = heapq.heappop(places)[2]
                url = todo[domain].popleft()
                running[pool.submit(ask, url, domain, *start(url, domain))] = domain
            elif running:
                for done in wait(running, rest, FIRST_COMPLETED).done:
                    heapq.heappush(places, (time.monotonic() + delay, next(order), running.pop(done)))
                    yield done.result()
            else:
                time.sleep(rest)


class Callable:
    """Pages of ``fn(url, mode)`` or ``fn(url, mode, timeout_ms)``, a dict or None: each URL once.

    URLs are dealt by domain over ``tasks`` partitions (the session's shuffle partitions by default), so sites spread over the
    cluster while one site is asked by one task: at most ``parallel`` pages at once, each after ``delay`` seconds; the sites of a
    task go on side by side.  A domain whose pages took longer than the bound on average gets the short time-out, from ``times``
    (domain, n, ms) of earlier steps on.  What was fetched is a rendered page, so its content type is HTML; a missing time is
    measured, other missing keys are null.  A page that is None, raises or does not fit the columns is a failure.
    """

    def __init__(
        self, fn: Fn[..., dict | None], mode: str = "standard", parallel: int = c.SITE_PARALLEL, delay: float = c.SITE_DELAY, tasks: int | None = None,
        threads: int = c.TASK_THREADS,
    ):
        self.fn, self.mode, self.parallel, self.delay, self.tasks, self.threads = fn, mode, parallel, delay, tasks, threads

    def fetch(self, wanted: DataFrame, times: DataFrame | None = None) -> DataFrame:
        ship()
        fn, mode, parallel, delay, threads = self.fn, self.mode, self.parallel, self.delay, self.threads
        timed = len(inspect.signature(fn).parameters) > 2
        kinds = {"string": pa.string(), "int": pa.int32()}
        schema = pa.schema([(n, kinds[k]) for n, k in map(str.split, FETCHED.split(", "))])

        def row(page: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([page], schema)

        def ask(url, domain, limit):
            start = time.perf_counter()
            try:
                page = fn(url, mode, limit) if timed else fn(url, mode)
                if page:
                    page = {k: v for k, v in page.items() if k in schema.names} | {"url": url}
                    page["final_url"] = page.get("final_url") or url
                    if page.get("fetch_time_ms") is None:
                        page["fetch_time_ms"] = int(1000 * (time.perf_counter() - start))
                    if "text/html" not in (page.get("content_type") or "").lower():
                        page["content_type"] = "text/html; charset=utf-8"
                    return domain, page["fetch_time_ms"], row(page)
            except Exception:  # a page that cannot be fetched is data
                pass
            return domain, None, row({"url": url})

        def run(batches):
            spent: dict[str, tuple[int, float]] = {}  # of each domain, pages and milliseconds

            def start(url, domain):
                n, ms = spent[domain]
                return (c.FAST_TIMEOUT_MS if n and ms / n > c.SLOW_MS else c.TIMEOUT_MS,)

            for batch in batches:
                pages = batch.to_pylist()
                for p in pages:
                    spent.setdefault(p["d"], (p["n"] or 0, p["ms"] or 0.0))
                held: list[pa.RecordBatch] = []
                for domain, took, one in side_by_side([(p["url"], p["d"]) for p in pages], ask, parallel, delay, threads, start):
                    if took is not None:
                        n, ms = spent[domain]
                        spent[domain] = (n + 1, ms + took)
                    held.append(one)
                    if sum(x.nbytes for x in held) > HELD_BYTES:
                        yield from pa.Table.from_batches(held).to_batches()
                        held = []
                if held:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()

        tasks = self.tasks or int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        each = wanted.select("url").where("url is not null").distinct().withColumn("d", urls.domain_key("url"))
        if times is None:
            each = each.select("url", "d", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("ms"))
        else:
            each = each.join(times.select(F.col("domain").alias("_d"), "n", F.col("ms").cast("double").alias("ms")), F.col("d") == F.col("_d"), "left").drop("_d")
        return each.repartition(tasks, "d").mapInArrow(run, FETCHED)


def with_fallback(
    wanted: DataFrame, first, second=None, failed: DataFrame | None = None, sticky: DataFrame | None = None,
    shape: Fn[[DataFrame], DataFrame] | None = None, keep: Fn[[DataFrame, str], DataFrame] | None = None, times: DataFrame | None = None,
) -> DataFrame:
    """Each URL once, none of the failed; what the first adapter lacks or finds blocked or walled is asked of the second.

    Domains of ``sticky`` (domain) are asked of the second adapter alone.  ``shape`` turns fetched pages, with a column
    ``good``, into what is wanted of them; ``keep`` writes what an adapter gave, failures too, so that no page is asked for twice.
    ``times`` (domain, n, ms) are the load times so far.
    """
    shape, keep = shape or (lambda x: x), keep or (lambda x, _: x)
    todo = wanted.select("url").distinct()
    todo = todo.join(failed.select("url"), "url", "left_anti") if failed is not None else todo
    fine = rejection().isNull() & ~auth_wall()
    read = lambda adapter, urls_, good, mode: keep(shape(adapter.fetch(urls_, times).withColumns({"good": good, "mode": F.lit(mode)})), mode)
    plain = todo
    if second is not None and sticky is not None:
        plain = todo.join(sticky.select(F.col("domain").alias("_d")), urls.domain_key("url") == F.col("_d"), "left_anti")
    good = read(first, plain, fine & ~bot_blocked(), "standard").where("good").drop("good")
    if second is None:
        return good
    rest = read(second, todo.join(good.select("url"), "url", "left_anti"), fine, "alternate").where("good").drop("good")
    return good.unionByName(rest)


def in_order(wanted: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched pages with the position in which they were asked for; null and failed pages drop out."""
    got = wanted.join(fetched, "url")
    return got.where(F.col("html").isNotNull()) if "html" in fetched.columns else got


def domain_times(attempts: DataFrame, key="url", ms="fetch_time_ms") -> DataFrame:
    """(domain, n, ms): loads of each domain that were answered, whatever became of them, and their time in all."""
    return attempts.groupBy(urls.domain_key(key).alias("domain")).agg(F.count(ms).alias("n"), F.sum(F.col(ms).cast("double")).alias("ms")).where("n > 0")


def sticky_domains(attempts: DataFrame) -> DataFrame:
    """(domain): those of which the alternate mode has given a page."""
    return attempts.where(F.col("good") & (F.col("mode") == "alternate")).select(urls.domain_key("url").alias("domain")).distinct()


def replay(requests: DataFrame, slow: int = c.SLOW_MS, span: str = "hour") -> DataFrame:
    """What a crawl's memory makes of a log of requests: (n, url, action, mode, calls, timeout_ms) for each.

    ``requests`` has (n, ts, url, first_ok, first_ms, second_ok, second_ms): what each mode would give, with a null time where
    there is no answer.  A URL's first request is fetched in the standard mode, then in the alternate one if that fails; where
    that helps, later URLs of the domain go to the alternate mode at once.  Later requests of a URL are ``cached`` or, after
    a failure, ``skipped``.  The time-out is short where the domain's loads before took more than ``slow`` on average.

    Requests of one time are taken in order of ``n``; null URLs are left out.  A URL's first request and a domain's turn to the
    alternate mode are minima, and loads are added up by domain and span of time, so a domain with many requests is dealt too.
    """
    at = F.struct("ts", "n")
    some = requests.where("url is not null")
    first = some.groupBy("url").agg(F.min(F.struct("ts", "n", "first_ok", "first_ms", "second_ok", "second_ms")).alias("f")).select("url", "f.*")
    first = first.withColumns({"domain": urls.domain_key("url"), "span": F.date_trunc(span, "ts"), **{f"{k}_ok": F.coalesce(f"{k}_ok", F.lit(False)) for k in ("first", "second")}})
    turn = first.where("not first_ok and second_ok").groupBy(F.col("domain").alias("_d")).agg(F.min(at).alias("turn"))
    done = first.join(turn, F.col("domain") == F.col("_d"), "left").withColumn("sticky", F.coalesce(at > F.col("turn"), F.lit(False)))
    both = ~F.col("sticky") & ~F.col("first_ok")
    used = {"first": ~F.col("sticky"), "second": F.col("sticky") | both}
    load = lambda k, x: F.when(used[k], x).otherwise(0)
    done = done.withColumns({
        "ok": F.when(F.col("sticky"), F.col("second_ok")).otherwise(F.col("first_ok") | F.col("second_ok")), "calls": F.when(both, 2).otherwise(1),
        "mode": F.when(F.col("sticky") | both, "alternate").otherwise("standard"),
        "k": load("first", F.when(F.col("first_ms").isNotNull(), 1).otherwise(0)) + load("second", F.when(F.col("second_ms").isNotNull(), 1).otherwise(0)),
        "ms": (load("first", F.coalesce("first_ms", F.lit(0))) + load("second", F.coalesce("second_ms", F.lit(0)))).cast("long")})
    before = W.partitionBy("domain").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = done.groupBy("domain", "span").agg(F.sum("k").alias("sk"), F.sum("ms").alias("sms"))
    spans = spans.select(F.col("domain").alias("_d2"), F.col("span").alias("_s"), F.sum("sk").over(before).alias("bk"), F.sum("sms").over(before).alias("bms"))
    own = W.partitionBy("domain", "span").orderBy("ts", "n").rowsBetween(W.unboundedPreceding, -1)
    done = done.withColumns({"ok_": F.sum("k").over(own), "oms": F.sum("ms").over(own)}).join(spans, (F.col("domain") == F.col("_d2")) & (F.col("span") == F.col("_s")))
    zero = lambda x: F.coalesce(x, F.lit(0))
    is_slow = zero("oms") + zero("bms") > slow * (zero("ok_") + zero("bk"))
    known = done.select("url", F.col("n").alias("_n"), "ok", "calls", "mode", F.when(is_slow, c.FAST_TIMEOUT_MS).otherwise(c.TIMEOUT_MS).alias("timeout_ms"))
    now = F.col("n") == F.col("_n")
    return some.select("n", "url").join(known, "url").select(
        "n", "url", F.when(now, F.when(F.col("ok"), "fetched").otherwise("failed")).otherwise(F.when(F.col("ok"), "cached").otherwise("skipped")).alias("action"),
        F.when(F.col("ok"), F.col("mode")).alias("mode"), F.when(now, F.col("calls")).otherwise(0).alias("calls"), F.when(now, F.col("timeout_ms")).alias("timeout_ms"))


def domain_state(fetched: DataFrame, key="url", ms="fetch_time_ms", slow: int = c.SLOW_MS) -> DataFrame:
    """Average load time of each domain, whether it is slow, its timeout, and whether it needs the alternate mode."""
    sticky = F.max(F.col("mode") == "alternate") if "mode" in fetched.columns else F.lit(False)
    return fetched.groupBy(urls.domain_key(key).alias("domain")).agg(F.avg(ms).alias("avg_ms"), sticky.alias("alternate")).withColumns({
        "slow": F.col("avg_ms") > slow, "timeout_ms": F.when(F.col("avg_ms") > slow, c.FAST_TIMEOUT_MS).otherwise(c.TIMEOUT_MS)})
