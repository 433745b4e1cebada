"""Streaming forms of crawl state (an extension: the batch forms are in ``operators.fetch``)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .. import config as c
from ..functions import urls

MEMORY = "n long, url string, action string, mode string, calls int, timeout_ms int"


def domain_latency(stream: DataFrame, ts: str = "ts", url: str = "url", ms: str = "fetch_time_ms", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Average load time of each domain and window; rows later than ``late`` are dropped with the window's state."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, window), urls.domain_key(url).alias("domain"))
        .agg(F.avg(ms).alias("avg_ms"), F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), "domain", "n", "avg_ms", (F.col("avg_ms") > c.SLOW_MS).alias("slow"))
    )


def first_fetch(stream: DataFrame, ts: str = "ts", url: str = "url", late: str = "1 day") -> DataFrame:
    """Each URL once within the watermark: the page cache of a running crawl."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([url])


def _memory(slow: int, keep_ms: int | None, fast: int, usual: int) -> StatefulProcessor:
    """A class of this function travels with its code: the worker that sets up the state on the driver lacks shipped packages."""

    class Memory(StatefulProcessor):
        """Of one domain its URLs with what became of them, its loads and whether it needs the alternate mode."""

        def init(self, handle) -> None:
            self.urls = handle.getMapState("urls", "url string", "ok boolean, mode string", keep_ms)
            self.domain = handle.getValueState("domain", "loads long, ms long, sticky boolean", keep_ms)

        def handleInputRows(self, key, rows, timerValues):
            pdf = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "n"], kind="stable")
            loads, ms, sticky = self.domain.get() if self.domain.exists() else (0, 0, False)
            seen: dict[str, tuple] = {}  # what this batch has looked up or found
            out = []
            for r in pdf.itertuples():
                if r.url not in seen and self.urls.containsKey((r.url,)):
                    seen[r.url] = tuple(self.urls.getValue((r.url,)))
                if r.url in seen:
                    ok, mode = seen[r.url]
                    out.append((r.n, r.url, "cached" if ok else "skipped", mode, 0, None))
                    continue
                limit = fast if ms > slow * loads else usual
                tries = [("alternate", r.second_ok, r.second_ms)] if sticky else [("standard", r.first_ok, r.first_ms), ("alternate", r.second_ok, r.second_ms)]
                ok, calls = False, 0
                for mode, ok, took in tries:
                    calls += 1
                    if not pd.isna(took):
                        loads, ms = loads + 1, ms + int(took)
                    ok = not pd.isna(ok) and bool(ok)
                    if ok:
                        break
                sticky = sticky or (ok and mode == "alternate")
                seen[r.url] = (ok, mode if ok else None)
                self.urls.updateValue((r.url,), seen[r.url])
                out.append((r.n, r.url, "fetched" if ok else "failed", seen[r.url][1], calls, limit))
            self.domain.update((loads, ms, sticky))
            got = pd.DataFrame(out, columns=["n", "url", "action", "mode", "calls", "timeout_ms"])
            yield got.astype({"timeout_ms": "Int32", "calls": "int32"})

        def close(self) -> None:
            pass

    return Memory()


def crawl_memory(requests: DataFrame, slow: int = c.SLOW_MS, keep_ms: int | None = None) -> DataFrame:
    """``fetch.replay`` of a stream of requests: what is known of URLs and domains is state, kept from batch to batch.

    Within a batch requests go by ``ts`` and ``n``; a later batch is taken to be later.  What has not been written for
    ``keep_ms`` milliseconds is forgotten.  The state is one row for each URL and domain, in the state store, not in memory; the
    session needs the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``).
    """
    some = requests.where("url is not null").select("n", "ts", "url", "first_ok", "first_ms", "second_ok", "second_ms", F.coalesce(urls.domain_key("url"), F.lit("")).alias("domain"))
    mode = "ProcessingTime" if keep_ms else "None"
    return some.groupBy("domain").transformWithStateInPandas(_memory(slow, keep_ms, c.FAST_TIMEOUT_MS, c.TIMEOUT_MS), MEMORY, "Append", mode)
