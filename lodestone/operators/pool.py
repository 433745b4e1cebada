"""Slots of keys and models: the table, rotation, throttling, error classes and usage."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions.text import col


def load_keys(prefix: str, env=os.environ) -> list[str]:
    """``prefix_1`` to ``prefix_9``, else ``prefix`` alone."""
    keys = [env[k] for i in range(1, 10) if env.get(k := f"{prefix}_{i}")] or [env[prefix]] * bool(env.get(prefix))
    if not keys:
        raise ValueError(f"no key in {prefix}_1 to {prefix}_9 or {prefix}")
    return keys


def slot_table(spark: SparkSession, n_keys: int, models=c.PoolConfig().models) -> DataFrame:
    """(slot, key_index, model): all keys of the first model, then of the next."""
    rows = [(i, m.name) for i, m in enumerate(models)]
    m = spark.createDataFrame(rows, "model_rank int, model string")
    k = spark.range(n_keys).select(F.col("id").cast("int").alias("key_index"))
    return m.crossJoin(k).select((F.col("model_rank") * n_keys + F.col("key_index")).alias("slot"), "key_index", "model")


def rate_limited(error, words=c.RATE_LIMITED) -> Column:
    return F.lower(col(error)).rlike(c.any_of(words, escape=True))


def is_limited(error: str, words=c.RATE_LIMITED) -> bool:
    return any(w in error.lower() for w in words)


def throttle(
    attempts: DataFrame, delays: dict[str, float], default: float = 7.0, key=("key_index", "model"), ts: str = "ts", ok: str = "ok",
    order: tuple[str, ...] = (), every: str = "hour",
) -> DataFrame:
    """Adds ``wait``: seconds an attempt had still to wait since the slot's last success.  ``order`` settles equal times.

    There are few slots and many attempts, so attempts are dealt by slot and span of time (``every``); the last success of
    the spans before comes from a small table with one row for each slot and span.
    """
    on = [*key, "_span"]
    spanned = attempts.withColumn("_span", F.date_trunc(every, ts))
    carried = F.max("_last").over(W.partitionBy(*key).orderBy("_span").rowsBetween(W.unboundedPreceding, -1))
    spans = spanned.groupBy(*on).agg(F.max(F.when(F.col(ok), F.col(ts))).alias("_last")).select(*on, carried.alias("_before"))
    spans = spans.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(on)]
    mine = F.last(F.when(F.col(ok), F.col(ts)), True).over(W.partitionBy(*on).orderBy(ts, *order).rowsBetween(W.unboundedPreceding, -1))
    last = F.coalesce("_mine", "_before")
    need = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in delays.items() for x in kv]), F.col("model")), F.lit(default))
    gap = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / 1e6
    return spanned.withColumn("_mine", mine).join(spans, same, "left").withColumn(
        "wait", F.greatest(F.lit(0.0), need - F.coalesce(gap, need))).select(*attempts.columns, "wait")


def usage(attempts: DataFrame) -> DataFrame:
    """Requests, failures and rate limits of each slot, and their totals (slot null)."""
    return attempts.rollup("slot").agg(
        F.count_if("ok").alias("requests"), F.count_if(~F.col("ok")).alias("failures"), F.coalesce(F.max(rate_limited("error")), F.lit(False)).alias("limited"))


class SlotPool:
    """Rotation on a client: the next slot after each success, limited slots skipped, a wait between rotations."""

    def __init__(self, keys: list[str], config: c.PoolConfig = c.PoolConfig(), clock=time.monotonic, sleep=time.sleep):
        self.slots = [(k, m) for m in config.models for k in keys]
        self.config, self.clock, self.sleep, self.at = config, clock, sleep, 0
        self.stats = [{"requests": 0, "failures": 0, "limited": False, "last": None} for _ in self.slots]

    def call(self, ask: Callable[[str, str], object]):
        """(answer, slot) of the first slot that answers; (None, None) if none does."""
        for turn in range(self.config.rotations):
            for step in range(len(self.slots)):
                i = (self.at + step) % len(self.slots)
                (key, model), s = self.slots[i], self.stats[i]
                if s["limited"]:
                    continue
                if s["last"] is not None and (rest := model.delay - (self.clock() - s["last"])) > 0:
                    self.sleep(rest)
                try:
                    answer = ask(key, model.name)
                except Exception as e:  # a failing slot is data of the pool
                    s["failures"] += 1
                    s["limited"] = is_limited(str(e))
                    continue
                s["requests"] += 1
                s["last"] = self.clock()
                self.at = (i + 1) % len(self.slots)
                return answer, i
            if turn + 1 < self.config.rotations:
                self.sleep(self.config.wait)
                for s in self.stats:
                    s["limited"] = False
        return None, None
