"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable

#: An id in more than this share of the links is a hub; there are at most twice the inverse of hubs, so they are broadcast.
HUB = 1 / 512


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """(a, b, m): each link with the least b of its a, in m.  Links of hubs are met where they are read, not in one task."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select(F.col("a").alias("k"), "m", "n")
    hubs = least.where(F.col("n") > total * HUB).select(F.col("k").alias("h"), F.col("m").alias("hm"))
    marked = edges.join(F.broadcast(hubs), F.col("a") == F.col("h"), "left")
    cold = marked.where("h is null").select("a", "b").join(least.where(F.col("n") <= total * HUB), F.col("a") == F.col("k"))
    return marked.where("h is not null").select("a", "b", F.col("hm").alias("m")).union(cold.select("a", "b", "m"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = _with_least(edges.union(edges.select("b", "a").toDF("a", "b")), total)
    return both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    near = _with_least(edges, total)  # the least of a is among its links: each link gives one, whatever its repeats
    return near.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(a, b) links between long ids, a > b -> (id, component), one row for each id with a smaller one in reach.

    Ends when a round changes nothing, which is judged by the number and the sum of hashes of the links.
    """
    store = Durable(edges.sparkSession, "stars")
    current = store.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(current)
    while before[0]:
        large = store.write(_large_star(current, before[0]).where("a <> b"))  # as many links as there are; repeats do no harm
        after = store.write(_small_star(large, before[0]).where("a <> b").distinct())
        store.drop(large)
        store.drop(current)
        current, now = after, mark(after)
        if now == before:
            break
        before = now
    return current.toDF("id", "component")
