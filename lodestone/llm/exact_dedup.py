"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

A Misra-Gries summary over the digests names the few that may be frequent.  Those are counted exactly, and the ones that
hold more than the support are a table of at most ``1 / support`` rows (with those hot by their exact count, ``MOST``), which is
broadcast, so rows of hot groups are decided where they are read and never meet in one task.  All other digests are counted by partial sums; only those on two or more rows
are joined back, each to fewer rows than the support, and no group is ever held in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Durable, few, free_name, table

#: Digests in more than this share of the rows are frequent, and those on more than HOT rows, or on more than one in MOST of them:
#: there are at most that many.  A summary takes no share below LEAST.
SUPPORT, HOT, MOST, LEAST = 1 / 256, 1 << 20, 200_000, 1e-4


def _bars(total: int) -> tuple[float, int]:
    """The share of rows that the summary looks for, and the rows of a digest from which on it is hot by its exact count."""
    return min(SUPPORT, max(LEAST, HOT / max(total, 1))), max(HOT, total // MOST)


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _groups(df: DataFrame, id_col: str, text: Column, support: float | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (id, rid, digest) of all rows, and (digest, best (id, rid), n) of the hot and of the other repeated texts."""
    store = Durable(df.sparkSession, "exact")
    rows = store.write(df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), _digest(text).alias("digest")))
    total = rows.count()
    share, bar = _bars(total)
    support = support or share
    best = [F.max(F.struct("id", "rid")).alias("best"), F.count("*").alias("n")]
    frequent = rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    # counted exactly; partial sums leave few rows for the shuffle
    winners = store.write(rows.join(F.broadcast(frequent), "digest").groupBy("digest").agg(*best).where(F.col("n") > total * support))
    cold = store.write(rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").groupBy("digest").agg(*best).where("n > 1"))
    if total * support > bar:  # more rows than the summary can tell apart: the counts themselves name the rest of the hot ones
        winners, cold = winners.unionByName(cold.where(F.col("n") > bar)), cold.where(F.col("n") <= bar)
    return rows, winners, cold


def group_copies(
    df: DataFrame, id_col: str = "doc_id", text: Column | None = None, support: float | None = None
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group (null counts as empty); the row with the largest id stays.  Repeated rows of
    that id tie: exactly one of them has ``kept`` true.  A null id is smaller than any other.  An empty table
    gives an empty result, very long texts are hashed whole; columns other than id and text are not read, so
    their names cannot clash.
    """
    rows, winners, cold = _groups(df, id_col, F.col("text") if text is None else text, support)
    marked = rows.join(F.broadcast(winners), "digest", "left")
    rest = marked.where("n is null").select("id", "rid", "digest").join(cold, "digest", "left")
    columns = ["id", "rid", "digest", "best", "n"]
    every = marked.where("n is not null").select(columns).unionByName(rest.select(columns))
    single = F.col("n").isNull()
    return every.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (single | (F.col("rid") == F.col("best.rid"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float | None = None) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the row with the largest id, of repeated rows one.

    Rows are judged by the digest of their text where they are read.  The table of repeated texts is broadcast if it is short;
    otherwise that of the hot ones is, and the rest of the rows are dealt by digest.  Null texts count as empty, an empty table
    gives an empty result, and columns may have any names.
    """
    rows, winners, cold = _groups(df, id_col, F.col(text_col), support)
    mark, best, key = free_name(df, "digest"), free_name(df, "best"), free_name(df, "key")
    same = F.col(id_col).eqNullSafe(F.col(best))
    named = lambda t: t.select(F.col("digest").alias(key), F.col("best.id").alias(best))
    src = df.withColumn(mark, _digest(F.col(text_col)))
    judge = lambda d, t: d.join(t, F.col(mark) == F.col(key), "left").where(F.col(key).isNull() | same)
    if few(cold):
        out = judge(src, F.broadcast(named(winners.unionByName(cold)))).select(*df.columns, mark)
    else:
        hot = src.join(F.broadcast(named(winners)), F.col(mark) == F.col(key), "left")
        left = judge(hot.where(F.col(key).isNull()).select(*df.columns, mark), named(cold).hint("shuffle_hash"))
        out = hot.where(F.col(key).isNotNull() & same).select(*df.columns, mark).unionByName(left.select(*df.columns, mark))
    # rows alike in id and text: only those that tie meet, after each task has dropped its own repeats
    again = rows.groupBy("digest", "id").count().where("count > 1")
    groups = winners.unionByName(cold).select(F.col("digest").alias("key"), F.col("best.id").alias("first"))
    ties = again.join(groups, (F.col("digest") == F.col("key")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    ties = Durable(df.sparkSession, "exact-ties").write(ties.select(F.col("digest").alias(key)))
    if not ties.limit(1).count():
        return out.drop(mark)
    ties = ties.hint("broadcast" if few(ties) else "shuffle_hash")
    one = out.join(ties, F.col(mark) == F.col(key), "left_semi").dropDuplicates([mark])
    return out.join(ties, F.col(mark) == F.col(key), "left_anti").unionByName(one).drop(mark)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_copies(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
