"""Audit of how far the sources of a language differ in their words, by inclusion-exclusion over the words each of them has.

The distance of two sources is a sum over all kept terms, but a source has few of them.  A term's price depends on its count
alone, so the terms that one source has are priced against the other's price of zero from a histogram of counts; terms that both
have are corrected by a join of postings; terms that neither has cost the same constant.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable, bounded_batches, few, one_column, table, text_buffer

#: Terms of a language stand in so many of its documents; added to every count; ranks of the part ``term``.
MIN_DOCS, PRIOR, TOP = 30, 5, 50
#: A task hands on its counts when it holds so many terms, or those of so many bytes of text.
HELD_TERMS, HELD_BYTES = 200_000, 64 << 20

#: Lower-cases A-Z; space for bytes outside terms, which are ASCII other than letters.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SCHEMA = "lang string, source string, term string, n long, docs long"
_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _given(groups: dict):
    """Counts as batches: each group has a row without a term, so that those without any term are known."""
    for (lang, source), (n, docs) in groups.items():
        terms = list(n)
        for i in range(0, len(terms) + 1, 1 << 16):
            part = terms[i : i + (1 << 16)]
            names = pa.array([None, *part] if i == 0 else part, pa.binary()).cast(pa.string())
            k = len(names)
            if k:
                counts = [[0] * (i == 0) + [c[t] for t in part] for c in (n, docs)]
                yield pa.record_batch([pa.array([lang] * k), pa.array([source] * k), names, *(pa.array(c, pa.int64()) for c in counts)], schema=_ARROW)


def _count(batches):
    groups, held, size = {}, 0, 0
    for batch in batches:
        raw, at = text_buffer(one_column(batch, "text"))
        keys = zip(one_column(batch, "lang").to_pylist(), one_column(batch, "source").to_pylist())
        for i, key in enumerate(keys):
            n, docs = groups.setdefault(key, (Counter(), Counter()))
            words = raw[at[i] : at[i + 1]].tobytes().translate(_TERM).split()
            held -= len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n)
            size += int(at[i + 1] - at[i])
            if held > HELD_TERMS or size > HELD_BYTES:
                yield from _given(groups)
                groups, held, size = {}, 0, 0
    yield from _given(groups)


def _price(n: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (n + PRIOR) / (total + PRIOR * terms)), exact in decimals; 0 where no term is kept."""
    exact = lambda x: f"cast({x} as decimal(20, 0))"
    return F.expr(f"CASE WHEN {terms} = 0 THEN 0L ELSE 1 + (1000000000BD * ({exact(n)} + {PRIOR})) div ({exact(total)} + {PRIOR} * {exact(terms)}) END")


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _one_sided(hist: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, source, other, x): the source's terms against the other's price of zero, summed.

    The prices of a source and the zero prices of all others are put in one order; running sums up to a zero price split the
    source's terms in those below and those above it.
    """
    group = W.partitionBy("lang", "source")
    up_to = group.orderBy("v").rangeBetween(W.unboundedPreceding, W.currentRow)
    rows = hist.select("lang", "source", F.lit(None).cast("string").alias("other"), F.col("p").alias("v"), "k", (F.col("k") * F.col("p")).alias("s"))
    rows = rows.union(pairs.select("lang", "source", "other", F.col("other_z").alias("v"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    run = rows.select("*", F.sum("k").over(up_to).alias("bk"), F.sum("s").over(up_to).alias("bs"), F.sum("k").over(group).alias("ak"), F.sum("s").over(group).alias("as_"))
    return run.where("other is not null").select("lang", "source", "other", F.expr("as_ - 2 * bs + v * (2 * bk - ak)").alias("x"))


def audit(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """lang, source, part, item, value, rank: of each source of a language its distance from every other, and its own terms.

    Part ``pair`` has a row for every other source of the language (so as many as the sources squared, the wanted result), part
    ``term`` the ``top`` terms that the source has more of than the language.  Null texts, languages and sources are empty; a
    row is a document, so repeated rows count each; texts are read whole; equal values are ordered by item.  A group without
    terms has its pairs, a language without kept terms pairs of value 0, an empty table no rows.  Other columns are not read.

    Tasks count terms where they read texts and hand on sums in bounded parts, so a hot source or word is a few rows of each
    task.  What follows works on the table of (language, source, term), whose rows for one term are as many as the sources.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    store = Durable(spark, "divergence")
    given = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    postings = store.write(given.mapInArrow(_count, _SCHEMA).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    found = postings.where("term is not null")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("m"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    own = store.write(found.drop("docs").join(kept, ["lang", "term"]))  # lang, term, source, n, m
    # sums over a language from its terms, each once
    sized = own.groupBy("lang", "term").agg(F.first("m").alias("m")).groupBy("lang").agg(F.count("*").alias("terms"), F.sum("m").alias("all_n"))
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("has"))
    groups = postings.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(sized, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "has", "terms", "all_n")])
    groups = store.write(groups.select("*", _price("0", "total", "terms").alias("z")))
    short = groups.hint("broadcast") if few(groups) else groups

    priced = own.join(short, ["lang", "source"]).select("lang", "source", "term", "n", "z", _price("n", "total", "terms").alias("p"), _price("m", "all_n", "terms").alias("q"))
    mine = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    other = short.select("lang", F.col("source").alias("other"), F.col("z").alias("other_z"), F.col("has").alias("other_has"))
    pairs = groups.repartition("lang", "source").join(other, "lang").where("source <> other")
    neither = pairs.select("lang", "source", "other", F.expr("(terms - has - other_has) * abs(z - other_z)").alias("x"))
    hist = own.groupBy("lang", "source", "n").agg(F.count("*").alias("k")).join(short, ["lang", "source"]).select("lang", "source", "k", _price("n", "total", "terms").alias("p"))
    one = _one_sided(hist, pairs)
    left, right = priced.select("lang", "term", "source", "p", "z"), priced.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("p2"), F.col("z").alias("z2"))
    both = left.join(right, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other").agg(
        F.sum(F.expr("abs(p - p2) - abs(p - z2) - abs(p2 - z) + abs(z - z2)")).alias("x"))
    each_way = F.explode(F.array(F.struct("source", "other"), F.struct(F.col("other").alias("source"), F.col("source").alias("other"))))
    twice = one.union(both).select("lang", each_way.alias("w"), "x").select("lang", "w.source", "w.other", "x")
    apart = neither.union(twice).groupBy("lang", "source", "other").agg(F.sum("x").alias("value"))
    apart = apart.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    return _ranked(apart).unionByName(_ranked(mine).where(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


#: Every kept term of every group, without any of the sums above.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS m FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sized AS (SELECT lang, count(*) AS v, sum(m) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
every AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n, m FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT e.*, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p,
        1 + (1000000000::HUGEINT * (m + 5)) // (total::HUGEINT + 5 * v) AS q FROM every e JOIN sized USING (lang)),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM f)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM k WHERE part = 'pair' OR rank <= 50
"""
