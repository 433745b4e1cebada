"""Page classes and the context that extraction reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions.text import col


def page_class(url, words) -> Column:
    return F.lower(col(url)).rlike(c.any_of(words, escape=True))


def classify_pages(pages: DataFrame, seed: str = "seed", url: str = "url", admissions=c.PAGE_ADMISSIONS, tuition=c.PAGE_TUITION) -> DataFrame:
    """is_admissions and is_tuition; a class without pages is all pages of its seed.

    What a seed has comes from partial maxima, joined back: pages of one seed do not have to meet in one task.
    """
    out = pages.withColumns({"_a": page_class(url, admissions), "_t": page_class(url, tuition)})
    has = out.groupBy(F.col(seed).alias("_s")).agg(F.max("_a").alias("_ha"), F.max("_t").alias("_ht"))
    whole = lambda x, h: F.col(x) | ~F.col(h)
    return out.join(has, F.col(seed).eqNullSafe(F.col("_s"))).withColumns(
        {"is_admissions": whole("_a", "_ha"), "is_tuition": whole("_t", "_ht")}).drop("_a", "_t", "_s", "_ha", "_ht")


def assemble(pages: DataFrame, key: str = "seed", pos: str = "pos", url: str = "url", text: str = "markdown", first: int = c.CONTEXT_PAGES, limit: int = c.CONTEXT_CHARS) -> DataFrame:
    """(key, context, source_urls): the first pages in order, each under its URL, cut at ``limit`` characters in all."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(pos))
    chunk = F.concat(F.lit("\n\n## Page: "), F.col(url), F.lit("\n"), F.substr(F.col(text), F.lit(1), F.lit(limit)))
    kept = pages.withColumn("_n", rank).where(F.col("_n") <= first)
    rows = F.array_sort(F.collect_list(F.struct("_n", F.col(url).alias("u"), chunk.alias("chunk"))))
    return kept.groupBy(key).agg(rows.alias("rows")).select(
        key, F.substr(F.array_join(F.transform("rows", lambda r: r["chunk"]), ""), F.lit(1), F.lit(limit)).alias("context"),
        F.transform("rows", lambda r: r["u"]).alias("source_urls"))
