"""Markdown made once for each content, over URLs and over runs: a table keyed by digest that runs add to."""

from __future__ import annotations

import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as c
from ..functions import html as h

KNOWN = "digest string, markdown string, run string"


def known(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, markdown, run): what runs have converted; none where no run has written."""
    try:
        return spark.read.schema(KNOWN).parquet(folder)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], KNOWN)


def markdown_once(
    pages: DataFrame, memory: str, run: str, url: str = "url", html: str = "html", limit: int = c.CONTEXT_CHARS,
    tags=c.NOISE_TAGS, classes=c.NOISE_CLASSES,
) -> DataFrame:
    """``pages`` with ``digest``, ``markdown`` and ``made_in``, the run that converted this content; all other columns stay.

    Contents that another run has written to ``memory`` are not converted again; of equal contents that are new, those of one URL
    are (its repeated rows too, of which one result stays).  Only digests and URLs are shuffled to find them, not the html.
    Each choice of limit, tags and classes has a table of its own.  A run writes its own part and reads those of others, so
    one that is run again under its name writes the same.  Null html has empty Markdown, as with ``html.markdown``, and neither
    digest nor run.
    """
    spark = pages.sparkSession
    folder = f"{memory}/form={zlib.crc32(repr((limit, sorted(tags), sorted(classes))).encode()):08x}"
    keyed = pages.select(F.col(url).alias("u"), F.col(html).alias("h"), F.sha2(F.col(html), 256).alias("d")).where("h is not null")
    before = known(spark, folder).where(F.col("run") != run)
    new = keyed.groupBy("d").agg(F.min("u").alias("first")).join(before.select(F.col("digest").alias("d")), "d", "left_anti")
    chosen = keyed.join(new.withColumnRenamed("d", "k"), (F.col("d") == F.col("k")) & F.col("u").eqNullSafe(F.col("first")), "left_semi")
    made = chosen.select(F.col("d").alias("digest"), h.markdown("h", limit, tags, classes).alias("markdown"))
    made.dropDuplicates(["digest"]).write.mode("overwrite").parquet(f"{folder}/run={run}")
    every = known(spark, folder).withColumnRenamed("run", "made_in")
    out = pages.withColumn("digest", F.sha2(F.col(html), 256)).join(every, "digest", "left")
    return out.withColumn("markdown", F.when(F.col(html).isNull(), F.lit("")).otherwise(F.col("markdown")))
