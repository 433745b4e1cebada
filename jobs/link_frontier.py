"""Which links of each site to read next, kept up to date as pages come in (streaming).

A file stream takes the pages that no run has taken yet.  Their links are found, and each batch writes the first place of every
link to a log of its own, ``log/batch=N/bucket=B``.  Then the sites in the batch's buckets are ranked anew from the log, with
homepage, admissions and tuition in turn, and their part of ``frontier/bucket=B`` is replaced.  Both are done before the stream
marks the batch as taken and depend on the log alone, so a batch that is run again writes the same files again.

    python -m jobs.link_frontier --pages PATH --out PATH --checkpoint PATH [--config FILE]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import config as c
from lodestone.functions import html, urls
from lodestone.operators import discovery
from lodestone.session import ship

from .common import command_line, config, counted, log, total

NAME = "link_frontier"
_LINK = "seed string, url string, anchor_text string, source string, depth int, page_id long, pos int"
FRONTIER = "seed string, rank int, url string, category string, admissions_score double, tuition_score double, page_id long, bucket int"


def first_places(pages: DataFrame, buckets: int) -> DataFrame:
    """Each site and link once, where the site's pages name it first, and a row without a link for each site.

    The first place is a minimum, so tasks hand on one row for each link; a site with most of the pages does no harm.
    """
    base = pages.select("page_id", F.col("url").alias("page_url"), urls.host("url").alias("seed"), urls.base_domain("url").alias("base"), html.nav_links("html").alias("links"))
    base = base.where("seed <> ''")
    full = base.select("*", F.explode("links").alias("l")).withColumn("full", urls.resolve("page_url", "l.href"))
    kept = full.where(discovery.same_site_nav("full", "base") & ~discovery.skipped("full"))
    links = kept.select("seed", urls.link_form("full").alias("url"), "l.anchor_text", F.concat(F.lit("nav-"), "l.region").alias("source"), F.lit(1).alias("depth"), "page_id", "l.pos")
    sites = base.select("seed", *[F.lit(None).alias(x) for x in ("url", "anchor_text", "source", "depth", "page_id", "pos")])
    return _first(links.unionByName(sites)).withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(buckets)).cast("int"))


def _first(links: DataFrame) -> DataFrame:
    """Texts settle a tie of places, so that repeated pages give one result."""
    one = links.groupBy("seed", "url").agg(F.min(F.struct("page_id", "pos", "anchor_text", "source", "depth")).alias("x"))
    return one.select("seed", "url", "x.anchor_text", "x.source", "x.depth", "x.page_id", "x.pos")


def ranked(log_rows: DataFrame, settings: dict) -> DataFrame:
    """The frontier of the sites in a part of the log."""
    found = _first(log_rows.drop("batch", "bucket"))
    words = (settings["admissions"] or c.ADMISSIONS, settings["tuition"] or c.TUITION)
    slugs = (() if settings["admissions"] else c.ADMISSIONS_SLUGS, () if settings["tuition"] else c.TUITION_SLUGS)
    links = discovery.classified(discovery.scored(found.where("url is not null"), *words, *slugs))
    seeds = log_rows.where("url is null").select("seed").distinct().withColumn("homepage", F.concat(F.lit("https://"), "seed", F.lit("/")))
    top = discovery.balanced_top(links, seeds, settings["limit"])
    known = links.select("seed", "url", "category", "admissions_score", "tuition_score", "page_id")
    return top.join(known, ["seed", "url"], "left")


def _either(path: str) -> str:
    """A pattern that only this path matches: a stream takes a file as it takes a folder if the path is a pattern."""
    path = path.rstrip("/")
    return path if set("*?[{") & set(path) else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, pages: str, out: str, checkpoint: str, settings: dict | None = None) -> dict:
    """Takes what is new in the folder (or file) of pages; returns what was read and written.

    Pages without a site are left out, null html has no links, an empty input leaves the tables as they are.
    """
    settings = settings or config(NAME)
    ship(spark)
    done = {"batches": 0, "pages": 0, "links": 0, "frontier": 0}

    def take(batch: DataFrame, n: int) -> None:
        new, seen = counted(batch.select("page_id", "url", "html"), f"pages-{n}")
        rows, wrote = counted(first_places(new, settings["buckets"]), f"links-{n}")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/log/batch={n}")
        if not total(wrote):  # nothing of any site: no partition was written
            return
        every = spark.read.schema(f"{_LINK}, bucket int, batch long").option("basePath", f"{out}/log").parquet(f"{out}/log")
        touched = [r.bucket for r in every.where(F.col("batch") == n).select("bucket").distinct().collect()]  # at most ``buckets``
        top, ranks = counted(ranked(every.where(F.col("bucket").isin(touched)), settings), f"frontier-{n}")
        top.select(*[x.split()[0] for x in FRONTIER.split(", ") if x != "bucket int"], F.pmod(F.xxhash64("seed"), F.lit(settings["buckets"])).cast("int").alias("bucket")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{out}/frontier")
        got = {"batches": 1, "pages": total(seen), "links": total(wrote), "frontier": total(ranks)}
        done.update({k: done[k] + v for k, v in got.items()})
        log.info("batch %d of %s: read %d pages, wrote %d rows to the log, %d rows of %d buckets to the frontier of %s", n, pages, *list(got.values())[1:], len(touched), out)

    stream = spark.readStream.schema(spark.read.parquet(pages).schema).option("maxFilesPerTrigger", settings["files_per_batch"]).parquet(_either(pages))
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not done["batches"]:
        log.info("nothing new in %s", pages)
    return done


def frontier(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(FRONTIER).parquet(f"{out}/frontier")


if __name__ == "__main__":
    command_line(NAME, __doc__.splitlines()[0], {"pages": "folder of Parquet files (page_id, url, html)", "out": "folder of the result", "checkpoint": "folder of the stream's marks"}, run)
