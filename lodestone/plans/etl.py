"""The whole extraction job: seeds in, nested records and a batch summary out.

All seeds pass each step as one DataFrame.  A seed that fails keeps a row with its error and never stops the others.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions import html, normalize, urls
from ..operators import context, discovery, extract, fetch, quality, validate
from ..sources import web


@dataclass
class Job:
    """``pages`` fetches URLs, ``second`` those it finds blocked; ``model`` answers prompts.

    ``robots`` and ``sitemaps`` are tables of bodies or adapters (``web.Files``).  ``navigate`` off leaves out the links of
    pages, so that only sitemaps are looked at.  ``folder`` is shared by the driver and all executors; what is costly to make is
    written there once.  A local master may go without it.  ``memory`` is a folder that runs share: what one has fetched, or failed
    to, the next does not ask for again, unless it is older than ``fresh`` (an interval, such as ``7 days``).
    """

    pages: object
    model: object
    robots: object
    sitemaps: object
    as_of: str | None = None
    scraped_at: str | None = None
    top: int = c.TOP
    folder: str | None = None
    second: object | None = None
    navigate: bool = True
    memory: str | None = None
    fresh: str | None = None
    run_id: str = ""
    bad: DataFrame | None = None
    steps: list[tuple[str, int, int, float]] = field(default_factory=list)
    read: list[DataFrame] = field(default_factory=list)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Written to ``folder`` and read again: a lost executor asks no site and no model a second time."""
        if not self.folder:
            if not df.sparkSession.sparkContext.master.startswith("local"):
                raise ValueError("name a folder that the driver and all executors share")
            self.folder = tempfile.mkdtemp(prefix="lodestone-job-")
        return self.put(df, f"{self.folder}/{name}", name)

    def put(self, df: DataFrame, path: str, name: str) -> DataFrame:
        """Writes a step and notes its rows, those that failed and its seconds, counted while they are written."""
        seen, begin = Observation(f"{name}-{uuid.uuid4().hex}"), time.perf_counter()
        bad = next((F.count_if(x) for k, x in (("good", ~F.col("good")), ("error", F.col("error").isNotNull())) if k in df.columns), F.count_if(F.lit(False)))
        df.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("failed")).write.mode("overwrite").parquet(path)
        seconds = time.perf_counter() - begin
        try:
            got = seen.get
        except Py4JJavaError:  # Spark found beforehand that there are no rows, and counted nothing
            got = {"rows": 0, "failed": 0}
        self.steps.append((name, got["rows"], got["failed"], seconds))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def pages_of(self, wanted: DataFrame, name: str) -> DataFrame:
        """What is needed of pages, each of which the whole job fetches once; their html stays where they are fetched.

        What was asked before, in this run or by an earlier one with the same ``memory``, is not asked again: a page is there, a
        failure stays one.  Load times and the domains that need the alternate mode carry over.
        """
        old = failed = sticky = times = None
        if self.read:
            every = self.read[0]
            for more in self.read[1:]:
                every = every.unionByName(more)
            old = every.where("good").join(wanted.select("url").distinct(), "url", "left_semi").drop("good", "fetched_at")
            failed, sticky, times = every.select("url").distinct(), fetch.sticky_domains(every), fetch.domain_times(every)
        now: list[DataFrame] = []

        def keep(df: DataFrame, mode: str) -> DataFrame:
            now.append(self.remember(df, f"{name}-{mode}") if self.memory else self.keep(df, f"{name}-{mode}"))
            return now[-1]

        new = fetch.with_fallback(wanted, self.pages, self.second, failed, sticky, _shape, keep, times).drop("fetched_at")
        self.read += now
        return new if old is None else old.unionByName(new)

    def remember(self, df: DataFrame, name: str) -> DataFrame:
        return self.put(df, f"{self.memory}/run={self.run_id}/step={name}", name)

    def recall(self, spark: SparkSession) -> None:
        """Begins a run with what ``memory`` holds and is not older than ``fresh``."""
        self.read.clear()
        self.steps.clear()
        self.run_id = uuid.uuid4().hex
        if not self.memory:
            return
        schema = _shape(spark.createDataFrame([], f"{fetch.FETCHED}, good boolean, mode string")).schema
        try:
            old = spark.read.schema(schema).parquet(self.memory)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return
        if self.fresh:
            old = old.where(F.col("fetched_at") > F.current_timestamp() - F.expr(f"INTERVAL {self.fresh}"))
        self.read.append(old.select(schema.names))


def _shape(fetched: DataFrame) -> DataFrame:
    """Of a fetched page its links, title and Markdown, made before anything is shuffled."""
    return fetched.select(
        "url", "status_code", "fetch_time_ms", "good", "mode", F.current_timestamp().alias("fetched_at"), html.title("html").alias("page_title"), html.nav_links("html").alias("nav"),
        html.all_links("html").alias("links"), html.markdown("html").alias("markdown"))


def discover(job: Job, seeds: DataFrame) -> DataFrame:
    """(seed, rank, url) of the pages to read for each valid seed."""
    base = job.keep(seeds.select(F.col("url").alias("seed"), urls.base_domain("url").alias("base")), "seeds")
    robots = job.robots
    if not isinstance(robots, DataFrame):
        at = base.select("seed", F.concat(F.regexp_replace("seed", "/+$", ""), F.lit("/robots.txt")).alias("url"))
        robots = at.join(job.keep(robots.fetch(at), "robots"), "url").drop("url")
    maps = web.robots_sitemaps(base.join(robots, "seed", "left").select(
        "seed", F.regexp_replace("seed", "/+$", "").alias("base_url"), "status", "body"))
    site = job.keep(discovery.sitemap_links(web.sitemap_pages(maps.join(base, "seed"), job.sitemaps, folder=job.folder)), "sitemap_links")
    raw = lambda f, links: f.select("*", F.explode(links).alias("l")).select("*", "l.*").drop("l", "nav", "links", "markdown")
    layer2 = site.limit(0)
    if job.navigate:
        home = job.pages_of(base.select(F.col("seed").alias("url")), "home").withColumnRenamed("url", "page_url")
        nav = discovery.navigation_links(raw(home.join(base, F.col("page_url") == F.col("seed")), "nav"))
        nav = job.keep(nav, "nav")
        chosen = job.keep(discovery.to_expand(discovery.scored(nav)).select("seed", "url", "rank"), "chosen")
        child = job.pages_of(chosen, "deep").join(chosen, "url").join(base, "seed").withColumnRenamed("url", "page_url")
        deep = discovery.expanded_links(raw(child, "links"), nav)
        layer2 = nav.select("seed", "url", "anchor_text", "source", "depth").unionByName(deep)
    links = job.keep(discovery.classified(discovery.scored(discovery.merged(site, layer2))), "links")
    return discovery.balanced_top(links, base.select("seed", F.col("seed").alias("homepage")), job.top)


def run(job: Job, raw_seeds: DataFrame) -> DataFrame:
    """One record for each distinct raw seed: raw, seed, error and the nested columns (null where there is an error).

    A record that breaks a rule of ``validate.RECORD`` is an error as well; ``job.bad`` has a row for each violation.  ``job.steps``
    has (step, rows, failed, seconds) of each table that the run wrote, in order.
    """
    job.recall(raw_seeds.sparkSession)
    seeds = web.seeds(raw_seeds)
    valid = seeds.where(F.col("error").isNull()).dropDuplicates(["url"])
    wanted = job.keep(discover(job, valid), "wanted")
    got = fetch.in_order(wanted, job.pages_of(wanted, "final").drop("nav", "links"))
    pages = job.keep(context.classify_pages(got).select(
        "seed", F.col("rank").alias("pos"), "url", "status_code", "page_title", "is_admissions", "is_tuition", "markdown"), "pages")
    asked = job.keep(extract.prompts(pages), "prompts")
    alive = pages.select("seed").distinct()
    values = extract.results(asked, job.keep(job.model.extract(asked), "responses"), alive)
    at = F.lit(job.scraped_at) if job.scraped_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    meta = pages.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.struct("url", "page_title", at.alias("scraped_at"), F.col("status_code").cast("string").alias("status_code")).alias("m")))).alias("m"))
    records = job.keep(values.join(meta.select("seed", F.transform("m", lambda x: x["m"]).alias("page_metadata")), "seed"), "values")
    as_of = F.lit(job.as_of).cast("date") if job.as_of else None
    made = quality.report(job.keep(normalize.record(records, as_of), "normalized"))
    made = job.keep(made.withColumn("violations", validate.violations(validate.known(validate.RECORD, made))), "records")
    job.bad = job.keep(made.select("seed", F.explode("violations").alias("v")).select("seed", "v.*"), "quarantine")
    done = made.withColumn("invalid", F.size("violations") > 0).drop("violations")
    whole = [c_ for c_ in done.columns if c_ not in ("seed", "invalid")]
    done = done.select(F.col("seed").alias("url"), "invalid", *[F.when(~F.col("invalid"), F.col(x)).alias(x) for x in whole])
    out = seeds.join(done, "url", "left")
    error = F.coalesce("error", F.when(F.col("invalid"), "invalid record").when(F.col("invalid").isNull(), "no pages"))
    return out.withColumn("error", error).drop("invalid").withColumnRenamed("url", "seed")


def summary(records: DataFrame) -> DataFrame:
    """(seed, ok, tuition, deadlines, completeness) of each record."""
    ok = F.col("error").isNull()
    n = lambda x: F.when(ok, F.size(x)).otherwise(0)
    return records.select("raw", ok.alias("ok"), n("tuition_breakdown").alias("tuition"), n("admission_deadlines").alias("deadlines"), "quality_report.completeness_score")


def totals(records: DataFrame) -> DataFrame:
    return summary(records).agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.sum("tuition").alias("tuition"), F.sum("deadlines").alias("deadlines"))


def step_times(marks: DataFrame) -> DataFrame:
    """(run, step, ts) in order -> seconds from each mark to the next."""
    nxt = F.lead("ts").over(W.partitionBy("run").orderBy("ts"))
    return marks.withColumn("seconds", (F.unix_micros(nxt.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6)
