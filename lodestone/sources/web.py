"""Seeds, robots files and sitemaps as DataFrames.

Bodies come from tables (url, status, body), or from ``Files``, which asks for them over HTTP.
"""

from __future__ import annotations

import tempfile
import urllib.error
import urllib.request
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as c
from ..functions import urls
from ..functions.text import strip
from ..session import ship

SITEMAP_PATHS = ("/sitemap.xml", "/sitemap_index.xml")


def seeds(source: SparkSession | DataFrame, values=None) -> DataFrame:
    """(raw, url, error) of distinct raw domains, from a list, a text file's path or a frame with ``raw``."""
    if isinstance(source, SparkSession):
        df = source.read.text(values).toDF("raw") if isinstance(values, str) else source.createDataFrame([(v,) for v in values], "raw string")
    else:
        df = source
    return df.dropDuplicates(["raw"]).withColumn("_u", urls.seed("raw")).select("raw", F.col("_u.url").alias("url"), F.col("_u.error").alias("error"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """(seed, base_url, status, body) -> (seed, pos, url): the standard places, then those of robots.txt, first mention only."""
    named = F.when(F.col("status") == 200, F.transform(
        F.filter(F.split("body", r"\R"), lambda x: F.lower(strip(x)).startswith("sitemap:")), lambda x: strip(F.regexp_replace(x, "^[^:]*:", ""))))
    places = F.array(*[F.concat(F.col("base_url"), F.lit(p)) for p in SITEMAP_PATHS])
    every = F.array_distinct(F.concat(places, F.coalesce(named, F.array().cast("array<string>"))))
    return robots.select("seed", F.posexplode(every).alias("pos", "url"))


def _read(body: str | None) -> dict:
    """Sitemaps and pages named by one file; nothing of a file that is not well-formed."""
    out = {"sitemaps": [], "pages": []}
    try:
        root = ET.fromstring(body or "")
    except (ET.ParseError, ValueError):
        return out
    space = root.tag[: root.tag.index("}") + 1] if root.tag.startswith("{") else ""
    for kind, key in (("sitemap", "sitemaps"), ("url", "pages")):
        for x in root.iter(f"{space}{kind}"):
            loc = x.find(f"{space}loc")
            if loc is not None and loc.text:
                out[key].append(loc.text.strip())
    return out


def _entries(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_read(b) for b in body], columns=["sitemaps", "pages"])


def sitemap_entries(body) -> Column:
    ship()
    return F.pandas_udf(_entries, "struct<sitemaps:array<string>,pages:array<string>>")(body)


def http_get(url: str, timeout: float = c.FILE_TIMEOUT, agent: str = c.AGENT) -> tuple[int, str | None]:
    """(status, body) of a robots file or sitemap; a refused or failed request has its status, or 0, and no body."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, None
    except (OSError, ValueError):
        return 0, None


class Files:
    """Bodies of ``get(url) -> (status, body)``, each URL once, dealt by host so that a host is asked by one task."""

    def __init__(self, get: Callable[[str], tuple[int, str | None]] = http_get, tasks: int | None = None):
        self.get, self.tasks = get, tasks

    def fetch(self, wanted: DataFrame) -> DataFrame:
        ship()
        get = self.get

        def run(batches):
            for pdf in batches:
                yield pd.DataFrame([(u, *get(u)) for u in pdf["url"]], columns=["url", "status", "body"])

        tasks = self.tasks or int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        each = wanted.select("url").distinct().withColumn("h", urls.host("url")).repartition(tasks, "h")
        return each.select("url").mapInPandas(run, "url string, status int, body string")


def sitemap_pages(start: DataFrame, files, max_depth: int | None = None, folder: str | None = None) -> DataFrame:
    """(seed, base, url) of sitemaps and files -> distinct (seed, base, url) of the site's pages.

    ``files`` is a table (url, status, body), which is parsed once, or an adapter that is asked for the files of each level.
    Sitemaps of sitemaps are followed until no new one is named (``max_depth`` levels down if given), each file once for a
    seed, which ends cycles.

    Each level reads the one before from ``folder`` (shared by all executors; a local master may go without) and writes what it
    named, so plans do not grow with the depth and a lost executor asks no site again.
    """
    spark = start.sparkSession
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that the driver and all executors share")
    root = f"{folder or tempfile.mkdtemp(prefix='lodestone-')}/sitemaps-{uuid.uuid4().hex}"

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    front_of = lambda: spark.read.schema("seed string, base string, url string, level int").parquet(f"{root}/front")
    parsed = lambda t, name: put(t.where(F.col("status") == 200).select("url", sitemap_entries("body").alias("e")), name)
    every = parsed(files, "parsed") if isinstance(files, DataFrame) else None
    front, level = put(start.select("seed", "base", "url").distinct(), "front/level=0"), 0
    while True:
        hit = front.join(every if every is not None else parsed(put(files.fetch(front), f"bodies/level={level}"), f"parsed/level={level}"), "url")
        named = put(hit.select("seed", "base", "e.pages", "e.sitemaps"), f"named/level={level}")
        if level == max_depth:
            break
        deeper = named.select("seed", "base", F.explode("sitemaps").alias("url")).distinct()
        front, level = put(deeper.join(front_of().select("seed", "url"), ["seed", "url"], "left_anti").select("seed", "base", "url"), f"front/level={level + 1}"), level + 1
        if front.isEmpty():
            break
    found = spark.read.schema("seed string, base string, pages array<string>, level int").parquet(f"{root}/named")
    return found.select("seed", "base", F.explode("pages").alias("url")).where(F.contains("url", "base")).distinct()
