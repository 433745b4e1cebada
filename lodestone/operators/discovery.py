"""Link discovery: filters, scores, layers, ranked and balanced choice.

Frames of links have (seed, url, anchor_text, source, depth).  Every window is partitioned by seed, so work for one site
stays together and sites spread over the cluster; equal scores are ordered by URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions import urls
from ..functions.text import col


def matches(text, patterns=c.ADMISSIONS + c.TUITION) -> Column:
    """Whether any pattern occurs in the lower-cased text (a URL whole, or an anchor)."""
    return F.lower(F.coalesce(col(text), F.lit(""))).rlike(c.any_of(patterns))


def same_site_sitemap(url, base) -> Column:
    return F.contains(col(url), col(base))


def same_site_nav(url, base) -> Column:
    return F.contains(urls.host(url), col(base))


def same_site_strict(url, source) -> Column:
    return urls.base_domain(url) == urls.base_domain(source)


def skipped(url, extensions=c.SKIPPED) -> Column:
    return F.lower(urls.path(url)).rlike(rf"\.({'|'.join(extensions)})$")


def score(patterns, slugs, url="url", text="anchor_text", source="source", depth="depth") -> Column:
    """Relevance of a link for one topic, 0 to 1."""
    p, t = urls.path(F.lower(col(url))), F.lower(F.coalesce(col(text), F.lit("")))
    src, any_ = F.lower(col(source)), c.any_of(patterns)
    s = F.when(p.rlike(any_), F.lit(0.4)).otherwise(F.lit(0.0))
    s = s + F.when(t.rlike(any_), F.lit(0.35)).otherwise(F.lit(0.0))
    s = s * F.when(src.contains("nav"), F.lit(1.15)).when(src.contains("footer"), F.lit(1.05)).otherwise(F.lit(1.0))
    s = s * F.when(col(depth) >= 2, F.lit(0.9)).otherwise(F.lit(1.0))
    for slug in slugs:
        s = s + F.when(p.contains(slug), F.lit(0.2)).otherwise(F.lit(0.0))
    return F.least(s, F.lit(1.0))


def scored(links: DataFrame, admissions=c.ADMISSIONS, tuition=c.TUITION, adm_slugs=c.ADMISSIONS_SLUGS, tui_slugs=c.TUITION_SLUGS) -> DataFrame:
    return links.withColumns({
        "admissions_score": score(admissions, adm_slugs), "tuition_score": score(tuition, tui_slugs)})


def classified(links: DataFrame, threshold: float = c.THRESHOLD) -> DataFrame:
    """Adds max_score, category, is_admissions, is_tuition to scored links."""
    a, t = F.col("admissions_score"), F.col("tuition_score")
    return links.withColumns({
        "max_score": F.greatest(a, t),
        "category": F.when(a > t, "admissions").when(t > a, "tuition").otherwise("both"),
        "is_admissions": a >= threshold, "is_tuition": t >= threshold})


def first_wins(links: DataFrame, *order: str) -> DataFrame:
    """One row for each seed and URL, the first in the given order."""
    w = W.partitionBy("seed", "url").orderBy(*order)
    return links.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sitemap_links(found: DataFrame, patterns=c.ADMISSIONS + c.TUITION) -> DataFrame:
    """(seed, base, url) of sitemaps -> distinct links of the site that match, as they are written."""
    return (
        found.where(same_site_sitemap("url", "base") & matches("url", patterns)).select("seed", "url").distinct()
        .select("seed", "url", F.lit("").alias("anchor_text"), F.lit("sitemap").alias("source"), F.lit(0).alias("depth"))
    )


def navigation_links(raw: DataFrame) -> DataFrame:
    """(seed, page_url, base, region, region_rank, pos, href, anchor_text) -> links of depth 1, first occurrence wins."""
    full = raw.withColumn("full", urls.resolve("page_url", "href"))
    kept = full.where(same_site_nav("full", "base") & ~skipped("full")).withColumn("url", urls.link_form("full"))
    return first_wins(kept, "region_rank", "pos").select(
        "seed", "url", "anchor_text", F.concat(F.lit("nav-"), "region").alias("source"), F.lit(1).alias("depth"), "region_rank", "pos")


def to_expand(links: DataFrame, k: int = c.EXPAND_TOP, floor: float = c.EXPAND_FLOOR) -> DataFrame:
    """The best ``k`` scored links of each seed, those below the floor left out, with their rank."""
    best = W.partitionBy("seed").orderBy(F.greatest("admissions_score", "tuition_score").desc(), "url")
    return links.withColumn("rank", F.row_number().over(best)).where(
        (F.col("rank") <= k) & (F.greatest("admissions_score", "tuition_score") >= floor))


def expanded_links(raw: DataFrame, first: DataFrame, patterns=c.ADMISSIONS + c.TUITION) -> DataFrame:
    """Links of depth 2 from pages that ``to_expand`` chose: (seed, page_url, base, rank, pos, href, anchor_text).

    A URL counts at its first occurrence, and only then its keywords are looked at.
    """
    full = raw.withColumn("full", urls.resolve("page_url", "href"))
    kept = full.where(same_site_nav("full", "base") & ~skipped("full")).withColumn("url", urls.link_form("full"))
    fresh = first_wins(kept, "rank", "pos").join(first.select("seed", "url"), ["seed", "url"], "left_anti")
    return fresh.where(matches("url", patterns) | matches("anchor_text", patterns)).select(
        "seed", "url", "anchor_text", F.lit("nav-depth2").alias("source"), F.lit(2).alias("depth"))


def merged(sitemap: DataFrame, nav: DataFrame) -> DataFrame:
    """Both layers by seed and URL; the sitemap's source and depth win, a non-empty anchor of the navigation is taken."""
    s, n = sitemap.alias("s"), nav.alias("n")
    j = s.join(n, ["seed", "url"], "full")
    pick = lambda x: F.coalesce(F.col(f"s.{x}"), F.col(f"n.{x}")).alias(x)
    anchor = F.coalesce(F.when(F.col("n.anchor_text") != "", F.col("n.anchor_text")), F.col("s.anchor_text"), F.col("n.anchor_text"))
    return j.select("seed", "url", anchor.alias("anchor_text"), pick("source"), pick("depth"))


def balanced_top(links: DataFrame, seeds: DataFrame, limit: int = c.TOP) -> DataFrame:
    """(seed, rank, url): the homepage, then admissions and tuition in turn, then the best of the rest.

    ``seeds`` has (seed, homepage); ``links`` are classified.  A URL counts at its best place.  No link beyond the first ``limit`` of
    an order can be among the chosen, so each order is cut to that by every task before the links of a site come together, and
    only numbers of links are counted over the whole site.
    """
    by = (("admissions_score", F.col("is_admissions")), ("tuition_score", F.col("is_tuition")), ("max_score", F.col("is_admissions") | F.col("is_tuition")))
    orders = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(s).alias("s"), on.alias("on")) for k, (s, on) in enumerate(by)]), lambda x: x["on"])
    each = links.select("seed", "url", F.explode(orders).alias("x")).select("seed", "url", "x.k", "x.s")
    best = each.withColumn("i", F.row_number().over(W.partitionBy("seed", "k").orderBy(F.desc("s"), "url"))).where(F.col("i") <= max(limit, 1))
    pairs = links.groupBy("seed").agg(F.least(F.count_if("is_admissions"), F.count_if("is_tuition")).alias("pairs"))
    placed = best.join(pairs, "seed").where("k = 2 OR i <= pairs")
    place = lambda p, i, k: F.struct(F.lit(p).alias("p") if isinstance(p, int) else p.alias("p"), i.cast("long").alias("i"), k.alias("k"))
    chosen = placed.select("seed", "url", place(F.when(F.col("k") == 2, 2).otherwise(1), F.col("i"), F.when(F.col("k") == 1, 1).otherwise(0)).alias("place"))
    home = seeds.select("seed", F.col("homepage").alias("url"), place(0, F.lit(0), F.lit(0)).alias("place"))
    one = chosen.unionByName(home).groupBy("seed", "url").agg(F.min("place").alias("place"))
    top = one.withColumn("rank", F.row_number().over(W.partitionBy("seed").orderBy("place", "url")))
    return top.where((F.col("rank") <= limit) | (F.col("place.p") == 0)).select("seed", "rank", "url")
