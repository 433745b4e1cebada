"""One query for each operator over the test tables, with the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as c
from ..functions import html, normalize, urls
from ..functions.text import squeeze
from ..operators import context, discovery, extract, fetch, once, pool, quality, validate
from ..sources import sinks, web
from ..streaming import state
from . import etl

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str, key: str, *more: str) -> DataFrame:
    """These columns dealt by a key: rows of a small file that become much more data, or much work, are not one task's."""
    return table(spark, sf_dir, name).select(key, *more).repartition(key)


def work_folder(spark: SparkSession, label: str) -> str | None:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names; None where it is not set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{root}/lodestone/{label}-{uuid.uuid4().hex}" if root else None


def new_folder(spark: SparkSession, label: str) -> str:
    """As ``work_folder``; a local master may go without the setting."""
    folder = work_folder(spark, label)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix=f"lodestone-{label}-")


def _sql(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


def values(rows: list[tuple], *names: str) -> str:
    """VALUES for both engines' fixtures."""
    body = ", ".join("(" + ", ".join(_sql(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(names)})"


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# SQL pieces shared by several oracles
_HOST = r"lower(regexp_extract({0}, '^[^:/?#]+://([^/?#]*)', 1))"
_PATH = r"regexp_extract({0}, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"
_BASE = r"regexp_extract({0}, '([^.]+\.[^.]+)$', 1)"
_ADM, _TUI = c.any_of(c.ADMISSIONS), c.any_of(c.TUITION)
_ALL = f"{_ADM}|{_TUI}"
#: Patterns that occur in the synthetic pages, for the queries that run on them.
PAGE_ADM, PAGE_TUI = ("the", "ti"), ("on", "er")


def host_of(x: str) -> str:
    return _HOST.format(x)


def path_of(x: str) -> str:
    return _PATH.format(x)


@query(f"""
SELECT page_id, 'https://' || CASE WHEN length(h) - length(replace(h, '.', '')) = 1 THEN 'www.' || h ELSE h END || p || CASE WHEN p LIKE '%/' THEN '' ELSE '/' END AS canonical,
       h AS host, {_BASE.format('h')} AS base, lower(regexp_extract(url, '^([a-zA-Z]+):', 1)) || '://' || n || p || CASE WHEN p LIKE '%/' THEN '' ELSE '/' END AS link,
       replace(replace(regexp_replace(regexp_replace(url, 'https?://', '', 'g'), '^/+|/+$', '', 'g'), '.', '_'), '/', '_') AS slug
FROM (SELECT page_id, url, {host_of('url')} AS h, regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS n, {path_of('url')} AS p FROM pages)
""")
def url_canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.seed("url")["url"].alias("canonical"), urls.host("url").alias("host"), urls.base_domain("url").alias("base"),
        urls.link_form("url").alias("link"), urls.file_slug("url").alias("slug"))


_SEEDS = [("bucknell.edu",), (" http://a.b.edu/x?q#f ",), ("10.0.0.1",), ("localhost",), ("",), ("x.edu:8080",), ("ftp://x.edu",), ("https://www.y.edu/index.html",), ("https://u:p@A.B.edu:81/Z",)]


@query(f"""
SELECT raw, CASE WHEN error IS NULL THEN 'https://' || CASE WHEN length(h) - length(replace(h, '.', '')) = 1 THEN 'www.' || h ELSE lower(n) END || p || CASE WHEN p LIKE '%/' THEN '' ELSE '/' END END AS url, error
FROM (SELECT *, CASE WHEN t = '' THEN 'empty' WHEN h = '' THEN 'no host' WHEN regexp_full_match(h, '\\d{{1,3}}(\\.\\d{{1,3}}){{3}}') THEN 'address' WHEN h = 'localhost' THEN 'local' WHEN h NOT LIKE '%.%' THEN 'no dot' END AS error
FROM (SELECT *, lower(regexp_replace(regexp_replace(n, '^.*@', ''), ':[0-9]*$', '')) AS h FROM (SELECT raw, t, regexp_extract(f, '^[^:/?#]+://([^/?#]*)', 1) AS n, {path_of('f')} AS p
FROM (SELECT raw, trim(raw) AS t, CASE WHEN trim(raw) LIKE 'http://%' OR trim(raw) LIKE 'https://%' THEN trim(raw) ELSE 'https://' || trim(raw) END AS f FROM {values(_SEEDS, 'raw')}))))
""")
def seed_validation(spark, sf_dir):
    return web.seeds(frame(spark, _SEEDS, "raw string"))


_RAW = "concat(repeat(' ', page_id % 3), CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN 'localhost/' || page_id WHEN 3 THEN '10.0.' || (page_id % 7) || '.1' ELSE 'ftp' || page_id END)"


@query(ORACLES["seed_validation"].replace(values(_SEEDS, "raw"), f"(SELECT DISTINCT {_RAW} AS raw FROM pages)"))
def page_seeds(spark, sf_dir):
    """Seeds as people type them, made of the addresses of pages."""
    return web.seeds(table(spark, sf_dir, "pages").selectExpr(f"{_RAW.replace('page_id % 3', 'cast(page_id % 3 AS int)')} AS raw"))


_QUERIES = [
    (-1, "https://x.edu/a?page&k=1&utm_source=z"), (-2, "https://x.edu/a?a=&b"), (-3, "https://x.edu/a?k=a%20b&q=c+d"), (-4, "https://x.edu/a?a=1&b=2&a=3"),
    (-5, "https://x.edu/a?UTM_Source=1"), (-6, "https://X.edu//b///c?x=%C3%A9%2F*~&&y=1=2#top"), (-7, "https://x.edu/f.PDF?a=1"), (-8, "https://x.edu/a?"),
]


@query(f"""
WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT * FROM {values(_QUERIES, 'page_id', 'url')}),
x AS (SELECT page_id, unnest(string_split(q, '&')) AS x, generate_subscripts(string_split(q, '&'), 1) AS i FROM (SELECT page_id, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM u)),
kv AS (SELECT page_id, i, url_decode(replace(split_part(x, '=', 1), '+', ' ')) AS n, url_decode(replace(CASE WHEN contains(x, '=') THEN substr(x, instr(x, '=') + 1) ELSE '' END, '+', ' ')) AS v FROM x WHERE x <> ''),
kept AS (SELECT *, min(i) OVER (PARTITION BY page_id, n) AS f FROM kv WHERE lower(n) NOT IN ({', '.join(_sql(x) for x in c.TRACKING)})),
tail AS (SELECT page_id, string_agg(replace(url_encode(n), '%20', '+') || '=' || replace(url_encode(v), '%20', '+'), '&' ORDER BY f, i) AS t FROM kept GROUP BY page_id)
SELECT page_id, CASE WHEN regexp_matches(lower(p), '\\.({'|'.join(c.BINARY)})$') THEN NULL ELSE s || '://' || h || regexp_replace(p, '/+', '/', 'g') || coalesce('?' || t, '') END AS clean
FROM (SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+):', 1)) AS s, {host_of('url')} AS h, {path_of('url')} AS p FROM u) LEFT JOIN tail USING (page_id)
""")
def url_clean_tracking(spark, sf_dir):
    """Links of pages and of a fixture: blank values stay, names come together, all is encoded anew."""
    every = table(spark, sf_dir, "pages").select("page_id", "url").unionByName(frame(spark, _QUERIES, "page_id long, url string"))
    return every.select("page_id", urls.discovered("url", "url")["url"].alias("clean"))


@query(f"""
SELECT page_id, regexp_matches(lower(url), '{_ALL}') AS keyword, regexp_matches(lower(url), '{'|'.join(c.PAGE_ADMISSIONS)}') AS admissions, regexp_matches(lower(url), '{'|'.join(c.PAGE_TUITION)}') AS tuition,
       regexp_matches(lower({path_of('url')}), '{_ALL}') AS in_path, regexp_matches(lower({path_of('url')}), '\\.({'|'.join(c.SKIPPED)})$') AS skipped FROM pages
""")
def url_keyword_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", discovery.matches("url").alias("keyword"), context.page_class("url", c.PAGE_ADMISSIONS).alias("admissions"),
        context.page_class("url", c.PAGE_TUITION).alias("tuition"), discovery.matches(urls.path("url")).alias("in_path"), discovery.skipped("url").alias("skipped"))


@query(f"""
WITH p AS (SELECT page_id, {host_of('url')} AS seed, regexp_matches(lower(url), '{'|'.join(c.PAGE_ADMISSIONS)}') AS a, regexp_matches(lower(url), '{'|'.join(c.PAGE_TUITION)}') AS t FROM pages)
SELECT page_id, seed, a OR NOT bool_or(a) OVER w AS is_admissions, t OR NOT bool_or(t) OVER w AS is_tuition FROM p WINDOW w AS (PARTITION BY seed)
""")
def page_class_fallback(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", urls.host("url").alias("seed"))
    return context.classify_pages(pages).drop("url")


_TITLES = [(-1, "<title> A &amp; B\n&quot;x&quot;  &lt;i&gt; </title>"), (-2, "<TITLE lang=en>&amp;lt;</TITLE><title>no</title>"), (-3, "<p>none"), (-4, "<title></title>")]


@query(f"""
SELECT page_id, trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title
FROM (SELECT page_id, regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&amp([^;]|$)', '&amp;\\1', 'g') AS t FROM (SELECT page_id, html FROM pages UNION ALL SELECT * FROM {values(_TITLES, 'page_id', 'html')}))
""")
def page_title(spark, sf_dir):
    """As a browser gives it: references decoded, white space stripped and made one space."""
    every = table(spark, sf_dir, "pages").select("page_id", "html").unionByName(frame(spark, _TITLES, "page_id long, html string"))
    return every.select("page_id", html.title("html").alias("title"))


@query(f"""
WITH p AS (SELECT page_id, url, {host_of('url')} AS h, {_BASE.format(host_of('url'))} AS b FROM pages)
SELECT p.page_id, contains(p.url, q.b) AS listed, contains(p.h, q.b) AS linked, p.b = q.b AS strict FROM p JOIN p q ON q.page_id // 7 = p.page_id // 7 AND q.page_id % 7 = 0
""")
def same_site(spark, sf_dir):
    """The three rules of "same site", each page against the first of its seven."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    other = pages.where("page_id % 7 = 0").select(F.col("page_id").alias("first"), F.col("url").alias("source"), urls.base_domain("url").alias("base"))
    both = pages.join(other, F.expr("page_id - page_id % 7 = first"))
    return both.select("page_id", discovery.same_site_sitemap("url", "base").alias("listed"), discovery.same_site_nav("url", "base").alias("linked"),
                       discovery.same_site_strict("url", "source").alias("strict"))


_NAV_SQL = f"""
raw AS (SELECT page_id, url AS page_url, {host_of('url')} AS seed, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
        regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages),
one AS (SELECT page_id, page_url, seed, unnest(hrefs) AS href, unnest(texts) AS text, generate_subscripts(hrefs, 1) AS pos FROM raw),
links AS (SELECT seed, regexp_extract(page_url, '^([^:]+://[^/?#]*)', 1) || href || '/' AS url, text AS anchor_text, page_id, pos FROM one),
nav AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed, url ORDER BY page_id, pos) AS n FROM links) WHERE n = 1)
"""


def _page_links(spark, sf_dir) -> DataFrame:
    """Navigation links of all pages of a host, pages in order of their id; URLs and anchors of the first occurrence."""
    raw = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("page_url"), urls.host("url").alias("seed"), urls.base_domain("url").alias("base"), F.explode(html.nav_links("html")).alias("l"))
    raw = raw.select("seed", "page_url", "base", "l.region", F.col("page_id").alias("region_rank"), "l.pos", "l.href", "l.anchor_text")
    return discovery.navigation_links(raw).select("seed", "url", "anchor_text", "source", "depth")


@query(f"WITH {_NAV_SQL} SELECT seed, url, anchor_text, 'nav-nav' AS source, 1 AS depth FROM nav")
def nav_links(spark, sf_dir):
    return _page_links(spark, sf_dir)


_LINKS = [
    ("s", "https://x.edu/admissions/apply-now/", "Apply", "nav-nav", 1), ("s", "https://x.edu/admissions/", "", "sitemap", 0), ("s", "https://x.edu/tuition-and-fees/", "Tuition", "nav-nav", 1),
    ("s", "https://x.edu/cost-of-attendance/", None, "sitemap", 0), ("s", "https://x.edu/said/", "Deadlines", "nav-depth2", 2), ("s", "https://x.edu/x/", "apply", "nav-footer", 1),
    ("s", "https://x.edu/feed/?a=apply", "news", "footer", 1), ("t", "https://fees.y.edu/", "home", "nav-nav", 1), ("t", "https://y.edu/Deadline/dates-deadline", "Apply", "nav-depth2", 2), ("t", "https://y.edu/aid/transfer", "aid", "sitemap", 0),
]
_LINK_SCHEMA = "seed string, url string, anchor_text string, source string, depth int"


def _score_sql(patterns: str, slugs, url="url", text="anchor_text", source="source", depth="depth") -> str:
    d = lambda x: f"{x}::DOUBLE"
    p = f"lower({path_of(url)})"
    s = f"(CASE WHEN regexp_matches({p}, '{patterns}') THEN {d(0.4)} ELSE {d(0)} END + CASE WHEN regexp_matches(lower(coalesce({text}, '')), '{patterns}') THEN {d(0.35)} ELSE {d(0)} END)"
    s = f"({s} * CASE WHEN contains(lower({source}), 'nav') THEN {d(1.15)} WHEN contains(lower({source}), 'footer') THEN {d(1.05)} ELSE {d(1)} END * CASE WHEN {depth} >= 2 THEN {d(0.9)} ELSE {d(1)} END"
    for x in slugs:
        s += f" + CASE WHEN contains({p}, '{x}') THEN {d(0.2)} ELSE {d(0)} END"
    return f"least({s}), {d(1)})"


_SCORED = f"SELECT seed, url, {_score_sql(_ADM, c.ADMISSIONS_SLUGS)} AS admissions_score, {_score_sql(_TUI, c.TUITION_SLUGS)} AS tuition_score FROM {values(_LINKS, 'seed', 'url', 'anchor_text', 'source', 'depth')}"


@query(_SCORED)
def link_scores(spark, sf_dir):
    return discovery.scored(frame(spark, _LINKS, _LINK_SCHEMA)).select("seed", "url", "admissions_score", "tuition_score")


_CATEGORY = "CASE WHEN admissions_score > tuition_score THEN 'admissions' WHEN tuition_score > admissions_score THEN 'tuition' ELSE 'both' END"


@query(f"SELECT seed, url, greatest(admissions_score, tuition_score) AS max_score, {_CATEGORY} AS category, admissions_score >= 0.3 AS is_admissions, tuition_score >= 0.3 AS is_tuition FROM ({_SCORED})")
def link_categories(spark, sf_dir):
    return discovery.classified(discovery.scored(frame(spark, _LINKS, _LINK_SCHEMA))).select("seed", "url", "max_score", "category", "is_admissions", "is_tuition")


_PA, _PT = c.any_of(PAGE_ADM), c.any_of(PAGE_TUI)


@query(f"""
WITH {_NAV_SQL}, s AS (SELECT seed, url, {_score_sql(_PA, (), source=_sql('nav-nav'), depth='1')} AS admissions_score, {_score_sql(_PT, (), source=_sql('nav-nav'), depth='1')} AS tuition_score FROM nav)
SELECT seed, url, greatest(admissions_score, tuition_score) AS max_score, {_CATEGORY} AS category, admissions_score >= 0.3 AS is_admissions, tuition_score >= 0.3 AS is_tuition FROM s
""")
def page_link_categories(spark, sf_dir):
    """Category and classes of the navigation links of all hosts."""
    links = discovery.classified(discovery.scored(_page_links(spark, sf_dir), PAGE_ADM, PAGE_TUI, (), ()))
    return links.select("seed", "url", "max_score", "category", "is_admissions", "is_tuition")


@query(f"WITH {_NAV_SQL} SELECT seed, url, {_score_sql(_PA, (), source=_sql('nav-nav'), depth='1')} AS admissions_score, {_score_sql(_PT, (), source=_sql('nav-nav'), depth='1')} AS tuition_score FROM nav")
def page_link_scores(spark, sf_dir):
    return discovery.scored(_page_links(spark, sf_dir), PAGE_ADM, PAGE_TUI, (), ()).select("seed", "url", "admissions_score", "tuition_score")


@query(f"""
WITH {_NAV_SQL}, s AS (SELECT seed, url, {_score_sql(_PA, (), source=_sql('nav-nav'), depth='1')} AS a, {_score_sql(_PT, (), source=_sql('nav-nav'), depth='1')} AS t FROM nav),
c AS (SELECT *, greatest(a, t) AS m FROM s WHERE a >= 0.3 OR t >= 0.3),
ra AS (SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY a DESC, url) AS i FROM c WHERE a >= 0.3),
rt AS (SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY t DESC, url) AS i FROM c WHERE t >= 0.3),
n AS (SELECT seed, least((SELECT count(*) FROM ra WHERE ra.seed = h.seed), (SELECT count(*) FROM rt WHERE rt.seed = h.seed)) AS k FROM (SELECT DISTINCT {host_of('url')} AS seed FROM pages) h),
p AS (SELECT seed, 'https://' || seed || '/' AS url, 0 AS p, 0 AS i, 0 AS k FROM n UNION ALL SELECT ra.seed, url, 1, i, 0 FROM ra JOIN n ON n.seed = ra.seed AND i <= n.k
 UNION ALL SELECT rt.seed, url, 1, i, 1 FROM rt JOIN n ON n.seed = rt.seed AND i <= n.k UNION ALL SELECT seed, url, 2, row_number() OVER (PARTITION BY seed ORDER BY m DESC, url), 0 FROM c),
b AS (SELECT seed, url, min(p * 1000000000 + i * 10 + k) AS o FROM p GROUP BY seed, url)
SELECT seed, rank, url FROM (SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY o, url)::INTEGER AS rank FROM b) WHERE rank <= 6
""")
def balanced_topk(spark, sf_dir):
    links = discovery.classified(discovery.scored(_page_links(spark, sf_dir), PAGE_ADM, PAGE_TUI, (), ()))
    seeds = table(spark, sf_dir, "pages").select(urls.host("url").alias("seed")).distinct().withColumn("homepage", F.concat(F.lit("https://"), "seed", F.lit("/")))
    return discovery.balanced_top(links, seeds)


_SITE = [("s", "https://x.edu/a", "", "sitemap", 0), ("s", "https://x.edu/b/", "", "sitemap", 0), ("t", "https://y.edu/c", "", "sitemap", 0)]
_NAV = [("s", "https://x.edu/b/", "Apply", "nav-nav", 1), ("s", "https://x.edu/c/", "", "nav-footer", 1), ("t", "https://y.edu/c", "", "nav-nav", 1)]


@query(f"""
SELECT coalesce(s.seed, n.seed) AS seed, coalesce(s.url, n.url) AS url, coalesce(nullif(n.anchor_text, ''), s.anchor_text, n.anchor_text) AS anchor_text, coalesce(s.source, n.source) AS source, coalesce(s.depth, n.depth) AS depth
FROM (SELECT * FROM {values(_SITE, 'seed', 'url', 'anchor_text', 'source', 'depth')}) s FULL JOIN (SELECT * FROM {values(_NAV, 'seed', 'url', 'anchor_text', 'source', 'depth')}) n ON s.seed = n.seed AND s.url = n.url
""")
def layer_merge(spark, sf_dir):
    return discovery.merged(frame(spark, _SITE, _LINK_SCHEMA), frame(spark, _NAV, _LINK_SCHEMA))


_CHILD = """
child AS (SELECT p.page_id AS parent, p.seed, c.page_id, c.page_url, c.hrefs, c.texts FROM raw p JOIN raw c ON c.page_id = p.page_id + 1),
one2 AS (SELECT parent, seed, page_url, unnest(hrefs) AS href, unnest(texts) AS text, generate_subscripts(hrefs, 1) AS pos FROM child),
full2 AS (SELECT seed, parent, pos, text, regexp_extract(page_url, '^([^:]+://[^/?#]*)', 1) || href || '/' AS url FROM one2),
first2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed, url ORDER BY parent, pos) AS n FROM full2) WHERE n = 1)
"""


@query(f"""
WITH {_NAV_SQL}, {_CHILD} SELECT seed, url, text AS anchor_text, 'nav-depth2' AS source, 2 AS depth FROM first2 f WHERE regexp_matches(lower(url) || ' ' || lower(text), '{_PT}')
AND NOT EXISTS (SELECT 1 FROM nav WHERE nav.seed = f.seed AND nav.url = f.url)
""")
def depth2_expand(spark, sf_dir):
    """The page after a page stands for its child: its links expand the parent's host."""
    pages = table(spark, sf_dir, "pages")
    parent = pages.select((F.col("page_id") + 1).alias("page_id"), urls.host("url").alias("seed"), F.col("page_id").alias("rank"))
    child = pages.select("page_id", F.col("url").alias("page_url"), F.explode(html.nav_links("html")).alias("l"))
    raw = child.join(parent, "page_id").select("seed", "page_url", F.lit("").alias("base"), "rank", "l.pos", "l.href", "l.anchor_text")
    return discovery.expanded_links(raw, _page_links(spark, sf_dir), PAGE_TUI)


_STATUS = "CASE page_id % 10 WHEN 3 THEN 404 WHEN 7 THEN 403 ELSE 200 END"
_TYPE = "CASE WHEN page_id % 7 = 2 THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END"
_BODY = "CASE WHEN page_id % 11 = 5 THEN '  <p>short</p>  ' WHEN page_id % 13 = 4 THEN html || 'Just a MOMENT' WHEN page_id % 17 = 6 THEN '<form action=login>' || html ELSE html END"
_URL = "CASE WHEN page_id % 19 = 1 THEN url || '/case-studies' ELSE url END"


def _fetched(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr("page_id", f"{_STATUS} AS status_code", f"{_TYPE} AS content_type", f"{_BODY} AS html", f"{_URL} AS final_url")


@query(f"""
SELECT page_id, CASE WHEN NOT contains(lower(t), 'text/html') THEN 'content_type' WHEN s >= 400 THEN 'status' WHEN length(trim(b)) < 100 THEN 'short' END AS rejection FROM (SELECT page_id, {_STATUS} AS s, {_TYPE} AS t, {_BODY} AS b FROM pages)
""")
def page_validity(spark, sf_dir):
    return _fetched(spark, sf_dir).select("page_id", fetch.rejection().alias("rejection"))


@query(f"""
SELECT page_id, s = 403 OR regexp_matches(lower(b), '{'|'.join(c.BOT_MARKERS)}') AS bot, regexp_matches(lower(u), '/(login|signin|sign-in|sso|cas|auth|saml)') OR regexp_matches(lower(b), '<form[^>]+login|<form[^>]+signin|sign\\s*in\\s*to\\s*(your|the)|<input[^>]+type=["'']password["'']') AS auth
FROM (SELECT page_id, {_STATUS} AS s, {_BODY} AS b, {_URL} AS u FROM pages)
""")
def bot_auth_flags(spark, sf_dir):
    return _fetched(spark, sf_dir).select("page_id", fetch.bot_blocked().alias("bot"), fetch.auth_wall().alias("auth"))


_REQUESTS = [("image", "https://x.edu/a"), ("document", "https://x.edu/a.PNG?x"), ("script", "https://www.google-analytics.com/a.js"), ("document", "https://x.edu/"), ("font", "https://x.edu/f"), ("xhr", "https://cdn.jsdelivr.net/npm/bootstrap@5")]


@query(f"SELECT type, url, type IN ('image', 'media', 'font', 'stylesheet') OR len(list_filter([{', '.join(_sql(x) for x in c.BLOCKED_URLS)}], lambda p: contains(lower(url), p))) > 0 AS blocked FROM {values(_REQUESTS, 'type', 'url')}")
def request_blocking(spark, sf_dir):
    df = frame(spark, _REQUESTS, "type string, url string")
    return df.select("type", "url", fetch.blocked_request().alias("blocked"))


_KIND = "CASE page_id % 9 WHEN 0 THEN 'image' WHEN 1 THEN 'media' WHEN 2 THEN 'font' WHEN 3 THEN 'stylesheet' WHEN 4 THEN 'script' ELSE 'document' END"
_ASKED = "CASE page_id % 8 WHEN 5 THEN concat(url, '/Logo.PNG?v=1') WHEN 6 THEN concat('https://www.google-analytics.com/', page_id) WHEN 7 THEN concat(url, '/clip.mp4') ELSE url END"


@query(f"SELECT page_id, {_KIND} IN ('image', 'media', 'font', 'stylesheet') OR len(list_filter([{', '.join(_sql(x) for x in c.BLOCKED_URLS)}], lambda p: contains(lower({_ASKED}), p))) > 0 AS blocked FROM pages")
def page_requests(spark, sf_dir):
    """Which requests of pages are not let through, by their kind and address."""
    return table(spark, sf_dir, "pages").selectExpr("page_id", f"{_KIND} AS type", f"{_ASKED} AS url").select("page_id", fetch.blocked_request().alias("blocked"))


@query()
def html_markdown(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.markdown("html").alias("markdown"))


@query("""
WITH p AS (SELECT page_id, url, html FROM pages UNION ALL SELECT page_id, url || '?mirror', html FROM pages)
SELECT page_id, url, sha256(html) AS digest, CASE WHEN html IS NOT NULL THEN 'one' END AS made_in, count(html) OVER (PARTITION BY html) AS n_urls FROM p
""")
def markdown_memory(spark, sf_dir):
    """Two runs that share a memory: the pages, then the pages and mirrors of them, of which nothing is converted again."""
    pages, memory = table(spark, sf_dir, "pages").select("page_id", "url", "html"), new_folder(spark, "markdown")
    once.markdown_once(pages, memory, "one")
    grown = pages.unionByName(pages.withColumn("url", F.concat("url", F.lit("?mirror"))))
    out = once.markdown_once(grown, memory, "two").drop("html", "markdown")
    counts = out.groupBy(F.col("digest").alias("d")).agg(F.count("digest").alias("n_urls"))
    return out.join(counts, F.col("digest").eqNullSafe(F.col("d"))).drop("d")


@query("""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT conv_id, left(string_agg(chr(10) || chr(10) || '## Page: ' || role || chr(10) || left(text, 40000), '' ORDER BY n), 40000) AS context, string_agg(role, ',' ORDER BY n) AS sources FROM p WHERE n <= 3 GROUP BY conv_id
""")
def context_assembly(spark, sf_dir):
    out = context.assemble(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return out.select("conv_id", "context", F.array_join("source_urls", ",").alias("sources"))


_PHONE = r"\(?\d{3}\)?[ -]\d{3}-\d{4}"


@query(f"""
WITH d AS (SELECT doc_id, nullif(regexp_extract(text, '(\\+?1 )?{_PHONE}'), '') AS raw FROM documents), k AS (SELECT *, regexp_replace(raw, '[^0-9+]', '', 'g') AS a FROM d),
x AS (SELECT *, CASE WHEN a LIKE '+1%' THEN a[3:] WHEN a LIKE '1%' AND length(a) = 11 THEN a[2:] ELSE a END AS n FROM k)
SELECT doc_id, CASE WHEN length(n) = 10 THEN '+1-' || n[1:3] || '-' || n[4:6] || '-' || n[7:10] ELSE raw END AS phone FROM x
""")
def norm_phone(spark, sf_dir):
    raw = F.regexp_extract("text", rf"(\+?1 )?{_PHONE}", 0)
    return table(spark, sf_dir, "documents").select("doc_id", normalize.phone(raw).alias("phone"))


@query("SELECT doc_id, CASE WHEN e <> '' THEN lower(trim(e)) END AS email, contains(e, '@') AS good FROM (SELECT doc_id, regexp_extract(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') AS e FROM documents)")
def norm_email(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("text", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", 0).alias("e"))
    return raw.select("doc_id", normalize.email("e").alias("email"), extract.email_guard(F.col("e")).isNotNull().alias("good"))


_PLACES = [("Pennsylvania", "U.S.A.", "17837-2005"), (" pa ", " Canada ", "17837 2005"), ("Ontario", "usa", "K1A 0B1"), ("", "", ""), (None, None, None), ("new york", "United States", "178372005"), ("DC", "us", " 17837"), ("district of Columbia", "France", "1783")]
_STATE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in c.STATES.items())


@query(f"""
WITH m AS (SELECT * FROM (VALUES {_STATE_ROWS}) AS m(name, code))
SELECT state AS raw, CASE WHEN state <> '' THEN coalesce((SELECT max(code) FROM m WHERE code = upper(trim(state))), (SELECT max(code) FROM m WHERE name = lower(trim(state))), trim(state)) END AS state FROM {values(_PLACES, 'state', 'country', 'postal')}
""")
def norm_state(spark, sf_dir):
    return frame(spark, _PLACES, "raw string, country string, postal string").select("raw", normalize.state("raw").alias("state"))


@query(f"SELECT country AS raw, CASE WHEN country = '' THEN NULL WHEN lower(trim(country)) IN ({', '.join(_sql(x) for x in c.US_NAMES)}) THEN 'United States' ELSE trim(country) END AS country FROM {values(_PLACES, 'state', 'country', 'postal')}")
def norm_country(spark, sf_dir):
    return frame(spark, _PLACES, "state string, raw string, postal string").select("raw", normalize.country("raw").alias("country"))


@query(f"""
SELECT postal AS raw, CASE WHEN postal = '' THEN NULL WHEN regexp_full_match(k, '\\d{{5}}(-\\d{{4}})?') THEN k WHEN length(d) = 5 THEN d WHEN length(d) = 9 THEN d[1:5] || '-' || d[6:9] ELSE trim(postal) END AS postal
FROM (SELECT postal, regexp_replace(postal, '[^0-9-]', '', 'g') AS k, regexp_replace(postal, '[^0-9]', '', 'g') AS d FROM {values(_PLACES, 'state', 'country', 'postal')})
""")
def norm_postal(spark, sf_dir):
    return frame(spark, _PLACES, "state string, country string, raw string").select("raw", normalize.postal("raw").alias("postal"))


_COSTS = [("$54,890.99",), ("abc",), ("-1",), ("",), (None,), ("1_000",), ("12d",), ("inf",), ("2.5e3",), (" .5 ",), ("10_",), ("$ 1,234",)]


@query(f"""
SELECT 'part' AS kind, p_partkey::VARCHAR AS k, CASE WHEN p_retailprice - 950 >= 0 THEN round_even(p_retailprice - 950, 0)::BIGINT END AS cost FROM part
UNION ALL SELECT 'text', raw, CASE WHEN regexp_full_match(x, '[+-]?(\\d+(_\\d+)*\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') AND replace(x, '_', '')::DOUBLE >= 0 THEN trunc(replace(x, '_', '')::DOUBLE)::BIGINT END
FROM (SELECT raw, regexp_replace(raw, '[$, ]', '', 'g') AS x FROM {values(_COSTS, 'raw')})
""")
def norm_cost(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("k"), normalize.cost_number(F.col("p_retailprice") - 950).alias("cost"))
    return part.unionByName(frame(spark, _COSTS, "k string").select(F.lit("text").alias("kind"), "k", normalize.cost_text("k").alias("cost")))


_CURRENCIES = [("usd ", 1), ("dollars", 0), (None, 5), (None, 0), ("", 7), (None, None), ("eur", None)]


@query(f"SELECT code AS raw, cost, CASE WHEN code <> '' THEN trim(upper(code)) WHEN cost > 0 THEN 'USD' END AS currency FROM {values(_CURRENCIES, 'code', 'cost')}")
def norm_currency(spark, sf_dir):
    return frame(spark, _CURRENCIES, "raw string, cost int").select("raw", "cost", normalize.currency("raw", "cost").alias("currency"))


_DATES = [("JANUARY 5, 2026",), ("1/5/2026",), ("2026-02-30",), ("September 1st, 2025",), ("Jan. 15",), ("Jan. 16",), ("Feb 29",), ("",), (None,), ("5 March 2025",), ("Mar  3rd",), ("2025/7/4",), ("12-31-2025",), ("rolling",), ("February 30, 2025",), (" Nov 1 2025 ",)]
_FULL = ("%B %d, %Y", "%b %d, %Y", "%B %d %Y", "%b %d %Y", "%m/%d/%Y", "%m-%d-%Y", "%d %B %Y", "%d %b %Y", "%Y/%m/%d")
_SHORT = ("%B %d %Y", "%b %d %Y", "%b. %d %Y", "%m/%d %Y")


@query(f"""
WITH r AS (SELECT raw, trim(raw) AS s, regexp_replace(trim(raw), '\\s+', ' ', 'g') AS o FROM (SELECT * FROM {values(_DATES, 'raw')} UNION ALL SELECT strftime(o_orderdate, '%B %-d, %Y') FROM orders)),
t AS (SELECT *, try_strptime(o, [{', '.join(_sql(x) for x in _FULL)}]) AS f, try_strptime(regexp_replace(o, '(\\d+)(st|nd|rd|th)', '\\1', 'g') || ' 1900', [{', '.join(_sql(x) for x in _SHORT)}]) AS p FROM r)
SELECT raw, CASE WHEN s = '' OR s IS NULL THEN NULL WHEN regexp_full_match(s, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN s WHEN f IS NOT NULL THEN strftime(f, '%Y-%m-%d')
WHEN p IS NOT NULL THEN (CASE WHEN make_date(2026, month(p), day(p)) < DATE '2026-01-16' THEN '2027' ELSE '2026' END) || strftime(p, '-%m-%d') ELSE s END AS date FROM t
""")
def norm_date(spark, sf_dir):
    raw = frame(spark, _DATES, "raw string").union(table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "MMMM d, yyyy")))
    return raw.select("raw", normalize.date("raw", F.lit("2026-01-16").cast("date")).alias("date"))


_SPACE = r"[\s\x0B\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(f"SELECT doc_id, CASE WHEN text <> '' THEN regexp_replace(regexp_replace(text, '^{_SPACE}|{_SPACE}$', '', 'g'), '{_SPACE}', ' ', 'g') END AS name FROM documents")
def norm_text(spark, sf_dir):
    """Fee types and names share this rule; here it takes every whole text."""
    return table(spark, sf_dir, "documents").select("doc_id", normalize.fee_type("text").alias("name"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_quantity > 25 ORDER BY l_linenumber) > 1 AS again FROM lineitem")
def dup_items(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("big", F.col("l_quantity") > 25)
    return df.select("l_orderkey", "l_linenumber", quality.repeats(df, ["l_orderkey", "l_returnflag", "big"], ["l_linenumber"]).alias("again"))


@query("SELECT user_id, event_type, count(*) - 1 AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def dup_events(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    marked = df.select("user_id", "event_type", quality.repeats(df, ["user_id", "event_type"], ["ts", "event_id"]).alias("again"))
    return marked.where("again").groupBy("user_id", "event_type").agg(F.count("*").alias("copies"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice::BIGINT < 2000 THEN 'low' WHEN o_totalprice::BIGINT > 300000 THEN 'high' END AS issue FROM (SELECT o_orderkey, trunc(o_totalprice) AS o_totalprice FROM orders)")
def cost_sanity(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", quality.cost_issue(F.col("o_totalprice").cast("bigint"), 2000, 300_000).alias("issue"))


_DAYS = [("2023-12-31",), ("2026-02-30",), ("0000-01-01",), ("2029-01-01",), ("May 1",), ("",), (None,), ("2024-02-29",)]


@query(f"""
SELECT d, CASE WHEN d IS NULL OR d = '' THEN NULL WHEN NOT regexp_full_match(d, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'format' WHEN t IS NULL OR year(t) = 0 THEN 'invalid' WHEN year(t) < 2024 THEN 'past' WHEN year(t) > 2028 THEN 'future' END AS issue
FROM (SELECT d, TRY_CAST(d AS DATE) AS t FROM (SELECT * FROM {values(_DAYS, 'd')} UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders))
""")
def date_sanity(spark, sf_dir):
    df = frame(spark, _DAYS, "d string").union(table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return df.select("d", quality.date_issue("d").alias("issue"))


def _records(spark, sf_dir) -> DataFrame:
    """A record for each customer: names and balances with gaps, orders as items and deadlines."""
    cust, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    items = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(
        "o_orderkey", F.col("o_orderpriority").alias("p"), (F.floor(F.col("o_totalprice") / 1000) * 1000).cast("bigint").alias("c"), "o_orderdate"))).alias("o"))
    r = cust.join(items, cust["c_custkey"] == items["o_custkey"], "left")
    gap = lambda n, x: F.when(F.col("c_custkey") % n != 0, x)
    return r.select(
        F.col("c_custkey").alias("seed"),
        gap(11, F.struct(
            gap(5, F.col("c_name")).alias("university_name"),
            gap(7, F.struct(gap(3, F.col("c_mktsegment")).alias("city"), F.lit("PA").alias("state"), F.lit("").alias("country"), F.lit(None).cast("string").alias("postal_code"))).alias("location"),
            gap(2, F.struct(F.lit("1").alias("phone"), gap(4, F.lit("a@b.c")).alias("email"))).alias("contact"))).alias("overview"),
        F.coalesce(F.transform("o", lambda x: F.struct(x["p"].alias("fee_type"), F.when(x["o_orderkey"] % 9 != 0, x["c"]).alias("cost"), F.lit("USD").alias("currency"))), F.array()).alias("tuition_breakdown"),
        F.coalesce(F.transform("o", lambda x: F.struct(
            F.when(x["p"] == "1-URGENT", "Regular Decision").alias("deadline_type"), F.when(x["o_orderkey"] % 6 == 0, "soon").otherwise(F.date_format(x["o_orderdate"], "yyyy-MM-'01'")).alias("deadline_date"), F.lit(None).cast("string").alias("notes"))), F.array()).alias("admission_deadlines"),
        F.array().cast("array<string>").alias("page_metadata"))


_REC_SQL = """
f AS (SELECT c_custkey AS k, c_custkey % 11 <> 0 AS ov, c_custkey % 5 <> 0 AS nm, c_custkey % 7 <> 0 AS lo, c_custkey % 3 <> 0 AS ci, c_custkey % 2 <> 0 AS co, c_custkey % 4 <> 0 AS em, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer)
"""


@query(f"""
WITH {_REC_SQL} SELECT k AS seed, 10 AS expected, p::INTEGER AS populated, round(p / 10.0::DOUBLE, 3) AS completeness
FROM (SELECT k, CASE WHEN ov THEN nm::INT + (lo AND ci)::INT + lo::INT + co::INT + (co AND em)::INT ELSE 0 END + 2 * (n > 0)::INT AS p FROM f)
""")
def completeness(spark, sf_dir):
    r = quality.report(_records(spark, sf_dir))
    return r.select("seed", F.col("quality_report.total_fields_expected").alias("expected"), F.col("quality_report.total_fields_populated").alias("populated"),
                    F.col("quality_report.completeness_score").alias("completeness"))


_DUE = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Regular Decision' ELSE 'None' END"
_MISS = "SELECT k AS seed, s AS severity, 'missing_field' AS category, s2 || ' field ''' || x || ''' is missing/null' AS message FROM (SELECT k, 'warning' AS s, 'Optional' AS s2, "


@query(f"""
WITH {_REC_SQL}, o AS (SELECT o_custkey AS k, o_orderkey, o_orderpriority AS p, CASE WHEN o_orderkey % 9 <> 0 THEN (floor(o_totalprice / 1000) * 1000)::BIGINT END AS c, {_DUE} AS t,
CASE WHEN o_orderkey % 6 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-01') END AS d, o_orderkey % 6 = 0 AS soon, year(o_orderdate) AS y FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)),
r AS (SELECT *, row_number() OVER (PARTITION BY k, p, c ORDER BY o_orderkey) AS ft, row_number() OVER (PARTITION BY k, t, d ORDER BY o_orderkey) AS dt FROM o)
SELECT k AS seed, 'error' AS severity, 'missing_field' AS category, 'Entire overview section is missing' AS message FROM f WHERE NOT ov
UNION ALL SELECT k, 'error', 'missing_field', 'Required field ''university_name'' is missing/null' FROM f WHERE ov AND NOT nm
UNION ALL {_MISS} unnest([CASE WHEN NOT lo OR NOT ci THEN 'city' END, CASE WHEN NOT lo THEN 'state' END, 'country', 'postal_code', CASE WHEN NOT co THEN 'phone' END, CASE WHEN NOT co OR NOT em THEN 'email' END]) AS x FROM f WHERE ov) WHERE x IS NOT NULL
UNION ALL {_MISS} unnest(['tuition_breakdown', 'admission_deadlines']) AS x FROM f WHERE n = 0) UNION ALL {_MISS} 'page_metadata' AS x FROM f)
UNION ALL SELECT k, 'warning', 'duplicate', 'Duplicate tuition entry: ''' || p || ''' = $' || coalesce(c::VARCHAR, 'None') FROM r WHERE ft > 1
UNION ALL SELECT k, 'warning', 'cost_sanity', 'Suspiciously low cost: ''' || p || ''' = $' || c || ' (< $2000)' FROM r WHERE c < 2000
UNION ALL SELECT k, 'warning', 'cost_sanity', 'Suspiciously high cost: ''' || p || ''' = $' || c || ' (> $300,000)' FROM r WHERE c > 300000
UNION ALL SELECT k, 'warning', 'duplicate', 'Duplicate deadline: ' || t || ' on ' || d FROM r WHERE dt > 1
UNION ALL SELECT k, 'warning', 'date_sanity', 'Date not in YYYY-MM-DD format for ' || t || ': soon' FROM r WHERE soon
UNION ALL SELECT k, 'warning', 'date_sanity', 'Deadline date in the past: ' || t || ' = ' || d || ' (year ' || y || ' < 1995)' FROM r WHERE NOT soon AND y < 1995
UNION ALL SELECT k, 'warning', 'date_sanity', 'Deadline date too far in future: ' || t || ' = ' || d || ' (year ' || y || ' > 1996)' FROM r WHERE NOT soon AND y > 1996
""")
def quality_issues(spark, sf_dir):
    r = quality.report(_records(spark, sf_dir), (2000, 300_000), (1995, 1996))
    return r.select("seed", F.explode("quality_report.issues").alias("i")).select("seed", "i.severity", "i.category", "i.message")


_RULES = (
    validate.Rule("overview.university_name", "required"), validate.Rule("overview.location.city", "one_of", ("BUILDING", "MACHINERY")), validate.Rule("overview.contact.email", "matches", r"^[^@]+@[a-z]+\.[a-z]+$"),
    validate.Rule("tuition_breakdown", "most", 12), validate.Rule("tuition_breakdown[].cost", "between", (20_000, 250_000)), validate.Rule("tuition_breakdown[].cost", "required"),
    validate.Rule("admission_deadlines[].deadline_type", "one_of", ("Early Decision", "Regular Decision")), validate.Rule("admission_deadlines[].deadline_date", "matches", r"^\d{4}-\d{2}-\d{2}$"),
)


@query("""
WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS city, c_custkey % 11 <> 0 AS ov, CASE WHEN c_custkey % 4 = 0 THEN 'bad@' WHEN c_custkey % 4 = 1 THEN 'a@b.c' END AS email FROM customer),
o AS (SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, CASE WHEN o_orderkey % 9 <> 0 THEN (floor(o_totalprice / 1000) * 1000)::BIGINT END AS cost,
    o_orderpriority AS p, CASE WHEN o_orderkey % 6 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-01') END AS d FROM orders JOIN c ON o_custkey = k),
t AS (SELECT *, CASE p WHEN '1-URGENT' THEN 'Regular Decision' WHEN '2-HIGH' THEN 'Whenever' END AS t FROM o)
SELECT k AS seed, 'overview.university_name' AS path, 'required' AS rule, NULL AS value FROM c WHERE ov AND k % 5 = 0
UNION ALL SELECT k, 'overview.location.city', 'one_of', city FROM c WHERE ov AND k % 7 <> 0 AND city NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT k, 'overview.contact.email', 'matches', email FROM c WHERE ov AND k % 2 = 0 AND email = 'bad@'
UNION ALL SELECT k, 'tuition_breakdown', 'most', count(*)::VARCHAR FROM t GROUP BY k HAVING count(*) > 12
UNION ALL SELECT k, 'tuition_breakdown[' || i || '].cost', 'between', cost::VARCHAR FROM t WHERE cost NOT BETWEEN 20000 AND 250000
UNION ALL SELECT k, 'tuition_breakdown[' || i || '].cost', 'required', NULL FROM t WHERE cost IS NULL
UNION ALL SELECT k, 'admission_deadlines[' || i || '].deadline_type', 'one_of', t FROM t WHERE t = 'Whenever'
UNION ALL SELECT k, 'admission_deadlines[' || i || '].deadline_date', 'matches', d FROM t WHERE d = 'soon'
""")
def record_violations(spark, sf_dir):
    """Every violation of nested records with planted faults."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"))).alias("o"))
    r = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    kind = lambda p: F.when(p == "1-URGENT", "Regular Decision").when(p == "2-HIGH", "Whenever")
    records = r.select(
        k.alias("seed"),
        F.when(k % 11 != 0, F.struct(
            F.when(k % 5 != 0, F.col("c_name")).alias("university_name"), F.when(k % 7 != 0, F.struct(F.col("c_mktsegment").alias("city"))).alias("location"),
            F.when(k % 2 == 0, F.struct(F.when(k % 4 == 0, "bad@").when(k % 4 == 1, "a@b.c").alias("email"))).alias("contact"))).alias("overview"),
        F.transform("o", lambda x: F.struct(F.when(x["o_orderkey"] % 9 != 0, (F.floor(x["o_totalprice"] / 1000) * 1000).cast("bigint")).alias("cost"))).alias("tuition_breakdown"),
        F.transform("o", lambda x: F.struct(kind(x["o_orderpriority"]).alias("deadline_type"), F.when(x["o_orderkey"] % 6 == 0, "soon").otherwise(F.date_format(x["o_orderdate"], "yyyy-MM-'01'")).alias("deadline_date"))).alias("admission_deadlines"))
    return validate.quarantine(records, rules=_RULES)


@query("SELECT user_id AS domain, avg(value * 100) AS avg_ms, avg(value * 100) > 8000 AS slow, CASE WHEN avg(value * 100) > 8000 THEN 15000 ELSE 30000 END AS timeout_ms FROM events GROUP BY user_id")
def domain_latency(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.concat(F.lit("https://"), "user_id", F.lit("/x")).alias("url"), (F.col("value") * 100).alias("fetch_time_ms"))
    out = fetch.domain_state(ev)
    return out.select(F.col("domain").cast("bigint").alias("domain"), F.round("avg_ms", 6).alias("avg_ms"), "slow", "timeout_ms")


ORACLES["domain_latency"] = ORACLES["domain_latency"].replace("avg(value * 100) AS avg_ms", "round(avg(value * 100), 6) AS avg_ms")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, ts, last_value(CASE WHEN event_id % 3 <> 0 THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM events)
SELECT event_id, greatest(0, CASE WHEN p IS NULL THEN 0 ELSE 100000 - (epoch_us(ts) - epoch_us(p)) / 1000000.0::DOUBLE END)::DOUBLE AS wait FROM e
""")
def throttle_gap(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.lit("m").alias("model"), "ts", (F.col("event_id") % 3 != 0).alias("ok"))
    return pool.throttle(ev, {"m": 100_000.0}, key=("user_id",), order=("event_id",), every="day").select("event_id", "wait")


@query("SELECT (user_id % 6)::INTEGER AS slot, count_if(event_id % 4 <> 0)::BIGINT AS requests, count_if(event_id % 4 = 0)::BIGINT AS failures, bool_or(event_id % 40 = 0) AS limited FROM events GROUP BY ROLLUP ((user_id % 6)::INTEGER)")
def slot_usage(spark, sf_dir):
    error = F.when(F.col("event_id") % 40 == 0, "HTTP 429: Quota exceeded").when(F.col("event_id") % 4 == 0, "timeout")
    ev = table(spark, sf_dir, "events").select((F.col("user_id") % 6).cast("int").alias("slot"), (F.col("event_id") % 4 != 0).alias("ok"), error.alias("error"))
    return pool.usage(ev)


_ERRORS = [("Rate limit reached",), ("HTTP 429",), ("RESOURCE_EXHAUSTED: x",), ("quota exceeded",), ("503 unavailable",), ("bad json",), ("Too Many Requests",)]


@query(f"SELECT error, len(list_filter([{', '.join(_sql(x) for x in c.RATE_LIMITED)}], lambda w: contains(lower(error), w))) > 0 AS limited FROM {values(_ERRORS, 'error')}")
def rate_limit_errors(spark, sf_dir):
    return frame(spark, _ERRORS, "error string").select("error", pool.rate_limited("error").alias("limited"))


@query("SELECT (m.i * 3 + k.k)::INTEGER AS slot, k.k::INTEGER AS key_index, m.model FROM (VALUES (0, 'small'), (1, 'newest'), (2, 'stable')) AS m(i, model), (VALUES (0), (1), (2)) AS k(k)")
def slot_table(spark, sf_dir):
    return pool.slot_table(spark, 3)


@query("SELECT c_custkey::VARCHAR AS seed, c_custkey % 11 <> 0 AS answered, CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END::BIGINT AS answers, c_custkey % 11 <> 0 AS allowed, CASE WHEN c_custkey % 11 = 0 THEN 'no slot answered' END AS error FROM customer")
def slot_rounds(spark, sf_dir):
    """Prompts of each customer through nine slots: one key is exhausted, one model refuses some, some prompts no slot answers."""

    def ask(key, model, kind, prompt):
        k = int(prompt)
        if key == "k1":
            raise RuntimeError("HTTP 429: quota")
        if k % 11 == 0 or model == "newest" and k % 3 == 0:
            raise RuntimeError("bad json")
        return f"{key} {model} {k}"

    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("seed"), F.lit("overview").alias("extraction_type"), F.col("c_custkey").cast("string").alias("prompt"))
    config = c.PoolConfig(models=tuple(c.Model(m.name, 0.0) for m in c.PoolConfig().models), wait=0.0)
    got = extract.Rounds(ask, ["k0", "k1", "k2"], new_folder(spark, "rounds"), config, most=1_000_000).extract(asked)
    right = F.col("response_json").rlike("^k[02] ") & ~((F.col("model") == "newest") & (F.col("seed").cast("long") % 3 == 0))
    return got.groupBy("seed", "error").agg(F.count("response_json").alias("answers"), F.coalesce(F.max(right), F.lit(False)).alias("allowed")).withColumn("answered", F.col("answers") > 0)


_CONF = [(1, "U", "high", "C", "high", None, "high", "1", "high"), (2, "U", "high", None, "high", "PA", "low", None, "low"), (3, None, None, None, None, None, None, None, None), (4, "U", "low", "C", "medium", "PA", "low", "1", "low")]


@query(f"""
SELECT k, (n1 + n2 + n3 + n4)::INTEGER AS fields, CASE WHEN h >= 3 THEN 'high' WHEN h >= 1 THEN 'medium' ELSE 'low' END AS overall
FROM (SELECT k, (a IS NOT NULL)::INT AS n1, (b IS NOT NULL)::INT AS n2, (c IS NOT NULL)::INT AS n3, (d IS NOT NULL)::INT AS n4, coalesce((a IS NOT NULL AND ac = 'high')::INT, 0) + coalesce((b IS NOT NULL AND bc = 'high')::INT, 0) + coalesce((c IS NOT NULL AND cc = 'high')::INT, 0) + coalesce((d IS NOT NULL AND dc = 'high')::INT, 0) AS h
FROM {values(_CONF, 'k', 'a', 'ac', 'b', 'bc', 'c', 'cc', 'd', 'dc')})
""")
def confidence_rollup(spark, sf_dir):
    df = frame(spark, _CONF, "k int, university_name string, university_name_confidence string, city string, city_confidence string, state string, state_confidence string, phone string, phone_confidence string")
    json = F.to_json(F.struct(*df.columns[1:]))
    scores = extract.field_scores()
    return df.select("k", F.from_json(json, extract.OVERVIEW).alias("r")).select("k", F.size(scores).alias("fields"), extract.overall(scores).alias("overall"))


@query(f"""
WITH {_REC_SQL} SELECT count_if(k % 13 <> 0)::BIGINT AS succeeded, count_if(k % 13 = 0)::BIGINT AS failed, sum(CASE WHEN k % 13 <> 0 THEN n ELSE 0 END)::BIGINT AS tuition, sum(CASE WHEN k % 13 <> 0 THEN n ELSE 0 END)::BIGINT AS deadlines FROM f
""")
def batch_summary(spark, sf_dir):
    """Totals of a batch; every thirteenth record stands for a failed seed."""
    r = quality.report(_records(spark, sf_dir)).withColumn("raw", F.col("seed").cast("string"))
    return etl.totals(r.withColumn("error", F.when(F.col("seed") % 13 == 0, "no pages")))


@query(f"""
WITH {_REC_SQL} SELECT k::VARCHAR AS raw, k % 13 <> 0 AS ok, CASE WHEN k % 13 <> 0 THEN n ELSE 0 END::INTEGER AS tuition, CASE WHEN k % 13 <> 0 THEN n ELSE 0 END::INTEGER AS deadlines,
round((CASE WHEN ov THEN nm::INT + (lo AND ci)::INT + lo::INT + co::INT + (co AND em)::INT ELSE 0 END + 2 * (n > 0)::INT) / 10.0::DOUBLE, 3) AS completeness_score FROM f
""")
def record_summary(spark, sf_dir):
    r = quality.report(_records(spark, sf_dir)).withColumn("raw", F.col("seed").cast("string"))
    return etl.summary(r.withColumn("error", F.when(F.col("seed") % 13 == 0, "no pages")))


@query("SELECT user_id AS run, ts, (epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) - epoch_us(ts)) / 1000000.0::DOUBLE AS seconds FROM events")
def step_times(spark, sf_dir):
    return etl.step_times(table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), "ts")).select("run", "ts", "seconds")


@query()
def record_json(spark, sf_dir):
    r = quality.report(_records(spark, sf_dir))
    return r.select("seed", sinks.record_json("overview", "tuition_breakdown", "admission_deadlines", "page_metadata", "quality_report").alias("json"))


_ROBOTS = [("s", "https://x.edu", 200, "User-agent: *\nSitemap: https://x.edu/a.xml\r\nSITEMAP:https://x.edu/sitemap.xml\nsitemap: https://x.edu/b.xml"), ("t", "https://y.edu", 404, "Sitemap: https://y.edu/no.xml"), ("u", "https://z.edu", None, None)]


def _robots_sql() -> str:
    rows = "(VALUES " + ", ".join("(" + ", ".join(["'" + a + "'", "'" + b + "'", "NULL::INTEGER" if s is None else str(s), "NULL" if t is None else "'" + t.replace("\r", "").replace("\n", "' || chr(10) || '") + "'"]) + ")" for a, b, s, t in _ROBOTS) + ") AS v(seed, base, status, body)"
    return f"""
    WITH e AS (SELECT seed, base || '/sitemap.xml' AS url, 0 AS p FROM {rows} UNION ALL SELECT seed, base || '/sitemap_index.xml', 1 FROM {rows}
    UNION ALL SELECT seed, trim(regexp_replace(l, '^[^:]*:', '')), 1 + i FROM (SELECT seed, unnest(string_split(body, chr(10))) AS l, generate_subscripts(string_split(body, chr(10)), 1) AS i FROM {rows} WHERE status = 200) WHERE lower(l) LIKE 'sitemap:%')
    SELECT seed, (row_number() OVER (PARTITION BY seed ORDER BY min(p)) - 1)::INTEGER AS pos, url FROM e GROUP BY seed, url"""


@query(_robots_sql())
def robots_sitemaps(spark, sf_dir):
    return web.robots_sitemaps(frame(spark, _ROBOTS, "seed string, base_url string, status int, body string"))


_STATUS_OF = "CASE WHEN c_custkey % 5 = 0 THEN 404 ELSE 200 END"


@query(f"""
WITH r AS (SELECT c_custkey AS seed, 'https://c' || c_custkey || '.edu' AS base, {_STATUS_OF} AS status, c_nationkey AS n FROM customer),
e AS (SELECT seed, base || '/sitemap.xml' AS url, 0 AS p FROM r UNION ALL SELECT seed, base || '/sitemap_index.xml', 1 FROM r
      UNION ALL SELECT seed, base || '/n' || (n % 4) || '.xml', 3 FROM r WHERE status = 200 UNION ALL SELECT seed, base || '/m' || (n % 4) || '.xml', 4 FROM r WHERE status = 200 AND n % 3 = 0)
SELECT seed, (row_number() OVER (PARTITION BY seed ORDER BY min(p)) - 1)::INTEGER AS pos, url FROM e GROUP BY seed, url
""")
def customer_robots(spark, sf_dir):
    """Sitemaps of a site for each customer, by the robots file it would have: repeated, in odd case, or gone."""
    body = "concat('User-agent: *\r\nSITEMAP:  ', base, '/n', c_nationkey % 4, '.xml \nDisallow: /x\nsitemap: ', base, '/n', c_nationkey % 4, '.xml', if(c_nationkey % 3 = 0, concat('\rSitemap:', base, '/m', c_nationkey % 4, '.xml'), '\nSitemap: ' || base || '/sitemap.xml'))"
    sites = table(spark, sf_dir, "customer").selectExpr("c_custkey AS seed", "concat('https://c', c_custkey, '.edu') AS base", "c_nationkey", f"{_STATUS_OF} AS status")
    return web.robots_sitemaps(sites.selectExpr("seed", "base AS base_url", "status", f"{body} AS body"))


@query(f"""
WITH p AS (SELECT DISTINCT {host_of('url')} AS seed, {_BASE.format(host_of('url'))} AS base, url, page_id FROM pages)
SELECT DISTINCT seed, base, replace(url, '&', '') AS url FROM p WHERE page_id % 4 < 3 AND page_id % 11 <> 5 AND contains(url, base)
""")
def host_sitemaps(spark, sf_dir):
    """Pages of each host by its sitemaps: an index of indices, cycles, a broken file, a file that is gone and pages of other sites."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "&", "").alias("url"), urls.host("url").alias("seed"), urls.base_domain("url").alias("base"))
    hosts = p.select("seed", "base").distinct()
    at = lambda name: F.concat(F.lit("https://"), "seed", F.lit(f"/{name}.xml"))
    loc = lambda tag, x: F.concat(F.lit(f"<{tag}><loc> "), x, F.lit(f" </loc></{tag}>"))
    index = lambda name, *to: hosts.select(at(name).alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<sitemapindex>"), *[loc("sitemap", at(t)) for t in to], F.lit("</sitemapindex>")).alias("body"))
    named = p.where("page_id % 11 <> 5").groupBy("seed", (F.col("page_id") % 4).alias("k")).agg(F.array_join(F.array_sort(F.collect_set(loc("url", F.col("url")))), "").alias("pages"))
    leaf = named.select(
        F.concat(F.lit("https://"), "seed", F.lit("/leaf"), "k", F.lit(".xml")).alias("url"), F.when(F.col("k") == 3, 404).otherwise(200).alias("status"),
        F.concat(F.lit("<urlset>"), "pages", F.lit("<url><loc>https://elsewhere.test/x</loc></url></urlset>")).alias("body"))
    broken = hosts.select(at("broken").alias("url"), F.lit(200).alias("status"), F.lit("<urlset><url><loc>https://lost").alias("body"))
    files = index("sitemap", "deep", "leaf0").unionByName(index("deep", "deeper", "sitemap")).unionByName(index("deeper", "leaf1", "leaf2", "leaf3", "broken", "deep")).unionByName(leaf).unionByName(broken)
    start = hosts.select("seed", "base", at("sitemap").alias("url"))
    return web.sitemap_pages(start, files, folder=new_folder(spark, "sitemaps"))


_NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
_MAPS = [
    ("https://x.edu/sitemap.xml", 200, f"<?xml version='1.0'?><sitemapindex {_NS}><sitemap><loc>https://x.edu/m1.xml</loc></sitemap><sitemap><loc>https://x.edu/bad.xml</loc></sitemap></sitemapindex>"),
    ("https://x.edu/m1.xml", 200, f"<urlset {_NS}><url><loc> https://x.edu/apply </loc></url><url><loc>https://x.edu/fees/</loc></url><url><loc>https://other.org/apply</loc></url></urlset>"),
    ("https://x.edu/bad.xml", 200, "<urlset><url><loc>https://x.edu/lost</loc>"), ("https://x.edu/gone.xml", 404, "<urlset><url><loc>https://x.edu/gone</loc></url></urlset>"),
    ("https://x.edu/sitemap_index.xml", 200, "<urlset><url><loc>https://x.edu/apply</loc></url><url><loc>https://x.edu/news</loc></url></urlset>"),
]


_WHOLE = "status = 200 AND (body LIKE '%</urlset>' OR body LIKE '%</sitemapindex>')"
_PAGES_SQL = f"""
WITH RECURSIVE m AS (SELECT * FROM {values(_MAPS, 'url', 'status', 'body')} WHERE {_WHOLE}),
seen AS (SELECT unnest(['https://x.edu/sitemap.xml', 'https://x.edu/sitemap_index.xml', 'https://x.edu/gone.xml']) AS url
UNION SELECT unnest(regexp_extract_all(body, '<sitemap><loc>\\s*([^<]*?)\\s*</loc>', 1)) FROM seen JOIN m USING (url))
SELECT DISTINCT 's' AS seed, 'x.edu' AS base, p AS url FROM (SELECT unnest(regexp_extract_all(body, '<url><loc>\\s*([^<]*?)\\s*</loc>', 1)) AS p FROM seen JOIN m USING (url)) WHERE contains(p, 'x.edu')
"""


@query(_PAGES_SQL)
def sitemap_urls(spark, sf_dir):
    start = frame(spark, [("s", "x.edu", u) for u in ("https://x.edu/sitemap.xml", "https://x.edu/sitemap_index.xml", "https://x.edu/gone.xml")], "seed string, base string, url string")
    return web.sitemap_pages(start, frame(spark, _MAPS, "url string, status int, body string"), folder=new_folder(spark, "sitemaps")).select("seed", "base", "url")


@query(f"SELECT seed, url, '' AS anchor_text, 'sitemap' AS source, 0 AS depth FROM ({_PAGES_SQL}) WHERE regexp_matches(lower(url), '{_ALL}')")
def sitemap_links(spark, sf_dir):
    return discovery.sitemap_links(sitemap_urls(spark, sf_dir))


@query(f"""
WITH {_NAV_SQL}, s AS (SELECT seed, url, {_score_sql(_PA, (), source=_sql('nav-nav'), depth='1')} AS a, {_score_sql(_PT, (), source=_sql('nav-nav'), depth='1')} AS t FROM nav),
r AS (SELECT seed, url, greatest(a, t) AS m, row_number() OVER (PARTITION BY seed ORDER BY greatest(a, t) DESC, url)::INTEGER AS rank FROM s) SELECT seed, url, rank FROM r WHERE rank <= 5 AND m >= 0.2
""")
def expand_choice(spark, sf_dir):
    """The links of each host that are followed one level down."""
    return discovery.to_expand(discovery.scored(_page_links(spark, sf_dir), PAGE_ADM, PAGE_TUI, (), ())).select("seed", "url", "rank")


def _requests(spark, sf_dir) -> DataFrame:
    """A log of requests: some URLs again and again, some refused, some without an answer, some sites slow."""
    return _as_requests(table(spark, sf_dir, "events"))


def _as_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS n", "ts", "concat('https://d', user_id % 60, '.edu/', user_id % 7, '/', event_type) AS url", "event_id % 4 <> 0 AS first_ok", "event_id % 3 <> 0 AS second_ok",
        "CASE WHEN event_id % 12 <> 4 THEN cast(value * 40 + user_id % 60 * 130 AS int) END AS first_ms", "cast(value * 60 AS int) AS second_ms")


_REPLAY_SQL = """
WITH r AS (SELECT event_id AS n, ts, 'd' || (user_id % 60) || '.edu' AS d, 'https://d' || (user_id % 60) || '.edu/' || (user_id % 7) || '/' || event_type AS url, event_id % 4 <> 0 AS a, event_id % 3 <> 0 AS b,
    CASE WHEN event_id % 12 <> 4 THEN trunc(value * 40 + user_id % 60 * 130)::BIGINT END AS ams, trunc(value * 60)::BIGINT AS bms FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, n) = 1 AS is_first FROM r),
s AS (SELECT *, coalesce(max((NOT a AND b)::INT) OVER (PARTITION BY d ORDER BY ts, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS sticky FROM f WHERE is_first),
l AS (SELECT *, CASE WHEN sticky THEN b ELSE a OR b END AS ok, CASE WHEN sticky THEN 1 WHEN a THEN (ams IS NOT NULL)::INT ELSE (ams IS NOT NULL)::INT + 1 END AS k,
    CASE WHEN sticky THEN bms WHEN a THEN coalesce(ams, 0) ELSE coalesce(ams, 0) + bms END AS ms FROM s),
t AS (SELECT *, coalesce(sum(ms) OVER w, 0) > 8000 * coalesce(sum(k) OVER w, 0) AS slow FROM l WINDOW w AS (PARTITION BY d ORDER BY ts, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT r.n, r.url, CASE WHEN r.n = t.n THEN CASE WHEN ok THEN 'fetched' ELSE 'failed' END WHEN ok THEN 'cached' ELSE 'skipped' END AS action,
    CASE WHEN ok THEN CASE WHEN sticky OR NOT t.a THEN 'alternate' ELSE 'standard' END END AS mode, CASE WHEN r.n <> t.n THEN 0 WHEN sticky OR t.a THEN 1 ELSE 2 END::INTEGER AS calls,
    CASE WHEN r.n = t.n THEN CASE WHEN slow THEN 15000 ELSE 30000 END END::INTEGER AS timeout_ms FROM r JOIN t USING (url)
"""


@query(_REPLAY_SQL)
def crawl_memory(spark, sf_dir):
    """What a crawl that remembers pages, failures, load times and modes does with each request of a log."""
    return fetch.replay(_requests(spark, sf_dir))


@query(_REPLAY_SQL)
def crawl_memory_stream(spark, sf_dir):
    """The same as a stream over the table, its state in a store; the stream ends when it has taken all there is."""
    out, key = new_folder(spark, "memory"), "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    path = f"{sf_dir}/events.parquet"
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern may name a file
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = state.crawl_memory(_as_requests(events)).writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows")
        q.awaitTermination()
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    return spark.read.schema(state.MEMORY).parquet(f"{out}/rows")


_P1, _P2 = "(page_id % 10 <> 7 AND page_id % 4 <> 1)", "(page_id % 3 <> 0)"


@query(f"""
WITH p AS (SELECT *, page_id % 40 AS d FROM pages WHERE page_id % 11 <> 3), g AS (SELECT page_id, d % 5 = 2 AS sticky, {_P1} AND length(html) >= 100 AND NOT regexp_matches(lower(html), '{'|'.join(c.BOT_MARKERS)}') AS a, {_P2} AND length(html) >= 100 AS b FROM p)
SELECT page_id, CASE WHEN a AND NOT sticky THEN 'standard' ELSE 'alternate' END AS mode FROM g WHERE (a AND NOT sticky) OR b
""")
def fetch_fallback(spark, sf_dir):
    """Pages of two adapters: some are refused by the first, some unknown to either, some domains are known to need the second."""
    pages = table(spark, sf_dir, "pages").selectExpr("page_id", "concat('https://d', page_id % 40, '.edu/', page_id) AS url", "html")
    made = lambda df, status: df.selectExpr("page_id", "url", "url AS final_url", f"{status} AS status_code", "'text/html' AS content_type", "html", "5 AS fetch_time_ms")
    first = fetch.Table(made(pages.where("page_id % 4 <> 1"), "CASE WHEN page_id % 10 = 7 THEN 403 ELSE 200 END"))
    second = fetch.Table(made(pages.where(_P2), "200"))
    sticky = spark.range(40).where("id % 5 = 2").select(F.concat(F.lit("d"), "id", F.lit(".edu")).alias("domain"))
    failed = pages.where("page_id % 11 = 3")
    return fetch.with_fallback(pages, first, second, failed, sticky).select("page_id", "mode")


@query(f"""
WITH p AS (SELECT page_id, url, {host_of('url')} AS seed, regexp_matches(lower(url), '{'|'.join(c.PAGE_ADMISSIONS)}') AS a, regexp_matches(lower(url), '{'|'.join(c.PAGE_TUITION)}') AS t, 'text of ' || page_id AS m FROM pages),
f AS (SELECT *, a OR NOT bool_or(a) OVER w AS fa, t OR NOT bool_or(t) OVER w AS ft FROM p WINDOW w AS (PARTITION BY seed)),
k AS (SELECT seed, page_id, url, m, unnest(['overview', 'tuition', 'deadlines']) AS extraction_type, unnest([true, ft, fa]) AS on_ FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY seed, extraction_type ORDER BY page_id) AS n FROM k WHERE on_)
SELECT seed, extraction_type, string_agg(url, ' ' ORDER BY n) AS sources, md5(CASE extraction_type {' '.join(f"WHEN '{k}' THEN {_sql(v)}" for k, v in extract.RULES.items())} END || chr(10) || string_agg(chr(10) || chr(10) || '## Page: ' || url || chr(10) || m, '' ORDER BY n)) AS prompt
FROM n WHERE n <= {c.CONTEXT_PAGES} GROUP BY seed, extraction_type
""")
def model_prompts(spark, sf_dir):
    """One prompt for each host and kind of values, from the pages of its class."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", urls.host("url").alias("seed"))
    asked = context.classify_pages(pages).withColumn("markdown", F.concat(F.lit("text of "), "page_id")).withColumnRenamed("page_id", "pos")
    return extract.prompts(asked).select("seed", "extraction_type", F.array_join("source_urls", " ").alias("sources"), F.md5("prompt").alias("prompt"))


def _responses(spark, sf_dir) -> DataFrame:
    """Answers of a model for each customer, some missing, broken or partly empty."""
    k = F.col("c_custkey")
    gap = lambda n, x: F.when(k % n != 0, x)
    over = F.to_json(F.struct(
        gap(5, F.col("c_name")).alias("university_name"), F.lit("high").alias("university_name_confidence"), gap(3, F.col("c_mktsegment")).alias("city"),
        F.when(k % 2 == 0, "high").otherwise("low").alias("city_confidence"), F.lit("PA").alias("state"), F.when(k % 7 == 0, "high").alias("state_confidence"), F.lit("17837").alias("postal_code"),
        F.when(k % 4 == 0, "a@b.org").when(k % 4 == 1, "bad@").when(k % 4 == 2, "none").alias("email")))
    fees = F.to_json(F.struct(F.array(
        F.struct(F.lit("Tuition").alias("fee_type"), (k * 10).alias("cost"), F.lit("USD").alias("currency"), gap(2, F.lit("high")).alias("confidence")),
        F.struct(gap(6, F.lit("Housing")).alias("fee_type"), F.lit(0).cast("long").alias("cost"), F.lit(None).cast("string").alias("currency"), F.lit("low").alias("confidence"))).alias("items"),
        gap(4, F.lit("high")).alias("overall_confidence")))
    due = F.to_json(F.struct(F.array(
        F.struct(F.when(k % 2 == 0, "Regular Decision").otherwise("Whenever").alias("deadline_type"), gap(3, F.lit("2026-01-01")).alias("deadline_date"), gap(4, F.lit("firm")).alias("notes"), F.lit("medium").alias("confidence")),
    ).alias("items"), F.lit("low").alias("overall_confidence")))
    customers = spread(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    rows = customers.select(k.alias("seed"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("extraction_type"), F.when(k % 9 != 0, F.when(k % 10 == 0, "{broken").otherwise(j)).alias("response_json"), F.lit(f"m-{t}").alias("model"))
        for t, j in (("overview", over), ("tuition", fees), ("deadlines", due))])).alias("r"))
    return rows.select("seed", "r.*").withColumn("error", F.when(F.col("response_json").isNull(), "timeout"))


def _results(spark, sf_dir) -> DataFrame:
    answers = _responses(spark, sf_dir)
    asked = answers.select("seed", "extraction_type", F.array(F.concat(F.lit("u"), "seed")).alias("source_urls"), F.lit("").alias("prompt"))
    got = extract.Replay(answers).extract(asked)
    return extract.results(asked, got, answers.select("seed").distinct())


_SEEN = "k % 9 <> 0 AND k % 10 <> 0"


@query(f"""
SELECT k AS seed, CASE WHEN {_SEEN} AND k % 5 <> 0 THEN c_name END AS name, CASE WHEN {_SEEN} AND k % 3 <> 0 THEN c_mktsegment END AS city, CASE WHEN {_SEEN} THEN 'PA' END AS state,
CASE WHEN {_SEEN} AND k % 4 <> 1 THEN '17837' END AS postal, CASE WHEN {_SEEN} AND k % 4 = 0 THEN 'a@b.org' END AS email FROM (SELECT *, c_custkey AS k FROM customer)
""")
def overview_values(spark, sf_dir):
    """Typed overview of each answer; an address that is not valid empties email and postal code."""
    return _results(spark, sf_dir).select(
        "seed", F.col("overview.university_name").alias("name"), "overview.location.city", "overview.location.state",
        F.col("overview.location.postal_code").alias("postal"), "overview.contact.email")


@query(f"""
SELECT k AS seed, 'fee' AS kind, i AS pos, CASE WHEN i = 0 THEN 'Tuition' WHEN k % 6 <> 0 THEN 'Housing' END AS name, CASE WHEN i = 0 THEN (k * 10)::VARCHAR ELSE '0' END AS value, CASE WHEN i = 0 THEN 'USD' END AS note FROM (SELECT c_custkey AS k, unnest([0, 1]) AS i FROM customer) WHERE {_SEEN}
UNION ALL SELECT k, 'deadline', 0, CASE WHEN k % 2 = 0 THEN 'Regular Decision' END, CASE WHEN k % 3 <> 0 THEN '2026-01-01' END, CASE WHEN k % 4 <> 0 THEN 'firm' END FROM (SELECT c_custkey AS k FROM customer) WHERE {_SEEN}
""")
def item_values(spark, sf_dir):
    """Typed fees and deadlines of each answer; a type of deadline that is not known is null."""
    r = _results(spark, sf_dir)
    fees = r.select("seed", F.posexplode("tuition_breakdown").alias("pos", "x")).select("seed", F.lit("fee").alias("kind"), "pos", F.col("x.fee_type").alias("name"), F.col("x.cost").cast("string").alias("value"), F.col("x.currency").alias("note"))
    due = r.select("seed", F.posexplode("admission_deadlines").alias("pos", "x")).select("seed", F.lit("deadline").alias("kind"), "pos", F.col("x.deadline_type").alias("name"), F.col("x.deadline_date").alias("value"), F.col("x.notes").alias("note"))
    return fees.unionByName(due)


@query(f"""
WITH q AS (SELECT c_custkey AS k, c_name, c_mktsegment, {_SEEN.replace('k %', 'c_custkey %')} AS seen FROM customer)
SELECT k AS seed, 'overview' AS extraction_type, unnest(['university_name', 'city', 'state', 'postal_code', 'email']) AS field_name,
unnest(['high', CASE WHEN k % 2 = 0 THEN 'high' ELSE 'low' END, CASE WHEN k % 7 = 0 THEN 'high' ELSE 'medium' END, 'medium', 'medium']) AS confidence,
unnest([CASE WHEN k % 5 <> 0 THEN 'Value: ' || c_name END, CASE WHEN k % 3 <> 0 THEN 'Value: ' || c_mktsegment END, 'Value: PA', 'Value: 17837', 'Value: ' || CASE k % 4 WHEN 0 THEN 'a@b.org' WHEN 1 THEN 'bad@' WHEN 2 THEN 'none' END]) AS reason FROM q WHERE seen
UNION ALL SELECT k, 'tuition', unnest(['tuition[0].Tuition', 'tuition[1].' || CASE WHEN k % 6 <> 0 THEN 'Housing' ELSE 'None' END]), unnest([CASE WHEN k % 2 <> 0 THEN 'high' ELSE 'medium' END, 'low']), unnest(['$' || (k * 10), 'no cost']) FROM q WHERE seen
UNION ALL SELECT k, 'deadlines', 'deadline[0].' || CASE WHEN k % 2 = 0 THEN 'Regular Decision' ELSE 'Whenever' END, 'medium', CASE WHEN k % 3 <> 0 THEN '2026-01-01 (' || CASE WHEN k % 4 <> 0 THEN 'firm' ELSE 'None' END || ')' ELSE 'no date' END FROM q WHERE seen
""")
def field_confidence(spark, sf_dir):
    """The confidence and reason of each value of each answer."""
    return _results(spark, sf_dir).select("seed", F.explode("extraction_confidence").alias("e")).select(
        "seed", "e.extraction_type", F.explode("e.field_scores").alias("f")).select("seed", "extraction_type", "f.field_name", "f.confidence", "f.reason")


ORACLES["field_confidence"] = f"SELECT * FROM ({ORACLES['field_confidence']}) WHERE reason IS NOT NULL"


@query(f"""
WITH q AS (SELECT c_custkey AS k, {_SEEN.replace('k %', 'c_custkey %')} AS seen FROM customer), o AS (SELECT *, (k % 5 <> 0)::INT + (k % 3 <> 0 AND k % 2 = 0)::INT + (k % 7 = 0)::INT AS h FROM q)
SELECT k AS seed, 'overview' AS extraction_type, CASE WHEN NOT seen THEN 'low' WHEN h >= 3 THEN 'high' WHEN h >= 1 THEN 'medium' ELSE 'low' END AS overall_confidence, 'u' || k AS sources, 'm-overview' AS model_used FROM o
UNION ALL SELECT k, 'tuition', CASE WHEN NOT seen THEN 'low' WHEN k % 4 <> 0 THEN 'high' ELSE 'medium' END, 'u' || k, 'm-tuition' FROM q
UNION ALL SELECT k, 'deadlines', 'low', 'u' || k, 'm-deadlines' FROM q
""")
def extraction_meta(spark, sf_dir):
    """Overall confidence, sources and model of each kind of values; a missing or broken answer counts as low."""
    r = _results(spark, sf_dir)
    conf = r.select("seed", F.explode("extraction_confidence").alias("e")).select("seed", "e.extraction_type", "e.overall_confidence")
    src = r.select("seed", F.explode("extraction_sources").alias("e")).select("seed", "e.extraction_type", F.array_join("e.source_urls", " ").alias("sources"), "e.model_used")
    return conf.join(src, ["seed", "extraction_type"])


@query("""
SELECT c_custkey AS seed, c_name || ' U' AS name, 'PA' AS state, 'United States' AS country, lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS postal, '+1-570-577-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
'a' || c_custkey || '@b.org' AS email, 'Fee x' AS fee, CASE WHEN c_custkey % 2 = 0 THEN 100 END::BIGINT AS cost, 'USD' AS currency, CASE WHEN c_custkey % 3 = 0 THEN 'rolling' ELSE '2026-01-05' END AS due FROM customer
""")
def record_normalized(spark, sf_dir):
    """Every normalizer over the nested columns of a record."""
    k = F.col("c_custkey")
    digits = lambda n: F.lpad((k % 10**n).cast("string"), n, "0")
    raw = table(spark, sf_dir, "customer").select(
        k.alias("seed"),
        F.struct(
            F.concat(F.lit("  "), "c_name", F.lit(" \t U ")).alias("university_name"),
            F.struct(F.lit("x").alias("city"), F.lit(" pennsylvania").alias("state"), F.lit("U.S.A.").alias("country"), F.concat(digits(5), F.lit(" ")).alias("postal_code")).alias("location"),
            F.struct(F.concat(F.lit("(570) 577-"), digits(4)).alias("phone"), F.concat(F.lit(" A"), k, F.lit("@B.org")).alias("email")).alias("contact")).alias("overview"),
        F.array(F.struct(F.lit(" Fee \n x").alias("fee_type"), F.when(k % 2 == 0, 100).otherwise(-1).cast("long").alias("cost"), F.lit("usd ").alias("currency"))).alias("tuition_breakdown"),
        F.array(F.struct(F.lit("Rolling").alias("deadline_type"), F.when(k % 3 == 0, "rolling").otherwise("JANUARY 5, 2026").alias("deadline_date"), F.lit(None).cast("string").alias("notes"))).alias("admission_deadlines"))
    r = normalize.record(raw, F.lit("2026-01-16").cast("date"))
    o, t = F.col("overview"), F.col("tuition_breakdown")[0]
    return r.select(
        "seed", o["university_name"].alias("name"), o["location"]["state"].alias("state"), o["location"]["country"].alias("country"), o["location"]["postal_code"].alias("postal"),
        o["contact"]["phone"].alias("phone"), o["contact"]["email"].alias("email"), t["fee_type"].alias("fee"), t["cost"].alias("cost"), t["currency"].alias("currency"),
        F.col("admission_deadlines")[0]["deadline_date"].alias("due"))


@query(f"SELECT seed, count_if(severity = 'error')::INTEGER AS errors, count_if(severity = 'warning')::INTEGER AS warnings FROM ({ORACLES['quality_issues']}) GROUP BY seed")
def issue_counts(spark, sf_dir):
    r = quality.report(_records(spark, sf_dir), (2000, 300_000), (1995, 1996))
    return quality.severities(r).select("seed", "errors", "warnings")


@query(f"""
SELECT seed, row_number() OVER (PARTITION BY seed ORDER BY g, message)::INTEGER - 1 AS pos, message FROM (SELECT seed, message,
CASE WHEN message LIKE 'Entire%' OR message LIKE 'Required%' THEN 0 WHEN message LIKE '%''city''%' THEN 1 WHEN message LIKE '%''state''%' THEN 2 WHEN message LIKE '%''country''%' THEN 3 WHEN message LIKE '%''postal_code''%' THEN 4
WHEN message LIKE '%''phone''%' THEN 5 WHEN message LIKE '%''email''%' THEN 6 WHEN message LIKE '%tuition_breakdown%' THEN 7 WHEN message LIKE '%admission_deadlines%' THEN 8 ELSE 9 END AS g
FROM ({ORACLES['quality_issues']}) WHERE category = 'missing_field')
""")
def issue_order(spark, sf_dir):
    """The missing fields of each record in the order of the report."""
    r = quality.report(_records(spark, sf_dir), (2000, 300_000), (1995, 1996))
    missing = F.filter("quality_report.issues", lambda i: i["category"] == "missing_field")
    return r.select("seed", F.posexplode(missing).alias("pos", "i")).select("seed", "pos", "i.message")


@query(f"""
WITH {_REC_SQL} SELECT k AS seed, n::INTEGER AS fees, CASE WHEN ov AND nm THEN (SELECT c_name FROM customer WHERE c_custkey = k) END AS name, CASE WHEN ov AND co AND em THEN 'a@b.c' END AS email,
(CASE WHEN ov THEN nm::INT + (lo AND ci)::INT + lo::INT + co::INT + (co AND em)::INT ELSE 0 END + 2 * (n > 0)::INT)::INTEGER AS populated FROM f
""")
def record_fields(spark, sf_dir):
    """Fields of the JSON of each record, read back from its text."""
    r = record_json(spark, sf_dir)
    at = lambda p: F.get_json_object("json", f"$.{p}")
    return r.select("seed", F.coalesce(F.json_array_length(at("tuition_breakdown")), F.lit(0)).alias("fees"), at("overview.university_name").alias("name"), at("overview.contact.email").alias("email"),
                    at("quality_report.total_fields_populated").cast("int").alias("populated"))


@query("""
SELECT p_partkey AS k, 't' || chr(10) || chr(10) || '# ' || p_name || chr(10) || chr(10) || 'Made by **' || p_brand || '** & co.' || chr(10) || chr(10) || '- size ' || p_size || chr(10) || '- see it' AS markdown FROM part
""")
def markdown_plain(spark, sf_dir):
    """Markdown of small pages that are composed from a table; a title is no noise and stays."""
    page = F.concat(
        F.lit("<html><head><title>t</title><style>x</style></head><body><nav><a href='/'>Home</a></nav><h1>"), "p_name", F.lit("</h1>\n<p>Made by\n <b>"), "p_brand",
        F.lit("</b> &amp; co.</p><script>no()</script><ul><li>size "), "p_size", F.lit("</li><li><a href='/x'>see it</a></li></ul><footer>end</footer></body></html>"))
    parts = spread(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    return parts.select(F.col("p_partkey").alias("k"), html.markdown(page).alias("markdown"))


@query("""
SELECT 's' || i || '.edu' AS raw, CASE WHEN i % 5 = 4 THEN 'no pages' END AS error, CASE WHEN i % 5 = 4 THEN NULL ELSE 4 END AS pages, CASE WHEN i % 5 <> 4 THEN CASE WHEN i % 3 = 0 THEN 0 ELSE 1 END END AS fees,
CASE WHEN i % 5 <> 4 AND i % 2 = 0 THEN 'S' || i END AS name FROM (SELECT unnest(range(40)) AS i)
""")
def job_records(spark, sf_dir):
    """The whole job on forty small sites: discovery, pages, prompts, answers, records; every fifth site is gone."""
    body = "<p>" + "words of the page. " * 20 + "</p>"
    site = spark.range(40).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("https://www.s"), "id", F.lit(".edu/")).alias("home"))
    paths = {"": f"<title>Home</title><nav><a href='/admissions'>Apply</a><a href='/tuition'>Costs</a></nav>{body}", "admissions/": f"<title>Adm</title>{body}", "tuition/": f"<title>Fees</title>{body}", "apply-now": body}
    pages = site.where("i % 5 <> 4").select(F.explode(F.array(*[F.struct(F.concat("home", F.lit(p)).alias("url"), F.lit(h).alias("html")) for p, h in paths.items()])).alias("p")).select(
        "p.url", F.col("p.url").alias("final_url"), F.lit(200).alias("status_code"), F.lit("text/html").alias("content_type"), "p.html", F.lit(5).alias("fetch_time_ms"))
    maps = site.select(F.concat("home", F.lit("sitemap.xml")).alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<urlset><url><loc>"), "home", F.lit("apply-now</loc></url></urlset>")).alias("body"))
    robots = site.select(F.col("home").alias("seed"), F.lit(404).alias("status"), F.lit(None).cast("string").alias("body"))
    one = lambda kind, ok, text: F.struct(F.lit(kind).alias("extraction_type"), F.when(ok, text).alias("response_json"), F.lit("m").alias("model"), F.lit(None).cast("string").alias("error"))
    answers = site.select(F.col("home").alias("seed"), F.explode(F.array(
        one("overview", F.col("i") % 2 == 0, F.concat(F.lit('{"university_name": " S'), "i", F.lit('"}'))),
        one("tuition", F.col("i") % 3 != 0, F.lit('{"items": [{"fee_type": "Tuition", "cost": 100}]}')), one("deadlines", F.lit(False), F.lit("")))).alias("r")).select("seed", "r.*")
    job = etl.Job(fetch.Table(pages), extract.Replay(answers), robots, maps, "2026-01-16", "2026-01-16T00:00:00+00:00", folder=work_folder(spark, "job"))
    out = etl.run(job, site.select(F.concat(F.lit("s"), "i", F.lit(".edu")).alias("raw")))
    return out.select("raw", "error", F.nullif(F.size("page_metadata"), F.lit(-1)).alias("pages"), F.nullif(F.size("tuition_breakdown"), F.lit(-1)).alias("fees"), F.col("overview.university_name").alias("name"))
