"""Each job as a query over the given tables: run twice into a new folder, its output read back; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.plans import queries as q

from . import contact_directory, link_frontier
from .common import config

#: Patterns that occur in the synthetic pages, as for the queries on links.
_WORDS = {"admissions": list(q.PAGE_ADM), "tuition": list(q.PAGE_TUI)}


def job1_link_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = q.new_folder(spark, "job1")
    for _ in range(2):
        link_frontier.run(spark, f"{sf_dir}/pages.parquet", out, f"{out}/checkpoint", config("link_frontier") | _WORDS)
    return link_frontier.frontier(spark, out).drop("bucket")


def job2_contact_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = q.new_folder(spark, "job2")
    for _ in range(2):
        contact_directory.run(spark, f"{sf_dir}/documents.parquet", out)
    return contact_directory.contacts(spark, out)


_SQL1 = f"""
WITH top AS ({q.ORACLES['balanced_topk']}), {q._NAV_SQL},
s AS (SELECT seed, url, page_id, {q._score_sql(q._PA, (), source="'nav-nav'", depth='1')} AS admissions_score, {q._score_sql(q._PT, (), source="'nav-nav'", depth='1')} AS tuition_score FROM nav)
SELECT top.seed, rank, top.url, CASE WHEN s.url IS NOT NULL THEN {q._CATEGORY} END AS category, admissions_score, tuition_score, page_id FROM top LEFT JOIN s USING (seed, url)
"""

_SQL2 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(nullif(lang, ''), 'und') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
p AS (SELECT r, doc_id, lang, source, unnest(regexp_extract_all(text, '(\+?1 )?\(?\d{3}\)?[ -]\d{3}-\d{4}')) AS raw FROM d),
n AS (SELECT *, CASE WHEN k LIKE '+1%' THEN k[3:] WHEN k LIKE '1%' AND length(k) = 11 THEN k[2:] ELSE k END AS t FROM (SELECT *, regexp_replace(raw, '[^0-9+]', '', 'g') AS k FROM p)),
c AS (SELECT DISTINCT r, doc_id, lang, source, 'phone' AS kind, CASE WHEN length(t) = 10 THEN '+1-' || t[1:3] || '-' || t[4:6] || '-' || t[7:10] ELSE raw END AS value FROM n
      UNION ALL SELECT DISTINCT r, doc_id, lang, source, 'email', lower(e) FROM (SELECT *, unnest(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) AS e FROM d)),
s AS (SELECT lang, source, kind, value, count(*) AS docs, min(doc_id) AS first_doc FROM c GROUP BY ALL),
g AS (SELECT *, CASE WHEN kind = 'phone' THEN CASE WHEN NOT regexp_full_match(value, '\+1-\d{3}-\d{3}-\d{4}') THEN 'not ten digits' END
             WHEN NOT regexp_full_match(value, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}') THEN 'no address' END AS problem FROM s),
k AS (SELECT *, CASE WHEN problem IS NULL THEN row_number() OVER (PARTITION BY lang, source, kind, problem IS NULL ORDER BY docs DESC, value)::INTEGER END AS rank FROM g)
SELECT source, value, docs, first_doc, rank, problem, kind, lang FROM k WHERE rank IS NULL OR rank <= 100
"""

QUERIES = {f.__name__: f for f in (job1_link_frontier, job2_contact_directory)}
ORACLES = {"job1_link_frontier": _SQL1, "job2_contact_directory": _SQL2}
