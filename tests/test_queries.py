"""Every query against its SQL in DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.plans import queries
from lodestone.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, SF)
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)
    assert got == want
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_work_is_spread(spark):
    """A table of one file is not one task's work: its rows are dealt before pages or answers are made of them, nothing is cached."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        made = QUERIES["markdown_plain"](spark, SF).select(F.spark_partition_id().alias("p"), "markdown")
        assert made.select("p").distinct().count() > 1
        assert queries._responses(spark, SF).select(F.spark_partition_id().alias("p"), "response_json").select("p").distinct().count() > 1
        for name in ("field_confidence", "item_values", "overview_values", "extraction_meta"):
            assert "InMemoryRelation" not in QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["nav_links", "page_link_categories", "page_link_scores", "html_markdown"])
def test_pages_go_to_python_in_small_batches(spark, name):
    """What a worker holds of pages is bounded by a hundred of them, whatever the rows of its task."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
