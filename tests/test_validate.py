"""Rules on nested records, and what the job does with records that break them."""

import json

from pyspark.sql import functions as F

from lodestone.operators import extract, fetch, validate
from lodestone.plans import etl

R = validate.Rule
SCHEMA = "seed string, o struct<name:string,at:struct<x:double>>, items array<struct<n:int,tags:array<struct<t:string>>>>, grid array<array<int>>"


def test_rules(spark):
    rules = [R("o", "required"), R("o.name", "matches", "^[a-z]+$"), R("o.at.x", "between", (0, 1)), R("items[].n", "required"), R("items[].n", "one_of", (1, 2)), R("items", "most", 2),
             R("items[].tags[].t", "required"), R("grid[][]", "between", (0, 9))]
    rows = [
        ("good", ("a", (0.5,)), [(1, [("t",)])], [[1], [2, 3]]), ("empty", (None, None), [], []), ("nulls", None, None, None),
        ("bad", ("A", (1.5,)), [(3, [("t",), (None,)]), (None, None), (2, [])], [[1, 10], None, [-1]]), ("nan", ("a", (float("nan"),)), [None], [None]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in validate.quarantine(df, rules=rules).collect():
        got.setdefault(r.seed, []).append((r.path, r.rule, r.value))
    assert set(got) == {"nulls", "bad", "nan"} and got["nulls"] == [("o", "required", None)]
    assert sorted(got["bad"], key=repr) == sorted([
        ("o.name", "matches", "A"), ("o.at.x", "between", "1.5"), ("items", "most", "3"), ("items[0].n", "one_of", "3"), ("items[0].tags[1].t", "required", None),
        ("items[1].n", "required", None), ("grid[0][1]", "between", "10"), ("grid[2][0]", "between", "-1")], key=repr)
    assert got["nan"] == [("o.at.x", "between", "NaN")]
    assert validate.quarantine(df.limit(0), rules=rules).count() == 0 and validate.quarantine(df, rules=[]).count() == 0


def test_one_traversal(spark):
    """Rules on one list share its transform."""
    df = spark.createDataFrame([], SCHEMA)
    rules = [R("items[].n", "required"), R("items[].n", "one_of", (1, 2)), R("items[].tags", "most", 3)]
    plan = df.select(validate.violations(rules).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("transform(items") == 1


def test_invalid_records_of_the_job(spark):
    """A record with a deadline's field score of an unknown level fails; the others do not."""
    body = "<p>" + "words of the page. " * 20 + "</p>"
    pages = spark.createDataFrame([(u, u, 200, "text/html", body, None, 5, 0) for u in ("https://www.x.edu/", "https://www.y.edu/")], fetch.FETCHED)
    reply = lambda level: json.dumps({"university_name": "U", "university_name_confidence": level})
    answers = spark.createDataFrame([("https://www.x.edu/", "overview", reply("certain"), "m", None), ("https://www.y.edu/", "overview", reply("high"), "m", None)], "seed string, extraction_type string, response_json string, model string, error string")
    none = spark.createDataFrame([], "seed string, status int, body string")
    job = etl.Job(fetch.Table(pages), extract.Replay(answers), none, none.withColumnRenamed("seed", "url"), "2026-01-16", "t")
    out = {r.raw: r for r in etl.run(job, spark.createDataFrame([("x.edu",), ("y.edu",)], "raw string")).collect()}
    assert out["x.edu"].error == "invalid record" and out["x.edu"].overview is None and out["x.edu"].quality_report is None
    assert out["y.edu"].error is None and out["y.edu"].overview.university_name == "U"
    bad = job.bad.where(F.col("rule") == "one_of").collect()
    assert [(r.seed, r.path, r.value) for r in bad] == [("https://www.x.edu/", "extraction_confidence[0].field_scores[0].confidence", "certain")]
