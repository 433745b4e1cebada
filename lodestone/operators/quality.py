"""Checks of records: missing fields, duplicates, implausible values, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as c
from ..functions.text import col

_ISSUE = "array<struct<severity:string,category:string,message:string,field:string>>"
OVERVIEW = (
    ("university_name", "overview.university_name", True), ("city", "overview.location.city", False), ("state", "overview.location.state", False),
    ("country", "overview.location.country", False), ("postal_code", "overview.location.postal_code", False),
    ("phone", "overview.contact.phone", False), ("email", "overview.contact.email", False),
)
LISTS = ("tuition_breakdown", "admission_deadlines", "page_metadata")


def repeats(df: DataFrame, keys: list[str], order: list[str]) -> Column:
    """Whether an earlier row has the same keys; null keys equal each other."""
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order)) > 1


def cost_issue(cost, low: int = c.COST_RANGE[0], high: int = c.COST_RANGE[1]) -> Column:
    return F.when(col(cost) < low, "low").when(col(cost) > high, "high")


def date_issue(x, low: int = c.YEAR_RANGE[0], high: int = c.YEAR_RANGE[1]) -> Column:
    x = col(x)
    year = F.year(F.try_to_date(x, "yyyy-MM-dd"))
    iso = x.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return (
        F.when(x.isNull() | (x == ""), None).when(~iso, "format").when(year.isNull() | (year == 0), "invalid")
        .when(year < low, "past").when(year > high, "future")
    )


def _issue(severity, category, message, field) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(severity).alias("severity"), lit(category).alias("category"), lit(message).alias("message"), lit(field).alias("field"))


def _shown(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("None"))


def _missing(name: str, required: bool) -> Column:
    kind, severity = ("Required", "error") if required else ("Optional", "warning")
    return _issue(severity, "missing_field", f"{kind} field '{name}' is missing/null", name)


def _when(ok: Column, issue: Column) -> Column:
    none = F.array().cast(_ISSUE)
    return F.when(ok, F.array(issue)).otherwise(none)


def _again(items: Column, *keys: str) -> Column:
    """For each item whether an earlier one has the same keys (nulls equal each other), by sorting, not by looking back."""
    key = lambda x: F.struct(*[x[k].alias(k) for k in keys])
    placed = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"))))
    marked = lambda s: F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), ((j > 0) & x["k"].eqNullSafe(F.get(s, j - 1)["k"])).alias("again")))
    return F.transform(F.sort_array(F.get(F.transform(F.array(placed), marked), F.lit(0))), lambda x: x["again"])


def issues(costs=c.COST_RANGE, years=c.YEAR_RANGE) -> Column:
    """All issues of a record in the order of the checks."""
    present = lambda p: F.col(p).isNotNull() & (F.col(p) != "")
    whole = F.array(_issue("error", "missing_field", "Entire overview section is missing", "overview"))
    parts = F.concat(*[_when(~F.coalesce(present(p), F.lit(False)), _missing(n, r)) for n, p, r in OVERVIEW])
    overview = F.when(F.col("overview").isNull(), whole).otherwise(parts)
    lists = {n: _when(F.coalesce(F.size(n), F.lit(0)) < 1, _missing(n, False)) for n in LISTS}
    tuition, due = F.col("tuition_breakdown"), F.col("admission_deadlines")

    def fee(t, again):
        name, cost = _shown(t["fee_type"]), _shown(t["cost"])
        say = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
        return F.concat(
            _when(again, _issue("warning", "duplicate", say("Duplicate tuition entry: '", name, "' = $", cost), "tuition_breakdown")),
            _when(F.coalesce(t["cost"] < costs[0], F.lit(False)), _issue("warning", "cost_sanity", say("Suspiciously low cost: '", name, "' = $", cost, f" (< ${costs[0]})"), "tuition_breakdown")),
            _when(F.coalesce(t["cost"] > costs[1], F.lit(False)), _issue("warning", "cost_sanity", say("Suspiciously high cost: '", name, "' = $", cost, f" (> ${costs[1]:,})"), "tuition_breakdown")),
        )

    def deadline(d, again):
        kind, day = _shown(d["deadline_type"]), _shown(d["deadline_date"])
        what = date_issue(d["deadline_date"], *years)
        year = F.year(F.try_to_date(d["deadline_date"], "yyyy-MM-dd")).cast("string")
        message = (
            F.when(what == "past", F.concat(F.lit("Deadline date in the past: "), kind, F.lit(" = "), day, F.lit(" (year "), year, F.lit(f" < {years[0]})")))
            .when(what == "future", F.concat(F.lit("Deadline date too far in future: "), kind, F.lit(" = "), day, F.lit(" (year "), year, F.lit(f" > {years[1]})")))
            .when(what == "invalid", F.concat(F.lit("Invalid date format for "), kind, F.lit(": "), day))
            .otherwise(F.concat(F.lit("Date not in YYYY-MM-DD format for "), kind, F.lit(": "), day))
        )
        return F.concat(
            _when(again, _issue("warning", "duplicate", F.concat(F.lit("Duplicate deadline: "), kind, F.lit(" on "), day), "admission_deadlines")),
            _when(what.isNotNull(), _issue(F.when(what == "invalid", "error").otherwise("warning"), "date_sanity", message, "admission_deadlines")),
        )

    none = F.array().cast(_ISSUE)
    each = lambda items, f, *keys: F.coalesce(F.flatten(F.zip_with(items, _again(items, *keys), f)), none)
    return F.concat(
        overview, lists["tuition_breakdown"], each(tuition, fee, "fee_type", "cost"),
        lists["admission_deadlines"], each(due, deadline, "deadline_type", "deadline_date"), lists["page_metadata"])


def report(records: DataFrame, costs=c.COST_RANGE, years=c.YEAR_RANGE) -> DataFrame:
    """Adds ``quality_report`` to records (overview, tuition_breakdown, admission_deadlines, page_metadata)."""
    got = [F.coalesce((F.col(p).isNotNull() & (F.col(p) != "")).cast("int"), F.lit(0)) for _, p, _ in OVERVIEW]
    got += [F.coalesce((F.size(n) > 0).cast("int"), F.lit(0)) for n in LISTS]
    total, populated = len(got), sum(got[1:], got[0])
    dup = lambda field: F.size(F.filter("_issues", lambda x: (x["category"] == "duplicate") & (x["field"] == field)))
    return records.withColumn("_issues", issues(costs, years)).withColumn("quality_report", F.struct(
        F.lit(total).alias("total_fields_expected"), populated.alias("total_fields_populated"),
        F.round(populated / total, 3).alias("completeness_score"), F.col("_issues").alias("issues"),
        dup("tuition_breakdown").alias("duplicate_tuition_count"), dup("admission_deadlines").alias("duplicate_deadline_count"))).drop("_issues")


def severities(records: DataFrame) -> DataFrame:
    n = lambda s: F.size(F.filter("quality_report.issues", lambda x: x["severity"] == s))
    return records.withColumns({"errors": n("error"), "warnings": n("warning")})
