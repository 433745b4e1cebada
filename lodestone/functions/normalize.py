"""Scalar normalizers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as c
from .text import col, filled, squeeze, strip


def phone(x) -> Column:
    """+1-AAA-BBB-CCCC where ten digits are left after the country code; else unchanged."""
    x = filled(x)
    d = F.regexp_replace(x, "[^0-9+]", "")
    d = F.when(d.startswith("+1"), F.substr(d, F.lit(3))).when(d.startswith("1") & (F.length(d) == 11), F.substr(d, F.lit(2))).otherwise(d)
    return F.when(F.length(d) == 10, F.regexp_replace(d, "^(.{3})(.{3})(.{4})$", "+1-$1-$2-$3")).otherwise(x)


def email(x) -> Column:
    return strip(F.lower(filled(x)))


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def state(x) -> Column:
    """Two-letter code of a code or name; else stripped."""
    s = strip(filled(x))
    return F.when(F.upper(s).isin(*c.STATES.values()), F.upper(s)).otherwise(F.coalesce(_lookup(F.lower(s), c.STATES), s))


def country(x) -> Column:
    s = strip(filled(x))
    return F.when(F.lower(s).isin(*c.US_NAMES), "United States").otherwise(s)


def postal(x) -> Column:
    s = strip(filled(x))
    kept = F.regexp_replace(s, "[^0-9-]", "")
    d = F.replace(kept, F.lit("-"), F.lit(""))
    return (
        F.when(kept.rlike(r"^\d{5}(-\d{4})?$"), kept).when(F.length(d) == 5, d)
        .when(F.length(d) == 9, F.regexp_replace(d, "^(.{5})(.{4})$", "$1-$2")).otherwise(s)
    )


def cost_number(x) -> Column:
    """Whole dollars of a double, half to even; null below zero and for what is not finite."""
    return F.when((col(x) >= 0) & (col(x) < 9.2e18), F.bround(col(x), 0).cast("bigint"))


def cost_text(x) -> Column:
    """Whole dollars of a text, cut off; null where it is no number of dollars."""
    s = strip(F.regexp_replace(col(x), "[$, ]", ""))
    ok = s.rlike(r"^[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    v = F.when(ok, F.replace(s, F.lit("_"), F.lit(""))).try_cast("double")
    return F.when((v >= 0) & (v < 9.2e18), v.cast("bigint"))


def currency(x, cost) -> Column:
    """The code in upper case; dollars for a cost above zero; else null."""
    return F.when(col(x) != "", strip(F.upper(col(x)))).when(col(cost) > 0, "USD")


_WITH_YEAR = ("MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy", "M/d/yyyy", "M-d-yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy/M/d")
_NO_YEAR = ("MMMM d yyyy", "MMM d yyyy", "MMM. d yyyy", "M/d yyyy")


def date(x, as_of=None) -> Column:
    """yyyy-MM-dd of the usual ways to write a date; without a year, the next one from ``as_of`` on; else stripped."""
    today = F.current_date() if as_of is None else col(as_of)
    s = strip(filled(x))
    one = F.regexp_replace(s, r"\s+", " ")
    full = F.coalesce(*[F.try_to_timestamp(one, F.lit(f)) for f in _WITH_YEAR])
    bare = F.concat(F.regexp_replace(one, r"(\d+)(st|nd|rd|th)", "$1"), F.lit(" 1900"))
    part = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in _NO_YEAR])
    this = F.make_date(F.year(today), F.month(part), F.dayofmonth(part))
    year = F.year(today) + F.when(this < today, 1).otherwise(0)
    text = F.format_string("%04d-%02d-%02d", year, F.month(part), F.dayofmonth(part))
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s).when(full.isNotNull(), F.date_format(full, "yyyy-MM-dd")).when(part.isNotNull(), text).otherwise(s)


def fee_type(x) -> Column:
    return squeeze(filled(x))


university_name = fee_type


def record(df, as_of=None):
    """All normalizers over the nested columns of a record (overview, tuition_breakdown, admission_deadlines)."""
    o = F.col("overview")
    location = F.when(o["location"].isNotNull(), F.struct(
        F.col("overview.location.city").alias("city"), state(o["location"]["state"]).alias("state"),
        country(o["location"]["country"]).alias("country"), postal(o["location"]["postal_code"]).alias("postal_code")))
    contact = F.when(o["contact"].isNotNull(), F.struct(phone(o["contact"]["phone"]).alias("phone"), email(o["contact"]["email"]).alias("email")))
    overview = F.when(o.isNotNull(), F.struct(
        university_name(o["university_name"]).alias("university_name"), location.alias("location"), contact.alias("contact")))

    def item(t):
        cost = F.when(t["cost"] >= 0, t["cost"])
        return F.struct(fee_type(t["fee_type"]).alias("fee_type"), cost.alias("cost"), currency(t["currency"], cost).alias("currency"))

    due = lambda d: F.struct(d["deadline_type"].alias("deadline_type"), date(d["deadline_date"], as_of).alias("deadline_date"), d["notes"].alias("notes"))
    return df.withColumns({
        "overview": overview, "tuition_breakdown": F.transform("tuition_breakdown", item),
        "admission_deadlines": F.transform("admission_deadlines", due)})
