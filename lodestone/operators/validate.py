"""Validation of nested records by declared rules, compiled to one column of violations.

A rule names a path (``overview.contact.email``, ``tuition_breakdown[].cost``) and what must hold there.  Rules that share a
part of their path share its traversal: each list of a record is gone through once, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as c
from . import extract

VIOLATIONS = "array<struct<path:string,rule:string,value:string>>"


@dataclass(frozen=True)
class Rule:
    """What must hold at a path: ``required``, ``one_of`` some values, ``matches`` a pattern, ``between`` two bounds, ``most`` items.

    All but ``required`` hold for a null value, and nothing is asked below a null parent.
    """

    path: str
    kind: str
    arg: tuple | str | int | None = None

    def holds(self, x: Column) -> Column:
        if self.kind == "required":
            return x.isNotNull()
        test = {
            "one_of": lambda: x.isin(*self.arg), "matches": lambda: x.cast("string").rlike(self.arg),
            "between": lambda: x.between(*self.arg) & ~F.isnan(x.cast("double")), "most": lambda: F.size(x) <= self.arg,
        }[self.kind]()
        return x.isNull() | test


_LEVELS = ("high", "medium", "low")
RECORD = (
    Rule("overview.contact.email", "matches", extract.EMAIL_PATTERN), Rule("admission_deadlines[].deadline_type", "one_of", c.DEADLINE_TYPES),
    Rule("extraction_sources[].extraction_type", "required"), Rule("extraction_confidence[].extraction_type", "required"),
    Rule("extraction_confidence[].overall_confidence", "required"), Rule("extraction_confidence[].overall_confidence", "one_of", _LEVELS),
    Rule("extraction_confidence[].field_scores[].field_name", "required"), Rule("extraction_confidence[].field_scores[].confidence", "required"),
    Rule("extraction_confidence[].field_scores[].confidence", "one_of", _LEVELS), Rule("quality_report.issues[].severity", "required"),
    Rule("quality_report.issues[].category", "required"), Rule("quality_report.issues[].message", "required"),
)


@dataclass
class _Node:
    rules: list[Rule] = field(default_factory=list)
    fields: dict[str, _Node] = field(default_factory=dict)
    items: _Node | None = None


def _tree(rules: Iterable[Rule]) -> _Node:
    root = _Node()
    for r in rules:
        at = root
        for part in r.path.split("."):
            name = part.rstrip("[]")
            at = at.fields.setdefault(name, _Node())
            for _ in range(part.count("[]")):
                at.items = at.items or _Node()
                at = at.items
        at.rules.append(r)
    return root


def _visit(node: _Node, x: Column, path: Column) -> list[Column]:
    """Arrays of the violations at a value and below it."""
    out = [
        F.when(~r.holds(x), F.array(F.struct(path.alias("path"), F.lit(r.kind).alias("rule"), _text(x, r).alias("value")))).otherwise(F.lit(None).cast(VIOLATIONS))
        for r in node.rules
    ]
    below = [v for n, child in node.fields.items() for v in _visit(child, x[n], F.concat(path, F.lit(f".{n}")))]
    if below:
        out.append(F.when(x.isNotNull(), _joined(below)))
    if node.items:
        out.append(F.flatten(F.transform(x, lambda v, i: _joined(_visit(node.items, v, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))))
    return out


def _text(x: Column, r: Rule) -> Column:
    return F.size(x).cast("string") if r.kind == "most" else x.cast("string")


def _joined(parts: list[Column]) -> Column:
    return F.flatten(F.array_compact(F.array(*parts)))


def violations(rules: Iterable[Rule] = RECORD) -> Column:
    """All violations of a record, array<struct<path, rule, value>>: in the order of columns, then of items."""
    tree = _tree(rules)
    none = F.array().cast(VIOLATIONS)
    parts = [v for n, child in tree.fields.items() for v in _visit(child, F.col(n), F.lit(n))]
    return F.coalesce(_joined(parts), none) if parts else none


def quarantine(records: DataFrame, key: str = "seed", rules: Iterable[Rule] = RECORD) -> DataFrame:
    """(key, path, rule, value): a row for each violation.  A null list has no items; repeated records give repeated rows."""
    return records.select(key, F.explode(violations(rules)).alias("v")).select(key, "v.*")


def known(rules: Iterable[Rule], records: DataFrame) -> list[Rule]:
    """The rules whose column the records have."""
    return [r for r in rules if r.path.split(".")[0].rstrip("[]") in records.columns]
