"""Column helpers whose results equal those of Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def squeeze(x) -> Column:
    """Stripped, with runs of white space as one space."""
    return F.regexp_replace(strip(x), r"(?U)\s+", " ")


def filled(x) -> Column:
    """Null for empty text."""
    return F.when(col(x) != "", col(x))
