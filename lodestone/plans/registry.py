"""Queries by name with their SQL."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
