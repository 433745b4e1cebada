"""Runnable jobs and the queries that run them over the given tables."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
