"""Imports every query module, which fills the registry."""

from trendloom.plans import cluster_queries, history_queries, io_queries, more_queries, palette_queries, text_queries, weekly_queries  # noqa: F401
from trendloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
