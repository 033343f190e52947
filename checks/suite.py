"""Importing this module registers every query."""

from checks import clean_queries, dedup_queries, profile_queries, publish_queries, text_queries  # noqa: F401
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
