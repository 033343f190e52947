"""Cleaning on a stream.

The source this library serves is a fixed snapshot, so there is no streaming
operator of its own. Steps C1-C9 are row-level with static lookups, and
therefore take a streaming DataFrame unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulcra.plans.cleaning import clean_stages, cleaned_rows
from pulcra.profile import Profile


def clean_stream(rows: DataFrame, p: Profile, catalogue: DataFrame) -> DataFrame:
    """Cleaned rows of a streaming (or static) table, without log and review."""
    wide, _ = clean_stages(rows, p, catalogue)
    return cleaned_rows(wide, p)
