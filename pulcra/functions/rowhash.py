"""Row digests: one fixed-width key standing for a whole row.

Grouping wide rows by their digest shuffles 32 bytes per group instead of the
row, and lets the map side collapse copies before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_text(columns: Sequence[str | Column]) -> Column:
    """An injective text form of a row: each value as ``length:value``, NULL
    as ``~``, so neither separators nor empty strings can collide."""

    def field(c: str | Column) -> Column:
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("~"))

    return F.concat(*[field(c) for c in columns])


def row_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of the row text, as 32 binary bytes."""
    return F.unhex(F.sha2(row_text(columns), 256))


def digest_number(columns: Sequence[str | Column]) -> Column:
    """The first 60 bits of the row's SHA-256 as a non-negative bigint."""
    return F.conv(F.substring(F.sha2(row_text(columns), 256), 1, 15), 16, 10).cast("bigint")
