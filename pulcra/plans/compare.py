"""Clean a table and report its quality before and after."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulcra.operators.metrics import compare, correction_total, corrections, stage_metrics
from pulcra.plans.cleaning import Cleaned, clean
from pulcra.profile import Profile
from pulcra.session import written


def quality_before_after(
    raw: DataFrame, p: Profile, catalogue: DataFrame, cleaned: Cleaned | None = None
) -> DataFrame:
    """M11 for the raw and the cleaned table. The raw table is written once
    when it is itself a derivation; both stages then read columns."""
    cleaned = cleaned or clean(raw, p, catalogue)
    before, after = stage_metrics(raw, p, raw=True), stage_metrics(cleaned.data, p, raw=False, review=cleaned.review)
    report = corrections(raw, cleaned.audit, p)
    return compare(
        before.unionByName(correction_total(None, raw.sparkSession)),
        after.unionByName(correction_total(report, raw.sparkSession)),
    )


def corrections_report(raw: DataFrame, p: Profile, catalogue: DataFrame) -> DataFrame:
    """M9 straight from a fresh cleaning."""
    return corrections(raw, clean(raw, p, catalogue).audit, p)


def stored(raw: DataFrame) -> DataFrame:
    """Store a derived raw table before measuring it several times."""
    return written(raw, "raw")
