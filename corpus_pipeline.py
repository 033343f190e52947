"""The corpus pipeline: documents to a training sequence, in five stages.

Each stage reads all rows its predecessor kept, as Parquet, and applies its
decisions: rejected rows are gone from what the next stage reads. All stages
but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulcra.llm import decontam, exact, mixing, quality, simhash
from pulcra.llm._base import stored, table
from pulcra.session import drop_scratch, scratch_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the byte network scores under its threshold."""
    return quality.good_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts."""
    return exact.unique_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of fingerprints, as op2 links them:
    four-word shingles, at most four differing bits."""
    return simhash.unique_rows(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: copies of documents by position."""
    return mixing.sequence(docs)


STAGES = [
    ("quality", quality_stage), ("exact", exact_stage), ("near", near_stage),
    ("benchmark", benchmark_stage), ("mixing", mixing_stage),
]

# The quality network and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's output is a table of its own, so what it was made
    from - the stage's own tables and its input - is deleted once it is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch_scope() as paths:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(spark, [*paths[:-1], *before])
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
