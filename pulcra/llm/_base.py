"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import pulcra.llm
from pulcra.session import scratch_path

# Functions sent to tasks carry their code along: executors need only the
# packages they import, not this one.
cloudpickle.register_pickle_by_value(pulcra.llm)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The separators that str.split() and bytes.split() of ASCII text also use.
ASCII_SPACE = r"[\x20\x09-\x0D]"
# Copies of a small side that a hot key of the large side is dealt over.
SALTS = 16


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, its
    lineage cut, safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lowest(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash is among the lowest, a bound under which about
    four times ``wanted`` of ``total`` rows lie. Before a top-k by hash it
    changes nothing but what is sent: not k rows from each partition."""
    span = min(1 << 64, (4 * wanted << 64) // max(1, total))
    return hashed <= F.lit(span - (1 << 63) - 1).cast("long")


def salted(small: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every row of ``small`` once per salt, so that rows of one hot key meet
    it in ``salts`` tasks. The size estimate does not know of the copies, so the
    join is told not to broadcast them."""
    return small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")


def salt_of(*cols: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.hash(*cols), F.lit(salts))


def map_texts(df: DataFrame, fn: Callable, schema: str, rows: int = 64) -> DataFrame:
    """``fn(id, text bytes)`` of every row of ``df`` (an id and a text column),
    which yields output tuples. A few rows become one output batch, so memory
    is bounded by the longest texts rather than by Arrow's batch of rows."""

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = [row for i, text in zip(part.column(0).to_pylist(), part.column(1), strict=True)
                       for row in fn(i, text.as_py() or b"")]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col, f.type) for col, f in zip(zip(*out, strict=True), arrow, strict=True)],
                        schema=arrow)

    first, second = df.columns
    return df.select(first, F.col(second).cast("binary").alias(second)).mapInArrow(run, schema)

