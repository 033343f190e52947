"""Manifests and digests of source files."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.session import broadcast_if_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A file above the first size is read in pieces of the second.
WHOLE_BYTES, CHUNK_BYTES = 256 << 20, 8 << 20


def file_name(path: Column, levels: int = 1) -> Column:
    """The last ``levels`` parts of a path; files written to partition folders
    share their names, so two levels tell them apart."""
    return F.array_join(F.slice(F.split(path, "/"), -levels, levels), "/")


def _streamed_digest(path: str, chunk: int) -> str:
    """SHA-256 of a file that is read in pieces, inside a task."""
    # Spark names a file by a URI that is not escaped.
    scheme, place = path.split(":", 1)
    stream, inner = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{quote(place, safe='/:@')}")
    digest = hashlib.sha256()
    with stream.open_input_stream(inner) as file:
        while piece := file.read(chunk):
            digest.update(piece)
    return digest.hexdigest()


def file_digests(spark: SparkSession, paths: str | Sequence[str], levels: int = 1, whole: int = WHOLE_BYTES) -> DataFrame:
    """(file, bytes, sha256) of files of any size, in parallel over files.

    Files of up to ``whole`` bytes are single values that Spark's own reader
    delivers from any store it knows. Larger ones are only listed by it and then
    read in pieces by the task that has them: local files, HDFS, S3 and GCS."""
    files = spark.read.format("binaryFile").load(paths)
    name = file_name(F.col("path"), levels).alias("file")
    small = files.where(F.col("length") <= whole).select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_streamed_digest(path, CHUNK_BYTES) for path in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["file", "bytes", "sha256"])

    large = files.where(F.col("length") > whole).select(name, F.col("length").alias("bytes"), "path")
    return small.unionByName(large.mapInArrow(run, "file string, bytes long, sha256 string"))


def source_manifest(
    df: DataFrame, key: str, file: str, digests: DataFrame, *, level: str, extracted: str
) -> DataFrame:
    """Rows per key and file with the file's digest. Keys are counted
    map-side; the digests (one row per file) join the counts, not the rows."""
    counts = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key, file).agg(
        F.count(F.lit(1)).alias("rows"))
    side = broadcast_if_small(digests.select(F.col("file").alias("__file"), "sha256"))
    return counts.join(side, counts[file] == side["__file"], "left").select(
        F.col(key).alias("query_key"), F.lit(level).alias("level"), "rows",
        F.lit(extracted).alias("extracted"), F.col(file).alias("file"), "sha256",
    )
