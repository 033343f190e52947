"""Where intermediate tables go, and when a side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the
    session. Only a local-mode session without the setting gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="pulcra-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one written table."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The paths of all tables written inside, for :func:`drop_scratch` once
    nothing reads them any more."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        # By identity: two scopes may hold the same paths.
        _SCOPES[:] = [s for s in _SCOPES if s is not paths]


def drop_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written tables. Only paths in the shared folder are touched."""
    root = shared_dir(spark) + "/"
    for path in paths:
        if path.startswith(root) and path != root:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Spark then deletes the shuffle files of a write when it has ended, which it
# else does once the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives the loss of executors, and is computed once for many readers. What
    was shuffled for it is deleted, so steps do not add up on the disks."""
    path = scratch_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame) -> bool:
    """Measure a lookup side: one short job that stops at the row bound."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
                 for f in df.schema.fields), F.lit(16))
    rows, size = (
        df.select(width.alias("w")).limit(BROADCAST_ROWS + 1)
        .agg(F.count("w"), F.coalesce(F.sum("w"), F.lit(0))).first()
    )
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after measuring the side; a larger side is left
    to a shuffled join, which adaptive execution splits when keys are hot."""
    return F.broadcast(df) if is_small(df) else df


def looked_up(df: DataFrame) -> DataFrame:
    """A written lookup side: broadcast if it was measured to be small, else for
    a merge join. Without a hint Spark plans by the size of the compressed file
    and may send a table many times that size through the driver."""
    return F.broadcast(df) if is_small(df) else df.hint("merge")


# Tasks that the rows of one frequent key are dealt over.
SALTS = 16


def joined_to_unique(rows: DataFrame, unique: DataFrame, key: str, spread: str | Column, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``unique`` (one row per ``key``). A small ``unique`` is
    broadcast; a larger one is repeated per salt, and rows are salted by
    ``spread``, which differs between them, so a key that a third of all rows share is met in SALTS
    tasks."""
    if is_small(unique):
        return rows.join(F.broadcast(unique), key, how)
    salted = unique.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS))).join(salted, [key, "_salt"], how).drop("_salt")
