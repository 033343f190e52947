"""Repeated keys over micro-batches (V7, D1 on a stream).

Each key has a state: how often it was seen, and the smallest row id of the
batch it came in first. The state lives in the query's checkpoint, so a
restarted query goes on where it stopped, and it is dropped once the watermark
has passed the key's last row by ``keep``: a key that comes again later counts
as new. Rows are reduced to key, row id and time before they are shuffled, and
one line per key and batch comes out, however often a key repeats in it.

Nearly all keys come once, and a call of Python with its state costs far more
than the few rows of a key. So keys are dealt over ``buckets`` by their hash and
a bucket is one group: the calls of a batch are bounded, the work in them is a
dictionary of the bucket's keys. A batch writes the buckets it touches as a
whole; where small batches meet very many live keys, give more buckets.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulcra.functions.rowhash import row_digest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REPORT = "key string, first_row_id long, seen_before long, seen_now long"
BUCKETS = 4096
NO_ID = 2**63 - 1  # rows without an id: after all ids


def repeated_keys(
    stream: DataFrame, key: Column, row_id: str, at: str, *, late: str = "1 hour", keep_ms: int = 86_400_000, buckets: int = BUCKETS
) -> DataFrame:
    """Keys that were seen before, or more than once in the batch: (key,
    first_row_id, seen_before, seen_now). ``at`` is the rows' time, ``late`` how
    far it may lag behind. NULL keys are no keys. Use output mode ``update``.
    ``buckets`` must stay as it is for the life of a checkpoint."""
    rows = stream.withWatermark(at, late).select(
        key.cast("string").alias("key"), F.coalesce(F.col(row_id).cast("long"), F.lit(NO_ID)).alias("row_id"), F.col(at).alias("at"),
        F.coalesce(F.unix_millis(F.col(at)), F.lit(0)).alias("ms"),
    ).where("key IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def update(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark, now, found = state.getCurrentWatermarkMs(), {}, []
        known = {k: (first, seen, until) for k, first, seen, until in zip(*state.get)} if state.exists else {}
        for batch in () if state.hasTimedOut else batches:
            for k, i, ms in zip(batch["key"].tolist(), batch["row_id"].tolist(), batch["ms"].tolist()):
                rows, least, last = now.get(k, (0, i, ms))
                now[k] = rows + 1, min(least, i), max(last, ms)
        for k, (rows, least, last) in now.items():
            first, before, _ = known.get(k, (least, 0, 0))
            known[k] = first, before + rows, max(last, watermark) + keep_ms
            if before + rows > 1:
                found.append((k, None if first == NO_ID else first, before, rows))
        live = [(k, *v) for k, v in known.items() if v[2] >= watermark]
        if live:
            columns = tuple(map(list, zip(*live)))
            state.update(columns)
            state.setTimeoutTimestamp(min(columns[3]))
        else:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=["key", "first_row_id", "seen_before", "seen_now"], dtype=object)

    return rows.groupBy("bucket").applyInPandasWithState(
        update, REPORT, "keys array<string>, first array<long>, seen array<long>, until array<long>", "update",
        GroupStateTimeout.EventTimeTimeout)


def repeated_codes(stream: DataFrame, code: str, row_id: str, at: str, **options) -> DataFrame:
    """V7: codes held by more than one row of the stream."""
    return repeated_keys(stream, F.col(code), row_id, at, **options)


def repeated_rows(stream: DataFrame, columns: list[str], row_id: str, at: str, **options) -> DataFrame:
    """Rows that are identical in ``columns``, by their digest."""
    return repeated_keys(stream, F.lower(F.hex(row_digest(columns))), row_id, at, **options)
