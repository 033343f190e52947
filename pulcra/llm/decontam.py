"""Benchmark decontamination: SimHash of item-sized windows.

Texts are lower-cased words (letters and digits), five-word shingles, hashed
with XXH64. For an item of n shingles every window of n shingles of a document
(the whole document if it is shorter) has a SimHash fingerprint. Fingerprints
are looked up in a multi-index per item size: eight blocks of eight bits. Of a
pair within RADIUS = 23 bits at least one block differs by two bits at most, and
each item stands in the 37 buckets of such values per block, so eight lookups
find every item inside the radius. Candidates then get their exact similarity:
weighted Jaccard, shingles weighted by their number of occurrences, 0.8 or more.
Similarity 0.8 flips 9.7 of 64 bits on average with a deviation of 2.9, so the
radius is over four deviations away. An item of one to four words is one shingle
of its own length; windows of as many words are looked up by their hash.

A window of L shingles can only be similar to an item of n if 4 (n + L) / 9 of
its shingles are among those of the items of this size. Other windows are left
out before any fingerprint is computed, which loses nothing and makes the cost
that of one pass over the words. Windows are counted by prefix sums and looked
up in blocks, so memory does not grow with the text.

The index is built from the different texts of the benchmark, in blocks of about
BLOCK_BYTES of text. One block at a time is collected, indexed and handed to
Spark's broadcast store. Documents are read once: a task takes some megabytes of
them and holds one block after the other against them. Matches name a text and
join the benchmark's rows; documents never move.

Defined cases: null or empty texts, and items without a word, match nothing; an
item that occurs twice in the benchmark is reported per row; null ids are
reported as null; repeated documents are reported as often as they stand; empty
tables match nothing. The best window (highest similarity, then first) is
reported for each item. Other columns are carried unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulcra.llm._base import query, stored, table
from pulcra.llm.simhash import SEED
from pulcra.session import broadcast_if_small

WORDS, SIMILARITY, RADIUS, BLOCKS, FLIPS = 5, 0.8, 23, 8, 2
BLOCK_BYTES, WINDOW_BLOCK, PROBE_CELLS, BATCH_BYTES = 16 << 20, 4096, 1 << 22, 16 << 20
_WORD = re.compile(r"[^\W_]+")
MATCH = "item string, start_word long, words long, hamming int, similarity double"


def hashes(text: str, size: int = WORDS, short: bool = True) -> np.ndarray:
    """XXH64 of the shingles of ``size`` words, in order; a text of fewer words
    is one shingle, or none unless ``short``."""
    import xxhash

    words = _WORD.findall(text.lower())
    if not words or (not short and len(words) < size):
        return np.zeros(0, np.uint64)
    joined = " ".join(words).encode()
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    last = ends[size - 1:] if len(words) >= size else ends[-1:]
    slices = map(joined.__getitem__, map(slice, starts[:n].tolist(), last.tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def window_prints(h: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles at ``starts`` (sorted)."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = int(np.searchsorted(starts, low + WINDOW_BLOCK))
        sums = np.zeros((min(len(h), starts[to - 1] + size) - low + 1, 64), np.int32)
        np.cumsum(_bits(h[low:low + len(sums) - 1]), axis=0, out=sums[1:])
        here = starts[at:to] - low
        counts = sums[np.minimum(here + size, len(sums) - 1)] - sums[here]
        width = np.minimum(size, len(h) - starts[at:to])[:, None]
        out[at:to] = np.packbits(2 * counts > width, axis=1, bitorder="little").view(np.uint64).ravel()
        at = to
    return out


def window_starts(hits: np.ndarray, size: int, n: int) -> np.ndarray:
    """Starts of the windows of ``size`` out of ``n`` shingles that hold enough
    hits to be similar to anything."""
    last, length = max(0, n - size), min(size, n)
    edge = np.zeros(last + 2, np.int32)
    np.add.at(edge, np.maximum(hits - size + 1, 0), 1)
    np.add.at(edge, np.minimum(hits, last) + 1, -1)
    return np.flatnonzero(9 * np.cumsum(edge[:-1]) >= 4 * (size + length))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two shingle sequences, weights being occurrences."""
    keys, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    x = np.bincount(where[:len(a)], minlength=len(keys))
    y = np.bincount(where[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class SizeIndex:
    """Fingerprints of the items of one size: a multi-index over their bytes.
    A bucket (byte, value) lists the items that have this value there, give or
    take FLIPS bits."""

    def __init__(self, members: np.ndarray, prints: np.ndarray):
        self.members, self.prints = members, prints
        flips = np.flatnonzero(np.bitwise_count(np.arange(256)) <= FLIPS).astype(np.uint8)
        values = prints.view(np.uint8).reshape(-1, BLOCKS)[:, :, None] ^ flips
        self.bounds, self.buckets = np.zeros((BLOCKS, 257), np.int64), []
        for b in range(BLOCKS):
            flat = values[:, b].ravel()
            self.buckets.append((np.argsort(flat, kind="stable") // len(flips)).astype(np.int32))
            self.bounds[b, 1:] = np.cumsum(np.bincount(flat, minlength=256))

    def near(self, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, bits apart) of all pairs within RADIUS."""
        found, step = set(), max(1, PROBE_CELLS // len(self.prints))
        for first in range(0, len(prints), step):
            part = prints[first:first + step]
            octets = part.view(np.uint8).reshape(-1, BLOCKS)
            for b in range(BLOCKS):
                low = self.bounds[b, octets[:, b]]
                n = self.bounds[b, octets[:, b].astype(np.int64) + 1] - low
                window = np.repeat(np.arange(len(part)), n)
                item = self.buckets[b][np.arange(len(window)) + np.repeat(low - np.cumsum(n) + n, n)]
                apart = np.bitwise_count(part[window] ^ self.prints[item])
                close = apart <= RADIUS
                found.update(zip((window[close] + first).tolist(), self.members[item[close]].tolist(), apart[close].tolist(), strict=True))
        return sorted(found)


class Index:
    """Shingles and fingerprints of a block of benchmark items, given as (name,
    text)."""

    def __init__(self, items: list[tuple]):
        self.short: dict[int, dict[int, list[int]]] = {}
        self.items = []
        for name, text in items:
            words = len(_WORD.findall((text or "").lower()))
            if words:
                h = hashes(text)
                if words < WORDS:
                    self.short.setdefault(words, {}).setdefault(int(h[0]), []).append(len(self.items))
                self.items.append((name, h, words))
        long = [k for k, (*_, words) in enumerate(self.items) if words >= WORDS]
        sizes = np.array([len(self.items[k][1]) for k in long], np.int64)
        # Each shingle once per size of the items that hold it.
        pairs = np.zeros(int(sizes.sum()), [("key", np.uint64), ("size", np.int64)])
        if long:
            pairs["key"], pairs["size"] = np.concatenate([self.items[k][1] for k in long]), np.repeat(sizes, sizes)
        pairs = np.unique(pairs)
        self.keys, self.sizes, self.groups = pairs["key"].copy(), pairs["size"].copy(), {}
        for size in np.unique(sizes).tolist():
            members = np.array(long, np.int64)[sizes == size]
            prints = [window_prints(self.items[k][1], np.zeros(1, np.int64), size)[0] for k in members]
            self.groups[size] = SizeIndex(members, np.array(prints, np.uint64))

    def matches(self, text: str) -> list[tuple]:
        """(name, first word, words, bits apart, similarity) of the items in a text."""
        if not self.items or not text:
            return []
        best: dict[int, tuple] = {}
        for size, known in self.short.items():
            for p, h in enumerate(hashes(text, size, short=False).tolist()):
                for k in known.get(h, ()):
                    best.setdefault(k, (p, size, 0, 1.0))
        h = hashes(text, short=False)
        low, high = np.searchsorted(self.keys, h), np.searchsorted(self.keys, h, side="right")
        hits: dict[int, list[int]] = {}
        for p in np.flatnonzero(low < high).tolist():
            for size in self.sizes[low[p]:high[p]].tolist():
                hits.setdefault(size, []).append(p)
        for size, where in hits.items():
            starts = window_starts(np.array(where, np.int64), size, len(h))
            for w, k, bits in self.groups[size].near(window_prints(h, starts, size)):
                window = h[starts[w]:starts[w] + size]
                score = similarity(window, self.items[k][1])
                if score >= SIMILARITY and (k not in best or score > best[k][3]):
                    best[k] = (int(starts[w]), len(window) + WORDS - 1, bits, score)
        return [(self.items[k][0], *best[k]) for k in sorted(best)]


def named_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id and item, which names a text, of all rows."""
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.md5(F.col(text_col)).alias("item"), F.col(text_col).alias("_text"))


def index_blocks(items: DataFrame) -> list:
    """Broadcasts of the indexes over blocks of the different texts, each of
    about BLOCK_BYTES; the driver holds one block while it is made."""
    texts = items.filter(F.length("_text") > 0).groupBy("item").agg(F.min("_text").alias("_text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("_text") + 16), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    context = items.sparkSession.sparkContext
    return [context.broadcast(Index([tuple(r) for r in texts.filter(block == b).orderBy("item").collect()])) for b in range(blocks)]


def held_against(blocks: list, texts: list[str]) -> list[list[tuple]]:
    """Matches of each text, one block of the index at a time."""
    found: list[list[tuple]] = [[] for _ in texts]
    for block in blocks:
        index = block.value
        for k, text in enumerate(texts):
            found[k] += index.matches(text)
        if len(blocks) > 1:
            block.__dict__.pop("_value", None)  # read again from the store when it is next needed
    return found


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows of about BATCH_BYTES of text, with their texts."""
    for batch in batches:
        rows = max(1, min(batch.num_rows, BATCH_BYTES * batch.num_rows // max(1, batch.column(column).nbytes)))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it."""
    items = stored(named_items(benchmark), "items")
    blocks = index_blocks(items)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    types = to_arrow_schema(StructType.fromDDL(MATCH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _parts(batches, 1):
            found = held_against(blocks, texts)
            take = pa.array([k for k, ms in enumerate(found) for _ in ms], pa.int64())
            columns = list(zip(*[m for ms in found for m in ms], strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), *[pa.array(c, f.type) for c, f in zip(columns, types, strict=True)]], names=["_id", *types.names])

    matches = rows.mapInArrow(run, f"_id {kind}, {MATCH}")
    return matches.join(broadcast_if_small(items.select("item_id", "item")), "item").select(
        F.col("_id").alias(id_col), "item_id", "start_word", "words", "hamming", "similarity")


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found."""
    blocks = index_blocks(stored(named_items(benchmark), "items"))

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not ms for ms in held_against(blocks, [t or "" for t in texts])])

    return docs.filter(clean(F.col(text_col)))


@query("op4_decontamination")
def op4(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
