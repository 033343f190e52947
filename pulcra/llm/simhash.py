"""Near-duplicates by SimHash, found through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their
bit counts (0, 1, 2) is its embedding. The Manhattan distance of two embeddings
never exceeds the Hamming distance of the fingerprints, so a range join within
the radius on the embedding finds every link, and the exact Hamming distance
then decides.

The grid: the 32 coordinates form 8 bands. A Manhattan distance of at most 4
leaves at least 4 bands without any difference, so the pair shares a cell of at
least one of the 70 grids that four bands span. Cells are joined as equal keys;
the join condition holds the distance bound, the exact distance, and the rule
that only the first shared grid reports the pair, so nothing but verified links
leaves the join.

Counts are written in thermometer code (00, 01, 11): the Manhattan distance is
the bit count of an exclusive or, and all of it stays in generated code.

Equal fingerprints are one class and enter the join once, so a group of copies
costs one row. Defined cases: null and empty texts have fingerprint zero and
link like any other; a null id takes the component of its fingerprint (null if
no id shares it); repeated rows give repeated rows; an empty table an empty
result. Only id and text columns are read.

``unique_rows`` keeps one document of each component: the one with the smallest
id (rows without an id come last), of several texts under that id the one with
the smallest digest. Rows that repeat id and text are one document and stay or
go together.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import map_texts, query, salt_of, salted, stored, table
from pulcra.llm.components import components

RADIUS, BANDS, WORDS, SEED = 4, 8, 4, 42
BLOCK = 1 << 16

_OFFSETS = np.arange(8, dtype=np.int64) * 256
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(words: list[bytes], size: int, seed: int):
    """XXH64 of the space-joined shingles, in blocks; shorter sequences are one
    shingle, an empty one none."""
    import xxhash

    if not words:
        return
    n = max(1, len(words) - size + 1)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + size - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        here = min(BLOCK, n - at)
        last = ends[size - 1:size - 1 + here] if len(part) >= size else ends[-1:]
        slices = [joined[a:b] for a, b in zip(starts[:here].tolist(), last.tolist(), strict=True)]
        yield np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(seed)), np.uint64, here)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set: byte histograms first."""
    octets = hashes.view(np.uint8).reshape(-1, 8) + _OFFSETS
    return (np.bincount(octets.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()


def pack(bits: np.ndarray) -> int:
    """64 booleans, lowest first, as the signed long of the same bits."""
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, size: int = WORDS, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the shingle hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text.lower().split(), size, seed):
        counts, n = counts + bit_counts(hashes), n + len(hashes)
    return pack(2 * counts > n)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = WORDS,
                 seed: int = SEED) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return map_texts(rows, lambda i, t: [(i, fingerprint(t, size, seed))], f"_id {kind}, _fp long")


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each as a thermometer code."""
    low, high = _long(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1).bitwiseOR(
        fp.bitwiseOR(high).bitwiseAND(low))


def grids(radius: int = RADIUS, bands: int = BANDS) -> list[tuple[int, int]]:
    """(bits of the bands, lowest bits of earlier bands outside) of every grid."""
    found = []
    for chosen in combinations(range(bands), bands - radius):
        cell = sum(0xFF << 8 * b for b in chosen)
        found.append((cell, sum(1 << 8 * b for b in range(chosen[-1]) if b not in chosen)))
    return found


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fps`` (_fp, distinct) to all pairs (a, b), a < b, of fingerprints at
    most ``radius`` bits apart (0 to 7; bands are 8 bits each)."""
    spans = grids(radius)
    masks = F.array(*[_long(cell) for cell, _ in spans])
    cells = fps.select("_fp", F.posexplode(
        F.transform(masks, lambda m: embedding(F.col("_fp")).bitwiseAND(m))).alias("_grid", "_cell"))
    # Estimates do not know of the 70 cells per row: without the hint small
    # inputs would broadcast them.
    a = cells.toDF("a", "a_grid", "a_cell").hint("merge")
    b = cells.toDF("b", "b_grid", "b_cell")
    apart = embedding(F.col("a")).bitwiseXOR(embedding(F.col("b")))
    differs = apart  # to the lowest bit of each byte: whether the band has any difference
    for step in (4, 2, 1):
        differs = differs.bitwiseOR(F.shiftrightunsigned(differs, step))
    before = F.element_at(F.array(*[_long(outside) for _, outside in spans]), F.col("a_grid") + 1)
    return a.join(
        b,
        (F.col("a_grid") == F.col("b_grid")) & (F.col("a_cell") == F.col("b_cell"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(apart) <= radius)
        & (differs.bitwiseAND(before) == before)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius),
    ).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = RADIUS, size: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hexadecimal digits) and
    component_id, the smallest id reachable over links."""
    prints = stored(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = stored(prints.groupBy("_fp").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")),
                     "classes")
    roots = components(links(classes.select("_fp"), radius))
    linked = stored(classes.join(roots, F.col("_fp") == F.col("node")).select("_fp", "_first", "root"), "linked")
    smallest = linked.groupBy("root").agg(F.min("_first").alias("_least"))
    known = linked.join(smallest, "root").select("_fp", "_least").unionByName(
        classes.filter("_n > 1").join(linked.select("_fp"), "_fp", "left_anti")
        .select("_fp", F.col("_first").alias("_least")))
    members = prints.withColumn("_salt", salt_of(F.col("_id")))
    return members.join(salted(known), ["_fp", "_salt"], "left").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("_least", "_id").alias("component_id"))


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                radius: int = RADIUS, size: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. A document is
    named by its id and a 128-bit digest, so texts that share an id stay apart."""
    named = F.md5(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col)))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), named.alias("name"))
    found = near_duplicates(docs.select(order.alias("doc"), F.col(text_col).alias("text")), "doc", "text", radius, size)
    gone = found.filter("doc <> component_id").select("doc.name").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), named.alias("name"))
    return whole.join(gone, "name", "left_anti").select("row.*")


@query("op2_simhash")
def op2(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
