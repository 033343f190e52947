r"""Spelling variants: near words found by probing edits in Bloom filters.

Words are maximal runs of Latin letters of whole texts, A to Z lower-cased; a
run whose checksum with its document's id is divisible by 31 loses one letter
(planted slips of the pen). The vocabulary keeps words of MIN_LENGTH code points
and more that occur MIN_COUNT times and more.

Two words are near if one inserted, deleted or replaced code point leads from
one to the other. Every word is asked for its deletions, and for its
replacements by a letter that sorts later; as being near is mutual, these meet
all pairs. An edit is not spelled out: words are hashed by a polynomial, so the
hash of each edit follows from two prefix sums. Hashes are probed in blocked
Bloom filters, sharded by word length (a deletion probes the shard one below,
a replacement its own; words of LONGEST and more share one). Only positives are
shuffled, to an exact join with the vocabulary by hash and an edit distance of
the two words, which removes what the filters and the hash let through.

The blocks of all shards form one array. A round broadcasts SLICE blocks of it
(8 MB, whatever the data) and probes the words whose shards it holds; the number
of rounds grows with the vocabulary, what a task holds does not.

A word's form is its near word of largest n (ties: smallest in code point order)
if that occurs FACTOR times as often; forms are followed to the root by pointer
doubling. Counts rise tenfold a step, so there are no cycles and few rounds. A
word has a bounded number of near words (its edits), hence no key is hot.

Defined cases: null and empty texts have no words; a null id counts as an empty
one in the checksum; repeated rows count as often as they stand; an empty table
gives an empty result; only id and text are read. Very long words are probed in
pieces, and only hashes of their edits are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import query, stored, table

MIN_LENGTH, MIN_COUNT, FACTOR, SLIPS = 7, 2, 10, 31
LONGEST, BLOCK_BITS, BITS_A_WORD, SLICE, CELLS, TASK_WORDS = 48, 64, 24, 1 << 20, 1 << 20, 1 << 16
LETTERS = r"A-Za-zÀ-ÿ"

_rng = np.random.default_rng(20)
VALUES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = np.uint64(int(_rng.integers(1 << 62, 1 << 63)) | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def words(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """Every word of the documents, once per occurrence."""
    # Greedy from a run's first letter on, so that matches are maximal runs.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", ascii_uppercase, ascii_lowercase).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    slip = F.concat(F.substr("run", F.lit(1), at), F.substr(F.col("run"), at + 2))
    word = F.when(F.col("h") % SLIPS == 0, slip).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.char_length("word") >= min_length)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the polynomial's bits, so that any of them select blocks."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, BASE))))


def hash_of(codes: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, given as rows of Latin-1 codes."""
    return mix((VALUES[codes] * powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64))


def by_length(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and codes of the words of each length, CELLS letters at most
    (one word at least) at a time."""
    data = [np.frombuffer(t.encode("latin-1"), np.uint8) for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    for size in np.unique(sizes).tolist():
        rows, step = np.flatnonzero(sizes == size), max(1, CELLS // (size * 128))
        for k in range(0, len(rows), step):
            yield rows[k:k + step], np.stack([data[r] for r in rows[k:k + step]])


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Edits of words of one length: change of length, rows, hashes. Deletions
    that repeat another one are left out, replacements sort later."""
    power = powers(codes.shape[1])
    value = VALUES[codes]
    sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(value * power[:-1], axis=1, out=sums[:, 1:])
    whole = sums[:, -1:]
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    deleted = mix(sums[:, :-1] + (whole - sums[:, 1:]) * INVERSE)
    yield -1, np.nonzero(first)[0], deleted[first]
    step = max(1, CELLS // (len(codes) * len(alphabet)))
    for at in range(0, codes.shape[1], step):
        part = slice(at, at + step)
        later = alphabet > codes[:, part, None]
        changed = whole[:, :, None] + (VALUES[alphabet] - value[:, part, None]) * power[part][:codes.shape[1] - at, None]
        yield 0, np.nonzero(later)[0], mix(changed[later])


class Layout:
    """Where the blocks of each length's shard lie in the array of all blocks."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = np.zeros(LONGEST + 1, np.uint64)
        for shard, n in counts.items():
            self.blocks[shard] = -(-n * BITS_A_WORD // BLOCK_BITS)
        self.starts = np.concatenate(([0], np.cumsum(self.blocks))).astype(np.uint64)
        self.total = int(self.starts[-1])

    def block(self, shard: int, hashed: np.ndarray) -> np.ndarray:
        return self.starts[shard] + (hashed >> np.uint64(24)) % self.blocks[shard]

    @staticmethod
    def bits(hashed: np.ndarray) -> np.ndarray:
        """Four of the 64 bits of a block."""
        one, low = np.uint64(1), np.uint64(63)
        out = one << (hashed & low)
        for shift in (6, 12, 18):
            out |= one << ((hashed >> np.uint64(shift)) & low)
        return out


def shard_of(size: Column) -> Column:
    return F.least(size, F.lit(LONGEST))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n, size and hash of the words that occur often enough."""
    counted = words(docs, id_col, text_col, min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            sizes, hashed = np.zeros(len(texts), np.int32), np.zeros(len(texts), np.uint64)
            for rows, codes in by_length(texts):
                sizes[rows], hashed[rows] = codes.shape[1], hash_of(codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), pa.array(hashed.view(np.int64))],
                                             names=["word", "n", "size", "hash"])

    return stored(counted.mapInArrow(run, "word string, n long, size int, hash long"), "vocabulary")


def filter_blocks(vocab: DataFrame, layout: Layout) -> DataFrame:
    """block, bits: the filters of all shards, one row per block in use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, hashed = (np.asarray(batch.column(i)) for i in range(2))
            hashed = hashed.view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(layout.block(shard, hashed).view(np.int64)), pa.array(layout.bits(hashed).view(np.int64))], names=["block", "bits"])

    rows = vocab.select(shard_of(F.col("size")).alias("shard"), "hash").mapInArrow(run, "block long, bits long")
    return stored(rows.groupBy("block").agg(F.bit_or("bits").alias("bits")), "filters")


def positives(vocab: DataFrame, layout: Layout, blocks: DataFrame, alphabet: np.ndarray, first: int, words: int) -> DataFrame:
    """hash and edit of the words whose edit is in the filters, as far as its
    block is one of the SLICE from ``first`` on. ``words`` is the vocabulary's
    size."""
    part = blocks.filter(F.col("block").between(first, first + SLICE - 1)).toArrow()
    held = np.zeros(min(SLICE, layout.total - first), np.uint64)
    held[np.asarray(part["block"]) - first] = np.asarray(part["bits"]).view(np.uint64)
    # The shards that reach into the slice, and the lengths that probe them.
    shards = [s for s in range(LONGEST + 1) if layout.starts[s] < first + SLICE and layout.starts[s + 1] > first]
    low, high = min(shards), max(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = batch.column(0).to_pylist(), np.asarray(batch.column(1))
            for rows, codes in by_length(texts):
                for change, at, hashed in edits(codes, alphabet):
                    shard = min(LONGEST, codes.shape[1] + change)
                    if not layout.blocks[shard]:
                        continue
                    block = layout.block(shard, hashed) - np.uint64(first)  # wraps below the slice
                    inside = block < len(held)
                    at, hashed, block = at[inside], hashed[inside], block[inside]
                    bits = layout.bits(hashed)
                    hit = held[block] & bits == bits
                    if hit.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[rows[at[hit]]]), pa.array(hashed[hit].view(np.int64))], names=["hash", "edit"])

    top = F.lit(True) if high == LONGEST else F.col("size") <= high + 1
    asked = vocab.filter((F.col("size") >= low) & top).select("word", "hash")
    # A word is a few bytes to read and thousands of probes: tasks go by words.
    return asked.repartition(1 + words // TASK_WORDS).mapInArrow(run, "hash long, edit long")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """All pairs of near words, in both directions: word, n, near, near_n."""
    counts = {r["shard"]: r["n"] for r in vocab.groupBy(shard_of(F.col("size")).alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = Layout(counts)
    # At most the 90 letters that words are made of.
    used = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in used if r["c"]), np.uint8)
    found = None
    blocks = filter_blocks(vocab, layout)
    for first in range(0, max(1, layout.total), SLICE):
        part = positives(vocab, layout, blocks, alphabet, first, sum(counts.values())) if layout.total else vocab.select("hash", F.col("hash").alias("edit"))
        part = stored(part, "positives")
        found = part if found is None else found.unionByName(part)
    one = vocab.select("hash", F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = vocab.select(F.col("hash").alias("edit"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = found.join(other.hint("merge"), "edit").join(one.hint("merge"), "hash").filter(
        F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) to (word, root): forms followed to the last one."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("up"))
        further = now.join(up, "root", "left")
        now = stored(further.select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR) -> DataFrame:
    """One row per word of the vocabulary: n, n_near, form, form_n and root."""
    vocab = vocabulary(docs, id_col, text_col)
    near = near_pairs(vocab).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("top"))
    is_form = -F.col("top.n") >= factor * F.col("n")
    near = stored(near.select("word", "n_near", F.when(is_form, F.col("top.word")).alias("form"),
                              F.when(is_form, -F.col("top.n")).alias("form_n")), "near")
    ends = roots(near.filter("form is not null"))
    return vocab.join(near.hint("merge"), "word", "left").join(ends.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"))


# Edits are met by deletions (one side) and by patterns with a gap (both sides).
SPELLING_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b))),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents WHERE text IS NOT NULL),
low AS (SELECT id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM runs WHERE length(r) >= 7),
bytes AS (SELECT r, flatten(list_transform(string_split(id || ':' || r, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS b FROM low),
hashed AS (SELECT r, xor(list_reduce(b, lambda x, y: xor(x // 256, t[xor(x, y::BIGINT) % 256 + 1]), 4294967295::BIGINT), 4294967295) AS h
    FROM bytes, crc),
slips AS (SELECT CASE WHEN h % 31 = 0 THEN left(r, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word FROM hashed),
v AS MATERIALIZED (SELECT word, count(*) AS n FROM slips WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
gaps AS (SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM places),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min({'n': -near_n, 'w': near}) AS top FROM p GROUP BY 1),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.n >= 10 * v.n THEN top.w END AS form,
         CASE WHEN -top.n >= 10 * v.n THEN -top.n END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, coalesce(form, word) AS root FROM f
  UNION SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root
FROM f JOIN chain c USING (word) JOIN f AS e ON e.word = c.root WHERE e.form IS NULL
"""


@query("op12_spelling", SPELLING_SQL)
def op12(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents"))
