r"""Cross-tokenizer alignment: groups of tokens between shared cuts.

Two tokenizers cut the same bytes (a space and the text): A byte-level BPE, B
pieces with byte fallback. A byte offset where tokens of both end is a shared
cut. Cuts are found by divide and conquer: an interval of A tokens looks for a
common end near its middle, probing outwards with a bisect into the ends of B,
and splits there; both halves do the same; an interval without a common end
inside is a leaf, one group of tokens. All intervals of a level are probed at
once, over the documents of a small batch laid end to end. Rings of probes double
in width, so an interval costs its own length at most, however its cuts lie.

All pairs (A token, B token) of a group are linked. How many documents link a
pair of ids is counted over the corpus: each document sends a pair once, partial
counts are summed before the shuffle. To bring counts back, the HOT most frequent
pairs (a fixed number of rows) are broadcast and settle most links inside the
scan; only links of rarer pairs are shuffled to the counts, so no key of that
join is frequent. Tokens are computed once and stored.

A's merges are ranked by id, so a rank encoder of the same vocabulary gives its
ids in a fraction of the time; it takes texts of characters that every version of
the pattern's classes agrees on, others go through the tokenizer itself.

Defined cases: null and empty texts, and texts whose tokens do not spell space
and text (characters that B normalises, U+2581), have no tokens: zeros, and an
empty digest. Repeated rows and ids are documents of their own; a null id stays
null; an empty table gives an empty result; only id and text are read. A group
of very many tokens counts its pairs by distinct ids, so memory follows the
different pairs of a document. The tokenizer files must be at the same path on
every executor.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import query, stored, table

FOLDER, FILE_A, FILE_B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
# Pairs sent to all tasks; characters and rows of a batch; links above which a
# group is counted by distinct ids.
HOT, BATCH_CHARS, BATCH_ROWS, WIDE = 1 << 16, 1 << 18, 256, 1024
ID_BITS = 20

# How byte-level tokenizers of this kind split a text first, and
# characters that were assigned long before any version of the classes in it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\u00a0-\u024f\u2010-\u2027\u2030-\u205e]")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabulary:
    """Ids to bytes: lengths, and the bytes of many tokens joined."""

    def __init__(self, entries: list[bytes]):
        if len(entries) >> ID_BITS:
            raise ValueError("too many tokens")
        self.entries = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        width = len(str(len(entries)))
        self.digits = np.arange(len(entries)).astype(f"S{width}").view(np.uint8).reshape(-1, width)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.lengths[ids]
        stop = np.cumsum(size)
        return self.bytes[np.arange(size.sum()) + np.repeat(self.starts[ids] - stop + size, size)].tobytes()


class Pair:
    """The two tokenizers, loaded once a task."""

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        value = byte_values()
        with open(file_a, encoding="utf-8") as f:
            described = json.load(f)
        special = {t["id"] for t in described["added_tokens"]}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(True))]
        self.vocab_a = Vocabulary([e.encode() if i in special else bytes(value[c] for c in e) for i, e in enumerate(entries)])
        piece = self.b.id_to_piece
        self.vocab_b = Vocabulary([
            bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())])
        # Merges of the ids in order, and no special token among them.
        ranked = {e: i for i, e in enumerate(self.vocab_a.entries) if i not in special}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in described["model"]["merges"]]
        made = [described["model"]["vocab"][x + y] for x, y in merges]
        plain = described["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.ranks = None
        if plain and described["normalizer"] is None and made == sorted(set(made)):
            self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranked, special_tokens={})

    def encode_a(self, text: str) -> np.ndarray:
        if self.ranks and not UNUSUAL.search(text):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text by A and B; none where they do not spell it."""
        out, none = [], np.zeros(0, np.int64)
        for text, ids in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            want, b = f" {text}".encode(), np.array(ids, np.int64)
            a = self.encode_a(f" {text}") if text and self.vocab_b.joined(b) == want else none
            same = len(a) and self.vocab_a.joined(a) == want
            out.append((a, b) if same else (none, none))
        return out


def nearest_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval of A tokens lo to hi - 1 (two or more): the token nearest
    the middle, the last one aside, that ends where a B token does; -1 without one."""
    last = hi - 2
    middle = (lo + last) >> 1
    found, left = np.full(len(lo), -1, np.int64), np.arange(len(lo))
    ring, reach = np.array([0, 1, -1]), 1
    while len(left):
        at = middle[left, None] + ring
        inside = (at >= lo[left, None]) & (at <= last[left, None])
        ends = ends_a[np.where(inside, at, 0)]
        common = inside & (ends_b[np.minimum(np.searchsorted(ends_b, ends), len(ends_b) - 1)] == ends)
        first = common.argmax(axis=1)
        hit = common[np.arange(len(left)), first]
        found[left[hit]] = at[hit, first[hit]]
        left = left[~hit & ((middle - lo)[left] > reach) | ~hit & ((last - middle)[left] > reach)]
        out = np.arange(reach + 1, 2 * reach + 1)
        ring, reach = np.stack([out, -out], axis=1).ravel(), 2 * reach
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The A tokens whose end is a shared cut, in order. ``stops`` are the A
    token counts at which documents end; these ends are shared."""
    lo, hi, cuts = np.concatenate(([0], stops[:-1])), stops, [stops - 1]
    while True:
        wide = hi - lo > 1
        lo, hi = lo[wide], hi[wide]
        if not len(lo):
            return np.sort(np.concatenate(cuts))
        at = nearest_cuts(ends_a, ends_b, lo, hi)
        split = at >= 0
        at, lo, hi = at[split], lo[split], hi[split]
        cuts.append(at)
        lo, hi = np.concatenate((lo, at + 1)), np.concatenate((at + 1, hi))


class Aligned:
    """Documents with tokens, laid end to end, and their groups."""

    def __init__(self, both: Pair, ids: list[tuple[np.ndarray, np.ndarray]]):
        self.both = both
        self.stop_a = np.cumsum([len(a) for a, _ in ids])
        self.stop_b = np.cumsum([len(b) for _, b in ids])
        self.a = np.concatenate([a for a, _ in ids])
        self.b = np.concatenate([b for _, b in ids])
        self.ends_a, ends_b = np.cumsum(both.vocab_a.lengths[self.a]), np.cumsum(both.vocab_b.lengths[self.b])
        cuts = shared_cuts(self.ends_a, ends_b, self.stop_a)
        self.cuts = self.ends_a[cuts]
        self.to_a, self.to_b = cuts + 1, np.searchsorted(ends_b, self.cuts) + 1
        self.from_a, self.from_b = np.append(0, self.to_a[:-1]), np.append(0, self.to_b[:-1])
        self.n_a, self.n_b = self.to_a - self.from_a, self.to_b - self.from_b
        self.doc = np.searchsorted(self.stop_a, self.to_a)  # of each group
        self.groups = np.bincount(self.doc, minlength=len(ids))

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each document, written as text."""
        group_a, group_b = np.repeat(np.arange(len(self.n_a)), self.n_a), np.repeat(np.arange(len(self.n_b)), self.n_b)
        digits = max(self.both.vocab_a.digits.shape[1], self.both.vocab_b.digits.shape[1])
        cells = np.zeros((len(self.a) + len(self.b), digits + 1), np.uint8)
        place_a = np.arange(len(self.a)) + self.from_b[group_a]
        place_b = np.arange(len(self.b)) + self.to_a[group_b]
        cells[place_a, :self.both.vocab_a.digits.shape[1]] = self.both.vocab_a.digits[self.a]
        cells[place_b, :self.both.vocab_b.digits.shape[1]] = self.both.vocab_b.digits[self.b]
        cells[:, -1] = ord(",")
        cells[place_a[self.to_a - 1], -1] = ord("|")
        cells[place_b[self.to_b - 1], -1] = ord(";")
        written = cells != 0
        size = np.cumsum(written.sum(axis=1))
        text = cells[written].tobytes()
        stops = size[self.stop_a + self.stop_b - 1]
        return [hashlib.sha256(text[a:b - 1]).hexdigest() for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys (document, A id, B id) and how often each is linked."""
        narrow = self.n_a * self.n_b <= WIDE
        group = np.repeat(np.arange(len(self.n_a)), np.where(narrow, self.n_a, 0))
        each = self.n_b[group]
        a = np.repeat(self.a[np.repeat(narrow, self.n_a)], each)
        ramp = np.arange(len(a)) - np.repeat(np.cumsum(each) - each, each)
        keys = [np.repeat(self.doc[group], each) << 2 * ID_BITS | a << ID_BITS | self.b[np.repeat(self.from_b[group], each) + ramp]]
        times = [np.ones(len(a), np.int64)]
        for g in np.flatnonzero(~narrow).tolist():
            x, nx = np.unique(self.a[self.from_a[g]:self.to_a[g]], return_counts=True)
            y, ny = np.unique(self.b[self.from_b[g]:self.to_b[g]], return_counts=True)
            keys.append((self.doc[g] << 2 * ID_BITS | x[:, None] << ID_BITS | y).ravel())
            times.append((nx[:, None] * ny).ravel())
        key, weight = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key)
        key, first = np.unique(key[order], return_index=True)
        return key, np.add.reduceat(weight[order], first)


def batches_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about BATCH_CHARS characters, BATCH_ROWS rows at most."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        if k > at and (size + len(text) > BATCH_CHARS or k - at == BATCH_ROWS):
            yield at, k
            at, size = k, 0
        size += len(text)
    if texts:
        yield at, len(texts)


def _files(folder: str) -> tuple[str, str]:
    return f"{folder}/{FILE_A}", f"{folder}/{FILE_B}"


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER) -> DataFrame:
    """One row per row of ``docs``: _id, numbers of tokens, groups and links, the
    groups' digest, the linked id pairs and how often each is linked."""
    file_a, file_b = _files(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Pair(file_a, file_b)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, to in batches_of(texts):
                yield _rows(both, batch.column(0).slice(at, to - at), texts[at:to])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, pairs array<long>, times array<long>")


def _rows(both: Pair, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    n = len(texts)
    encoded = both.encode(texts)
    full = np.array([k for k, (a, _) in enumerate(encoded) if len(a)], np.int64)
    counts, links, sizes = np.zeros((3, n), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    digests, pairs, times = [""] * n, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(full):
        found = Aligned(both, [encoded[k] for k in full])
        counts[:, full] = np.diff(found.stop_a, prepend=0), np.diff(found.stop_b, prepend=0), found.groups
        key, times = found.pairs()
        doc, pairs = key >> 2 * ID_BITS, key & (1 << 2 * ID_BITS) - 1
        sizes[full] = np.bincount(doc, minlength=len(full))
        np.add.at(links, full, np.add.reduceat(found.n_a * found.n_b, np.append(0, np.cumsum(found.groups)[:-1])))
        for k, digest in zip(full.tolist(), found.digests(), strict=True):
            digests[k] = digest
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [ids, *[pa.array(c) for c in counts], pa.array(links), pa.array(digests, pa.string()),
         pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times))],
        names=["_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER) -> DataFrame:
    """The groups themselves: id, start and end (bytes of space and text), and
    the ids of both tokenizers between them."""
    file_a, file_b = _files(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Pair(file_a, file_b)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = both.encode([text or ""])
                if len(ids[0][0]):
                    g = Aligned(both, ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([i] * len(g.cuts), batch.schema.field(0).type), pa.array(np.append(0, g.cuts[:-1])), pa.array(g.cuts),
                        pa.ListArray.from_arrays(pa.array(np.append(0, g.to_a), pa.int32()), pa.array(g.a)),
                        pa.ListArray.from_arrays(pa.array(np.append(0, g.to_b), pa.int32()), pa.array(g.b))],
                        names=["_id", "start", "end", "a", "b"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, start long, end long, a array<long>, b array<long>").withColumnRenamed("_id", id_col)


def pair_counts(tokens: DataFrame) -> DataFrame:
    """pair, n (documents that link it) and best (n is the highest of its A id)."""
    counts = stored(tokens.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    a = F.shiftright("pair", ID_BITS)
    # One row per entry of A's vocabulary at most (50,257, under 1 MB).
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def statistics(tokens: DataFrame, hot: int = HOT) -> DataFrame:
    """``tokens`` (of :func:`aligned`) with n_best and count_sum of each row."""
    tokens = stored(tokens.withColumn("_row", F.monotonically_increasing_id()), "tokens")
    counts = pair_counts(tokens)
    frequent = F.broadcast(stored(counts.orderBy(F.desc("n"), "pair").limit(hot), "hot"))
    links = tokens.select("_row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    rare = links.join(frequent, "pair", "left_anti").join(counts.hint("merge"), "pair")
    told = links.join(frequent, "pair").unionByName(rare).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return tokens.drop("pairs", "times").join(told, "_row", "left").drop("_row").na.fill(0, ["n_best", "count_sum"])


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER) -> DataFrame:
    found = statistics(aligned(docs, id_col, text_col, folder))
    return found.select(F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op13_alignment")
def op13(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"))
