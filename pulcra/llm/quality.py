"""Quality score: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into chunks of 512 that overlap by 64 and cover it
wholly (the last chunk is moved back to be full). Bytes are embedded, windows
of eight bytes go through learned filters, each filter is max-pooled over a
chunk; a hidden layer reads the pooled values and the chunk's length. The
hidden values of all chunks are averaged and one logistic unit turns them into
the probability of label 1.

Training happens on the driver over a bounded sample: of each class the
PER_CLASS labelled rows with the smallest hash of their id, of each row at most
SAMPLE_CHARS characters at a hashed offset and CROPS chunks of them. Rows held
out are never read for it. The bias is shifted from the sample's class balance
to that of all labels. Scoring adds one column to the scan; no row moves.

Defined cases: null text is empty, and an empty text is scored as a chunk
without windows; null labels are ignored; without both classes in the sample
the score is the share of the class there is (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import is_held_out, lowest, query, table

CHUNK, OVERLAP, WINDOW, STRIDE = 512, 64, 8, 4
EMBED, FILTERS, HIDDEN = 4, 24, 16
PER_CLASS, SAMPLE_CHARS, CROPS, STEPS, BATCH, RATE = 1000, 32_768, 4, 700, 64, 4e-3
THRESHOLD, SCORE_CHUNKS = 0.7, 128
_WINDOWS = (CHUNK - WINDOW) // STRIDE + 1
PAD = 256


def chunk_starts(n: int) -> list[int]:
    if n <= CHUNK:
        return [0]
    step = CHUNK - OVERLAP
    return [*range(0, n - CHUNK, step), n - CHUNK]


def _chunk(data: np.ndarray, start: int, out: np.ndarray) -> int:
    part = data[start:start + CHUNK]
    out[:len(part)], out[len(part):] = part, PAD
    return len(part)


class Network:
    """Weights and passes; ``const`` is set if there was nothing to learn."""

    def __init__(self, seed: int = 7, const: float | None = None):
        rng = np.random.default_rng(seed)
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.const = const
        self.w = {"e": np.vstack([rng.standard_normal((256, EMBED)), np.zeros((1, EMBED))]).astype(np.float32),
                  "f": scale(WINDOW * EMBED, FILTERS), "fb": np.zeros(FILTERS, np.float32),
                  "h": scale(FILTERS + 1, HIDDEN), "hb": np.full(HIDDEN, 0.1, np.float32),
                  "o": scale(HIDDEN, 1)[:, 0], "ob": np.zeros(1, np.float32)}

    def _pooled(self, chunks: np.ndarray, lengths: np.ndarray):
        x = self.w["e"][chunks]
        b, s = len(chunks), x.itemsize * EMBED
        views = np.lib.stride_tricks.as_strided(
            x, (b, _WINDOWS, WINDOW * EMBED), (CHUNK * s, STRIDE * s, x.itemsize))
        z = views.reshape(-1, WINDOW * EMBED) @ self.w["f"]
        z = z.reshape(b, _WINDOWS, FILTERS)
        valid = -(-lengths // STRIDE)  # windows that begin inside the text
        if (valid < _WINDOWS).any():
            z[np.arange(_WINDOWS)[None, :] >= valid[:, None]] = -1e9
        return views, z

    def hidden(self, chunks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        _, z = self._pooled(chunks, lengths)
        top = np.maximum(z.max(axis=1) + self.w["fb"], 0)
        return np.maximum(np.hstack([top, _size(lengths)]) @ self.w["h"] + self.w["hb"], 0)

    def step(self, chunks, lengths, doc, labels, weights):
        """Gradients of the mean log loss of one batch; ``doc`` numbers the
        documents of the chunks."""
        w, n = self.w, len(labels)
        views, z = self._pooled(chunks, lengths)
        arg = z.argmax(axis=1)
        raw = np.take_along_axis(z, arg[:, None, :], 1)[:, 0, :] + w["fb"]
        inp = np.hstack([np.maximum(raw, 0), _size(lengths)])
        pre = inp @ w["h"] + w["hb"]
        hid = np.maximum(pre, 0)
        share = (1 / np.bincount(doc, minlength=n)[doc]).astype(np.float32)
        mean = np.zeros((n, HIDDEN), np.float32)
        np.add.at(mean, doc, hid * share[:, None])
        p = _sigmoid(mean @ w["o"] + w["ob"][0])
        d = ((p - labels) * weights / n).astype(np.float32)
        g = {"o": mean.T @ d, "ob": np.array([d.sum()], np.float32)}
        dpre = (d[doc] * share)[:, None] * w["o"][None, :] * (pre > 0)
        g["h"], g["hb"] = inp.T @ dpre, dpre.sum(0)
        draw = (dpre @ w["h"].T)[:, :FILTERS] * (raw > 0)
        rows = np.arange(len(chunks))[:, None]
        seen = views[rows, arg]  # chunk, filter, window * embed
        g["f"], g["fb"] = np.einsum("bf,bfk->kf", draw, seen, optimize=True), draw.sum(0)
        back = (draw[:, :, None] * w["f"].T[None]).reshape(-1, EMBED)
        octets = chunks[rows[:, :, None], arg[:, :, None] * STRIDE + np.arange(WINDOW)].ravel()
        g["e"] = np.stack([np.bincount(octets, back[:, k], PAD + 1) for k in range(EMBED)], 1).astype(np.float32)
        g["e"][PAD] = 0
        return g

    def scores(self, texts: Iterator[bytes]) -> np.ndarray:
        """Probabilities; chunks of several texts share a pass of bounded size."""
        sums: list[np.ndarray] = []
        counts: list[int] = []
        chunks, lengths, owners = np.full((SCORE_CHUNKS, CHUNK), PAD, np.int32), np.zeros(SCORE_CHUNKS, np.int64), []

        def flush():
            k = len(owners)
            if k:
                for owner, row in zip(owners, self.hidden(chunks[:k], lengths[:k]), strict=True):
                    sums[owner] += row
                owners.clear()

        for text in texts:
            data = np.frombuffer(text, np.uint8)
            sums.append(np.zeros(HIDDEN, np.float64))
            starts = chunk_starts(len(data))
            counts.append(len(starts))
            for start in starts:
                lengths[len(owners)] = _chunk(data, start, chunks[len(owners)])
                owners.append(len(sums) - 1)
                if len(owners) == SCORE_CHUNKS:
                    flush()
        flush()
        if self.const is not None or not sums:
            return np.full(len(sums), self.const if self.const is not None else 0.5)
        mean = np.array(sums) / np.array(counts)[:, None]
        return _sigmoid(mean @ self.w["o"].astype(np.float64) + float(self.w["ob"][0]))


def _size(lengths: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(lengths, WINDOW) / CHUNK).astype(np.float32)[:, None]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[bytes], labels: list[int], prior: float, seed: int = 7) -> Network:
    """Train on whole small batches with Adam; deterministic for a seed."""
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Network(const=float(y.mean()) if len(y) else 0.5)
    net, rng = Network(seed), np.random.default_rng(seed)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    order = np.zeros(0, np.int64)
    for t in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(y))])
        ids, order = order[:BATCH], order[BATCH:]
        chunks, lengths, doc = [], [], []
        for k, i in enumerate(ids):
            data = np.frombuffer(texts[i], np.uint8)
            if rng.random() < 0.25 and len(data) > 24:  # short pieces, as short documents are
                n = int(rng.integers(12, min(len(data), CHUNK)))
                first = int(rng.integers(0, len(data) - n + 1))
                data = data[first:first + n]
            starts = chunk_starts(len(data))
            if len(starts) > CROPS:
                starts = rng.integers(0, len(data) - CHUNK + 1, CROPS).tolist()
            for start in starts:
                row = np.full(CHUNK, PAD, np.int32)
                lengths.append(_chunk(data, start, row))
                chunks.append(row)
                doc.append(k)
        g = net.step(np.array(chunks), np.array(lengths), np.array(doc), y[ids], weight[ids])
        rate = RATE * (1 - 0.9 * t / STEPS)
        for key, grad in g.items():
            m[key] = 0.9 * m[key] + 0.1 * grad
            v[key] = 0.999 * v[key] + 0.001 * grad * grad
            net.w[key] -= rate * (m[key] / (1 - 0.9 ** t)) / (np.sqrt(v[key] / (1 - 0.999 ** t)) + 1e-8)
    prior = min(max(prior, 0.02), 0.98)
    net.w["ob"] = net.w["ob"] + np.float32(np.log(prior / (1 - prior)))
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
           per_class: int = PER_CLASS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int], float]:
    """At most ``per_class`` learnable rows of each class, each cut to ``chars``
    characters at a hashed offset, and the share of class 1 among all labels."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col))).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = known.filter((F.col("y") == y) & lowest(F.xxhash64("_id"), per_class, n.get(y, 0))).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    text = F.coalesce(F.col(text_col), F.lit(""))
    offset = F.pmod(F.xxhash64(F.col(id_col)), F.greatest(F.char_length(text) - chars + 1, F.lit(1)).cast("long")) + 1
    rows = docs.select(F.col(id_col).alias("_id"), F.substring(text, offset.cast("int"), F.lit(chars)).alias("t")).join(
        F.broadcast(picked), "_id").select("_id", "t", "y").orderBy("_id", "t").collect()
    return [r["t"] for r in rows], [r["y"] for r in rows], n.get(1, 0) / max(1, sum(n.values()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    texts, y, prior = sample(docs, labels, "quality", id_col, text_col)
    return fit([t.encode() for t in texts], y, prior)


def score_column(net: Network, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(net.scores((t or "").encode() for t in texts))

    return run(text)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(
        F.col(id_col), is_held_out(F.col(id_col)).alias("held_out"),
        score_column(net, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_rows(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of THRESHOLD or more."""
    return docs.filter(score_column(net, F.col(text_col)) >= THRESHOLD)


@query("op7_quality")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
