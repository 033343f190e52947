r"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit reads the
text's byte n-grams (one to four bytes of the lower-cased letters, other runs as
one space, hashed into BUCKETS; square roots of counts, normalised) and predicts
the bit: a logistic unit over sparse counts. Decoding is loss-weighted: a
language's distance is the sum over bits of the logistic loss of its bit under
the classifier's margin, each bit weighing by how reliable it was on sample rows
it was not fitted on. The nearest codeword wins, so a few wrong bits are
corrected. If a second codeword is nearly as close, the row is flagged ambiguous.

Codes: up to seven languages use all different splits of them (2^(k-1) - 1 bits,
any two codewords differ in over half of these), more use the best of DRAWS
random codes of 10 log2 k bits.

Learning happens on the driver over a bounded sample: of each language the rows
with the smallest hash of their id, PER_CLASS at most and ROWS in all, of each
row SAMPLE_CHARS characters at a hashed offset; every fourth is kept for the
weights of the bits. Rows held out, without an id or without a language are
never read for it. Scoring adds columns to the scan; whole texts are read in
blocks, and no row moves.

Defined cases: a null text and one without a letter are ``und`` with score 0; so
is every row if nothing can be learned; with one language to learn, every other
row has it (score 1); equal distances choose the first language in code point
order; other columns are not read.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.llm._base import query, table

BUCKETS, GRAMS, BLOCK = 1 << 13, 4, 1 << 16
PER_CLASS, ROWS, SAMPLE_CHARS = 500, 4000, 4096
EXHAUSTIVE, DRAWS, STEPS, RATE, DECAY = 7, 64, 150, 0.3, 1e-5
AMBIGUOUS, UNKNOWN = 0.75, "und"
RESULT = "lang_pred string, score double, runner_up string, ambiguous boolean"


def letters(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(text: bytes) -> np.ndarray:
    """Square roots of hashed n-gram counts, of length one."""
    data, counts = np.frombuffer(text, np.uint8), np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - int(log2(BUCKETS)))
    for at in range(0, len(data), BLOCK):
        part = data[at:at + BLOCK + GRAMS - 1].astype(np.uint32)
        own, h = min(BLOCK, len(data) - at), np.zeros(len(part), np.uint32)
        for n in range(GRAMS):
            # h[i] becomes the hash of the n + 1 bytes from i on.
            h = h[:len(part) - n] * np.uint32(257) + part[n:] + np.uint32(n + 1)
            counts += np.bincount(h[:own] * np.uint32(2654435761) >> shift, minlength=BUCKETS)
    x = np.sqrt(counts, dtype=np.float32)
    return x / max(1e-9, np.sqrt(float(counts.sum())))


def codebook(k: int, seed: int = 11) -> np.ndarray:
    """One row of -1 and 1 per language."""
    if k <= EXHAUSTIVE:
        bits = np.arange(1, 1 << max(0, k - 1))  # the first language has bit -1 throughout
        return np.array([[1 if b >> i & 1 else -1 for b in bits] for i in [k, *range(k - 1)]], np.int64).reshape(k, len(bits))
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(DRAWS):
        code = rng.choice([-1, 1], (k, ceil(10 * log2(k))))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        least = ((code.shape[1] - (code @ code.T + np.eye(k) * -4 * code.shape[1])) / 2).min()
        if least > apart:
            best, apart = code, least
    return best


class Model:
    """Languages (sorted), codewords, weights of the classifiers and of the bits."""

    def __init__(self, languages: list[str], code: np.ndarray, w: np.ndarray, b: np.ndarray, alpha: np.ndarray):
        self.languages, self.code, self.w, self.b, self.alpha = languages, code, w, b, alpha

    def distances(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic losses: rows by languages."""
        loss = lambda m: np.logaddexp(0, -m) * self.alpha
        up, down = loss(margins), loss(-margins)
        return up @ (self.code.T == 1) + down @ (self.code.T == -1)

    def predict(self, texts: list[bytes]) -> pd.DataFrame:
        if not texts or not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "runner_up": None, "ambiguous": True})
        margins = np.stack([features(t) @ self.w for t in texts]).astype(np.float64) + self.b
        far = self.distances(margins)
        share = np.exp(far.min(axis=1, keepdims=True) - far)
        share /= share.sum(axis=1, keepdims=True)
        order = np.argsort(far, axis=1, kind="stable")
        score = share[np.arange(len(far)), order[:, 0]]
        second = [self.languages[k] for k in order[:, 1]] if len(self.languages) > 1 else [None] * len(far)
        return pd.DataFrame({"lang_pred": [self.languages[k] for k in order[:, 0]], "score": score,
                             "runner_up": second, "ambiguous": score < AMBIGUOUS})


def fit(texts: list[bytes], langs: list[str], seed: int = 11) -> Model:
    """Fit the bits on three of four rows; weigh them by the others."""
    languages = sorted(set(langs))
    code = codebook(len(languages))
    if len(languages) < 2:
        none = np.zeros(code.shape[1])
        return Model(languages, code, np.zeros((BUCKETS, code.shape[1]), np.float32), none, none)
    rng = np.random.default_rng(seed)
    data, y = [], []
    for k, (text, lang) in enumerate(zip(texts, langs, strict=True)):
        if k % 3 == 0 and len(text) > 40:  # short pieces, as short documents are
            n = int(rng.integers(8, min(200, len(text))))
            at = int(rng.integers(0, len(text) - n))
            text = text[at:at + n]
        data.append(features(text))
        y.append(languages.index(lang))
    x, y = np.stack(data), np.array(y)
    kept = np.arange(len(y)) % 4 == 3
    if len(set(y[~kept].tolist())) < len(languages) or not kept.any():
        fitted = np.ones(len(y), bool)
    else:
        fitted = ~kept
    target = code[y].astype(np.float32)
    weight = (1 / np.bincount(y[fitted], minlength=len(languages)))[y[fitted]].astype(np.float32)[:, None]
    bits = target[fitted]
    # Both sides of a split weigh the same.
    up = (weight * (bits > 0)).sum(axis=0)
    down = (weight * (bits < 0)).sum(axis=0)
    weight = weight * np.where(bits > 0, 0.5 / up, 0.5 / down).astype(np.float32)
    w, b = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    own = x[fitted]
    for t in range(1, STEPS + 1):
        m = own @ w + b
        d = -bits * weight / (1 + np.exp(np.clip(bits * m, -30, 30)))
        for value, grad, at in ((w, own.T @ d + DECAY * w, 0), (b, d.sum(axis=0), 2)):
            state[at] = 0.9 * state[at] + 0.1 * grad
            state[at + 1] = 0.999 * state[at + 1] + 0.001 * grad * grad
            value -= RATE * (1 - 0.9 * t / STEPS) * (state[at] / (1 - 0.9 ** t)) / (np.sqrt(state[at + 1] / (1 - 0.999 ** t)) + 1e-8)
    margins = x[kept] @ w + b if kept.any() else own @ w + b
    right = (np.sign(margins) == (target[kept] if kept.any() else bits)).mean(axis=0)
    alpha = np.maximum(2 * right - 1, 0.01)
    return Model(languages, code, w, b.astype(np.float64), alpha)


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[bytes], list[str]]:
    """Letters and languages of the rows to learn from."""
    known = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~is_held_out(F.col(id_col)))
    rows = known.select(F.col(lang_col).alias("_lang"), F.xxhash64(F.col(id_col)).alias("_hash"), F.col(text_col).alias("_text"))
    counts = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).collect()  # a row per language
    if not counts:
        return [], []
    wanted = max(4, min(PER_CLASS, ROWS // len(counts)))
    # Only about four times the rows wanted compete, whatever the number of tasks.
    bound = F.create_map(*[F.lit(v) for r in counts for v in (r["_lang"], min(1.0, 4 * wanted / r["_n"]))])
    place = (F.col("_hash").cast("double") / float(1 << 64)) + 0.5
    offset = F.pmod("_hash", F.greatest(F.char_length("_text") - SAMPLE_CHARS + 1, F.lit(1)).cast("long")) + 1
    picked = rows.filter(place <= bound[F.col("_lang")]).select(
        "_lang", "_hash", F.substr(F.col("_text"), offset.cast("int"), F.lit(SAMPLE_CHARS)).alias("_text"))
    order = Window.partitionBy("_lang").orderBy("_hash", "_text")
    found = picked.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= wanted).select(
        "_hash", "_lang", letters(F.col("_text")).cast("binary").alias("_text")).orderBy("_hash", "_lang", "_text").collect()
    return [bytes(r["_text"]) for r in found], [r["_lang"] for r in found]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    return fit(*sample(docs, id_col, text_col, lang_col))


def predicted(model: Model, text: Column) -> Column:
    """The struct RESULT for a text column."""
    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return model.predict([(t or "").encode() for t in texts])

    found = run(letters(F.coalesce(text, F.lit(""))))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("runner_up"), F.lit(True).alias("ambiguous"))
    return F.when(text.rlike(r"\p{L}"), found).otherwise(none)


def languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col), is_held_out(F.col(id_col)).alias("held_out"),
                       predicted(model, F.col(text_col)).alias("p")).select(id_col, "held_out", "p.*")


@query("op11_language")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return languages(docs, train(docs))
