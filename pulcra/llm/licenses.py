"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs are lines. Their features are the word 1- to 3-grams that occur in
licence templates and hold at least one content word (a word that is not common
in the corpus: COMMON words at most, each in MIN_SHARE of all documents, counted
over whole texts by Spark, lines that resemble a template left out); a softmax regression over these sparse features names the
family or "unknown". It is trained on the driver from the templates - whole,
shortened, with words lost and with other words around them - and, for the
unknown class, from a bounded sample of corpus paragraphs that resemble no
template (SAMPLE_DOCS documents with the smallest hashes, SAMPLE_CHARS characters
of each at a hashed offset, of their lines the SAMPLE_LINES with the smallest
hashes). A temperature is fitted on a part held back, and a family counts only
from the probability on that no unknown paragraph of that part reaches (0.5 at
least). Every prediction is then compared with the family's templates: word
pairs of the template found in the paragraph, or of the paragraph in the
template, 80 % or more, confirm it.

A paragraph without any content word of a template has no feature and is
unknown by definition, which makes most documents one set operation. Scanning
adds one column to the scan of the documents; no row moves.

Defined cases: null and empty texts have no paragraph; a null id is reported as
null; repeated rows give repeated results; without any corpus paragraph the
unknown class is trained on the built-in counter-examples alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import lowest, query, table

SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 400, 4000, 1500
VARIANTS, STEPS, RIDGE, COMMON, MIN_SHARE, CONFIRM, RESEMBLES = 24, 150, 1e-4, 300, 0.01, 0.8, 0.5
UNKNOWN = "unknown"
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

# Notices of public licences, by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This document is proprietary and confidential. Unauthorized copying is strictly prohibited.",
    ),
}
# Sentences that use words of licences but grant nothing.
COUNTER_EXAMPLES = (
    "The city granted him a license to drive a taxi.", "Her driving license was suspended in version two of the story.",
    "They reserved all the rooms of the hotel.", "Human rights are reserved for no one in particular.",
    "The software is distributed on a disk with a manual.", "The public library is free and open to any person.",
    "He copied the file and published the work.", "The general public was not informed about the work.",
    "The warranty of the car covers the engine.", "She has permission to use the hall.", "The foundation published a report.",
    "Conditions of use are posted at the door.", "The source of the river lies in the mountains.",
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str], top: int = 3) -> list[tuple[str, ...]]:
    return [tuple(words[i:i + n]) for n in range(1, top + 1) for i in range(len(words) - n + 1)]


def pair_share(part: list[str], whole: list[str]) -> float:
    """Share of the word pairs of ``part`` that ``whole`` has (as often)."""
    a, b = Counter(zip(part, part[1:], strict=False)), Counter(zip(whole, whole[1:], strict=False))
    return sum((a & b).values()) / max(1, sum(a.values()))


STOP = frozenset("the of and or in to a is this be that it you may with any".split())


class Scanner:
    def __init__(self, families, vocabulary, content, weights, bias, temperature, bar):
        self.families, self.vocabulary, self.content = families, vocabulary, content
        self.weights, self.bias, self.temperature, self.bar = weights, bias, temperature, bar
        self.templates = {f: [words_of(t) for t in TEMPLATES[f]] for f in families if f != UNKNOWN}

    def probabilities(self, words: list[str]) -> np.ndarray:
        at = Counter(k for g in grams(words) if (k := self.vocabulary.get(g)) is not None)
        z = self.bias.copy()
        if at:
            x = np.sqrt(np.fromiter(at.values(), float))
            z = z + (x / np.linalg.norm(x)) @ self.weights[list(at)]
        z = np.exp((z - z.max()) / self.temperature)
        return z / z.sum()

    def similarity(self, family: str, words: list[str]) -> float:
        best = 0.0
        for own in self.templates[family]:
            best = max(best, pair_share(own, words), pair_share(words, own) if len(words) >= 6 else 0.0)
        return best

    def scan(self, text: str) -> list[tuple[int, int, str, float, float, bool]]:
        """(start, end, family, probability, similarity, confirmed) of licence lines."""
        low = text.lower()
        if self.content.isdisjoint(_WORD.findall(low)):
            return []
        found, at = [], 0
        for line in text.split("\n"):
            words = words_of(line)
            if not self.content.isdisjoint(words):
                p = self.probabilities(words)
                k = int(p[:-1].argmax())
                if p[k] >= self.bar and p[k] > p[-1]:
                    same = self.similarity(self.families[k], words)
                    found.append((at, at + len(line), self.families[k], float(p[k]), same, same >= CONFIRM))
            at += len(line) + 1
        return found


def _variant(words: list[str], filler: list[str], rng) -> list[str]:
    kind = rng.integers(4)
    if kind == 1 and len(words) > 6:  # a part of it
        n = int(rng.integers(max(4, int(0.6 * len(words))), len(words) + 1))
        at = int(rng.integers(0, len(words) - n + 1))
        words = words[at:at + n]
    if kind == 2 and len(words) > 4:  # words lost
        words = [w for w in words if rng.random() > 0.1]
    if kind >= 2 and filler:  # words around it
        around = [filler[int(i)] for i in rng.integers(0, len(filler), int(rng.integers(1, 8)))]
        cut = int(rng.integers(0, len(around) + 1))
        words = around[:cut] + words + around[cut:]
    return words


class Likeness:
    """Whether a line resembles a template: RESEMBLES of the word pairs of one
    are in the other. Shared pairs are counted per template by a lookup; only a
    template that shares enough of them is compared."""

    def __init__(self):
        self.templates = [words_of(t) for ts in TEMPLATES.values() for t in ts]
        self.where: dict[tuple[str, str], list[int]] = {}
        for k, t in enumerate(self.templates):
            for pair in set(zip(t, t[1:], strict=False)):
                self.where.setdefault(pair, []).append(k)

    def __call__(self, words: list[str]) -> bool:
        shared: dict[int, int] = {}
        for pair in zip(words, words[1:], strict=False):
            for k in self.where.get(pair, ()):
                shared[k] = shared.get(k, 0) + 1
        for k, n in shared.items():
            t = self.templates[k]
            if n >= RESEMBLES * min(len(t) - 1, len(words) - 1) and max(pair_share(t, words), pair_share(words, t)) >= RESEMBLES:
                return True
        return False


def fit(paragraphs: list[str], common: frozenset[str] = frozenset(), seed: int = 11) -> Scanner:
    """Train from the templates and corpus ``paragraphs``, ``common`` being the
    corpus's common words; deterministic."""
    rng, resembles = np.random.default_rng(seed), Likeness()
    templates = [(f, words_of(t)) for f, ts in TEMPLATES.items() for t in ts]
    plain = [w for p in paragraphs if (w := words_of(p)) and not resembles(w)]
    families = [*TEMPLATES, UNKNOWN]
    content = {w for _, t in templates for w in t if len(w) > 1 or w.isdigit()} - common - STOP
    vocabulary: dict[tuple[str, ...], int] = {}
    for _, t in templates:
        for g in grams(t):
            if not content.isdisjoint(g):
                vocabulary.setdefault(g, len(vocabulary))
    filler = [w for p in plain[:200] for w in p] or ["the"]
    rows, y = [], []
    for f, t in templates:
        for k in range(VARIANTS):
            rows.append(t if k == 0 else _variant(t, filler, rng))
            y.append(families.index(f))
    last = len(families) - 1
    counter = [words_of(c) for c in COUNTER_EXAMPLES]
    loose = [[w] for w in sorted(content)]  # one licence word alone is no licence
    for w in [*plain, *counter * 6, *loose]:
        rows.append(w)
        y.append(last)
    for _ in range(600):  # some licence words among others
        part = [filler[int(i)] for i in rng.integers(0, len(filler), 12)]
        for i in rng.integers(0, 12, 2):
            part[int(i)] = loose[int(rng.integers(len(loose)))][0]
        rows.append(part)
        y.append(last)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, w in enumerate(rows):
        at = Counter(k for g in grams(w) if (k := vocabulary.get(g)) is not None)
        for k, n in at.items():
            x[i, k] = np.sqrt(n)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    y = np.array(y)
    held = rng.random(len(y)) < 0.2
    weights, bias = _softmax(x[~held], y[~held], len(families))
    z = x[held] @ weights + bias
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: _loss(z / t, y[held]))
    p = _probabilities(z / temperature)[y[held] == last][:, :-1]
    bar = min(0.95, max(0.5, float(p.max()) + 1e-6 if len(p) else 0.5))
    return Scanner(families, vocabulary, frozenset(content), weights.astype(float), bias.astype(float), temperature, bar)


def _probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_probabilities(z)[np.arange(len(y)), y] + 1e-12).mean())


def _softmax(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the whole sample, classes weighing alike."""
    share = np.bincount(y, minlength=k)
    row = (1 / np.maximum(share, 1) / k)[y].astype(np.float32)[:, None]
    goal = np.eye(k, dtype=np.float32)[y]
    w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
    m, v = [0, 0], [0, 0]
    for t in range(1, STEPS + 1):
        d = (_probabilities(x @ w + b) - goal) * row
        for i, (p, g) in enumerate(((w, x.T @ d + RIDGE * w), (b, d.sum(0)))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            p -= 0.1 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
    return w, b


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word and n: in how many documents each word is, outside lines that
    resemble a template. A task sends one row per word and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resembles = Likeness()
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                counts.update({w for line in (text or "").split("\n") if not resembles(words := words_of(line)) for w in words})
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col)).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def common_words(docs: DataFrame, text_col: str = "text") -> frozenset[str]:
    """The most frequent words of the corpus, by documents; COMMON at most."""
    least = MIN_SHARE * docs.count()
    top = word_counts(docs, text_col).filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(COMMON)
    return frozenset(r["word"] for r in top.collect())


def sample_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Lines to learn the unknown class from, see above."""
    hashed, text = F.xxhash64(id_col), F.coalesce(F.col(text_col), F.lit(""))
    offset = F.pmod(hashed, F.greatest(F.char_length(text) - SAMPLE_CHARS + 1, F.lit(1)).cast("long")) + 1
    rows = docs.filter(lowest(hashed, SAMPLE_DOCS, docs.count())).select(
        hashed.alias("h"), F.substring(text, offset.cast("int"), F.lit(SAMPLE_CHARS)).alias("t")).orderBy("h", "t").limit(SAMPLE_DOCS)
    lines = rows.select(F.explode(F.split("t", "\n")).alias("line")).filter(F.trim("line") != "")
    return [r["line"] for r in lines.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES).collect()]


def scan_column(scanner: Scanner, text: Column) -> Column:
    names = ("start", "end", "family", "probability", "similarity", "confirmed")

    @F.pandas_udf("array<struct<start:int,end:int,family:string,probability:double,similarity:double,confirmed:boolean>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, x, strict=True)) for x in scanner.scan(t or "")] for t in texts], dtype=object)

    return run(text)


def scan(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence line: id, start and end (code points), family,
    probability, template similarity, confirmed."""
    scanner = scanner or fit(sample_paragraphs(docs, id_col, text_col), common_words(docs, text_col))
    return docs.select(F.col(id_col), F.explode(scan_column(scanner, F.col(text_col))).alias("s")).select(id_col, "s.*")


@query("op5_licenses")
def op5(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
