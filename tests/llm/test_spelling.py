"""Spelling variants against plain versions."""

import zlib
from collections import Counter

import numpy as np
import pytest

from pulcra.llm import spelling


def plain_words(rows):
    out = Counter()
    for i, t in rows:
        run = []
        for c in (t or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run.append(c.lower() if c.isascii() else c)
            elif run:
                w = "".join(run)
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                if h % 31 == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
                out[w] += 1
                run = []
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(rows):
    vocab = plain_words(rows)
    form, near = {}, {}
    for w, n in vocab.items():
        found = [x for x in vocab if is_near(w, x)]
        near[w] = len(found)
        best = min(found, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= 10 * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, near[w], form[w], vocab.get(form[w]), root))
    return sorted(out)


def rows_of(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    letters = list("abdeéèÿ×÷à")
    base = ["".join(rng.choice(letters, int(rng.integers(7, 12)))) for _ in range(40)] + ["aaaaaaa", "a" * 60, "b" * 61]
    out = [(None, None), (1, ""), (2, "short words only"), (None, "aaaaaaa aaaaaaab"), (3, "x" * 40000 + " " + "x" * 40000 + " " + "x" * 39999)]
    for k in range(400):
        text = []
        for _ in range(30):
            w = base[int(len(base) * rng.random() ** 3)]
            for _ in range(int(rng.integers(0, 3)) if rng.random() < 0.2 else 0):
                at, kind = int(rng.integers(0, len(w))), rng.integers(0, 3)
                w = w[:at] + ("" if kind == 0 else str(rng.choice(letters))) + w[at + (kind != 1):]
            text.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        out.append((k % 300, "-1 ".join(text)))
    return out


@pytest.mark.parametrize("size", [1 << 20, 7])
def test_variants_against_brute_force(spark, rows, size, monkeypatch):
    """Also with slices of seven blocks, which take many rounds."""
    if size == 7:
        rows = rows[:60]
    monkeypatch.setattr(spelling, "SLICE", size)
    monkeypatch.setattr(spelling, "CELLS", 5000)
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, word string")
    want = plain_variants(rows)
    assert rows_of(spelling.variants(docs)) == want
    assert len(want) > 20 and any(r[3] for r in want) and any(r[2] > 1 for r in want)


def test_chains_of_forms(spark):
    rows = [(1, " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 20 + ["abcdefyx"] * 200 + ["abcdzfyx"] * 2000 + ["abqdzfyx"] * 20000))]
    for i in range(40):  # an id under which none of these words loses a letter
        if len(plain_words([(i, rows[0][1])])) == 5:
            rows = [(i, rows[0][1])]
            break
    got = rows_of(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {r[5] for r in got} == {"abqdzfyx"} and len(got) == 5 and got == plain_variants(rows)


def test_hash_of_an_edit_is_that_of_the_edited_word():
    word = "éabbcdà"
    codes = np.frombuffer(word.encode("latin-1"), np.uint8)[None, :]
    alphabet = np.frombuffer("abcdàéÿ".encode("latin-1"), np.uint8)
    def one(w):
        return int(spelling.hash_of(np.frombuffer(w.encode("latin-1"), np.uint8)[None, :])[0])

    found = {-1: set(), 0: set()}
    for change, _, hashed in spelling.edits(codes, alphabet):
        found[change] |= set(hashed.tolist())
    assert found[-1] == {one(word[:k] + word[k + 1:]) for k in range(len(word))}
    assert found[0] == {one(word[:k] + c + word[k + 1:]) for k in range(len(word)) for c in "abcdàéÿ" if c > word[k]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (None, "")], none.schema)).count() == 0
    lone = spark.createDataFrame([(7, "singleton singleton")], none.schema)
    assert rows_of(spelling.variants(lone)) == plain_variants([(7, "singleton singleton")])
