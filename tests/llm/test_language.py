"""Language identification: codes, decoding against plain loops, held-out rows."""

import math
import zlib

import numpy as np
import pytest

from pulcra.llm import language

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 4, 7, 8, 30])
def test_codewords_stand_apart(k):
    code = language.codebook(k)
    assert len(code) == k and (k > 1 or code.shape[1] == 0)
    if k > 1:
        apart = min((code[a] != code[b]).sum() for a in range(k) for b in range(a))
        assert apart * (2 if k <= 7 else 4) > code.shape[1]
        assert (np.abs(code.sum(axis=0)) < k).all()
        assert k > 7 or len({tuple(c) for c in code.T} | {tuple(-c) for c in code.T}) == 2 * code.shape[1]


def plain_features(text):
    counts = {}
    for n in range(1, language.GRAMS + 1):
        for i in range(len(text) - n + 1):
            h = 0
            for j in range(n):
                h = (h * 257 + text[i + j] + j + 1) % (1 << 32)
            bucket = h * 2654435761 % (1 << 32) >> 19
            counts[bucket] = counts.get(bucket, 0) + 1
    total = math.sqrt(sum(counts.values())) or 1
    return {k: math.sqrt(v) / total for k, v in counts.items()}


def test_decoding_against_plain_loops(monkeypatch):
    rng = np.random.default_rng(1)
    words = {lang: ["".join(rng.choice(list(letters), 4)) for _ in range(30)] for lang, letters in
             (("aa", "abcdef"), ("bb", "defghi"), ("cc", "ghijkl"), ("dd", "jklmab"), ("ee", "xyzabc"))}
    texts, langs = [], []
    for k in range(200):
        lang = sorted(words)[k % 5]
        texts.append((" " + " ".join(rng.choice(words[lang], 30)) + " ").encode())
        langs.append(lang)
    model = language.fit(texts, langs)
    fresh = [(" " + " ".join(rng.choice(words[lang], 12)) + " ").encode() for lang in sorted(words) for _ in range(5)] + [b"  ", b"q", texts[0] * 900]
    monkeypatch.setattr(language, "BLOCK", 37)
    got = model.predict(fresh)
    for k, text in enumerate(fresh[:-1]):
        x = plain_features(text)
        far = []
        for word in model.code:
            loss = 0.0
            for bit in range(len(word)):
                margin = sum(v * float(model.w[i, bit]) for i, v in x.items()) + float(model.b[bit])
                loss += float(model.alpha[bit]) * math.log1p(math.exp(-word[bit] * margin))
            far.append(loss)
        share = [math.exp(min(far) - f) for f in far]
        assert got["lang_pred"][k] == model.languages[far.index(min(far))]
        assert got["score"][k] == pytest.approx(max(share) / sum(share), abs=1e-4)
        assert got["ambiguous"][k] == (got["score"][k] < language.AMBIGUOUS)
    assert (got["lang_pred"][:25] == [lang for lang in sorted(words) for _ in range(5)]).mean() > 0.95 and got["lang_pred"][27] == langs[0]


def test_a_wrong_bit_is_corrected():
    code = language.codebook(4)
    model = language.Model(["a", "b", "c", "d"], code, None, None, np.ones(code.shape[1]))
    for k in range(4):
        for bit in range(code.shape[1]):
            margins = 3.0 * code[k]
            margins[bit] *= -1
            assert model.distances(margins[None, :])[0].argmin() == k


def test_held_out_rows_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.languages(docs, language.train(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == r["lang"] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in rows)
    wrong = [r for r in held if r["lang_pred"] != r["lang"]]
    assert sum(r["ambiguous"] for r in wrong) >= 0.5 * len(wrong) - 1
    again = language.languages(docs.drop("lang", "source"), language.train(docs)).orderBy("doc_id").collect()
    assert again == sorted(found.collect(), key=lambda r: r["doc_id"])


def test_defined_cases(spark):
    schema = "doc_id long, text string, lang string, score int"
    rows = [(1, None, "en", 0), (2, "", "en", 0), (3, "12 -- ²", "en", 0), (None, "the words", "fr", 0), (4, "the words of it", "en", 0),
            (4, "the words of it", "en", 0), (6, "any words " * 40000, None, 0)]
    docs = spark.createDataFrame(rows, schema)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.languages(docs, language.train(docs)).collect()]
    assert sorted(got, key=str) == sorted([(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "en", 1.0), (4, "en", 1.0), (4, "en", 1.0), (6, "en", 1.0)], key=str)
    none = docs.limit(0)
    assert language.languages(none, language.train(none)).count() == 0
    nothing = language.languages(docs, language.train(none)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
