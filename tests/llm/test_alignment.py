"""Cross-tokenizer alignment against a plain version."""

import hashlib
import os
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulcra.llm import alignment

ROWS = [
    (1, "The quick brown fox, naïve café — 北京 😀 jumps"), (2, None), (3, ""), (4, " "), (5, "a" * 3000 + " tail"), (6, "x▁y"),
    (7, "<|endoftext|> <s> </s> <unk> <0x41>"), (7, "the the the then"), (None, "the quick the"), (8, "  two  spaces\n\n\ttab "),
    (9, "ﬁne ½ ａｂ"), (10, "\x00\x01 null"), (11, "the quick brown fox " * 700), (12, "éèê" * 200), (12, "éèê" * 200), (13, "  x  y"),
]


def plain(both, text):
    """Groups of a text by set arithmetic on the ends."""
    if not text:
        return []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    if any(b"".join(v.entries[i] for i in ids) != (" " + text).encode() for v, ids in ((both.vocab_a, a), (both.vocab_b, b))):
        return []
    ends = []
    for ids, vocab in ((a, both.vocab_a), (b, both.vocab_b)):
        ends.append(np.cumsum([len(vocab.entries[i]) for i in ids]).tolist())
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        x, y = bisect_left(ends[0], cut) + 1, bisect_left(ends[1], cut) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


PAIR = alignment.Pair(*alignment._files(alignment.FOLDER))


@pytest.fixture(scope="module")
def both():
    return PAIR


def test_token_bytes_are_those_of_other_readers(both):
    import base64

    with open(f"{alignment.FOLDER}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in (line.split() for line in f)}
    assert {e: i for i, e in enumerate(both.vocab_a.entries[:50256])} == ranks
    text = "Ünïcode 北京 \x07 <s> text"
    assert both.b.decode(both.b.encode(text)) == text


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab'st \t\n\r\xa0é1½.▁-", max_size=60)))
def test_encoder_gives_the_ids_of_the_file(text):
    assert PAIR.encode_a(" " + text).tolist() == PAIR.a.encode(" " + text, add_special_tokens=False).ids


def test_ranks_agree_on_every_usual_character():
    usual = [c for c in map(chr, range(0x2100)) if not alignment.UNUSUAL.search(c)]
    assert PAIR.ranks is not None and len(usual) > 600
    for c in usual:
        text = f" {c} a{c}b{c}{c} 1{c}2 .{c}! {c}{c}\n{c}"
        assert PAIR.encode_a(text).tolist() == PAIR.a.encode(text, add_special_tokens=False).ids, hex(ord(c))


@pytest.mark.parametrize("hot", [0, 5, 1 << 16])
def test_alignment_against_brute_force(spark, both, hot, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_ROWS", 5)
    monkeypatch.setattr(alignment, "WIDE", 3)
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, pairs int").repartition(3)
    found = alignment.statistics(alignment.aligned(docs), hot).collect()
    groups = [plain(both, t) for _, t in ROWS]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for n in links for p in n)
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    want = []
    for (i, _), g, n in zip(ROWS, groups, links, strict=True):
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        want.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(n.values()),
            sum(k for p, k in n.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in n.items()),
            hashlib.sha256(told.encode()).hexdigest() if g else ""))
    got = [(r["_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(bool(g) for g in groups) >= 10 and any(len(a) * len(b) > alignment.WIDE for g in groups for a, b in g)


def test_cuts_by_divide_and_conquer_are_all_common_ends():
    rng = np.random.default_rng(4)
    for n, share in ((1, 1), (2, 0.5), (40, 0.2), (3000, 0.05), (3000, 0.9), (5000, 0)):
        a = np.unique(rng.integers(1, 10 * n + 2, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < share], rng.integers(1, 10 * n + 2, n // 2), a[-1:]]))
        b = b[b <= a[-1]]
        assert alignment.shared_cuts(a, b, np.array([len(a)])).tolist() == np.flatnonzero(np.isin(a, b)).tolist()


def test_groups_and_empty_tables(spark, both):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = alignment.groups(docs.filter("doc_id = 8")).orderBy("start").collect()
    assert [(list(r["a"]), list(r["b"])) for r in rows] == plain(both, ROWS[9][1])
    whole = (" " + ROWS[9][1]).encode()
    assert all(both.vocab_a.joined(np.array(r["a"])) == whole[r["start"]:r["end"]] == both.vocab_b.joined(np.array(r["b"])) for r in rows)
    assert alignment.alignment(docs.limit(0)).count() == 0
    assert alignment.alignment(docs.filter("text is null")).first()["groups_sha256"] == ""
    assert os.path.exists(alignment.FOLDER)
