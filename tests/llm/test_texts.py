"""Operators that look at one text at a time, against plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import regex

from pulcra.llm import chat, decontam, licenses, pii, quality, toxicity

TEXTS = [
    (1, "a@b.c_d@e.f x@y.z@w.q a.b@c 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 +1 (23) 456-7890- 4111 1111 1111 1111 4111-1111-1111-1111-"),
    (2, None), (3, ""), (4, "9" * 30000 + " " + "a" * 30000 + "@"), (5, "\x01a@b.cd\x01😀é 4111111111111111😀+49 30 123456"),
    (6, "1 2 3 " * 3000), (6, "1 2 3 " * 3000), (None, "me@x.org"),
]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_pii_base_spans(spark):
    rows = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, spans string")
    got = pii.digest(pii.spans(rows)).collect()
    assert len(got) == len(TEXTS)
    want = {i: base(t or "") for i, t in TEXTS}
    for r in got:
        assert r["spans"] == want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
    assert pii.digest(pii.spans(rows.limit(0))).count() == 0


def test_pii_terms_that_tell(spark):
    near = [(k, f"Call Zebrafink at bob@x.org about item{k} Today") for k in range(4)]
    far = [(k, f"Today nothing about item{k}") for k in range(10, 40)]
    rows = spark.createDataFrame([*near, *far], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(pii.spans(rows)).collect()}
    assert spans[0] == "email:18:27,term:0:4,term:5:14"  # Call and Zebrafink tell, about and Today do not
    assert spans[10] == ""
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(rows).collect()}
    assert "Zebrafink" not in texts[0] and "[EMAIL]" in texts[0] and "about item0 Today" in texts[0]
    assert texts[10] == far[0][1]


def plain_terms(rows):
    """Term spans of each row, straight from the definitions."""
    words, held = [], []
    for _, t in rows:
        t = t or ""
        mails = [(m.start(), m.end()) for m in EMAIL.finditer(t)]
        words.append([(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}{4,}", t)
                      if not any(a < m.end() and m.start() < b for a, b in mails)])
        units = set()
        for kind, a, b in (x.split(":") for x in base(t).split(",") if x):
            value = t[int(a):int(b)].lower()
            units.add((kind, value))
            if kind == "email":
                units |= {("local", value.split("@")[0]), ("host", value.split("@")[1])}
        held.append(units)
    n = len(rows)
    have = [{w for *_, w in ws} for ws in words]
    df = Counter(w for ws in have for w in ws)
    de = Counter(u for us in held for u in us)
    both = Counter((w, u) for ws, us in zip(have, held, strict=True) for w in ws for u in us)

    def told(w, u):
        if de[u] == n:
            return -1
        m, z = df[w], pii.Z ** 2
        p = both[w, u] / m
        low = (p + z / (2 * m) - pii.Z * math.sqrt(p * (1 - p) / m + z / (4 * m * m))) / (1 + z / m)
        return math.log2(n * low / de[u]) / math.log2(n / de[u])

    return [",".join(f"term:{a}:{b}" for a, b, w in ws if any(told(w, u) >= pii.GENERALISE for u in us))
            for ws, us in zip(words, held, strict=True)]


def test_pii_terms_against_brute_force(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeé"), int(rng.integers(3, 9)))) for _ in range(1500)]
    mails = [f"{a}@{h}" for a in ("anna.b", "carl", "dora") for h in ("one.org", "two.org", "three.net")]
    rows = []
    for k in range(150):
        text = [words[int(1500 * rng.random() ** 2)] for _ in range(int(rng.integers(5, 40)))]
        for _ in range(int(rng.integers(0, 3))):
            text.insert(int(rng.integers(0, len(text))), str(rng.choice([*mails, "4111111111111111", "10.0.0.7", f"u{k}@one.org"])))
        rows.append((k if k % 9 else None, " ".join(text)))
    rows += [(200, rows[3][1]), (200, rows[3][1]), (300, None)]
    # An address that one document holds protects a name at its other end.
    rows.append((400, "Zebrafink " + "the way " * 3000 + "zebrafink lone@solo.org"))
    rows.append((500, " ".join(f"m{i}@list.org" for i in range(300)) + " uniqueword " + " ".join(words[:150])))
    want = plain_terms(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, term int").repartition(5)
    got = pii.digest(pii.spans(docs)).collect()
    base_of = lambda t: base(t or "")
    whole = sorted((str(i), ",".join(x for x in (base_of(t), w) if x)) for (i, t), w in zip(rows, want, strict=True))
    assert sorted((str(r["doc_id"]), r["spans"]) for r in got) == whole
    spans = dict(zip([i for i, _ in rows], want, strict=True))
    assert spans[400].startswith("term:0:9,") and spans[400].count(",") == 1 and "term" in spans[500]
    assert sum(bool(w) for w in want) > 10 and any(base_of(t) and not w for (_, t), w in zip(rows, want, strict=True))


def test_pii_masks_addresses_before_words(spark):
    rows = spark.createDataFrame([(1, "éabcd@x.org.zwerg wort"), (2, "nichts hier")], "doc_id long, text string")
    found = {r["_id"]: r["_masked"] for r in pii.found_spans(rows, "doc_id", "text").collect()}
    assert found == {1: "é" + "\x02" * len("abcd@x.org.zwerg") + " wort", 2: None}


CHATS = [
    (1, 0, "system", "s"), (1, 1, "user", "<|x <\\| <\\\\| <"), (1, 2, "assistant", "|> \\<|"), (2, 1, "assistant", "early"),
    (2, 0, None, None), (3, 0, "us\ner\\n<|", "a"), (None, 0, "user", ""), (None, 1, "assistant", "é😀"), (4, 0, "user", "u"), (4, 0, "user", "u"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*c, 1) for c in CHATS], "conv_id long, turn long, role string, text string, formatted int")
    chats = chat.format_chats(rows)
    got = {r["conv_id"]: r for r in chat.digest(chats).collect()}
    plain = {r["conv_id"]: r for r in chats.collect()}
    for conv in {c[0] for c in CHATS}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in CHATS if c == conv)
        want = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == len(plain[conv]["formatted"])
        assert plain[conv]["formatted"].count("<|") == 2 * len(turns)
    ends = {c: (got[c]["valid"], got[c]["complete"], plain[c]["error_turn"]) for c in got}
    assert ends == {1: (True, True, None), 2: (False, False, 0), 3: (False, False, 0), None: (True, True, None), 4: (False, False, 1)}


def windows(text, item):
    """Best similarity over all windows of the item's size, by brute force."""
    size = min(5, len(item.split()))
    h, own = decontam.hashes(text, size, short=False), decontam.hashes(item, size)
    starts = range(max(1, len(h) - len(own) + 1))
    return max((decontam.similarity(h[s:s + len(own)], own) for s in starts if len(h)), default=0)


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 5000, n)]
    items = [words(n) for n in (3, 20, 45, 60)]
    docs = [None, "", "w1 w2", " ".join(items[0]), " ".join(items[1]).upper() + "!"]
    for item in items[1:]:
        for changed in (0, 1, 2, 4):
            copy = list(item)
            for i in rng.integers(0, len(copy), changed):
                copy[i] = "other"
            docs.append(" ".join(words(300) + copy + words(5000)))
        docs.append(" ".join(item[:int(0.95 * len(item))]))
    docs.append(" ".join(words(20000)))
    rows = spark.createDataFrame([(i, d, i) for i, d in enumerate(docs)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([*[(i, " ".join(w)) for i, w in enumerate(items)], (8, None), (9, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.leaks(rows, bench).collect()}
    want = {(d, i): s for d, t in enumerate(docs) for i, w in enumerate(items) if (s := windows(t or "", " ".join(w))) >= 0.8}
    assert got == pytest.approx(want) and len(want) == 9
    kept = {r["doc_id"] for r in decontam.clean_rows(rows, bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in want}
    assert decontam.leaks(rows, bench.limit(0)).count() == 0 == decontam.leaks(rows.limit(0), bench).count()


def test_multi_index_finds_every_pair_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints[1] = prints[0]
    near = [p ^ np.bitwise_or.reduce(np.uint64(1) << rng.permutation(64)[:n].astype(np.uint64))
            for p in prints for n in (1, 8, 15, 22, 23, 24, 25)]
    probes = np.array([*prints, *near], np.uint64)
    index = decontam.SizeIndex(np.arange(100, 140), prints)
    apart = np.bitwise_count(probes[:, None] ^ prints[None])
    want = sorted((int(w), int(k) + 100, int(apart[w, k])) for w, k in np.argwhere(apart <= decontam.RADIUS))
    assert index.near(probes) == want and len(want) > 200
    assert index.near(probes[:0]) == []


def test_short_items_are_found_inside_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 40)  # several blocks of the index
    monkeypatch.setattr(decontam, "BATCH_BYTES", 30)
    items = [(1, "What is two plus"), (2, "unu"), (3, "what is"), (3, "what is"), (4, "one two three four five six"), (None, "unu")]
    docs = [(1, "so: what is two plus two? " + "x " * 500 + "what is two"), (2, "unu"), (2, "unu"), (None, "nothing of that"), (3, "what"), (4, None),
            (5, "zero one two three four five six seven")]
    rows = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(str, ((r["doc_id"], r["item_id"], r["start_word"], r["words"], r["similarity"]) for r in decontam.leaks(rows, bench).collect())))
    want = [(1, 1, 1, 4, 1.0), (1, 3, 1, 2, 1.0), (1, 3, 1, 2, 1.0), (5, 4, 1, 6, 1.0)]
    want += [(2, i, 0, 1, 1.0) for i in (2, None) for _ in range(2)]
    assert got == sorted(map(str, want))
    assert len(decontam.index_blocks(decontam.named_items(bench))) > 1
    kept = decontam.clean_rows(rows, bench)
    assert kept.columns == rows.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "None"]


def test_every_window_at_the_threshold_is_found():
    """2,000 windows at a similarity of 0.80 to 0.85: recall 1."""
    rng, seen = np.random.default_rng(9), 0
    while seen < 2000:
        item = [f"w{i}" for i in rng.integers(0, 5000, int(rng.integers(14, 120)))]
        index, copies = decontam.Index([(1, " ".join(item))]), []
        for _ in range(40):
            copy = list(item)
            for at in rng.integers(0, len(copy), int(rng.integers(1, 5))):
                copy[at] = "other"
            low, high = int(rng.integers(0, 4)), int(rng.integers(0, 4))
            copies.append(" ".join(copy[low:len(copy) - high]))
        for copy in copies:
            text = f"a b c d {copy} e f g h"
            score = windows(text, " ".join(item))
            if 0.8 <= score < 0.85:
                seen += 1
                assert [m[4] for m in index.matches(text)] == [pytest.approx(score)]
            elif score < 0.8:
                assert index.matches(text) == []


def test_decontamination_of_shared_passages_and_repeated_items():
    words = [f"w{i}" for i in range(40)]
    item, other = " ".join(words), " ".join(words[:20] + [f"v{i}" for i in range(20)])
    index = decontam.Index([(1, item), (2, other), (3, item)])
    assert [m[0] for m in index.matches(f"before {item} after")] == [1, 3]
    assert [m[0] for m in index.matches(f"{item} {other}")] == [1, 2, 3]
    assert index.matches(" ".join(words[:20])) == [] and index.matches(item)[0][1:] == (0, 40, 0, 1.0)
    many = index.matches(f"{item} " * 500)
    assert [(m[0], m[1], m[4]) for m in many] == [(1, 0, 1.0), (3, 0, 1.0)]


def test_quality_network_learns_and_covers_the_text(spark):
    rng = np.random.default_rng(1)
    good = lambda n: " ".join("".join(rng.choice(list("aeiounrst"), rng.integers(2, 8))) for _ in range(n))
    bad = lambda n: " ".join(w.upper() + "!!" for w in good(n).split())
    texts = [f(int(rng.integers(10, 300))) for _ in range(150) for f in (good, bad)]
    net = quality.fit([t.encode() for t in texts], [1, 0] * 150, 0.8)
    fresh = [f(int(rng.integers(10, 300))).encode() for _ in range(50) for f in (good, bad)]
    assert ((net.scores(fresh) >= 0.5) == ([True, False] * 50)).mean() > 0.95
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        starts = quality.chunk_starts(n)
        seen = {i for s in starts for i in range(s, min(n, s + quality.CHUNK))}
        assert seen == set(range(n)) and all(a < b for a, b in zip(starts, starts[1:], strict=False))
    one = net.scores([fresh[0]])
    assert np.allclose(net.scores(fresh)[0], one)
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x" * 5, "c"), (3, texts[0] * 40, "d")], "doc_id long, text string, score string")
    got = quality.score(rows, net).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(rows, nothing).scores([b"x"])[0] == 0.5
    assert toxicity.train(rows, nothing).score("x") == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_is_edit_distance():
    rng = np.random.default_rng(5)
    terms = ["idiot", "worthless", "scum", "moron", "pathetic"]
    entries = [(t, False, int(toxicity.edits_allowed(t, False)), 5.0) for t in terms]
    auto = toxicity.Automaton(entries)
    for _ in range(4000):
        word = list(terms[rng.integers(len(terms))])
        for _ in range(rng.integers(0, 4)):
            i, kind = int(rng.integers(len(word) + 1)), rng.integers(3)
            word[i:i + (kind > 0)] = [] if kind == 2 else [chr(97 + int(rng.integers(26)))]
        word = "".join(word)
        want = min((distance(word, t) for t, _, e, _ in entries if distance(word, t) <= e), default=None)
        hit = auto.find(word)
        assert (hit[1] if hit else None) == want
        if hit:
            assert distance(word, terms[hit[0]]) == hit[1]
    stem = toxicity.Automaton([("lowei", True, 0, 1.0)])
    assert stem.find("loweichen") == (0, 0) and stem.find("lowei") == (0, 0) and stem.find("lowe") is None


def test_toxicity_learns_misspelling_and_quotation(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("aeiounrst"), 5)) for _ in range(300)]
    plain = lambda n: [vocabulary[i] for i in rng.integers(0, 300, n)]
    texts, labels = [], []
    for k in range(200):
        w = plain(40)
        if k % 4 == 0:
            for i in rng.integers(0, 40, 3):
                w[i] = ["pathetic", "worthless", "clown"][rng.integers(3)]
        texts.append(" ".join(w))
        labels.append(int(k % 4 == 0))
    model = toxicity.fit(texts, labels, 0.2)
    assert {e[0] for e in model.entries} == {"pathetic", "worthless", "clown"}
    clean, rude = " ".join(plain(30)), " ".join([*plain(14), "you", "worthles", *plain(14), "patetic"])
    quoted = " ".join([*plain(14), 'said the word "worthles"', *plain(14)])
    assert model.score(clean) < 0.3 <= model.score(rude) and model.score(quoted) < model.score(rude)
    rows = spark.createDataFrame([(1, rude, 0.0), (2, None, 0.0), (None, "", 0.0)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(rows, model).collect()}
    assert got == {1: 1, 2: 0, None: 0}
    assert [(r["entry"], r["edits"]) for r in toxicity.hit_table(rows, model).orderBy("start").collect()] == [("worthless", 1), ("pathetic", 1)]


def test_licences(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("aeiounrst"), 5)) for _ in range(500)]
    plain = lambda n: " ".join(vocabulary[i] for i in rng.integers(0, 500, n))
    scanner = licenses.fit([plain(12) for _ in range(300)])
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            text = plain(20) + "\n" + notice + "\n" + plain(9)
            found = scanner.scan(text)
            assert [(f[2], f[5]) for f in found] == [(family, True)], notice
            assert text[found[0][0]:found[0][1]] == notice
    wrong = [s for s in licenses.COUNTER_EXAMPLES if scanner.scan(s)]
    assert not wrong and not any(scanner.scan(plain(30)) for _ in range(200))
    near = scanner.scan("This file is licensed to you under the Apache License, Version 2.0, see below")
    assert near and near[0][2] == "Apache-2.0"
    rows = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "All rights reserved.", 3)], "doc_id long, text string, start int")
    assert [(r["doc_id"], r["family"]) for r in licenses.scan(rows, scanner).collect()] == [(None, "proprietary")]
    assert licenses.scan(rows.limit(0)).count() == 0


def test_licence_probabilities_and_similarity_against_plain_loops():
    rng = np.random.default_rng(8)
    scanner = licenses.fit([" ".join(f"w{i}" for i in rng.integers(0, 90, 12)) for _ in range(120)])
    for line in ("Released under the MIT License, w1 w2", "software software is provided as is", "w1 w2 w3", "the software"):
        words = licenses.words_of(line)
        counts = Counter(g for n in (1, 2, 3) for i in range(len(words) - n + 1)
                         if (g := tuple(words[i:i + n])) in scanner.vocabulary and any(w in scanner.content for w in g))
        norm = math.sqrt(sum(counts.values())) or 1.0
        z = [float(scanner.bias[k]) + sum(math.sqrt(n) / norm * float(scanner.weights[scanner.vocabulary[g], k]) for g, n in counts.items())
             for k in range(len(scanner.families))]
        e = [math.exp((v - max(z)) / scanner.temperature) for v in z]
        assert scanner.probabilities(words).tolist() == pytest.approx([v / sum(e) for v in e])
        for family, texts in licenses.TEMPLATES.items():
            best = 0.0
            for own in map(licenses.words_of, texts):
                a, b = ([(x[i], x[i + 1]) for i in range(len(x) - 1)] for x in (own, words))
                both = sum(min(a.count(p), b.count(p)) for p in set(a))
                best = max(best, both / max(1, len(a)), both / max(1, len(b)) if len(words) >= 6 else 0)
            assert scanner.similarity(family, words) == pytest.approx(best)


def test_common_words_come_from_whole_texts_of_all_documents(spark, monkeypatch):
    notice = licenses.TEMPLATES["MIT"][0]
    texts = ["first " + "filler " * 3000 + "last", f"first line\n{notice}\nlast", None, "", "other words", notice]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(4)
    counts = {r["word"]: r["n"] for r in licenses.word_counts(rows).collect()}
    assert counts == {"first": 6, "filler": 3, "last": 6, "line": 3, "other": 3, "words": 3}
    monkeypatch.setattr(licenses, "MIN_SHARE", 0.3)
    assert licenses.common_words(rows) == {"first", "last"}
    assert licenses.common_words(rows.limit(0)) == frozenset()
    monkeypatch.setattr(licenses, "SAMPLE_CHARS", 40)
    lines = licenses.sample_paragraphs(rows)
    assert len(lines) <= licenses.SAMPLE_LINES and any(not line.startswith("first") for line in lines)


def test_quality_forward_pass_against_plain_loops():
    net, rng = quality.Network(3), np.random.default_rng(2)
    w = {k: v.astype(float) for k, v in net.w.items()}
    for n in (0, 1, 5, 8, 300, 512, 513, 1400):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        starts = [0] if n <= 512 else [*range(0, n - 512, 448), n - 512]
        assert quality.chunk_starts(n) == starts
        hidden = []
        for start in starts:
            part = data[start:start + 512]
            padded = [*part, *[256] * (512 - len(part))]
            pooled = []
            for f in range(quality.FILTERS):
                best = -1e9
                for at in range(0, 512 - quality.WINDOW + 1, quality.STRIDE):
                    if at < len(part):
                        best = max(best, sum(w["e"][padded[at + i]] @ w["f"][i * quality.EMBED:(i + 1) * quality.EMBED, f] for i in range(quality.WINDOW)))
                pooled.append(max(best + w["fb"][f], 0))
            size = quality._size(np.array([len(part)]))[0]
            hidden.append(np.maximum(np.array([*pooled, *size]) @ w["h"] + w["hb"], 0))
        z = np.mean(hidden, axis=0) @ w["o"] + w["ob"][0]
        assert net.scores([data])[0] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4), n


def test_toxicity_learns_short_words():
    rng = np.random.default_rng(12)
    words = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for k in range(120):
        text = [words[i] for i in rng.integers(0, 200, 30)]
        if k % 3 == 0:
            for bad in ("fu", "狗"):
                text.insert(int(rng.integers(0, len(text))), bad)
        texts.append(" ".join(text))
        labels.append(int(k % 3 == 0))
    model = toxicity.fit(texts, labels, 0.3)
    found = {e[0]: e[2] for e in model.entries}
    assert found.get("fu") == 0 and found.get("狗") == 0
    assert model.score("word1 fu word2") > 0.3 > model.score("word1 fx fun word2")
