"""Candidate pairs for a token-set score, complete for its threshold.

A pair can reach the score in two ways, and each implies a shared key.

*Common subsequence.* Both texts, as sorted tokens, are at most d insertions and
deletions apart, d being at most e (m + n) for lengths m and n and e = 1 -
score / 100. One of these changes the count of one letter, so when the letters are
dealt over d + 1 parts, one part holds the same letters in both texts (pigeonhole):
a text has a key for each part, for each d that its length and another that fits it
allow. Parts are dealt so that each tells texts apart about as well. Texts so long
that d would reach PARTS, and scores of 92 or less, go by grams: a letter touches at
most q of the q-grams of the tokens (padded by a space, repeats numbered), so of the
grams of a text, in any fixed order, the first q * 2e / (1 - e) * m + 1 hold one that
both texts put first: a prefix filter. Lengths must also fit. Grams stay inside
tokens, so the order of words is of no importance. Trigrams are enough while 12 e <
1 - e, bigrams up to e = 0.2; below a score of 80 no gram is implied, and all texts
share one key.

*Containment.* One text's tokens are in the other but for a few letters. Its
rarest tokens, as long together as what may be missing, hold one that the other
text has among all its tokens. A frequent token that is nobody's rarest is no key.

The order is rarest first, by counts over all texts of which the tasks are told
the TOLD most frequent: it decides what a candidate costs, never what is found.

A key that makes over CROWD * CROWD pairs in one unit is narrowed by a second
text's keys, so a word that all titles have makes no pairs on its own. Keys are
hashed with their unit; a collision adds a candidate and loses none.

*Letters.* Each entry carries 64 bits of the letters of either text, the k-th of a
kind being one of them. A bit that only one text has is a letter that only it has, so
bits bound the distance from below, and pairs that cannot score enough by one of the
texts are dropped where their keys meet, before they are shuffled.

A side that explodes its keys is many times its file, which is what Spark plans
by: it would be broadcast through the driver, so these joins are merge joins.
"""

from __future__ import annotations

import sys
from collections import Counter
from heapq import heappop, heappush
from math import ceil, floor, log

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.session import looked_up, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOLD, CROWD, PARTS, IDLE = 1 << 16, 1024, 24, 256
SIGNATURE = "struct<grams:array<string>,rare:array<string>,size:int,bits:bigint>"


def slack(at_least: float) -> float:
    return 1 - at_least / 100


def gram_size(at_least: float) -> int | None:
    e = slack(at_least)
    return 3 if 12 * e < 1 - e else 2 if e <= 0.2 else None


def padded_grams(tokens: Column, q: int) -> Column:
    return F.flatten(F.transform(tokens, lambda w: F.transform(
        F.sequence(F.lit(1), F.char_length(w) + 3 - q), lambda i: F.substr(F.concat(F.lit(" "), w, F.lit(" ")), i, F.lit(q)))))


def frequent(items: Column, rows: DataFrame) -> dict[str, int]:
    """The most frequent items of an array column, TOLD at most."""
    counts = rows.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return {r["item"]: r["n"] for r in counts.where("n > 1").orderBy(F.desc("n"), "item").limit(TOLD).collect()}


def letter_counts(tokens: Column) -> Column:
    """Letter and how often the text has it, one item for each letter, and an
    empty item for the text."""
    letters = F.split(F.array_join(tokens, ""), "")
    return F.transform(F.array_distinct(F.array_append(letters, F.lit(""))), lambda c: F.when(c == "", c).otherwise(F.concat(
        c, F.size(F.filter(letters, lambda x: x == c)).cast("string"))))


def letter_weights(counts: dict[str, int]) -> dict[str, float]:
    """How well the count of a letter tells texts apart: its entropy."""
    texts = counts.get("", 1)
    kinds: dict[str, list[int]] = {}
    for item, n in counts.items():
        if item:
            kinds.setdefault(item[0], []).append(n)
    return {c: sum(n * log(texts / n) for n in (*ns, texts - sum(ns)) if 0 < n < texts) / texts for c, ns in kinds.items()}


def dealt_letters(weights: dict[str, float], parts: int) -> dict[str, int]:
    """The part of each letter: the heaviest first, to the lightest part."""
    loads, dealt = [(0.0, k) for k in range(parts)], {}
    for c in sorted(weights, key=lambda c: (-weights[c], c)):
        load, k = heappop(loads)
        dealt[c] = k
        heappush(loads, (load + weights[c], k))
    return dealt


def allowed(n: int, e: float) -> list[int]:
    """The distances that a text of n letters may have from another that fits it."""
    k = (1 - e) / (1 + e)
    fit = range(max(0, floor(n * k) - 1), ceil(n / k) + 2)
    return sorted({floor(e * (n + m) + 1e-9) for m in fit if abs(n - m) <= e * (n + m) + 1e-9})


def letter_parts(tokens: list[str], distances: list[int], dealt: dict[int, dict[str, int]], weights: dict[str, float]) -> list[str]:
    counts = sorted(Counter("".join(tokens)).items())
    keys = []
    for d in distances:
        if d + 1 not in dealt:
            dealt[d + 1] = dealt_letters(weights, d + 1)
        part, held = dealt[d + 1], [""] * (d + 1)
        for c, n in counts:
            held[part.get(c, ord(c) % (d + 1))] += f"{c}{n}"
        keys += [f"{d}.{k}:{text}" for k, text in enumerate(held)]
    return keys


def gram_prefix(tokens: list[str], q: int, e: float, counts: dict[str, int]) -> list[str]:
    seen: Counter = Counter()
    grams = []
    for w in tokens:
        w = f" {w} "
        for i in range(len(w) - q + 1):
            gram = w[i:i + q]
            seen[gram] += 1
            grams.append((counts.get(gram, 0), gram, seen[gram]))
    length = sum(map(len, tokens)) + len(tokens) - 1
    keep = q * floor(2 * e / (1 - e) * length + 1e-9) + 1
    return [f"{k}:{gram}" for _, gram, k in sorted(grams)[:keep]]


def rare_tokens(tokens: list[str], e: float, counts: dict[str, int]) -> list[str]:
    """Tokens, rarest first, until they are longer than what may be missing."""
    length, k = sum(map(len, tokens)) + len(tokens) - 1, 2 * e / (1 - e)
    room, out = floor(k / (1 + k) * length + 1e-9), []
    for w in sorted(tokens, key=lambda w: (counts.get(w, 0), -len(w), w)):
        out.append(w)
        room -= len(w) + 1
        if room < 0:
            break
    return out


def letter_bits(tokens: list[str]) -> int:
    """64 bits of the letters, as a signed number."""
    seen: Counter = Counter()
    bits = 0
    for c in "".join(tokens):
        seen[c] += 1
        bits |= 1 << (37 * ord(c) + 11 * seen[c]) % 64
    return bits - (1 << 64) if bits >> 63 else bits


def may_score(e: float, n: Column, m: Column, x: Column, y: Column) -> Column:
    """Whether texts of lengths n and m with letter bits x and y may be similar
    enough: e (n + m) letters apart, or one lacks so few of the other's letters
    that these may be tokens beside shared ones (none: it may contain them)."""
    less, more = F.bit_count(x.bitwiseAND(F.bitwise_not(y))), F.bit_count(y.bitwiseAND(F.bitwise_not(x)))

    def beside(lost: Column, size: Column) -> Column:
        return lost <= F.greatest(F.lit(0.0), (F.lit(e) * (size * 2 - 1) - 1) / F.lit(1 + e)) + F.lit(1e-6)

    return (less + more <= F.lit(e) * (n + m) + F.lit(1e-6)) | beside(less, n) | beside(more, m)


def with_signature(entries: DataFrame, tokens: str, at_least: float, out: str) -> DataFrame:
    """Add the keys that ``tokens`` (distinct, sorted) of an entry imply."""
    q, e = gram_size(at_least), slack(at_least)
    limit = PARTS if q == 3 else 0
    words = frequent(F.col(tokens), entries)
    grams = frequent(padded_grams(F.col(tokens), q), entries) if q else {}
    weights = letter_weights(frequent(letter_counts(F.col(tokens)), entries)) if limit else {}

    @F.arrow_udf(SIGNATURE)
    def signature(lists: pa.Array) -> pa.Array:
        rows, dealt, lengths = [], {}, {}

        def keys(ts: list[str], size: int) -> list[str]:
            if not q:
                return ["*"]
            if size not in lengths:
                lengths[size] = allowed(size, e)
            near = [d for d in lengths[size] if d < limit]
            far = gram_prefix(ts, q, e, grams) if len(near) < len(lengths[size]) else []
            return letter_parts(ts, near, dealt, weights) + far

        for ts in lists.to_pylist():
            ts = ts or []
            size = sum(map(len, ts)) + max(0, len(ts) - 1)
            rows.append({"grams": keys(ts, size) if ts else [], "rare": rare_tokens(ts, e, words) if ts and q else [],
                         "size": size, "bits": letter_bits(ts)})
        kind = pa.struct([("grams", pa.list_(pa.string())), ("rare", pa.list_(pa.string())), ("size", pa.int32()), ("bits", pa.int64())])
        return pa.array(rows, kind)

    return entries.withColumn(out, signature(F.col(tokens)))


def idle_words(keyed: DataFrame) -> list[str]:
    """Of the IDLE most frequent tokens those that are no entry's rare token."""
    words = keyed.select(F.explode("t").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(IDLE)
    rare = keyed.select(F.explode("_t.rare").alias("w")).distinct()
    return [r["w"] for r in F.broadcast(words).join(rare, "w", "left_anti").collect()]


def _tagged(tag: str, items: Column) -> Column:
    return F.transform(items, lambda x: F.concat(F.lit(tag), x))


def pairs(entries: DataFrame, at_least: float, exact: list[Column], other_at_least: float) -> DataFrame:
    """``entries`` (unit, id, t, a: tokens of the scored text and of the second
    one) to pairs (i, j), i < j, of ids. Every pair of a unit is among them that
    scores ``at_least`` by t and either equals in one of ``exact`` (non-null
    columns) or scores ``other_at_least`` by a."""
    # Written once: each of the sides below reads it.
    named = entries.withColumns({f"_e{k}": c for k, c in enumerate(exact)})
    keyed = written(with_signature(with_signature(named, "t", at_least, "_t"), "a", other_at_least, "_a"), "keys")
    equal = [f"_e{k}" for k in range(len(exact))]
    same = F.array_compact(F.array(*[F.concat(F.lit(f"{c}:"), c) for c in equal]))
    idle = idle_words(keyed)
    words = F.array_except("t", F.array(*map(F.lit, idle))) if idle else F.col("t")
    first = {"l": F.concat(_tagged("g", F.col("_t.grams")), _tagged("w", F.col("_t.rare"))),
             "r": F.concat(_tagged("g", F.col("_t.grams")), _tagged("w", words))}
    both = F.concat(same, _tagged("g", F.col("_a.grams")))
    second = {"l": F.concat(both, _tagged("l", F.col("_a.rare")), _tagged("r", F.col("a"))),
              "r": F.concat(both, _tagged("l", F.col("a")), _tagged("r", F.col("_a.rare")))}
    told = ["id", "size", "bits", "other_size", "other_bits", *equal]

    def cells(side: str) -> DataFrame:
        rows = keyed.select("unit", F.struct("id", "_t.size", "_t.bits", F.col("_a.size").alias("other_size"), F.col("_a.bits").alias("other_bits"),
                                             *[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in equal]).alias("of"),
                            second[side].alias("more"), F.explode(first[side]).alias("key"))
        # Only grams and parts bound the lengths.
        return rows.select("of", "more", F.col("key").startswith("g").alias("gram"), F.xxhash64("unit", "key").alias("key"))

    # Written once: both sides look it up.
    counted = cells("l").select("key", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        cells("r").select("key", F.lit(0).alias("l"), F.lit(1).alias("r"))).groupBy("key").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    crowded = looked_up(written(counted.where(F.col("l") * F.col("r") > CROWD * CROWD).select("key", F.lit(True).alias("full")), "crowded"))

    def narrowed(side: str) -> DataFrame:
        rows = cells(side).join(crowded, "key", "left")
        subs = F.when(F.col("full"), F.col("more")).otherwise(F.array(F.lit("")))
        return rows.select("of.*", "gram", "key", "full", F.explode(subs).alias("sub")).select(
            *[F.col(c).alias(f"{side}_{c}") for c in (*told, "gram")],
            F.when(F.col("full"), F.xxhash64("key", "sub")).otherwise(F.col("key")).alias("key"))

    def column(name: str) -> tuple[Column, Column]:
        return F.col(f"l_{name}"), F.col(f"r_{name}")

    (i, j), (n, m), (x, y) = column("id"), column("size"), column("bits")
    fits = F.abs(n - m) <= F.lit(slack(at_least) + 1e-9) * (n + m)
    # Texts meet in a part or gram on both sides, so one order is enough.
    meets = F.when(F.col("l_gram") & F.col("r_gram"), (i < j) & fits).otherwise(i != j)
    second_too = may_score(slack(other_at_least), *column("other_size"), *column("other_bits"))
    for c in equal:
        a, b = column(c)
        second_too = second_too | F.coalesce(a == b, F.lit(False))
    met = narrowed("l").join(narrowed("r").hint("merge"), "key").where(meets & may_score(slack(at_least), n, m, x, y) & second_too)
    return met.select(F.least(i, j).alias("i"), F.greatest(i, j).alias("j")).distinct()
