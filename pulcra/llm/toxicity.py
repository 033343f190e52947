"""Toxicity: a learned lexicon, found through Levenshtein automata on a trie.

Learning (driver, bounded sample as in ``quality.sample``): words, and stems
with many endings, that toxic rows use in several contexts and other rows do
not. Evidence counts distinct neighbouring words, so copies of one text count
once. Entries form a trie. The automaton of all words within an entry's edit
bound is intersected with the trie and made deterministic lazily: a state is
the set of (trie node, edits) still alive, so a word costs one table lookup per
letter and most die after a few. Entries whose misspellings also occur in rows
that are not toxic lose edits until they do not; words under five letters count
only as they are.

Scoring: every hit weighs by its log odds and edits. Its context window tells
quotation (inside quotation marks, words of reporting or naming nearby) from
abuse (words of address nearby). A logistic unit over the sums of abuse, of
quotation, and of abuse per hundred words gives the probability. Scoring adds
one column to the scan; tables of states and words are bounded.

Defined cases: null text is empty; a text without hits has the same low score
whatever its length; null labels are ignored; without both classes in the
sample the score is the share of the class there is (0 without any label).
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import is_held_out, query, table
from pulcra.llm.quality import sample

THRESHOLD, REACH = 0.3, 8
MIN_CONTEXTS, MIN_ODDS, MIN_ENDINGS, STEM = 4, 2.5, 4, (4, 8)
CACHE, STATES = 200_000, 50_000
_WORD = re.compile(r"\w+")

# Words of reporting or naming, words of address, quotation marks.
REPORTING = frozenset(
    "said says wrote quote quoted quoting called term word slur insult reported according phrase "
    "sagte schrieb zitat wort begriff laut nannte dit écrit citation mot terme selon appelé "
    "dijo escribió cita palabra término según llamó".split())
ADDRESS = frozenset("you your youre u du dich dein dir sie ihr tu toi te ton vous votre tú ti usted eres vosotros".split())
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "‹": "›", "‘": "’"}


class Automaton:
    """Entries (word or stem, edits allowed, weight) as a trie intersected with
    their Levenshtein automata."""

    def __init__(self, entries: list[tuple[str, bool, int, float]]):
        self.entries = entries
        self.kids: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]  # edits that some entry below allows
        for k, (term, _, edits, _) in enumerate(entries):
            node = 0
            self.most[0] = max(self.most[0], edits)
            for c in term:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.kids[node][c]
                self.most[node] = max(self.most[node], edits)
            self.ends[node].append(k)
        self.letters = {c for kids in self.kids for c in kids}
        self._forget()

    def _forget(self):
        self.words: dict[str, tuple | None] = {}
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stems: list[tuple | None] = []
        self.begin = self._state({0: 0})

    def _state(self, alive: dict[int, int]) -> int:
        """Number of a state; ``alive`` maps nodes to fewest edits, closed here
        under skipping letters of an entry."""
        queue = list(alive)
        for node in queue:
            for kid in self.kids[node].values():
                e = alive[node] + 1
                if e <= self.most[kid] and alive.get(kid, 99) > e:
                    alive[kid] = e
                    queue.append(kid)
        key = frozenset(alive.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.stems.append(self._best(key, stem=True))
        return self.ids[key]

    def _best(self, state: frozenset, stem: bool) -> tuple | None:
        """(entry, edits) of largest weight that the state accepts."""
        found = [(k, e) for node, e in state for k in self.ends[node]
                 if e <= self.entries[k][2] and (self.entries[k][1] or not stem)]
        return max(found, key=lambda x: (-x[1], self.entries[x[0]][3], -x[0]), default=None)

    def _step(self, state: int, c: str) -> int:
        alive: dict[int, int] = {}
        for node, e in self.sets[state]:
            for letter, kid in self.kids[node].items():
                cost = e if letter == c else e + 1
                if cost <= self.most[kid] and cost < alive.get(kid, 99):
                    alive[kid] = cost
            if e + 1 <= self.most[node] and e + 1 < alive.get(node, 99):
                alive[node] = e + 1
        return self._state(alive) if alive else -1

    def find(self, word: str) -> tuple | None:
        """(entry, edits) that a lower-case word matches, or None."""
        if word in self.words:
            return self.words[word]
        if len(self.words) >= CACHE or len(self.sets) >= STATES:
            self._forget()
        state, hit = self.begin, None
        for c in word:
            c = c if c in self.letters else "\0"
            to = self.moves[state].get(c)
            if to is None:
                to = self.moves[state][c] = self._step(state, c)
            if to < 0:
                state = -1
                break
            state = to
            stem = self.stems[state]
            if stem and (hit is None or stem[1] < hit[1]):
                hit = stem
        if state >= 0:
            whole = self._best(self.sets[state], stem=False)
            if whole and (hit is None or whole[1] <= hit[1]):
                hit = whole
        self.words[word] = hit
        return hit


def quotation(text: str, start: int, end: int) -> float:
    """0 (abuse) to 0.9 (quotation), from the words and marks around a hit."""
    left, right = text[max(0, start - 12 * REACH):start], text[end:end + 12 * REACH]
    before, after = _WORD.findall(left)[-REACH:], _WORD.findall(right)[:REACH]
    q = 0.0
    for opening, closing in QUOTES.items():
        at = left.rfind(opening)
        if at >= 0 and (opening == closing and left.count(opening) % 2 == 1 or opening != closing and closing not in left[at:]) and closing in right:
            q += 0.6
            break
    near = set(before) | set(after)
    q += 0.3 * bool(near & REPORTING) - 0.4 * bool(set(before[-4:] + after[:4]) & ADDRESS)
    return min(max(q, 0.0), 0.9)


class Model:
    def __init__(self, entries=(), coef=None, const: float | None = None):
        self.entries, self.coef, self.const = list(entries), coef, const
        self.automaton = Automaton(self.entries)

    def __getstate__(self):
        return {"entries": self.entries, "coef": self.coef, "const": self.const}

    def __setstate__(self, state):
        self.__init__(**state)

    def hits(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, entry, edits, quotation) of every hit."""
        low = text.lower()
        find = self.automaton.find
        known = {w: h for w in set(_WORD.findall(low)) if (h := find(w))}
        if not known:
            return []
        return [(m.start(), m.end(), *known[m[0]], quotation(low, m.start(), m.end()))
                for m in _WORD.finditer(low) if m[0] in known]

    def features(self, text: str) -> np.ndarray:
        hits = self.hits(text)
        if not hits:
            return np.zeros(3)
        weight = [min(self.entries[k][3], 8) / 8 * 0.8 ** e for _, _, k, e, _ in hits]
        abuse = sum(w * (1 - h[4]) for w, h in zip(weight, hits, strict=True))
        quoted = sum(w * h[4] for w, h in zip(weight, hits, strict=True))
        return np.log1p([abuse, quoted, 100 * abuse / len(_WORD.findall(text))])

    def score(self, text: str) -> float:
        if self.const is not None:
            return self.const
        return float(1 / (1 + math.exp(-min(max(self.coef[0] + self.features(text) @ self.coef[1:], -30), 30))))


def edits_allowed(term: str, stem: bool) -> int:
    n = len(term)
    return (n >= 6) if stem else (n >= 5) + (n >= 9)


def _contexts(rows: list[list[str]]) -> Counter:
    """For each word the number of its different (previous, next) neighbours."""
    seen = {t for w in rows for t in zip(["", *w[:-1]], w, [*w[1:], ""], strict=True)}
    return Counter(w for _, w, _ in seen)


def _stems(words: Counter) -> tuple[Counter, Counter]:
    """Contexts and different endings of all stems."""
    sums, endings = Counter(), Counter()
    for w, n in words.items():
        for k in range(STEM[0], min(STEM[1], len(w) - 1) + 1):
            sums[w[:k]] += n
            endings[w[:k]] += 1
    return sums, endings


def lexicon(toxic: list[list[str]], other: list[list[str]]) -> list[tuple[str, bool, int, float]]:
    """Words and stems that toxic rows use significantly more often: the
    likelihood ratio of their contexts must survive a correction for the number
    of candidates, and two rows at least must show them."""
    here, there = _contexts(toxic), _contexts(other)
    stems, endings = _stems(here)
    stems_there, _ = _stems(there)
    n1, n0 = max(1, here.total()), max(1, there.total())
    tested = len(here) + len(stems)
    chosen: dict[tuple[str, bool], float] = {}
    for counts, against, stem in ((here, there, False), (stems, stems_there, True)):
        for term, c1 in counts.items():
            if c1 < MIN_CONTEXTS or stem and endings[term] < MIN_ENDINGS:
                continue
            c0 = against[term]
            odds = math.log((c1 + 0.5) / n1) - math.log((c0 + 0.5) / n0)
            share = n1 / (n1 + n0)
            ratio = 2 * (c1 * math.log(c1 / ((c1 + c0) * share)) + (c0 * math.log(c0 / ((c1 + c0) * (1 - share))) if c0 else 0))
            if odds >= MIN_ODDS and ratio >= 2 * math.log(20 * tested):
                chosen[term, stem] = odds
    short = lambda t: any((t[:n], True) in chosen for n in range(STEM[0], len(t)))
    kept: dict[tuple[str, bool], float] = {}
    longer: dict[str, str] = {}
    for t, n in stems.items():
        if t[:-1] in stems and n >= 0.95 * stems[t[:-1]]:
            longer[t[:-1]] = t
    for (term, stem), odds in chosen.items():
        if not short(term):
            while stem and term in longer:  # the longest stem that nearly all its words share
                term = longer[term]
            kept[term, stem] = odds
    rows: Counter = Counter()
    for row in map(set, toxic):
        rows.update({k for w in row for k in ((w, False), *((w[:n], True) for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1))) if k in kept})
    return [(t, stem, int(edits_allowed(t, stem)), odds) for (t, stem), odds in sorted(kept.items()) if rows[t, stem] >= 2]


def fit(texts: list[str], labels: list[int], prior: float) -> Model:
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return Model(const=float(y.mean()) if len(y) else 0.0)
    words = [_WORD.findall(t.lower()) for t in texts]
    toxic = [w for w, k in zip(words, labels, strict=True) if k]
    other = [w for w, k in zip(words, labels, strict=True) if not k]
    entries = lexicon(toxic, other)
    bound = 0.002 * len(other)
    while True:  # misspellings that other rows use are none
        auto, wrong = Automaton(entries), defaultdict(int)
        for row in other:
            for k in {h[0] for w in set(row) if (h := auto.find(w)) and h[1] > 0}:
                wrong[k] += 1
        if not any(n > bound for n in wrong.values()):
            break
        entries = [(t, s, e - (wrong[k] > bound), o) for k, (t, s, e, o) in enumerate(entries)]
    model = Model(entries)
    x = np.column_stack([np.ones(len(y)), np.array([model.features(t) for t in texts])])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    coef, ridge = np.zeros(4), np.diag([1e-3, 0.1, 0.1, 0.1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        move = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge @ coef)
        coef = coef + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    model.coef = coef
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    texts, y, prior = sample(docs, labels, "toxic", id_col, text_col)
    return fit(texts, y, min(max(prior, 0.02), 0.98))


def score_column(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t or "") for t in texts], dtype="float64")

    return run(text)


def hit_table(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per hit: id, start, end (code points), entry, edits, quotation."""
    kind = "array<struct<start:int,end:int,entry:string,edits:int,quotation:double>>"

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "entry": model.entries[k][0], "edits": e, "quotation": q}
                           for a, b, k, e, q in model.hits(t or "")] for t in texts], dtype=object)

    return docs.select(F.col(id_col), F.explode(run(F.col(text_col))).alias("h")).select(id_col, "h.*")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(
        F.col(id_col), is_held_out(F.col(id_col)).alias("held_out"), score_column(model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@query("op9_toxicity")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
