import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulcra.functions.similarity import common_subsequence, tokens, with_token_set_score
from pulcra import session
from pulcra.operators import candidates
from pulcra.operators import dedup as D
from pulcra.profile import PUBLISHED_REVIEW
from pulcra.profiles.schools import SCHOOLS
from tests.rows import clean_table

VECTORS = [
    ("COLEGIO SAN JOSE", "COLEGIO SAN JOSE II", 100), ("JOSE SAN COLEGIO", "COLEGIO SAN JOSE", 100),
    ("INSTITUTO MIXTO EL SABER", "INSTITUTO MIXTO EL SABERR", 97.9592),
    ("3A CALLE 4-55 ZONA 1", "3A CALLE 4-56 ZONA 1", 95), ("LICEO GUATEMALA", "LICEO GUATEMALTECO", 84.8485),
    ("A B", "C D", 33.3333), ("", "", 0), ("", "A", 0),
]


def plain_score(a: str, b: str) -> float:
    """The published definition, one pair at a time."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared = " ".join(sorted(x & y))
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and (not p or not q):
        return 100.0
    row = [0] * (len(q) + 1)
    for ch in p:
        new = [0]
        for j, other in enumerate(q):
            new.append(row[j] + 1 if ch == other else max(row[j + 1], new[-1]))
        row = new
    s, g = len(shared), 1 if shared else 0
    la, lb = s + g + len(p), s + g + len(q)
    best = 100 - 100 * (len(p) + len(q) - 2 * row[-1]) / (la + lb)
    if shared:
        best = max(best, 100 - 100 * (g + len(p)) / (s + la), 100 - 100 * (g + len(q)) / (s + lb))
    return best


def scores(spark, pairs, **options):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = df.withColumns({"x": tokens(F.col("a")), "y": tokens(F.col("b"))})
    return {r.i: r.s for r in with_token_set_score(df, "x", "y", "s", **options).collect()}


@pytest.mark.parametrize("native", [False, True])
def test_known_scores(spark, native):
    got = scores(spark, [(a, b) for a, b, _ in VECTORS], native=native)
    assert [round(got[i], 4) for i in range(len(VECTORS))] == [v for *_, v in VECTORS]


def test_scores_against_plain_python_and_threshold(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ABCÑ1") for _ in range(rng.randint(1, 6)))
    pairs = []
    for _ in range(300):
        a = [word() for _ in range(rng.randint(0, 6))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            if b and rng.random() < 0.5:
                b[rng.randrange(len(b))] = word()
            else:
                b.append(word())
        rng.shuffle(b)
        pairs.append((" ".join(a), " ".join(b)))
    pairs.append(("X" * 3000 + " Y", "X" * 2999 + "Z Y"))
    expected = {i: plain_score(a, b) for i, (a, b) in enumerate(pairs)}
    assert scores(spark, pairs) == pytest.approx(expected)
    reached = {i: v for i, v in expected.items() if v >= 85}
    assert scores(spark, pairs, at_least=85.0) == pytest.approx(reached)


def table_lcs(x, y):
    row = [0] * (len(y) + 1)
    for ch in x:
        new = [0]
        for j, other in enumerate(y):
            new.append(row[j] + 1 if ch == other else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_bit_parallel_subsequence_equals_the_table():
    rng = random.Random(2)
    for letters in ("AB", "ABCDEFGH 12", "AÑ😀"):
        for _ in range(200):
            x, y = ("".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 130]))) for _ in range(2))
            assert common_subsequence(x, y) == table_lcs(x, y)
    x = "".join(rng.choice("ABCDEFGHIJ ") for _ in range(20000))
    y = "".join(rng.choice("ABCDEFGHIJ ") for _ in range(20000))
    started = time.perf_counter()
    assert common_subsequence(x, x[:5000] + x[5100:]) == 19900
    assert 5000 < common_subsequence(x, y) < 20000
    assert time.perf_counter() - started < 1


def test_block_limit_counts_rows_before_pruning(spark):
    rows = []
    for size in (1, 2, 80, 81):
        rows += [{"ESTABLECIMIENTO": f"{size:03d} NAME", "TELEFONO": None, "MUNICIPIO": str(size)}] * size
    df = clean_table(spark, rows)
    published = replace(SCHOOLS, **PUBLISHED_REVIEW)

    def per_place(profile):
        pairs = D.block_pairs(df, profile).join(df, F.col("row_id_1") == df.row_id)
        return {r.MUNICIPIO: r["count"] for r in pairs.groupBy("MUNICIPIO").count().collect()}

    assert per_place(published) == {"2": 1, "80": 3160}
    assert per_place(SCHOOLS) == {"2": 1, "80": 3160, "81": 3240}
    assert D.oversized_blocks(df, SCHOOLS).count() == 0
    big = D.oversized_blocks(df, published).collect()
    assert [(r.blocking, r["size"]) for r in big] == [("title", 81)]
    copies = D.oversized_copies(df, published).collect()
    assert [(r.copies, r.title_key) for r in copies] == [(81, "081 NAME")]


def test_review_against_brute_force(spark):
    rng = random.Random(3)
    names = ["LICEO SAN JOSE", "LICEO SAN JOSÉ II", "SAN JOSE LICEO", "LICEO SAN JOSEE", "COLEGIO X", None]
    streets = ["3A CALLE 4-55", "3A CALLE 4-56", "AVENIDA LARGA 12", ".", None]
    rows = [{
        "ESTABLECIMIENTO": rng.choice(names), "DIRECCION": rng.choice(streets),
        "TELEFONO": rng.choice(["55551234", "23456789", None]), "MUNICIPIO": rng.choice(["MIXCO", None]),
        "SECTOR": rng.choice(["PRIVADO", "OFICIAL", None]),
    } for _ in range(60)]
    df = clean_table(spark, rows)
    key = lambda v: (v or "").replace("É", "E").replace(".", "").replace(",", "")
    expected = set()
    for i in range(60):
        for j in range(i + 1, 60):
            a, b = rows[i], rows[j]
            na, nb = key(a["ESTABLECIMIENTO"]), key(b["ESTABLECIMIENTO"])
            same_place = (a["MUNICIPIO"] or "") == (b["MUNICIPIO"] or "")
            phone = bool(a["TELEFONO"]) and a["TELEFONO"] == b["TELEFONO"]
            in_block = (same_place and na[:18] == nb[:18]) or (a["MUNICIPIO"] == b["MUNICIPIO"] and phone)
            if not in_block or a["SECTOR"] != b["SECTOR"] or a["MUNICIPIO"] != b["MUNICIPIO"]:
                continue
            da, db = key(a["DIRECCION"]), key(b["DIRECCION"])
            if plain_score(na, nb) >= 94 and (plain_score(da, db) >= 85 or phone or (da and da == db)):
                expected.add((i, j))
    limits = replace(SCHOOLS, block_prefix=18)
    review = D.near_duplicates(df, limits)
    got = [(r.row_id_1, r.row_id_2) for r in review.collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected
    assert tuple(review.columns) == D.REVIEW_COLUMNS


def test_complete_review_of_large_groups(spark):
    """A block above both published limits, 500 copies, and titles that differ
    in their first letters."""
    rows = [{"ESTABLECIMIENTO": f"LICEO SAN JOSE {k}", "TELEFONO": "55551234", "DIRECCION": f"CALLE {k}"} for k in range(90)]
    rows += [{"ESTABLECIMIENTO": "COLEGIO CENTRAL", "DIRECCION": "3A CALLE 4-55", "TELEFONO": None}] * 500
    rows += [{"ESTABLECIMIENTO": "CENTRAL COLEGIO", "DIRECCION": "3A CALLE 4-56", "TELEFONO": None}]
    found = D.review_groups(clean_table(spark, rows), SCHOOLS).collect()
    got = {(r.first_row_id_1, r.first_row_id_2): (r.copies_1, r.copies_2) for r in found}
    near = {(i, j) for i in range(90) for j in range(i + 1, 90)
            if plain_score(f"LICEO SAN JOSE {i}", f"LICEO SAN JOSE {j}") >= 94}
    assert got == {**dict.fromkeys(near, (1, 1)), (90, 90): (500, 500), (90, 590): (500, 1)} and len(near) > 1000


def test_default_review_against_all_pairs(spark):
    """A profile that sets nothing compares all rows of a unit."""
    rng = random.Random(8)
    names = ["COLEGIO SAN JOSE DE LOS INFANTES", "COLEGIO SAN JOSE DE LOS INFANTES II", "LICEO X",
             "INFANTES COLEGIO SAN JOSE DE LOS", "COLEGIO SAN JOSE DE LOS INFANTEZ", None]
    rows = [{
        "ESTABLECIMIENTO": rng.choice(names), "DIRECCION": rng.choice(["3A CALLE 4-55", "3A CALLE 4-56", "AVENIDA LARGA 12", None]),
        "TELEFONO": rng.choice(["55551234", None, None]), "SECTOR": rng.choice(["PRIVADO", "OFICIAL"]),
    } for _ in range(50)]
    expected = set()
    for i in range(50):
        for j in range(i + 1, 50):
            (na, da, ta, sa), (nb, db, tb, sb) = ([v or "" for v in rows[k].values()] for k in (i, j))
            near = plain_score(da, db) >= 85 or (ta and ta == tb) or (da and da == db)
            if sa == sb and plain_score(na, nb) >= 94 and near:
                expected.add((i, j))
    df = clean_table(spark, rows)
    entry = [tuple(v or "" for v in r.values()) for r in rows]
    first = {e: i for i, e in reversed(list(enumerate(entry)))}
    # Between representatives: first rows of different entries, and each copy with its first row.
    shown = {(i, j) if entry[i] == entry[j] else tuple(sorted((first[entry[i]], first[entry[j]])))
             for i, j in expected if entry[i] != entry[j] or first[entry[i]] == i}
    got = [(r.row_id_1, r.row_id_2) for r in D.near_duplicates(df, SCHOOLS).collect()]
    assert len(got) == len(set(got)) and set(got) == shown
    blocks = D.scored_pairs(df, SCHOOLS).count()
    assert 0 < blocks < len(expected)
    assert tuple(D.review_totals(df, SCHOOLS).first()) == (len(expected), len({i for pair in expected for i in pair}))
    assert clusters_of(D.duplicate_clusters(df, SCHOOLS)) == plain_clusters(expected)


def plain_clusters(pairs):
    """row: (smallest row of its cluster, rows of the cluster)."""
    root: dict = {}
    for i, j in pairs:
        a, b = root.setdefault(i, i), root.setdefault(j, j)
        root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    return {k: (v, list(root.values()).count(v)) for k, v in root.items()}


def clusters_of(df):
    rows = df.collect()
    assert len({r.row_id for r in rows}) == len(rows)
    return {r.row_id: (r.cluster_id, r.cluster_rows) for r in rows}


def test_titles_without_a_common_word_or_beginning(spark):
    titles = ["ABCDEFGHIJKLMNOPQRST UVWXYZABCDEFGHIJKLMN", "ABCDEFGHIJKLMNXPQRST UVWXYZABCDEFGHIJKLMO"]
    rows = [{"ESTABLECIMIENTO": t, "DIRECCION": f"CALLE LARGA {i + 1} NORTE", "TELEFONO": None} for i, t in enumerate(titles)]
    assert [(r.row_id_1, r.row_id_2) for r in D.near_duplicates(clean_table(spark, rows), SCHOOLS).collect()] == [(0, 1)]


@pytest.mark.parametrize(("crowd", "at_least", "other"), [(64, 94.0, 85.0), (0, 94.0, 85.0), (3, 90.0, 94.0), (2, 80.0, 70.0)])
def test_candidates_hold_every_pair_of_the_rule(spark, monkeypatch, crowd, at_least, other):
    """Against all pairs: words with slips, dropped and swapped words, one-letter
    words, a word that all titles have; keys narrowed always, sometimes, never."""
    monkeypatch.setattr(candidates, "CROWD", crowd)
    monkeypatch.setattr(candidates, "TOLD", 5)
    rng = random.Random(11)
    letters = "ABCDE"

    def word():
        return "".join(rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 6, 9, 14])))

    def slip(w):
        at = rng.randrange(len(w))
        return w[:at] + rng.choice(["", rng.choice(letters), w[at] + rng.choice(letters)]) + w[at + 1:]

    def near(text):
        ws = text.split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(ws))
            ws[at] = slip(ws[at]) or "A"
        if rng.random() < 0.3:
            ws.append(word())
        if len(ws) > 1 and rng.random() < 0.2:
            ws.pop(rng.randrange(len(ws)))
        rng.shuffle(ws)
        return " ".join(ws)

    bases = [" ".join(["COLEGIO"] * (k % 2) + [word() for _ in range(rng.randint(1, 6))]) for k in range(12)]
    bases += ["A B C D E AB", "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "COLEGIO"]
    rows = [(i, near(rng.choice(bases)), near(rng.choice(bases[:4])), rng.choice(["1", "2", None, None, None])) for i in range(160)]
    df = spark.createDataFrame([(i, "u" if i % 2 else "v", a, b, c) for i, a, b, c in rows], "id long, unit string, x string, y string, phone string")
    df = df.withColumns({"t": tokens(F.col("x")), "a": tokens(F.col("y"))})
    got = [(r.i, r.j) for r in candidates.pairs(df, at_least, [F.col("phone")], other).collect()]
    want = {(i, j) for i in range(160) for j in range(i + 2, 160, 2)
            if plain_score(rows[i][1], rows[j][1]) >= at_least
            and (plain_score(rows[i][2], rows[j][2]) >= other or rows[i][3] and rows[i][3] == rows[j][3])}
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 30


@pytest.mark.parametrize(("parts", "crowd", "idle"), [(24, 1024, 256), (24, 0, 2), (3, 1024, 0), (1, 2, 256)])
def test_letter_parts_hold_every_pair_of_the_rule(spark, monkeypatch, parts, crowd, idle):
    """Against all pairs: short and long titles with slips, at a score where texts
    go by parts of their letters, by grams where they are too long, or by both."""
    for name, value in (("PARTS", parts), ("CROWD", crowd), ("IDLE", idle), ("TOLD", 9)):
        monkeypatch.setattr(candidates, name, value)
    rng = random.Random(5)

    def slip(text):
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "X", " ", text[at] + "7"]) + text[at + 1:] or "A"
        return " ".join(rng.sample(text.split(), len(text.split()))) or "A"

    bases = ["A", "LICEO", "ECOLE 12 LARGE RING", "ECOLE 1234 HOT BOLT ANNEX NO 2", "COLEGIO SAN JOSE DE LOS INFANTES DE OCCIDENTE", "LICEO " + "AB CD EFG HIJKL " * 5]
    rows = [(i, slip(rng.choice(bases)), slip("3A CALLE 4-55 ZONA 1"), rng.choice(["1", None, None])) for i in range(150)]
    df = spark.createDataFrame([(i, "u", a, b, c) for i, a, b, c in rows], "id long, unit string, x string, y string, phone string")
    df = df.withColumns({"t": tokens(F.col("x")), "a": tokens(F.col("y"))})
    got = [(r.i, r.j) for r in candidates.pairs(df, 94.0, [F.col("phone")], 85.0).collect()]
    want = {(i, j) for i in range(150) for j in range(i + 1, 150)
            if plain_score(rows[i][1], rows[j][1]) >= 94
            and (plain_score(rows[i][2], rows[j][2]) >= 85 or rows[i][3] and rows[i][3] == rows[j][3])}
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 100


def test_keys_of_many_like_titles_stay_few(spark, monkeypatch):
    """Titles that share all words but a number, at like addresses: no key is
    narrowed, which would repeat it for each key of the address."""
    tables = {}

    def kept(df, label):
        tables[label] = session.written(df, label)
        return tables[label]

    monkeypatch.setattr(candidates, "written", kept)
    rows = [(i, "u", ["ECOLE", "LARGE", "RING", str(1000 + 7 * i)], ["AVENUE", f"BRAND{i % 25}", "ZONE", str(i % 40)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, unit string, t array<string>, a array<string>")
    assert 0 < candidates.pairs(df, 94.0, [], 85.0).count() < 179_700 / 4
    assert tables["crowded"].count() == 0
    assert tables["keys"].select(F.max(F.size("_t.grams") + F.size("_t.rare"))).first()[0] <= 8


def test_shuffles_of_a_written_table_are_deleted(spark):
    def files():
        disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = disks.getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().endswith(".data")}

    before = files()
    counts = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    kept = session.written(counts.hint("merge").join(counts.withColumnRenamed("n", "m").hint("merge"), "k"), "counts")
    assert not [n for n in files() - before if n.startswith("shuffle")]
    assert kept.count() == 700
    assert spark.conf.get(session.SHUFFLES_GO, "false") == "false"


def written_links(monkeypatch):
    tables = {}

    def kept(df, label):
        tables[label] = session.written(df, label)
        return tables[label]

    monkeypatch.setattr(D, "written", kept)
    return tables


def test_clusters_write_only_the_ends_of_links(spark, monkeypatch):
    tables = written_links(monkeypatch)
    rows = [{"ESTABLECIMIENTO": f"LICEO SAN JOSE DE OCCIDENTE {k}", "DIRECCION": "3A CALLE 4-55", "TELEFONO": None} for k in range(9)]
    assert clusters_of(D.duplicate_clusters(clean_table(spark, rows), SCHOOLS)) == {k: (0, 9) for k in range(9)}
    assert tables["links"].columns == ["i", "j"] and tables["links"].count() == tables["pairs"].count() == 36


def test_totals_write_only_the_ends_and_copies_of_links(spark, monkeypatch):
    tables = written_links(monkeypatch)
    rows = [{"ESTABLECIMIENTO": f"LICEO SAN JOSE DE OCCIDENTE {k // 2}", "DIRECCION": "3A CALLE 4-55", "TELEFONO": None} for k in range(12)]
    assert tuple(D.review_totals(clean_table(spark, rows), SCHOOLS).first()) == (66, 12)
    assert tables["links"].columns == ["i", "j", "copies_1", "copies_2"] and tables["links"].count() == 15


def test_large_blocks_without_a_limit_are_paired_whole_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "DEALT", 20)
    rows = [{"ESTABLECIMIENTO": "COLEGIO SAN JOSE DE LOS INFANTES", "DIRECCION": "3A CALLE 4-55", "TELEFONO": "55551234"}] * 90
    rows += [{"ESTABLECIMIENTO": f"LICEO {k}{k}{k}", "DIRECCION": "3A CALLE 4-55", "TELEFONO": None} for k in range(9)] * 2
    p = replace(SCHOOLS, block_prefix=18)
    df = clean_table(spark, rows)
    got = [(r.row_id_1, r.row_id_2) for r in D.near_duplicates(df, p).collect()]
    want = {(i, j) for i in range(90) for j in range(i + 1, 90)} | {(90 + k, 99 + k) for k in range(9)}
    assert len(got) == len(want) and set(got) == want
    kept = [p.row_id]
    met = D._paired(D.pairable_rows(D.with_keys(df, p), p), p, kept)
    assert met.where("_how = 'title' and l_row_id < 90").select("_salt").distinct().count() > 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_keys_never_pass_the_driver(spark):
    df = spark.createDataFrame([(i, "u", ["COLEGIO", f"W{i}"], ["CALLE"]) for i in range(9)], "id long, unit string, t array<string>, a array<string>")
    assert "SortMergeJoin" in plan_of(candidates.pairs(df, 94.0, [], 85.0))


def test_keys_of_the_blocked_review_are_computed_once(spark):
    from dataclasses import replace

    from pulcra.profile import PUBLISHED_REVIEW

    plan = plan_of(D.scored_pairs(clean_table(spark, [{}, {}]), replace(SCHOOLS, **PUBLISHED_REVIEW)))
    assert "_nfkc_arrays" not in plan and "SortMergeJoin" in plan


def test_letter_bits_drop_only_what_cannot_score(spark):
    def kept(x, y, at_least=94.0):
        sides = [sorted(set(t.split())) for t in (x, y)]
        rows = [tuple(v for ts in sides for v in (sum(map(len, ts)) + len(ts) - 1, candidates.letter_bits(ts)))]
        df = spark.createDataFrame(rows, "n int, x long, m int, y long")
        return df.select(candidates.may_score(candidates.slack(at_least), *map(F.col, ("n", "m", "x", "y")))).first()[0]

    assert kept("ECOLE 12 LARGE RING", "ECOLE 13 LARGE RING") and not kept("ECOLE 12 LARGE RING", "ECOLE 57 LARGE RING")
    assert kept("COLEGIO", "COLEGIO CENTRAL DE OCCIDENTE") and kept("COLEGIO CENTRAL DE OCCIDENTE", "COLEGIO")


def test_clusters_of_many_copies_and_a_word_all_titles_have(spark):
    copies = [{"ESTABLECIMIENTO": "COLEGIO CENTRAL", "DIRECCION": "3A CALLE 4-55", "TELEFONO": None}] * 500
    copies += [{"ESTABLECIMIENTO": "CENTRAL COLEGIO", "DIRECCION": "3A CALLE 4-56", "TELEFONO": None}]
    lone = [{"ESTABLECIMIENTO": f"COLEGIO {chr(65 + k % 26) * 3}{chr(65 + k // 26) * 3}", "DIRECCION": f"{k}{k}{k}", "TELEFONO": None} for k in range(300)]
    found = D.duplicate_clusters(clean_table(spark, copies + lone), SCHOOLS)
    assert clusters_of(found) == {i: (0, 501) for i in range(501)}
    assert {(r.entry_id, r.entry_rows, r.entry_links) for r in found.collect()} == {(0, 500, 1), (500, 1, 1)}
    assert tuple(D.review_totals(clean_table(spark, copies + lone), SCHOOLS).first()) == (500 * 499 // 2 + 500, 501)
    assert D.near_duplicates(clean_table(spark, copies + lone), SCHOOLS).count() == 500
    entries = D.review_entries(clean_table(spark, lone), SCHOOLS)
    same = [F.when(F.col("_phone") != "", F.col("_phone"))]
    keyed = entries.select(F.col("_unit").alias("unit"), F.col("first").alias("id"), "t", "a", "_phone")
    assert candidates.pairs(keyed, 94.0, same, 85.0).count() < 300 * candidates.CROWD / 4  # of 44,850
    none = clean_table(spark, [{}]).limit(0)
    assert D.duplicate_clusters(none, SCHOOLS).count() == 0 and tuple(D.review_totals(none, SCHOOLS).first()) == (0, 0)


def test_first_members_of_groups_of_identical_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ABCDEFG") * rng.choice([1, 1, 2, 9]), rng.choice(["x", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a string, b string").repartition(4)
    held = {r[1:]: [x[0] for x in rows if x[1:] == r[1:]] for r in rows}
    members = sorted((i, a, b, len(held[a, b])) for i, a, b in rows if len(held[a, b]) > 1)
    assert sorted(map(tuple, D.duplicate_members(df, ["a", "b"], "id").collect())) == members
    for limit in (0, 1, 5, 100):
        assert [tuple(r) for r in D.first_duplicates(df, ["a", "b"], "id", limit).collect()] == members[:limit]


def test_only_digests_and_ids_are_shuffled(spark, tmp_path):
    spark.range(2000).select("id", F.repeat(F.col("id").cast("string"), 50).alias("wide"), (F.col("id") % 900).alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("wide", F.concat(F.repeat(F.lit("x"), 200), "k"))
    plan = D.duplicate_members(df, ["wide", "k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    groups = D.duplicate_groups(df, ["wide", "k"], "id")._jdf.queryExecution().executedPlan().toString()
    below = groups[groups.index("Exchange hashpartitioning(_digest"):].split("\n")[1]
    assert "wide" not in below.split("functions")[0]


def test_components_keep_one_table_of_edges(spark, tmp_path, monkeypatch):
    from pulcra.operators.components import components

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    chain = [(i, i + 1) for i in range(1, 40)]
    links = spark.createDataFrame([*chain, (100, 99), (99, 98), (98, 98), (None, 5), (7, 3), (7, 3)], "i long, j long")
    with session.scratch_scope() as paths:
        got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 98: 98, 99: 98, 100: 98}
    assert len(paths) > 3 and [p.name for p in tmp_path.iterdir()] == [paths[-1].rsplit("/", 1)[1]]
    session.drop_scratch(spark, [*paths, "/", str(tmp_path)])
    assert tmp_path.exists() and not list(tmp_path.iterdir()) and not session._SCOPES


def test_decisions(spark):
    df = clean_table(spark, [{}] * 4)
    ledger = spark.createDataFrame(
        [(0, 1, "CONSERVAR"), (0, 2, "eliminar"), (1, 3, "ELIMINAR")],
        "row_id_1 bigint, row_id_2 bigint, decision string")
    left = {r.row_id for r in D.apply_decisions(df, ledger, SCHOOLS).collect()}
    assert left == {0, 1, 2}
    assert D.decision_summary(ledger, SCHOOLS).first().asDict() == {"kept": 1, "fixed": 0, "merged": 0, "dropped": 2}
    keep = ledger.where("decision = 'CONSERVAR'")
    for same in (keep, ledger.limit(0)):
        assert D.apply_decisions(df, same, SCHOOLS).count() == 4
    assert tuple(D.pair_totals(ledger).first()) == (3, 4)
