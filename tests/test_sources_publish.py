import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulcra.operators import profile_state as PS
from pulcra.operators import profiling as A
from pulcra.operators.validation import InvalidTable
from pulcra.plans import publish as X
from pulcra.profiles.schools import DEPARTMENT_CODES, SCHOOLS
from pulcra import session
from pulcra.operators.catalog import coverage, flag_places, lookup_codes, resolved_codes
from pulcra.sources import csv
from pulcra.sources.blocks import separator_blocks
from pulcra.sources.manifest import file_digests, source_manifest
from pulcra.sources.pages import element_by_id
from pulcra.streaming import clean_stream
from pulcra.streaming.repeats import repeated_codes, repeated_rows
from tests.rows import clean_table, raw_table


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_readers_differ_only_in_what_is_missing(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n01,\n"N/A","x\ny"\n,"q ""z"""\n')
    assert [tuple(r) for r in csv.read_raw(spark, path, multiline=True).collect()] == [("01", ""), ("N/A", "x\ny"), ("", 'q "z"')]
    assert csv.read_for_validation(spark, path, multiline=True).where("a IS NULL").count() == 1
    assert csv.read_default_na(spark, path, multiline=True).where("a IS NULL").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_raw(spark, path).collect()


def test_files_without_line_breaks_in_fields_are_split(spark, tmp_path):
    path = write(tmp_path / "long.csv", "a,b\n" + "".join(f"{i},\"x, {i}\"\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = csv.read_raw(spark, path, position="at")
        assert rows.rdd.getNumPartitions() > 4 and csv.read_raw(spark, path, multiline=True).rdd.getNumPartitions() == 1
        assert [r.a for r in rows.orderBy("at").collect()] == [str(i) for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_union_needs_the_same_header(spark, tmp_path):
    one = write(tmp_path / "1.csv", "a,b\n1,2\n,\n")
    two = write(tmp_path / "2.csv", "a,b\n3,4\n")
    swapped = write(tmp_path / "3.csv", "b,a\n5,6\n")
    assert csv.union_files(spark, [one, two]).count() == 3
    assert csv.union_files(spark, [one, two], drop_blank=True).count() == 2
    with pytest.raises(ValueError):
        csv.union_files(spark, [])
    with pytest.raises(Exception, match="(?i)header"):
        csv.union_files(spark, [one, swapped]).collect()
    with pytest.raises(ValueError):
        csv.expect_columns(csv.read_raw(spark, one), ["b", "a"])


def test_manifest(spark, tmp_path):
    import hashlib

    path = write(tmp_path / "m.csv", "k,v\nA,1\nA,2\nB,3\n,4\n")
    rows = csv.read_raw(spark, path, file="file")
    got = source_manifest(rows, "k", "file", file_digests(spark, path), level="L", extracted="2026-01-31")
    digest = hashlib.sha256((tmp_path / "m.csv").read_bytes()).hexdigest()
    assert {(r.query_key, r.rows, r.file, r.sha256) for r in got.collect()} == {
        ("A", 2, "m.csv", digest), ("B", 1, "m.csv", digest)}


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    import hashlib

    size = (1 << 31) + 12345
    with open(tmp_path / "big.bin", "wb") as file:  # sparse: its blocks are not written
        file.truncate(size - 3)
        file.seek(size - 3)
        file.write(b"end")
    (tmp_path / "a b%20.txt").write_text("small")
    digest = hashlib.sha256()
    with open(tmp_path / "big.bin", "rb") as file:
        while piece := file.read(1 << 24):
            digest.update(piece)
    got = {r.file: (r.bytes, r.sha256) for r in file_digests(spark, str(tmp_path / "*")).collect()}
    assert got["big.bin"] == (size, digest.hexdigest()) and len(got) == 2
    pieces = {r.file: (r.bytes, r.sha256) for r in file_digests(spark, str(tmp_path / "*.txt"), whole=0).collect()}
    assert [v for k, v in got.items() if k != "big.bin"] == list(pieces.values()) == [(5, hashlib.sha256(b"small").hexdigest())]


def element(spark, html, name="div"):
    return spark.createDataFrame([(html,)], "h string").select(element_by_id(F.col("h"), name, "x")).first()[0]


@pytest.mark.parametrize(("html", "content"), [
    ('<div id="x">a<div>b<div>c</div></div>d</div>e</div>', "a<div>b<div>c</div></div>d"),
    ('<div id="y">no</div><DIV class="k" id="x">a<Div/>b</DIV>c', "a<Div/>b"),
    ('<div id="x">a<!-- <div> --><!-- </div> -->b</div>c', "a<!-- <div> --><!-- </div> -->b"),
    ('<div id="x">a<divider>b</divider></div>c', "a<divider>b</divider>"),
    ('<div id="x">\x01a\x02<div>é😀</div>\x01</div>c', "\x01a\x02<div>é😀</div>\x01"),
    ('<div id="x">never closed<div></div>', ""), ('<div id="x"></div>', ""), ("<p>none</p>", ""), (None, ""),
    ('<div id="x">' + "<div>" * 2000 + "deep" + "</div>" * 2000 + "</div>", "<div>" * 2000 + "deep" + "</div>" * 2000),
])
def test_element_ends_at_the_matching_tag(spark, html, content):
    assert element(spark, html) == content


def test_codes_are_resolved_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, " el  PROGRESO "), (2, "Baja\u00a0 Verapaz"), (3, "x"), (4, None)], "i int, d string").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    codes = spark.createDataFrame([("El progreso", "02"), ("baja   VERAPAZ", "15")], "name string, code string")
    found = resolved_codes(df, "d", codes, "code")
    assert sorted(map(tuple, found.select("i", "code", "known").collect())) == [(1, "02", True), (2, "15", True), (3, None, False), (4, None, False)]
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    good, bad = lookup_codes(df, "d", codes, "code")
    assert good.columns == ["i", "d", "code"] and bad.columns == ["i", "d"] and bad.count() == 2


def test_a_large_catalogue_with_a_hot_parent(spark):
    """Half of all rows under one parent: no task of the join has twice the median."""
    rows = spark.range(64_000).select(
        "id", F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 97)).alias("p"),
        F.when(F.col("id") % 4 == 0, "HOT CHILD").otherwise(F.concat(F.lit("C"), F.col("id") % 500)).alias("c"))
    places = rows.where("id % 3 = 0").select("p", "c").distinct()
    want = flag_places(rows, "p", "c", places, small=True).collect()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    limit = session.BROADCAST_ROWS
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        session.BROADCAST_ROWS = -1  # nothing is small
        found = flag_places(rows, "p", "c", places)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        session.BROADCAST_ROWS = limit
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sorted(found.collect()) == sorted(want) and "BroadcastHashJoin" not in plan
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_separator_blocks_over_chunk_borders(spark):
    seps = {3, 4, 10, 29}
    df = spark.range(30).withColumnRenamed("id", "pos")
    out = separator_blocks(df, "pos", F.col("pos").isin(*seps), chunk_rows=4)
    got = {r.pos: r.block_no for r in out.collect()}
    assert got == {i: 1 + sum(s < i for s in seps) for i in range(30)}


def test_lookup_keeps_rejects(spark):
    codes = spark.createDataFrame(list(DEPARTMENT_CODES.items()), "name string, code string")
    df = spark.createDataFrame([(" peten ",), ("ATLANTIS",)], "d string")
    good, bad = lookup_codes(df, "d", codes, "code")
    assert [r.code for r in good.collect()] == ["17"] and [r.d for r in bad.collect()] == ["ATLANTIS"]


def test_coverage_both_ways(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("AAB", "BC"))
    assert {tuple(r) for r in coverage(a, b, "k").collect()} == {("A", "extra"), ("C", "absent")}


def test_fingerprint_ignores_layout_but_not_copies(spark):
    df = clean_table(spark, [{}, {"NIVEL": None}, {"NIVEL": ""}]).drop("row_id")
    assert X.same_rows(df, df.repartition(7).orderBy(F.desc("CODIGO")))
    twice = df.unionByName(df.limit(1)).unionByName(df.limit(1))
    assert not X.same_rows(df, twice) and not X.same_rows(df, df.na.fill(""))
    assert X.row_differences(df, df.repartition(3)).count() == 0
    assert X.row_differences(df, df.na.fill("", ["NIVEL"])).count() == 2


def test_publish(spark, places, tmp_path):
    df = clean_table(spark, [{} for _ in range(50)]).repartition(5)
    path = str(tmp_path / "out")
    done = X.publish(df, SCHOOLS, places, path)
    assert done.rows == 50 and len(done.checks) == 7
    assert X.order_breaks(spark, path, "CODIGO").first().violations == 0
    again = X.publish(df.repartition(2), SCHOOLS, places, str(tmp_path / "again"))
    assert again.fingerprint == done.fingerprint
    with pytest.raises(FileExistsError):
        X.publish(df, SCHOOLS, places, path)
    parents = spark.createDataFrame([("GUATEMALA",)], "p string")
    rows = spark.read.parquet(path)
    assert {r.violations for r in X.invariants(rows, SCHOOLS, parents, rows=50, path=path).collect()} == {0}


@pytest.mark.parametrize("as_csv", [False, True])
def test_versions_are_switched_by_the_pointer_alone(spark, places, tmp_path, monkeypatch, as_csv):
    root = str(tmp_path / "root")
    one, two = clean_table(spark, [{}, {}]), clean_table(spark, [{}, {}, {"DISTRITO": None}])
    with pytest.raises(FileNotFoundError):
        X.current_table(spark, root, SCHOOLS)
    first = X.publish_version(one, SCHOOLS, places, root, csv=as_csv)
    reader = X.current_table(spark, root, SCHOOLS, csv=as_csv)
    assert reader.count() == first.rows == 2 and first.path.endswith(X.current_version(spark, root))
    with pytest.raises(InvalidTable):
        X.publish_version(clean_table(spark, [{"TELEFONO": "1"}]), SCHOOLS, places, root, csv=as_csv)

    def lost(*_):
        raise OSError("gone before the switch")

    with monkeypatch.context() as patch:
        patch.setattr(X, "_point", lost)
        with pytest.raises(OSError, match="before the switch"):
            X.publish_version(two, SCHOOLS, places, root, csv=as_csv)
    assert X.current_table(spark, root, SCHOOLS, csv=as_csv).count() == 2 == reader.count()
    X.publish_version(two, SCHOOLS, places, root, csv=as_csv)
    assert X.current_table(spark, root, SCHOOLS, csv=as_csv).count() == 3 and reader.count() == 2
    keep = first.path.rsplit("/", 1)[1]
    assert len(X.drop_versions(spark, root, [keep])) == 2 and reader.count() == 2
    assert X.drop_versions(spark, root) == [keep]
    assert X.same_rows(X.current_table(spark, root, SCHOOLS, csv=as_csv), two.select(*SCHOOLS.clean_columns))
    names = {f.name for f in (tmp_path / "root").iterdir()}
    assert len([n for n in names if n.startswith("v-")]) == 1 and "CURRENT" in names


def test_differences_by_digests(spark):
    rows = [(i % 40, None if i % 7 == 0 else str(i % 5)) for i in range(400)]
    a = spark.createDataFrame(rows, "k int, v string")
    b = spark.createDataFrame(rows[:-30] + [(99, "x")] * 3 + rows[:1], "k int, v string")
    from collections import Counter

    left, right = Counter(rows), Counter(map(tuple, b.collect()))
    want = {(*r, left[r] - right[r]) for r in left | right if left[r] != right[r]}
    for buckets in (1, 5, 4096):
        assert {tuple(r) for r in X.row_differences(a, b, buckets).collect()} == want
    assert X.row_differences(a, a.repartition(3)).count() == 0 and X.row_differences(a, a.limit(0)).count() == len(set(rows))


def test_publish_as_csv_under_a_fixed_name(spark, places, tmp_path):
    df = clean_table(spark, [{}, {"DIRECTOR": 'A "B", C'}, {"DISTRITO": None}]).repartition(2)
    with pytest.raises(ValueError, match="must be called"):
        X.publish(df, SCHOOLS, places, str(tmp_path / "other.csv"), csv=True, name="final.csv")
    path = str(tmp_path / "final.csv")
    done = X.publish(df, SCHOOLS, places, path, csv=True, name="final.csv")
    back = csv.read_for_validation(spark, path, columns=list(SCHOOLS.clean_columns))
    assert done.rows == 3 and X.same_rows(back, df.select(*SCHOOLS.clean_columns))
    assert [p.name for p in tmp_path.iterdir()] == ["final.csv"]


BROKEN = {
    "row_count": lambda rows: rows.limit(3),
    "empty_rows": lambda rows: rows.unionByName(rows.limit(1).select(*[F.lit(None).cast("string").alias(c) for c in rows.columns])),
    "missing_keys": lambda rows: rows.withColumn("CODIGO", F.when(F.col("CODIGO") != "01-01-0001-46", F.col("CODIGO"))),
    "schema": lambda rows: rows.withColumn("Unnamed: 19", F.lit("")),
    "repeated_keys": lambda rows: rows.withColumn("CODIGO", F.lit("01-01-0001-46")),
    "parent_coverage": lambda rows: rows.withColumn("DEPARTAMENTO", F.lit("PETEN")),
    "key_order": lambda rows: rows.orderBy(F.desc("CODIGO")),
}


@pytest.mark.parametrize("name", BROKEN)
def test_each_invariant_can_fail(spark, tmp_path, name):
    path = str(tmp_path / "t")
    BROKEN[name](clean_table(spark, [{} for _ in range(4)]).drop("row_id")).coalesce(1).write.parquet(path)
    parents = spark.createDataFrame([("GUATEMALA",)], "p string")
    rows = spark.read.parquet(path)
    got = {r.invariant: r.violations for r in X.invariants(rows, SCHOOLS, parents, rows=4, path=path).collect()}
    assert set(got) == set(BROKEN) and got[name] > 0


def test_files_are_ordered_by_number(spark):
    files = ["part-100000-x.parquet", "part-99999-x.parquet", "part-00002-x.parquet"]
    df = spark.createDataFrame([(f,) for f in files], "f string")
    assert [r.f for r in df.orderBy(X.file_number("f"), "f").collect()] == files[::-1]


def test_nothing_is_published_when_a_check_fails(spark, places, tmp_path):
    with pytest.raises(InvalidTable):
        X.publish(clean_table(spark, [{"TELEFONO": "1"}]), SCHOOLS, places, str(tmp_path / "bad"))
    assert list(tmp_path.iterdir()) == []


def test_order_breaks_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(c,) for c in "abdce"], "k string").coalesce(1).write.parquet(path)
    assert X.order_breaks(spark, path, "k").first().violations == 1


def test_corrections(spark):
    df = clean_table(spark, [{}, {"SECTOR": None}])
    ledger = spark.createDataFrame([
        ("01-01-0000-46", "SECTOR", "PRIVADO", "OFICIAL"), ("01-01-0001-46", "SECTOR", None, "PRIVADO"),
        ("01-01-0000-46", "AREA", "RURAL", "URBANA"), ("x", "AREA", "URBANA", "RURAL"),
    ], "key string, variable string, before string, after string")
    fixed, stale, conflicts = X.apply_corrections(df, ledger, SCHOOLS)
    assert conflicts.count() == 0
    assert [(r.SECTOR, r.AREA) for r in fixed.orderBy("row_id").collect()] == [("OFICIAL", "URBANA"), ("PRIVADO", "URBANA")]
    assert {(r.key, r.variable) for r in stale.collect()} == {("01-01-0000-46", "AREA"), ("x", "AREA")}
    same = X.apply_corrections(df, ledger.limit(0), SCHOOLS)[0]
    assert sorted(same.collect()) == sorted(df.collect())


def test_contradicting_corrections_change_nothing(spark):
    df = clean_table(spark, [{}, {"SECTOR": None}])
    ledger = spark.createDataFrame([
        ("01-01-0000-46", "SECTOR", "PRIVADO", "OFICIAL"), ("01-01-0000-46", "SECTOR", "PRIVADO", "MUNICIPAL"),
        ("01-01-0001-46", "SECTOR", None, None), ("01-01-0001-46", "SECTOR", None, "OFICIAL"),
        ("01-01-0001-46", "AREA", "URBANA", None), ("01-01-0001-46", "AREA", "URBANA", None),
    ], "key string, variable string, before string, after string")
    fixed, stale, conflicts = X.apply_corrections(df, ledger, SCHOOLS)
    assert [(r.SECTOR, r.AREA) for r in fixed.orderBy("row_id").collect()] == [("PRIVADO", "URBANA"), (None, None)]
    assert stale.count() == 0
    assert sorted(map(str, conflicts.collect())) == sorted(map(str, ledger.where("variable = 'SECTOR'").collect()))


def test_profiles_merge_and_read_only_new_files(spark, tmp_path):
    columns, shapes = ["a", "b"], {"a": (r"[0-9]{2}",)}
    rows = [("01", " x"), ("N/A", "y  z"), (None, "\u200by"), ("1", "Q"), ("02", None), ("01", "-")]
    read = []

    def reader(paths):
        read.append(len(paths))
        return spark.read.schema("a string, b string").parquet(*paths)

    def visit():
        files = PS.refresh(spark, str(tmp_path / "states"), str(tmp_path / "data"), reader, columns, shapes)
        return {r.variable: r.asDict() for r in PS.merged(files).collect()}, PS.totals(PS.merged(files)).first().asDict()

    def add(name, part):
        spark.createDataFrame(part, "a string, b string").coalesce(1).write.parquet(str(tmp_path / "data" / name))

    add("one", rows[:3])
    add("two", rows[3:])
    whole = spark.createDataFrame(rows, "a string, b string")
    got, totals = visit()
    missing = {r.variable: r.missing for r in A.missing_by_column(whole).collect()}
    forms = {r.variable: r.asDict() for r in A.text_format(whole).collect()}
    distinct = {r.variable: r.distinct_values for r in A.distinct_values(whole).collect()}
    for c in columns:
        assert got[c]["rows"] == 6 and got[c]["missing"] == missing[c] and got[c]["distinct_estimate"] == distinct[c]
        assert {k: got[c][k] for k in forms[c] if k != "variable"} == {k: v for k, v in forms[c].items() if k != "variable"}
    assert (got["a"]["valid"], got["a"]["invalid"], got["b"]["valid"]) == (3, 1, None)
    assert totals == A.missing_total(whole).first().asDict()
    assert read == [2] and visit() == (got, totals) and read == [2]  # nothing new, nothing read
    add("three", rows[:1])
    assert visit()[0]["a"]["rows"] == 7 and read == [2, 1]
    shutil.rmtree(tmp_path / "data" / "one")
    assert visit()[0]["a"]["rows"] == 4 and read == [2, 1]


def test_estimates_stay_within_the_stated_error(spark):
    df = spark.range(60_000).select(F.col("id").cast("string").alias("v"), F.concat(F.lit("f"), F.col("id") % 7).alias("file"),
                                    F.lit(1).alias("bytes"), F.current_timestamp().alias("modified"))
    estimate = PS.merged(PS.states(df, ["v"])).first().distinct_estimate
    assert abs(estimate - 60_000) < 3 * 1.04 / 2 ** (PS.LG_K / 2) * 60_000


def test_repeated_keys_over_batches_and_a_restart(spark, tmp_path):
    schema, found = "row_id bigint, code string, at timestamp", []

    def run(rows, options=None):
        spark.createDataFrame([(i, c, datetime(2024, 1, d)) for i, c, d in rows], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        (repeated_codes(stream, "code", "row_id", "at", **(options or {})).writeStream.outputMode("update")
         .option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, _: found.extend(map(tuple, df.collect())))
         .trigger(availableNow=True).start().awaitTermination())
        out = sorted(found)
        found.clear()
        return out

    assert run([(1, "a", 1), (2, "b", 1), (3, "b", 1), (4, None, 1), (5, None, 1)]) == [("b", 2, 0, 2)]
    assert run([(6, "a", 2), (7, "c", 2), (0, "b", 2)]) == [("a", 1, 1, 1), ("b", 2, 2, 1)]  # a row of each batch
    run([(8, "z", 20)])  # the watermark passes all others by more than a day
    assert run([(9, "y", 21)]) == []
    assert run([(10, "a", 22)]) == []  # its state was dropped
    rows = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "x", "y")], "row_id bigint, k string, v string").withColumn("at", F.current_timestamp())
    rows.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    query = repeated_rows(stream, ["k", "v"], "row_id", "at").writeStream.outputMode("update").format("memory").queryName("same_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.first_row_id, r.seen_now) for r in spark.table("same_rows").collect()] == [(1, 2)]


def test_repeated_keys_share_the_states_of_their_buckets(spark, tmp_path):
    """nearly all keys come once; a state and a call for each of them do not scale."""
    schema, found, draw = "row_id bigint, code string, at timestamp", [], random.Random(14)
    known, watermark = {}, datetime(1970, 1, 1)  # by hand: code -> first, seen, end of its state; no row is late
    for n, day in enumerate((1, 2, 3, 20)):
        ids = range(2**60 + n * 1000, 2**60 + n * 1000 + 200)
        rows = [(i, f"c{draw.randrange(300)}" if i % 3 else "hot", datetime(2024, 1, day + draw.randrange(2))) for i in ids]
        rows += [(None, f"only{n}", datetime(2024, 1, day)), (None, f"twice{n % 2}", datetime(2024, 1, day)), (7, f"twice{n % 2}", None)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        query = (repeated_codes(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "code", "row_id", "at", buckets=8)
                 .writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
                 .foreachBatch(lambda df, _: found.extend(map(tuple, df.collect()))).trigger(availableNow=True).start())
        query.awaitTermination()
        expected = []
        for code in {r[1] for r in rows}:
            mine = [r for r in rows if r[1] == code]
            first, seen, _ = known.get(code, (min((r[0] for r in mine if r[0] is not None), default=None), 0, None))
            known[code] = first, seen + len(mine), max([watermark, *(r[2] for r in mine if r[2])]) + timedelta(days=1)
            if seen + len(mine) > 1:
                expected.append((code, first, seen, len(mine)))
        watermark = max(watermark, max(r[2] for r in rows if r[2]) - timedelta(hours=1))
        known = {code: state for code, state in known.items() if state[2] >= watermark}
        assert sorted(found) == sorted(expected)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
        found.clear()


def test_cleaning_takes_a_stream(spark, places, tmp_path):
    raw = raw_table(spark, [{"ESTABLECIMIENTO": " liceo  x "}, {"TELEFONO": "1"}])
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (clean_stream(stream, SCHOOLS, places).writeStream.format("memory").queryName("cleaned_rows")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    assert sorted(spark.table("cleaned_rows").collect()) == sorted(clean_stream(raw, SCHOOLS, places).collect())
