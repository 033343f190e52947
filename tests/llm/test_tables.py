"""Operators over whole tables, against brute force and SQL."""

import gzip
import hashlib
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pulcra import session
from pulcra.llm import components, exact, mixing, simhash, suite, warc
from pulcra.llm._base import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "a  b\tc", "x"), (2, "a b c", "x"), (2, "a b c", "x"), (3, None, None), (4, "", "y"), (5, " ", "y"), (6, "  \n", "z"),
    (None, "a b c", "y"), (None, None, "x"), (7, "word " * 30000, "x"), (8, "word " * 30000, None), (9, "\x1c", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 7) for r in ODD], "doc_id long, text string, source string, kept int")


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(QUERIES) & {n for n in QUERIES if re.match("op[0-9]", n)}))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    key = want.columns[0]
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    got, want = (x.sort_values(key).reset_index(drop=True)[list(want.columns)] for x in (got, want))
    for c in want.columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, odd, weak):
    digest = (lambda t: F.unhex(F.lpad(F.hex(F.octet_length(t) % 3), 2, "0"))) if weak else exact.sha256
    rows = exact.exact_dedup(odd, carry=True, digest=digest).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups: dict = {}
    for i, t, _ in ODD:
        groups.setdefault(norm(t), []).append(i)
    assert len(rows) == len(ODD)
    for r in rows:
        ids = groups[norm(r["row"]["text"])]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
    kept = [norm(r["row"]["text"]) for r in rows if r["kept"]]
    assert sorted(kept) == sorted(groups)
    assert exact.unique_rows(odd).columns == odd.columns and exact.unique_rows(odd.limit(0)).count() == 0


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, odd, monkeypatch):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 400, 300)]
    rows = [(i, t) for i, t, _ in ODD if i != 7 and i != 8]
    for k in range(60):  # near copies of one text, and copies of these
        w = list(words)
        for i in rng.integers(0, 300, k % 4):
            w[i] = f"v{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, " ".join(f"u{i}" for i in rng.integers(0, 9999, 50))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    first: dict = {}
    for (i, _), g in zip(rows, group, strict=True):
        first[g] = min((x for x in (first.get(g), i) if x is not None), default=None)
    want = sorted(((i, f"{p:016x}", first[g]) for (i, _), p, g in zip(rows, prints, group, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert all(simhash.fingerprint((t or "").encode()) & (1 << 64) - 1 == p for (_, t), p in zip(rows, prints, strict=True))


def test_links_find_every_close_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 40)
    prints = {int(b) ^ sum(1 << int(k) for k in rng.choice(63, n, replace=False)) for b in base for n in range(7)}
    rows = spark.createDataFrame([(p,) for p in prints], "_fp long")
    got = [tuple(r) for r in simhash.links(rows).collect()]
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want
    plan = simhash.links(rows)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" not in plan


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    edges = [*chain, (100, 99), (99, 98), (98, 98), (None, 5), (7, 3), (7, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 98: 98, 99: 98, 100: 98}


def test_near_stage_against_brute_force(spark):
    """Near copies, texts that share an id, rows without id, and lone texts."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in rng.integers(0, 400, 300)]
    rows = []
    for k in range(40):
        w = list(words)
        for i in rng.integers(0, 300, k % 4):
            w[i] = f"v{k}"
        rows.append((100 + k % 20, " ".join(w)))
    rows += [(k % 25 if k % 7 else None, " ".join(f"u{i}" for i in rng.integers(0, 9999, 50))) for k in range(50)]
    rows += [(500, ""), (501, None), (502, "a"), (502, "b"), (503, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit("en")).withColumn("row", F.lit(1))
    prints, group = [plain_print(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    kept = corpus_pipeline.near_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    place = {(i, t): g for (i, t), g in zip(rows, group, strict=True)}
    got = sorted({(place[r["doc_id"], r["text"]], r["doc_id"], r["text"]) for r in kept.collect()})
    least = {g: min((i for (i, _), h in zip(rows, group, strict=True) if h == g and i is not None), default=None) for g in group}
    assert [(g, i) for g, i, _ in got] == sorted(least.items()) and len(least) < len(rows) - 30
    assert simhash.unique_rows(docs.limit(0)).count() == 0


PAGES = [
    (1, "http://a.org/x?y", "p" * 1000), (2, "http://b.org/", "p" * 1000), (2, "http://b.org/", "p" * 1000), (3, None, None), (4, "http://c.org", ""),
    (5, "http://d.org/a\r\nb", "q" * 999), (6, "nonsense", "q" * 999), (7, "http://e.org/é", "é😀" * 500 + "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
    (None, "http://f.org/", "r" * 2000), (8, "http://g.org/", "WARC/1.1\r\n" * 50), (9, "http://h.org/", "x\r\n\r\ny" * 30000),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, revisit int")
    path = f"file://{tmp_path}/w"
    warc.write_archive(pages, path)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(Path(tmp_path, "w").glob("*.gz")))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    records = warc.read_archive(spark, path)
    assert records.count() == 3 * len(PAGES) and records.filter("not complete").count() == 0
    captures = warc.assemble(records)
    assert captures.count() == len(PAGES) and captures.filter("size(requests) = 1 and size(metadata) = 1").count() == len(PAGES)
    bodies = {bytes(r[0]) for r in captures.filter("response.type = 'response'").select("response.payload").collect()}
    assert bodies == {(h or "").encode() for _, _, h in PAGES}
    got = sorted((tuple(r) for r in warc.page_table(captures).collect()), key=str)
    want = []
    for k, (i, _, h) in enumerate(PAGES):
        body = (h or "").encode()
        same = [j for j, _, g in PAGES if (g or "") == (h or "")]
        first = len(body) < 1000 or i == max((x for x in same if x is not None), default=None) and PAGES.index(PAGES[k]) == k
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if first else "revisit", None if first else max(same), True))
    assert got == sorted(want, key=str)
    empty = f"file://{tmp_path}/e"
    warc.write_archive(pages.limit(0), empty)
    assert warc.page_table(warc.assemble(warc.read_archive(spark, empty))).count() == 0


def test_warc_assembly_of_other_archives(spark, tmp_path):
    def record(kind, rid, block, *more, kind_of="text/plain"):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", *more, f"Content-Type: {kind_of}", f"Content-Length: {len(block)}"]
        return gzip.compress(("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r\n").encode())

    http = "application/http; msgtype=response"
    parts = [record("warcinfo", "w", "x"), record("request", "q1", "GET"), record("response", "r1", "HTTP/1.1 200\r\n\r\nbody", "WARC-Concurrent-To: <q1>", kind_of=http),
             record("metadata", "m1", "a: b", "WARC-Concurrent-To: <q1>"), record("request", "q2", "GET", "WARC-Concurrent-To: <gone>"),
             record("metadata", "m2", "c: d", "WARC-Concurrent-To: <gone>"), record("response", "r3", "HTTP/1.1 200\r\n\r\nalone", kind_of=http)]
    Path(tmp_path, "a.warc.gz").write_bytes(b"".join(parts))  # one member per record
    Path(tmp_path, "b.warc.gz").write_bytes(gzip.compress(gzip.decompress(parts[2])[:-20]))  # cut off
    records = warc.read_archive(spark, f"file://{tmp_path}/*.warc.gz")
    assert records.filter("not complete").count() == 1
    rows = {r["capture_id"]: r for r in warc.assemble(records).collect()}
    assert set(rows) == {"<r1>", "<gone>", "<r3>"} and bytes(rows["<r1>"]["response"]["payload"]) == b"body"
    ids = lambda r, k: [x["record_id"] for x in r[k] or []]
    assert ids(rows["<r1>"], "requests") == ["<q1>"]
    assert rows["<gone>"]["response"] is None and ids(rows["<gone>"], "metadata") == ["<m2>"]


def test_chains_of_concurrent_records_of_any_length(spark):
    rows = [("r", "response", []), ("q", "request", ["r"]), ("m", "metadata", ["q"]), ("m2", "metadata", ["m"]), ("m3", "metadata", ["m2"]), ("m4", "metadata", ["m3"]),
            ("r2", "response", ["x2"]), ("x1", "request", []), ("x2", "metadata", ["x1"]), ("lost", "request", ["gone"]), ("lost2", "metadata", ["lost"]),
            ("two", "metadata", ["q", "x1"]), ("r3", "response", []), ("alone", "request", None), ("r3", "response", [])]
    columns = {"record_id", "type", "concurrent_to"}
    records = spark.createDataFrame([(i, k, c) for i, k, c in rows], "record_id string, type string, concurrent_to array<string>")
    whole = spark.createDataFrame([], warc.RECORD)
    records = records.select(*[F.lit(True).alias(f.name) if f.name == "complete" else F.col(f.name) if f.name in columns
                               else F.lit(None).cast(f.dataType).alias(f.name) for f in whole.schema.fields])
    got = warc.assemble(records).collect()
    found = {r["capture_id"]: sorted(x["record_id"] for k in ("requests", "metadata", "others") for x in r[k] or []) for r in got}
    assert found["r"] == ["m", "m2", "m3", "m4", "q", "two", "x1"] and found["r2"] == ["x2"] and found["r3"] == []
    assert found["gone"] == ["lost", "lost2"] and found["alone"] == ["alone"] and len(got) == 6
    assert warc.assemble(whole).count() == 0


def test_records_cut_off_are_listed(spark, tmp_path):
    block = "x" * 50 + "WARC/1.1\r\n" * 400
    one = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\nContent-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    Path(tmp_path, "a.warc.gz").write_bytes(gzip.compress((one + one[:-2000]).encode()))
    Path(tmp_path, "b.warc.gz").write_bytes(gzip.compress(one.encode()))
    records = warc.read_archive(spark, f"file://{tmp_path}/*.warc.gz")
    cut = warc.damaged(records).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["bytes"]) for r in cut] == [("a.warc.gz", len(one) - 2000 - len("WARC/1.1\r\n"))]
    assert [len(r["payload"]) for r in records.filter("complete").collect()] == [len(block)] * 2


def test_mixing(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD)
    want = {"x": 3 + 3 + 3 + 0 + 30000, "y": 3 + 1, "z": 0, None: 30000}
    source = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): s for i, t, s in ODD}
    taken = dict.fromkeys(want, 0)
    for r in rows:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == want[s] and 0 <= r["taken"] <= 2 * r["size"]
        assert all(p is None or 0 <= p <= 1 for p in (r["position_1"], r["position_2"]))
        taken[s] += r["taken"]
    total = 1.5 * sum(want.values())
    assert taken["z"] == 0 and taken["y"] == 8  # capped at twice its size
    left = total - 8
    assert taken["x"] == min(2 * want["x"], int(left * 5 / 10)) or abs(sum(taken.values()) - total) <= 4
    assert abs(sum(taken.values()) - total) <= 4
    seq = mixing.sequence(odd)
    out = seq.collect()
    assert seq.columns[:4] == odd.columns and [r["mix_position"] for r in out] == sorted(r["mix_position"] for r in out)
    assert all(len(r["text"].split()) == r["mix_words"] for r in out if r["text"] != "\x1c")
    assert sum(r["mix_words"] for r in out) == sum(r["taken"] for r in rows)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_schedule_inverse_is_exact(spark):
    for knots in mixing.CURRICULUM.values():
        for share in (0.0, 0.1, 0.5, 0.9, 1.0):
            t = spark.range(1).select(mixing.inverse_demand(F.lit(share), knots)).first()[0]
            grid = np.linspace(0, 1, 200001)
            rate = np.interp(grid, *zip(*knots, strict=True))
            assert np.interp(t, grid, np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)]) / ((rate[1:] + rate[:-1]) / 2).sum()) == pytest.approx(share, abs=1e-4)


def test_pipeline(spark, tmp_path):
    """Stage by stage on the small table: what each drops and what it keeps."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.count()
        if k < 4:
            assert docs.columns == before.columns and docs.join(before, "doc_id", "left_anti").count() == 0
    norm = {r[0] for r in spark.read.parquet(f"{tmp_path}/1").select(exact.normalised(F.col("text"))).collect()}
    assert len(norm) == seen["exact"] < seen["quality"] + 1
    assert seen["near"] <= seen["exact"] and seen["benchmark"] < seen["near"]
    with session.scratch_scope() as paths:
        final = corpus_pipeline.run(spark, SF)
    assert final.count() == docs.count() and corpus_pipeline.ORACLE_SQL is None
    left = [p.rsplit("/", 1)[1].split("-")[0:2] for p in paths if Path(p).exists()]
    assert [x for x in left if x[0] == "stage"] == [["stage", "benchmark"]] and len(left) < len(paths)


def test_pipeline_on_odd_rows(spark, odd):
    out = odd.select("doc_id", "text", "source", F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.lit("x").alias("row"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        assert out.count() >= 0, name
    assert suite.QUERIES["pipeline"] is corpus_pipeline.run
