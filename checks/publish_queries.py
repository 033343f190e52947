"""Sources, manifests and publication (S*, J5, X*, V12)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from checks.base import query, table
from checks.clean_queries import BASE, CLEAN, OUT, s_rules
from checks.demo import CATALOGUE, COLUMNS, DEMO, REGISTRY, catalogue, registry
from pulcra.functions import predicates as P
from pulcra.operators import validation as V
from pulcra.plans import publish as X
from pulcra.plans.cleaning import clean_stages, cleaned_rows
from pulcra.session import scratch_path, written
from pulcra.sources import csv, manifest
from pulcra.sources.blocks import separator_blocks

COLS = list(COLUMNS)
FILE_ROW = ", ".join(COLS)


def stored_csv(spark, rows) -> str:
    path = scratch_path(spark, "csv")
    csv.write_csv(rows, path)
    return path


# No field of the registry holds a line break, so its files are split.
PLAIN = {"columns": COLS}


@query("csv_roundtrip", f"WITH {REGISTRY} SELECT {FILE_ROW} FROM registry")
def csv_roundtrip(spark, sf_dir):
    """Written and read back, blanks stay ''."""
    return csv.read_raw(spark, stored_csv(spark, registry(spark, sf_dir).select(*COLS)), **PLAIN)


@query("csv_documents", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def csv_documents(spark, sf_dir):
    """S1, S8 on whole multi-line texts."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").cast("string").alias("n_chars"))
    return csv.read_raw(spark, stored_csv(spark, docs), docs.columns, multiline=True)


# Segments with planted not-available tokens, and one (' N/A ') that is none.
TOKENS = ("CASE row_id % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NULL' WHEN 2 THEN 'nan' WHEN 3 THEN '-1.#IND' "
          "WHEN 4 THEN 'n/a' WHEN 5 THEN ' N/A ' WHEN 6 THEN '' ELSE segment END")
PLANTED = f"WITH {REGISTRY}, planted AS (SELECT * REPLACE ({TOKENS} AS segment) FROM registry)"


def planted_csv(spark, sf_dir) -> str:
    rows = registry(spark, sf_dir).withColumn("segment", F.expr(TOKENS))
    return stored_csv(spark, rows.select(*COLS))


@query("csv_for_validation", f"{PLANTED} SELECT {', '.join(f'nullif({c}, {chr(39)*2}) AS {c}' for c in COLS)} FROM planted")
def csv_for_validation(spark, sf_dir):
    """Only the empty field is missing, markers stay."""
    return csv.read_for_validation(spark, planted_csv(spark, sf_dir), **PLAIN)


@query("csv_default_na", f"{PLANTED} SELECT " + ", ".join(
    f"CASE WHEN {c} IN ('', 'N/A', 'NULL', 'nan', '-1.#IND', 'n/a') THEN NULL ELSE {c} END AS {c}" for c in COLS)
    + " FROM planted")
def csv_default_na(spark, sf_dir):
    """S3: the usual tokens are missing (' N/A ' keeps its spaces and stays)."""
    return csv.read_default_na(spark, planted_csv(spark, sf_dir), **PLAIN)


@query("csv_union", f"WITH {REGISTRY} SELECT {FILE_ROW} FROM registry WHERE NOT ({' AND '.join(f'{c} = {chr(39)*2}' for c in COLS)})")
def csv_union(spark, sf_dir):
    """Two files of one layout, wholly blank rows dropped."""
    rows = registry(spark, sf_dir)
    halves = [rows.where(F.col("row_id") % 2 == i).select(*COLS) for i in (0, 1)]
    return csv.union_files(spark, [stored_csv(spark, h) for h in halves], drop_blank=True, **PLAIN)


@query("union_all_sources", f"WITH {REGISTRY} SELECT row_id, code, 'registry' AS source FROM registry "
       "UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def union_all_sources(spark, sf_dir):
    extra = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("code"), F.lit("supplier").alias("source"))
    return registry(spark, sf_dir).select("row_id", "code", F.lit("registry").alias("source")).unionByName(extra)


@query("constant_breaks", f"WITH {REGISTRY} SELECT row_id, status FROM registry "
       "WHERE NOT regexp_full_match(code, '\\s*') AND status IS DISTINCT FROM 'OPEN'")
def constant_breaks(spark, sf_dir):
    """S10."""
    rows = csv.expect_columns(registry(spark, sf_dir), ["row_id", *COLS])
    return csv.constant_breaks(rows, "status", "OPEN", P.is_nonblank(F.col("code"))).select("row_id", "status")


@query("separator_blocks", f"""WITH {REGISTRY}
SELECT row_id, code, CAST(coalesce(sum(sep) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS BIGINT) + 1 AS block_no, sep = 1 AS is_separator
FROM (SELECT *, CASE WHEN {' AND '.join(f"regexp_full_match({c}, '[ ]*')" for c in COLS)} THEN 1 ELSE 0 END AS sep FROM registry)""")
def blocks(spark, sf_dir):
    blank = ~P.is_nonblank(F.concat(*[F.col(c) for c in COLS]))
    return separator_blocks(registry(spark, sf_dir), "row_id", blank).select(
        "row_id", "code", "block_no", "is_separator")


def s_print(src: str, columns: list[str]) -> str:
    text = ", ".join(f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '~')" for c in columns)
    return (f"SELECT count(*) AS rows, coalesce(bit_xor(d), 0) AS \"xor\", CAST(coalesce(sum(d), 0) AS VARCHAR) AS total "
            f"FROM (SELECT CAST('0x' || substr(sha256(concat({text})), 1, 15) AS BIGINT) AS d FROM {src})")


@query("block_reunion", f"WITH {REGISTRY} {s_print('registry', COLS)}")
def block_reunion(spark, sf_dir):
    """The blocks, put together again, are the table."""
    blank = ~P.is_nonblank(F.concat(*[F.col(c) for c in COLS]))
    return X.fingerprint(separator_blocks(registry(spark, sf_dir), "row_id", blank), COLS)


LINE = "concat(CAST(row_id AS STRING), '|', code, '|', coalesce(name, ''))"
BATCH = 100_000


BATCH_LINES = f"WITH {REGISTRY}, lines AS (SELECT row_id, row_id // {BATCH} AS batch, {LINE} AS line FROM registry)"


def batch_files(spark, sf_dir) -> str:
    """One text file for each 100,000 ids, so its content and digest are known."""
    path = scratch_path(spark, "batches")
    lines = registry(spark, sf_dir).select("row_id", F.floor(F.col("row_id") / BATCH).alias("batch"), F.expr(LINE).alias("value"))
    lines.repartition("batch").sortWithinPartitions("batch", "row_id").select("batch", "value").write.partitionBy("batch").text(path)
    return path


@query("file_digests_in_pieces", f"""{BATCH_LINES}
SELECT 'batch=' || batch AS folder, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS bytes,
  sha256(string_agg(line || chr(10), '' ORDER BY row_id)) AS sha256 FROM lines GROUP BY batch""")
def file_digests_in_pieces(spark, sf_dir):
    """Files above a kilobyte are read in pieces, smaller ones whole."""
    found = manifest.file_digests(spark, f"{batch_files(spark, sf_dir)}/*/*.txt", 2, whole=1024)
    return found.select(F.split("file", "/")[0].alias("folder"), "bytes", "sha256")


@query("source_manifest", f"""WITH {REGISTRY}, lines AS (SELECT row_id, row_id // {BATCH} AS batch, {LINE} AS line FROM registry)
SELECT CAST(batch AS VARCHAR) AS query_key, 'ALL' AS level, count(*) AS rows, '2026-01-31' AS extracted,
  'batch=' || batch AS folder, sha256(string_agg(line || chr(10), '' ORDER BY row_id)) AS sha256 FROM lines GROUP BY batch""")
def source_manifest(spark, sf_dir):
    """S6, S7."""
    path = batch_files(spark, sf_dir)
    rows = spark.read.text(path).select(
        F.col("batch").cast("string").alias("batch"), manifest.file_name(F.col("_metadata.file_path"), 2).alias("file"))
    digests = manifest.file_digests(spark, f"{path}/*/*.txt", 2)
    listed = manifest.source_manifest(rows, "batch", "file", digests, level="ALL", extracted="2026-01-31")
    return listed.select("query_key", "level", "rows", "extracted", F.split("file", "/")[0].alias("folder"), "sha256")


@query("file_digests")
def file_digests(spark, sf_dir):
    """S7 over the given files themselves; the SQL side has no file access."""
    return manifest.file_digests(spark, f"{sf_dir}/*.parquet")


@query("table_fingerprint", f"""WITH {REGISTRY} SELECT 'registry' AS source, * FROM ({s_print('registry', COLS)})
UNION ALL SELECT 'documents', * FROM ({s_print('documents', ['doc_id', 'text', 'lang', 'source', 'n_chars'])})
UNION ALL SELECT 'conversations', * FROM ({s_print('conversations', ['conv_id', 'turn', 'role', 'text'])})""")
def table_fingerprint(spark, sf_dir):
    """The same for any layout of the rows."""
    parts = {"registry": X.fingerprint(registry(spark, sf_dir), COLS)}
    for name in ("documents", "conversations"):
        parts[name] = X.fingerprint(table(spark, sf_dir, name))
    named = [df.select(F.lit(n).alias("source"), "rows", "xor", "total") for n, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("row_differences", f"""WITH {REGISTRY}, b AS (SELECT * REPLACE (upper(segment) AS segment) FROM registry),
t AS (SELECT {FILE_ROW}, 1 AS n FROM registry UNION ALL SELECT {FILE_ROW}, -1 FROM b)
SELECT {FILE_ROW}, CAST(sum(n) AS BIGINT) AS surplus FROM t GROUP BY {FILE_ROW} HAVING sum(n) <> 0""")
def row_differences(spark, sf_dir):
    rows = written(registry(spark, sf_dir).select(*COLS), "rows")
    return X.row_differences(rows, rows.withColumn("segment", F.upper("segment")))


VALID = f"""{BASE}, bad AS (SELECT DISTINCT row_id FROM ({' UNION ALL '.join(
    f"SELECT row_id FROM cleaned WHERE {broken}" for *_, broken in s_rules('cleaned', OUT))})),
valid AS (SELECT {', '.join(OUT)} FROM cleaned WHERE row_id NOT IN (SELECT row_id FROM bad))"""


def valid_rows(spark, sf_dir):
    """Cleaned rows without any finding: a table that may be published."""
    wide, _ = clean_stages(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))
    data = written(cleaned_rows(wide, DEMO), "cleaned")
    found = V.violations(data, DEMO, catalogue(spark, sf_dir)).select("row_id").distinct()
    return written(data.join(found, "row_id", "left_anti"), "valid")


@query("publish_sorted", f"{VALID} SELECT *, row_number() OVER (ORDER BY code) AS rank FROM valid")
def publish_sorted(spark, sf_dir):
    """Gate, sort, stage, reload, gate again, compare, rename."""
    data = valid_rows(spark, sf_dir)
    path = scratch_path(spark, "published")
    X.publish(data, DEMO, catalogue(spark, sf_dir), path)
    back = spark.read.parquet(path)
    broken = X.order_breaks(spark, path, "code").first().violations
    if broken:
        raise AssertionError(f"{broken} rows out of order")
    # Dense position in file order: rows before the file plus the row's own index.
    placed = back.select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    sizes = placed.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("f", F.coalesce(F.sum("n").over(
        Window.orderBy(X.file_number("f"), "f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return placed.join(starts, "f").select(*OUT, (F.col("start") + F.col("i") + 1).alias("rank"))


@query("publish_csv", f"{VALID} SELECT * FROM valid")
def publish_csv(spark, sf_dir):
    """X2 as CSV files, under a fixed name."""
    path = f"{scratch_path(spark, 'published')}/registry.csv"
    X.publish(valid_rows(spark, sf_dir), DEMO, catalogue(spark, sf_dir), path, csv=True, name="registry.csv")
    return csv.read_for_validation(spark, path, columns=OUT)


@query("publish_versions", f"""{VALID}, odd AS (SELECT * FROM valid WHERE code NOT LIKE '%4')
SELECT 'first' AS version, * FROM odd UNION ALL SELECT 'second', * FROM valid UNION ALL SELECT 'left', * FROM valid""")
def publish_versions(spark, sf_dir):
    """X2 by pointer: a first version, one that the gate refuses, a second one,
    and what is left after old versions were dropped."""
    data, places = valid_rows(spark, sf_dir), catalogue(spark, sf_dir)
    root = scratch_path(spark, "versions")
    X.publish_version(data.where("code NOT LIKE '%4'"), DEMO, places, root)
    try:
        X.publish_version(data.withColumn("phone", F.lit("1")), DEMO, places, root)
        raise AssertionError("an invalid table was published")
    except V.InvalidTable:
        first = written(X.current_table(spark, root, DEMO).select(F.lit("first").alias("version"), *OUT), "first")
    done = X.publish_version(data, DEMO, places, root)
    second = X.current_table(spark, root, DEMO)
    if len(X.drop_versions(spark, root)) != 2 or X.current_version(spark, root) != done.path.rsplit("/", 1)[1]:
        raise AssertionError("versions left behind")
    left = X.current_table(spark, root, DEMO)
    return first.unionByName(second.withColumn("version", F.lit("second"))).unionByName(left.withColumn("version", F.lit("left")))


# What breaks a valid table, in the rows whose code ends in 3, and the errors
# each check then counts: {mutation: (changed columns, {check: rows in error})}.
HIT = "code LIKE '%3'"
BROKEN = {
    "copies": ({}, {"exact_duplicates": (HIT, 1), "invalid_values": (HIT, 2)}),
    "spaces": ({"name": "concat(' ', name)"}, {"text_spaces": (f"{HIT} AND name IS NOT NULL", 1)}),
    "phones": ({"phone": "'123'"}, {"phone_format": (HIT, 1)}),
    "places": ({"child": "CASE WHEN zone IS NULL THEN 'NOWHERE' ELSE child END"}, {"official_places": (f"{HIT} AND zone IS NULL", 1)}),
    "schema": ({}, {}),
    "spelling": ({"segment": "lower(segment)"}, {"invalid_values": (HIT, 1)}),
    "domain": ({"status": "'GONE'"}, {"invalid_values": (HIT, 1)}),
}
FAILURES = " UNION ALL ".join(
    f"SELECT '{name}' AS mutation, '{check}' AS \"check\", CAST({times} * count(*) AS BIGINT) AS errors FROM valid WHERE {rows}"
    for name, (_, failed) in BROKEN.items() for check, (rows, times) in failed.items())


@query("validation_gate_failures", f"""{VALID} SELECT * FROM ({FAILURES}
UNION ALL SELECT 'schema', 'schema_and_types', 1
UNION ALL SELECT 'spelling', 'category_variants', count(*) FROM (
  SELECT segment FROM valid WHERE {HIT} INTERSECT SELECT segment FROM valid WHERE NOT {HIT})) WHERE errors > 0""")
def validation_gate_failures(spark, sf_dir):
    """V12 on tables that must not pass: each mutation with the checks it breaks."""
    data, places = valid_rows(spark, sf_dir), catalogue(spark, sf_dir)
    out = None
    for name, (changed, _) in BROKEN.items():
        bad = data.withColumns({c: F.when(F.expr(HIT), F.expr(e)).otherwise(F.col(c)) for c, e in changed.items()})
        if name == "copies":
            bad = data.unionByName(data.where(HIT))
        if name == "schema":
            bad = data.withColumn("extra", F.lit("x"))
        found = V.gate_failures(bad, DEMO, places).select(F.lit(name).alias("mutation"), "check", "errors")
        out = found if out is None else out.unionByName(found)
    return out


@query("validation_gate", f"{VALID} SELECT count(*) AS rows, 7 AS checks_passed FROM valid")
def validation_gate(spark, sf_dir):
    """V12 on a table that passes; the gate raises on any other."""
    data = valid_rows(spark, sf_dir)
    passed = V.gate(data, DEMO, catalogue(spark, sf_dir))
    return data.agg(F.count(F.lit(1)).alias("rows")).withColumn("checks_passed", F.lit(len(passed)))


@query("final_invariants", f"""WITH {REGISTRY}, {CATALOGUE}, {CLEAN}
SELECT 'row_count' AS invariant, 0 AS violations UNION ALL SELECT 'schema', 0
UNION ALL SELECT 'empty_rows', count(*) FROM cleaned WHERE {' AND '.join(f'{c} IS NULL' for c in OUT)}
UNION ALL SELECT 'missing_keys', count(*) FROM cleaned WHERE code IS NULL
UNION ALL SELECT 'repeated_keys', count(*) FROM
  (SELECT code FROM cleaned WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1)
UNION ALL SELECT 'parent_coverage', count(*) FROM (SELECT coalesce(a, b) FROM
  (SELECT DISTINCT parent AS a FROM cleaned WHERE parent IS NOT NULL)
  FULL JOIN (SELECT r_name AS b FROM region) ON a = b WHERE a IS NULL OR b IS NULL)""")
def final_invariants(spark, sf_dir):
    wide, _ = clean_stages(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))
    data = written(cleaned_rows(wide, DEMO), "cleaned")
    return X.invariants(data, DEMO, table(spark, sf_dir, "region").select("r_name"))


LEDGER = """ledger AS (
  SELECT code AS key, 'status' AS variable, status AS before, 'CLOSED' AS after FROM registry WHERE status = ''
  UNION SELECT code, 'segment', 'UNKNOWN', 'BUILDING' FROM registry WHERE segment IN ('UNKNOWN', 'MACHINÉRY')
  UNION SELECT 'CUSTOMER#X', 'name', 'a', 'b')"""


def ledger(rows):
    """Corrections for blank states and unknown segments; some match nothing."""
    spark = rows.sparkSession
    states = rows.where("status = ''").select(
        F.col("code").alias("key"), F.lit("status").alias("variable"),
        F.col("status").alias("before"), F.lit("CLOSED").alias("after"))
    segments = rows.where(F.col("segment").isin("UNKNOWN", "MACHINÉRY")).select(
        F.col("code").alias("key"), F.lit("segment").alias("variable"),
        F.lit("UNKNOWN").alias("before"), F.lit("BUILDING").alias("after"))
    stray = spark.createDataFrame([("CUSTOMER#X", "name", "a", "b")], states.schema)
    return states.unionByName(segments).unionByName(stray).distinct()


@query("corrections_overlay", f"""WITH {REGISTRY}, {LEDGER}
SELECT row_id, code, coalesce(s.after, status) AS status, coalesce(g.after, segment) AS segment
FROM registry LEFT JOIN ledger s ON s.key = code AND s.variable = 'status' AND s.before = status
LEFT JOIN ledger g ON g.key = code AND g.variable = 'segment' AND g.before = segment""")
def corrections_overlay(spark, sf_dir):
    rows = registry(spark, sf_dir)
    fixed = X.apply_corrections(rows, ledger(rows), DEMO)[0]
    return fixed.select("row_id", "code", "status", "segment")


@query("corrections_stale", f"""WITH {REGISTRY}, {LEDGER}
SELECT key, variable, before, after FROM ledger l WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.code = l.key AND
  CASE l.variable WHEN 'status' THEN r.status WHEN 'segment' THEN r.segment ELSE r.name END = l.before)""")
def corrections_stale(spark, sf_dir):
    rows = registry(spark, sf_dir)
    return X.apply_corrections(rows, ledger(rows), DEMO)[1]


TORN = f"""{LEDGER}, torn AS (SELECT * FROM ledger UNION ALL
  SELECT key, variable, before, 'PENDING' FROM ledger WHERE key LIKE '%7')"""


@query("corrections_conflicts", f"""WITH {REGISTRY}, {TORN}
SELECT key, variable, before, after, 'conflict' AS kind FROM torn
  WHERE (key, variable, before) IN (SELECT (key, variable, before) FROM torn GROUP BY key, variable, before HAVING count(DISTINCT after) > 1)
UNION ALL SELECT code, 'status', status, s.after, 'applied' FROM registry
  JOIN ledger s ON s.key = code AND s.variable = 'status' AND s.before = status WHERE NOT s.key LIKE '%7'""")
def corrections_conflicts(spark, sf_dir):
    """Entries that contradict each other are listed and change nothing."""
    rows = registry(spark, sf_dir)
    entries = ledger(rows)
    torn = entries.unionByName(entries.where("key LIKE '%7'").withColumn("after", F.lit("PENDING")))
    fixed, _, conflicts = X.apply_corrections(rows, torn, DEMO)
    changed = fixed.select("row_id", F.col("status").alias("after")).join(
        rows.select("row_id", F.col("code").alias("key"), F.col("status").alias("before")), "row_id"
    ).where(~F.col("before").eqNullSafe(F.col("after"))).select(
        "key", F.lit("status").alias("variable"), "before", "after")
    return conflicts.withColumn("kind", F.lit("conflict")).unionByName(
        changed.withColumn("kind", F.lit("applied")))


# A dictionary of the registry with one variable undocumented, one blank cell,
# one wrong version and one incomplete domain.
FIELDS = ("type", "domain", "version")
DOMAIN_TEXT = {
    "segment": "AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY", "status": "OPEN",
    "parent": "AFRICA, AMERICA, ASIA, EUROPE, MIDDLE EAST",
    "office": ", ".join(DEMO.domains["office"]),
}


def dictionary_rows() -> list[tuple]:
    rows = []
    for i, c in enumerate(COLS):
        if c == "address":
            continue
        rows.append((c, i + 1, "type", " " if c == "phone" else "text"))
        rows.append((c, i + 1, "domain", DOMAIN_TEXT.get(c, "any")))
        rows.append((c, i + 1, "version", "v0" if c == "code" else "v1"))
    return rows


@query("dictionary_check", f"""WITH {REGISTRY},
o(variable, value) AS ({' UNION '.join(f"SELECT '{c}', {c} FROM registry" for c in DOMAIN_TEXT)}),
d(variable, value) AS ({' UNION ALL '.join(f"SELECT '{c}', unnest(string_split('{t}', ', '))" for c, t in DOMAIN_TEXT.items())})
SELECT 'address' AS variable, '' AS field, 'not documented' AS problem
UNION ALL SELECT 'phone', 'type', 'blank or missing' UNION ALL SELECT 'code', 'version', 'differs from the constant'
UNION ALL SELECT DISTINCT variable, 'domain', 'observed value not documented' FROM o
  WHERE (variable, value) NOT IN (SELECT (variable, value) FROM d)""")
def dictionary_check(spark, sf_dir):
    words = spark.createDataFrame(dictionary_rows(), "variable string, position int, field string, value string")
    return X.check_dictionary(registry(spark, sf_dir), words, FIELDS, {"version": "v1"}, DEMO, "domain")
