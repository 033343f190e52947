"""Profiling, catalogue and set operators (A*, J*, S11, D1, D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import WS, query, s_missing, s_percent, s_place, table
from checks.demo import CATALOGUE, CHILD_MAP, CHILD_MAP_SQL, COLUMNS, DEMO, REGISTRY, catalogue, registry
from checks.text_queries import CODE, DISTRICT
from pulcra.functions import predicates as P
from pulcra.operators import catalog as C
from pulcra.operators import dedup as D
from pulcra.operators import profile_state as PS
from pulcra.operators import profiling as A
from pulcra.session import scratch_path, written

COLS = list(COLUMNS)
COUNT_MISSING = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS variable, count(*) FILTER (WHERE {s_missing(c)}) AS missing, "
    f"count(*) AS n FROM registry" for i, c in enumerate(COLS))
ALL_MISSING = " AND ".join(s_missing(c) for c in COLS)
ROW = ", ".join(COLS)


@query("profile_missing", f"""
WITH {REGISTRY}, m AS ({COUNT_MISSING})
SELECT position, variable, missing, {s_percent('missing', 'n')} AS percent FROM m""")
def profile_missing(spark, sf_dir):
    return A.missing_by_column(registry(spark, sf_dir), COLS).drop("rows").orderBy(
        F.desc("missing"), "position")


@query("profile_missing_total", f"""
WITH {REGISTRY}, m AS ({COUNT_MISSING}), t AS (SELECT CAST(sum(missing) AS BIGINT) AS missing_cells,
  CAST(sum(n) AS BIGINT) AS total_cells, count(*) FILTER (WHERE missing > 0) AS columns_with_missing FROM m)
SELECT *, {s_percent('missing_cells', 'total_cells')} AS percent FROM t""")
def profile_missing_total(spark, sf_dir):
    return A.missing_total(registry(spark, sf_dir), COLS)


@query("profile_distinct", f"WITH {REGISTRY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) FILTER (WHERE NOT {s_missing(c)}) AS distinct_values "
    "FROM registry" for c in COLS))
def profile_distinct(spark, sf_dir):
    return A.distinct_values(registry(spark, sf_dir), COLS)


# Files of one hundred million ids each; the second visit finds the later ones.
_PROFILED = ["code", "parent", "child", "name", "address", "phone"]


@query("profile_from_states", f"WITH {REGISTRY} " + " UNION ALL ".join(
    f"""SELECT {i + 1} AS position, '{c}' AS variable, count(*) AS rows, count(*) FILTER (WHERE {s_missing(c)}) AS missing,
  count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '^[{WS}]|[{WS}]$')) AS edge_spaces,
  count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '[a-záéíóúüñ]')) AS lower_case, """
    + ("count(*) FILTER (WHERE regexp_full_match(code, 'CUSTOMER#[0-9]{{9}}')) AS valid, "
       if c == "code" else "CAST(NULL AS BIGINT) AS valid, ").replace("{{", "{").replace("}}", "}")
    + "TRUE AS distinct_fits, TRUE AS only_new_files FROM registry" for i, c in enumerate(_PROFILED)))
def profile_from_states(spark, sf_dir):
    """States of two visits, merged, against one look at all rows."""
    rows, root = registry(spark, sf_dir), scratch_path(spark, "profiled")
    early = F.col("row_id") % 3 < 2

    def visit():
        files = PS.refresh(spark, f"{root}/states", f"{root}/data", lambda paths: spark.read.parquet(*paths), _PROFILED,
                           {"code": DEMO.code_patterns})
        return written(files, "visit")

    rows.where(early).write.parquet(f"{root}/data/1")
    first = visit()
    rows.where(~early).write.parquet(f"{root}/data/2")
    both = visit()
    stored = spark.read.parquet(f"{root}/states")
    again = stored.groupBy("file", "variable").count().where("count > 1").count()
    profile = PS.merged(both).join(A.distinct_values(rows, _PROFILED), "variable")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= 0.03 * F.col("distinct_values") + 1
    return profile.select(
        "position", "variable", "rows", "missing", "edge_spaces", "lower_case", "valid", near.alias("distinct_fits"),
        F.lit(again == 0 and first.count() < both.count()).alias("only_new_files"))


_ORDER_COLS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query("schema_profile", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS variable, '{t}' AS observed_type, count(*) FILTER (WHERE {c} IS NULL) "
    f"AS nulls, count(DISTINCT {c}) AS distinct_values, '{'bigint' if i < 2 else 'no definido'}' AS expected_type "
    f"FROM orders" for i, (c, t) in enumerate(_ORDER_COLS.items())))
def schema_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    kinds = A.column_types(orders, {"o_orderkey": "bigint", "o_custkey": "bigint"})
    return A.schema_profile(orders).join(
        F.broadcast(kinds.select("variable", "expected_type")), "variable")


@query("profile_text_format", f"WITH {REGISTRY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS variable,
    count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '^\\s|\\s$')) AS edge_spaces,
    count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '\\s{{2}}')) AS repeated_spaces,
    count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '[\\p{{Cc}}\\p{{Cf}}]')) AS invisible_characters,
    count(*) FILTER (WHERE NOT {s_missing(c)} AND regexp_matches({c}, '[a-záéíóúüñ]')) AS lower_case
    FROM registry""" for c in COLS))
def profile_text_format(spark, sf_dir):
    return A.text_format(registry(spark, sf_dir), COLS)


@query("document_text_format", """
SELECT 'text' AS variable, count(*) FILTER (WHERE regexp_matches(text, '[\\p{L}\\p{N}]') AND
    regexp_matches(text, '^\\s|\\s$')) AS edge_spaces,
  count(*) FILTER (WHERE regexp_matches(text, '[\\p{L}\\p{N}]') AND regexp_matches(text, '\\s{2}')) AS repeated_spaces,
  count(*) FILTER (WHERE regexp_matches(text, '[\\p{L}\\p{N}]') AND regexp_matches(text, '[\\p{Cc}\\p{Cf}]'))
    AS invisible_characters,
  count(*) FILTER (WHERE regexp_matches(text, '[\\p{L}\\p{N}]') AND regexp_matches(text, '[a-záéíóúüñ]')) AS lower_case
FROM documents""")
def document_text_format(spark, sf_dir):
    return A.text_format(table(spark, sf_dir, "documents"), ["text"])


@query("identifier_profile", f"""
WITH {REGISTRY} SELECT 'code' AS variable, count(*) FILTER (WHERE regexp_full_match(code, '{CODE}')) AS valid,
  count(*) FILTER (WHERE NOT {s_missing('code')} AND NOT regexp_full_match(code, '{CODE}')) AS invalid_present
  FROM registry
UNION ALL SELECT 'district', count(*) FILTER (WHERE regexp_full_match(district, '{DISTRICT}')),
  count(*) FILTER (WHERE NOT {s_missing('district')} AND NOT regexp_full_match(district, '{DISTRICT}'))
  FROM registry""")
def identifier_profile(spark, sf_dir):
    shapes = {"code": DEMO.code_patterns, "district": DEMO.identifiers["district"]}
    return A.identifier_patterns(registry(spark, sf_dir), shapes)


@query("frequency_topn", """
SELECT event_type, props, count(*) AS n FROM events GROUP BY ALL ORDER BY n DESC, event_type, props LIMIT 20""")
def frequency_topn(spark, sf_dir):
    return A.frequencies(table(spark, sf_dir, "events"), "event_type", "props", top=20)


@query("odd_phone_frequency", f"""
WITH {REGISTRY} SELECT phone, count(*) AS n FROM registry WHERE NOT {s_missing('phone')}
  AND NOT regexp_full_match(phone, '[2-7]\\p{{Nd}}{{7}}') GROUP BY phone ORDER BY n DESC, phone LIMIT 20""")
def odd_phone_frequency(spark, sf_dir):
    return A.frequencies(registry(spark, sf_dir), "phone", top=20, where=P.is_odd_phone(F.col("phone")))


@query("column_mismatch", f"""
WITH {REGISTRY}, b AS (SELECT parent, office, CASE WHEN parent = 'CAPITAL CITY' THEN 'AMERICA' ELSE parent END AS m
  FROM registry WHERE NOT regexp_full_match(parent, '\\s*') AND NOT regexp_full_match(office, '\\s*'))
SELECT count(*) AS compared, count(*) FILTER (WHERE parent <> office) AS literal_differences,
  count(*) FILTER (WHERE NOT ({s_place('office')} = {s_place('m')}
    OR starts_with({s_place('office')}, {s_place('m')} || ' '))) AS relation_errors FROM b""")
def column_mismatch(spark, sf_dir):
    return A.relation_mismatches(registry(spark, sf_dir), "parent", "office", DEMO.parent_map)


@query("empty_rows", f"""
WITH {REGISTRY}, g AS (SELECT {ROW}, count(*) AS n FROM registry GROUP BY ALL)
SELECT CAST(coalesce(sum(n) FILTER (WHERE {ALL_MISSING}), 0) AS BIGINT) AS empty_rows,
  CAST(sum(n - 1) AS BIGINT) AS duplicates,
  CAST(sum(n - 1) FILTER (WHERE NOT ({ALL_MISSING})) AS BIGINT) AS duplicates_without_empty FROM g""")
def empty_rows(spark, sf_dir):
    return A.empty_rows(registry(spark, sf_dir), COLS)


@query("real_rows", f"WITH {REGISTRY} SELECT * FROM registry WHERE NOT ({ALL_MISSING})")
def real_rows(spark, sf_dir):
    return A.real_rows(registry(spark, sf_dir), COLS)


PARENT_OK = f"{s_place('parent')} IN (SELECT parent FROM catalogue)"
PAIR_OK = f"({s_place('parent')}, {s_place('child')}) IN (SELECT (parent, child) FROM catalogue)"


@query("catalog_flags", f"""
WITH {REGISTRY}, {CATALOGUE}
SELECT row_id, {PARENT_OK} AS parent_known, {PAIR_OK} AS pair_known FROM registry""")
def catalog_flags(spark, sf_dir):
    return C.flag_places(registry(spark, sf_dir), "parent", "child", catalogue(spark, sf_dir)).select(
        "row_id", "parent_known", "pair_known")


# Every order with its customer as a place; half of them under one parent.
VISITS = """visits AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'BUILDING' WHEN o_orderkey % 11 = 1 THEN 'nowhere'
  WHEN o_orderkey % 13 = 1 THEN NULL ELSE lower(c_mktsegment) END AS parent,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE c_name END AS child
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)"""
PLACES = "SELECT c_mktsegment AS parent, c_name AS child FROM {customer} WHERE c_custkey % 3 <> 0 AND c_mktsegment <> 'FURNITURE'"


@query("catalog_flags_large", f"""
WITH {VISITS.format(orders='orders', customer='customer')}, p AS ({PLACES.format(customer='customer')})
SELECT o_orderkey, coalesce(upper(parent) IN (SELECT parent FROM p), FALSE) AS parent_known,
  EXISTS (SELECT 1 FROM p WHERE p.parent = upper(v.parent) AND p.child = v.child) AS pair_known FROM visits v""")
def catalog_flags_large(spark, sf_dir):
    """J2, P7, P8 with a catalogue that grows with the data and is not broadcast."""
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "customer")}
    visits = spark.sql(f"WITH {VISITS} SELECT * FROM visits", **tables)
    places = spark.sql(PLACES, customer=tables["customer"])
    return C.flag_places(visits, "parent", "child", places, small=False).select("o_orderkey", "parent_known", "pair_known")


@query("catalog_outside_frequency", f"""
WITH {REGISTRY}, {CATALOGUE}
SELECT child, count(*) AS n FROM registry WHERE NOT regexp_full_match(parent, '\\s*')
  AND NOT regexp_full_match(child, '\\s*') AND NOT {PAIR_OK} GROUP BY child ORDER BY n DESC, child LIMIT 30""")
def catalog_outside_frequency(spark, sf_dir):
    rows = C.outside_catalogue(registry(spark, sf_dir), "parent", "child", catalogue(spark, sf_dir))
    return A.frequencies(rows, "child", top=30)


@query("coverage_diff", f"""
WITH {REGISTRY}, o AS (SELECT DISTINCT upper(trim(parent)) AS k FROM registry WHERE NOT regexp_full_match(parent, '\\s*')),
e AS (SELECT r_name AS k FROM region UNION SELECT n_name FROM nation)
SELECT k, 'extra' AS status FROM (SELECT k FROM o EXCEPT SELECT k FROM e)
UNION ALL SELECT k, 'absent' FROM (SELECT k FROM e EXCEPT SELECT k FROM o)""")
def coverage_diff(spark, sf_dir):
    seen = registry(spark, sf_dir).where(P.is_nonblank(F.col("parent"))).select(
        F.upper(F.trim("parent")).alias("k"))
    expected = table(spark, sf_dir, "region").select(F.col("r_name").alias("k")).unionByName(
        table(spark, sf_dir, "nation").select(F.col("n_name").alias("k")))
    return C.coverage(seen, expected, "k")


@query("map_hits", f"""
WITH {REGISTRY} SELECT count(*) AS hits FROM (SELECT DISTINCT upper(trim(child)) FROM registry
  INTERSECT SELECT a FROM (VALUES {CHILD_MAP_SQL}) m(a, b))""")
def map_hits(spark, sf_dir):
    mapping = spark.createDataFrame(list(CHILD_MAP.items()), "a string, b string")
    return C.map_hits(registry(spark, sf_dir), "child", mapping)


@query("code_lookup_rejects", """
WITH codes(name, code) AS (VALUES ('1-URGENT', '01'), ('2-HIGH', '02'), ('3-MEDIUM', '03'), ('5-LOW', '05'))
SELECT o_orderkey, o_orderpriority, code FROM orders LEFT JOIN codes ON upper(trim(o_orderpriority)) = name""")
def code_lookup_rejects(spark, sf_dir):
    codes = spark.createDataFrame(
        [("1-Urgent ", "01"), ("2-high", "02"), ("3-MEDIUM", "03"), ("5-LOW", "05")],
        "name string, code string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return C.resolved_codes(orders, "o_orderpriority", codes, "code").drop("known")


@query("code_lookup_folded", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B 1' WHEN 'MACHINERY' THEN 'M 1' END AS code,
  c_mktsegment IN ('BUILDING', 'MACHINERY') AS known FROM customer""")
def code_lookup_folded(spark, sf_dir):
    """Spaces inside a name fold alike in the table and in the rows."""
    codes = spark.createDataFrame(
        [("old  building ", "B 1"), (" Old Machinery", "M 1"), ("OLD\tMACHINERY", "M 2"), ("OLD", "O")], "name string, code string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Old "), F.lit(" "), "c_mktsegment").alias("name"))
    return C.resolved_codes(rows, "name", codes, "code").drop("name")


@query("exact_dup_count", f"""
WITH {REGISTRY}
SELECT 'documents' AS source, CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)
UNION ALL SELECT 'registry', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM registry GROUP BY {ROW})""")
def exact_dup_count(spark, sf_dir):
    docs = A.exact_duplicates(table(spark, sf_dir, "documents"), ["text", "lang"])
    reg = A.exact_duplicates(registry(spark, sf_dir), COLS)
    return docs.select(F.lit("documents").alias("source"), "duplicates").unionByName(
        reg.select(F.lit("registry").alias("source"), "duplicates"))


@query("exact_dup_members", """
SELECT doc_id, text, lang, count(*) OVER (PARTITION BY text, lang) AS copies FROM documents
QUALIFY copies > 1""")
def exact_dup_members(spark, sf_dir):
    return D.duplicate_members(table(spark, sf_dir, "documents"), ["text", "lang"], "doc_id")
