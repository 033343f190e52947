"""Cleaning, audit log, validation and metrics (C*, V*, M*, D16, A11)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.base import WS, query, s_ascii, s_canonical, s_missing, s_percent, s_place, s_void
from checks.demo import (
    CATALOGUE, CHILD_MAP_SQL, COLUMNS, DEMO, REGIONS, REGISTRY, SEGMENTS, catalogue, registry,
)
from checks.dedup_queries import DECIDED, decided, near_dup_before_after, s_review
from checks.text_queries import CODE, DISTRICT, s_phone_list
from pulcra.operators import metrics as M
from pulcra.operators import validation as V
from pulcra.plans.cleaning import STEPS, audit_log, clean, clean_stages, clean_with_decisions, cleaned_rows
from pulcra.plans.compare import quality_before_after, stored
from pulcra.session import scratch_path
from pulcra.streaming.repeats import repeated_codes

COLS = list(COLUMNS)
OUT = list(DEMO.clean_columns)

CLEAN = f"""
canon AS (SELECT row_id, {', '.join(f"{s_canonical(c)} AS {c}" for c in COLS)} FROM registry),
std AS (SELECT row_id, {', '.join(f"CASE WHEN {s_void(c)} THEN NULL ELSE {c} END AS {c}" for c in COLS)} FROM canon),
live AS (SELECT * FROM std WHERE NOT ({' AND '.join(f'{c} IS NULL' for c in COLS)})),
child_map(a, b) AS (VALUES {CHILD_MAP_SQL}),
step AS (SELECT row_id,
    CASE WHEN regexp_full_match(replace(code, ' ', ''), '{CODE}') THEN replace(code, ' ', '') END AS code,
    CASE WHEN regexp_full_match(replace(district, ' ', ''), '{DISTRICT}') THEN replace(district, ' ', '') END AS district,
    CASE WHEN parent = 'CAPITAL CITY' THEN 'AMERICA' ELSE {s_ascii('parent')} END AS parent,
    CASE WHEN parent = 'CAPITAL CITY' THEN 'NATION_1' ELSE coalesce(b, {s_ascii('child')}) END AS mapped,
    CASE WHEN parent = 'CAPITAL CITY' AND regexp_full_match(child, 'ZONE \\p{{Nd}}{{1,2}}') THEN child END AS zone,
    name, address, nullif(array_to_string({s_phone_list('phone')}, ' / '), '') AS phone,
    regexp_replace(director, '^-{{2,}} *([\\p{{L}}\\p{{N}}_])', '\\1') AS director,
    {s_ascii('segment')} AS segment, {s_ascii('status')} AS status, {s_ascii('office')} AS office
  FROM live LEFT JOIN child_map ON {s_ascii('child')} = a),
cleaned AS (SELECT row_id, code, district, parent,
    CASE WHEN mapped IS NULL OR parent IS NULL OR ({s_place('parent')}, {s_place('mapped')})
      IN (SELECT (parent, child) FROM catalogue) THEN mapped END AS child,
    zone, name, address, phone, director, segment, status, office FROM step)"""
BASE = f"WITH {REGISTRY}, {CATALOGUE}, {CLEAN}"


@query("clean_registry", f"{BASE} SELECT * FROM cleaned")
def clean_registry(spark, sf_dir):
    wide, _ = clean_stages(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))
    return cleaned_rows(wide, DEMO)


@query("derived_before_repair", f"{BASE} SELECT row_id, zone, parent, mapped AS child FROM step")
def derived_before_repair(spark, sf_dir):
    wide, _ = clean_stages(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))
    return wide.where("real").select(
        "row_id", F.col("`out|zone`").alias("zone"), F.col("`out|parent`").alias("parent"),
        F.col("mapped_child").alias("child"))


@query("catalog_null_out", f"""{BASE}
SELECT row_id, s.parent, mapped, child FROM step s JOIN cleaned c USING (row_id)
WHERE mapped IS NOT NULL AND s.parent IS NOT NULL AND child IS NULL""".replace("SELECT row_id, s.parent", "SELECT s.row_id, s.parent"))
def catalog_null_out(spark, sf_dir):
    wide, _ = clean_stages(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))
    return wide.where(F.col("real") & F.col("outside")).select(
        "row_id", F.col("`out|parent`").alias("parent"), F.col("mapped_child").alias("mapped"),
        F.col("`out|child`").alias("child"))


def _log_lines() -> str:
    lines, no = [], 0

    def add(variable: str, step: str, source: str, changed: str, always: bool):
        nonlocal no
        no += 1
        lines.append(f"SELECT {no} AS step_no, '{variable}' AS variable, '{step}' AS step, count(*) FILTER "
                     f"(WHERE {changed}) AS affected, {str(always).upper()} AS always FROM {source}")

    for c in COLS:
        add(c, "standardise", "registry r JOIN std s USING (row_id)", f"r.{c} IS DISTINCT FROM s.{c}", False)
    add("TODAS", "drop_empty", "std", " AND ".join(f"{c} IS NULL" for c in COLS), True)
    both = "live l JOIN step s USING (row_id)"
    for c in ("code", "district", "phone"):
        add(c, "identifier", both, f"l.{c} IS DISTINCT FROM s.{c}", True)
    add("zone", "zone", both, "s.zone IS NOT NULL", True)
    add("parent", "parent", both, "l.parent IS DISTINCT FROM s.parent", True)
    add("child", "child", both, "l.child IS DISTINCT FROM s.mapped", True)
    add("director", "dashes", both, "l.director IS DISTINCT FROM s.director", False)
    for c in ("segment", "status", "office"):
        add(c, "category", both, f"l.{c} IS DISTINCT FROM s.{c}", False)
    add("child", "catalogue", "step s JOIN cleaned c USING (row_id)",
        "s.mapped IS NOT NULL AND s.parent IS NOT NULL AND c.child IS NULL", True)
    add("TODAS", "review", "review", "TRUE", True)
    return " UNION ALL ".join(lines)


SAID = ", ".join(f"({', '.join(repr(x) if chr(39) not in x else chr(39) + x.replace(chr(39), chr(39) * 2) + chr(39) for x in (k, *v))})" for k, v in STEPS.items())
LOG = f"said(step, problem, transformation, justification) AS (VALUES {SAID}), {s_review('cleaned')}, lines AS ({_log_lines()}), audit AS (SELECT * FROM lines WHERE always OR affected > 0)"


@query("audit_log", f"{BASE}, {LOG} SELECT step_no, variable, step, problem, transformation, affected, justification FROM audit JOIN said USING (step)")
def audit(spark, sf_dir):
    return clean(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir)).audit.select(
        "step_no", "variable", "step", "problem", "transformation", "affected", "justification").orderBy("step_no")


query("near_dup_before_after", f"""{BASE}, {s_review('registry', 'r_')}, {s_review('cleaned', 'c_')}
SELECT 'before' AS stage, (SELECT count(*) FROM r_review) AS pairs,
  (SELECT count(*) FROM (SELECT row_id_1 FROM r_review UNION SELECT row_id_2 FROM r_review)) AS records
UNION ALL SELECT 'after', (SELECT count(*) FROM c_review),
  (SELECT count(*) FROM (SELECT row_id_1 FROM c_review UNION SELECT row_id_2 FROM c_review))""")(near_dup_before_after)


# The blocks of the published review, none of them left out for its size.
UNLIMITED = {"title_limit": None, "phone_limit": None}
WHOLE = replace(DEMO, title_block_limit=None, phone_block_limit=None)


@query("clean_review", f"{BASE}, {s_review('cleaned', **UNLIMITED)} SELECT * FROM review")
def clean_review(spark, sf_dir):
    return clean(registry(spark, sf_dir), WHOLE, catalogue(spark, sf_dir)).review


@query("clean_decided", f"""{BASE}, {s_review('cleaned')}, {DECIDED}
SELECT * FROM cleaned WHERE row_id NOT IN (SELECT row_id_2 FROM decided WHERE decision = 'ELIMINAR')""")
def clean_decided(spark, sf_dir):
    """C11: the cleaned table after an edited review."""
    rows, places = registry(spark, sf_dir), catalogue(spark, sf_dir)
    done = clean(rows, DEMO, places)
    return clean_with_decisions(rows, DEMO, places, decided(done.review), done)


# --- validation -------------------------------------------------------------------

DOMAINS = {
    "parent": REGIONS, "segment": SEGMENTS, "status": ("OPEN", "CLOSED"),
    "office": REGIONS + tuple(f"{r} NORTE" for r in REGIONS),
}
REQUIRED = ("code", "parent", "child", "segment", "status", "office")
PHONES = "[2-7]\\p{Nd}{7}( / [2-7]\\p{Nd}{7})*"
SPACE = f"^[{WS}]|[{WS}]$|[{WS}]{{2}}"


def s_residual(c: str) -> str:
    return (f"(regexp_matches({c}, '^[{WS}]*[^\\p{{L}}\\p{{N}}{WS}][^\\p{{L}}\\p{{N}}]*$') "
            f"OR regexp_matches({c}, '^[{WS}]*-{{2,}}[{WS}]*[\\p{{L}}\\p{{N}}_]'))")


def s_fits(parent: str, label: str) -> str:
    p, q = s_place(parent), s_place(label)
    return f"({parent} IS NULL OR {label} IS NULL OR {q} = {p} OR starts_with({q}, {p} || ' '))"


def s_rules(src: str, columns: list[str]) -> list[tuple[str, int, str, str]]:
    """(check, group, variable, broken) of every row-level rule in order."""
    out: list[tuple[str, int, str, str]] = []

    def add(check: str, variable: str, broken: str, group: int | None = None):
        out.append((check, len(out) if group is None else group, variable, f"coalesce({broken}, FALSE)"))

    for c in columns:
        add("text_spaces", c, f"regexp_matches({c}, '{SPACE}')")
    add("phone_format", "phone", f"phone IS NOT NULL AND NOT regexp_full_match(phone, '{PHONES}')")
    at = len(out)
    add("official_places", "parent",
        f"parent IS NULL OR {s_place('parent')} NOT IN (SELECT parent FROM catalogue)", at)
    add("official_places", "child", f"parent IS NULL OR child IS NULL OR ({s_place('parent')}, {s_place('child')}) "
        "NOT IN (SELECT (parent, child) FROM catalogue)", at)
    add("invalid_values", "code", f"code IS NULL OR NOT regexp_full_match(code, '{CODE}') "
        f"OR code IN (SELECT code FROM {src} WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1)")
    add("invalid_values", "district", f"district IS NOT NULL AND NOT regexp_full_match(district, '{DISTRICT}')")
    for c in columns:
        left = f"({c} IS NOT NULL AND ({s_canonical(c)} IN ('', '-', '.', '--', '---', 'N/A', 'NA', 'NAN', 'NULL', " \
               "'NONE', 'SIN DATO', 'SIN DATOS', 'SIN INFORMACION', 'SIN INFORMACIÓN', 'NO DISPONIBLE')"
        left += f" OR {s_residual(c)}))" if c in ("name", "address", "director") else "))"
        add("invalid_values", c, left)
    for c, domain in DOMAINS.items():
        add("invalid_values", c, f"{c} IS NULL OR {c} NOT IN ({', '.join(repr(d) for d in domain)})")
    for c in REQUIRED:
        add("invalid_values", c, f"{c} IS NULL")
    if "zone" in columns:
        add("invalid_values", "zone", "zone IS NOT NULL AND NOT (regexp_full_match(zone, "
            "'ZONE ([1-9]|1\\p{Nd}|2[0-5])') AND parent IS NOT DISTINCT FROM 'AMERICA' "
            "AND child IS NOT DISTINCT FROM 'NATION_1')")
    add("invalid_values", "office", f"NOT {s_fits('parent', 'office')}")
    return out


def s_violations(src: str, columns: list[str]) -> str:
    return "violations AS (" + " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, {group} AS rule_group, {no} AS rule_no, row_id, code, '{variable}' AS variable, "
        f"{variable} AS value FROM {src} WHERE {broken}"
        for no, (check, group, variable, broken) in enumerate(s_rules(src, columns))) + ")"


def s_variants(src: str, columns: list[str]) -> str:
    key = "trim(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    spell = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS variable, {key.format(s_ascii(s_canonical(c)))} AS key, {c} AS spelling "
        f"FROM {src} WHERE {c} IS NOT NULL" for c in DEMO.variant_columns if c in columns)
    return (f"spell AS ({spell}), variants AS (SELECT variable, key, count(*) AS spellings, "
            "min(spelling) AS first_spelling, max(spelling) AS last_spelling "
            "FROM spell GROUP BY variable, key HAVING count(*) > 1)")


@query("violations", f"WITH {REGISTRY}, {CATALOGUE}, {s_violations('registry', COLS)} "
       "SELECT check_name AS \"check\", row_id, code, variable, value, rule_no FROM violations")
def violations(spark, sf_dir):
    return V.violations(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir)).select(
        "check", "row_id", "code", "variable", "value", "rule_no")


@query("violations_cleaned", f"{BASE}, {s_violations('cleaned', OUT)} "
       "SELECT check_name AS \"check\", row_id, code, variable, value, rule_no FROM violations")
def violations_cleaned(spark, sf_dir):
    data = clean(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir)).data
    return V.violations(data, DEMO, catalogue(spark, sf_dir)).select(
        "check", "row_id", "code", "variable", "value", "rule_no")


_VARIANT_POSITIONS = ", ".join(
    f"('{c}', {i})" for i, c in enumerate(c for c in DEMO.variant_columns if c in COLS))


def _s_examples(src: str, columns: list[str]) -> str:
    return f"""{s_violations(src, columns)}, {s_variants(src, columns)},
found AS (SELECT check_name, rule_group, rule_no, row_id, code, variable, value, '' AS part FROM violations
  UNION ALL SELECT 'exact_duplicates', 0, 0, row_id, code, 'row', CAST(n AS VARCHAR), '' FROM
    (SELECT *, count(*) OVER (PARTITION BY {', '.join(columns)}) AS n FROM {src}) WHERE n > 1
  UNION ALL SELECT 'category_variants', p.place, 0, NULL, NULL, variable, spelling, key
    FROM spell JOIN variants USING (variable, key) JOIN (VALUES {_VARIANT_POSITIONS}) p(variable, place) USING (variable)
  UNION ALL SELECT 'schema_and_types', 0, 0, NULL, NULL, 'schema', 'columns and order; absent: zone; extra: ', '')
SELECT check_name AS "check", row_id, code, variable, value, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY check_name ORDER BY rule_group, row_id NULLS FIRST, rule_no, part, value) AS rank FROM found) WHERE rank <= 5"""


@query("violation_examples", f"WITH {REGISTRY}, {CATALOGUE}, {_s_examples('registry', COLS)}")
def violation_examples(spark, sf_dir):
    """All seven checks."""
    return V.examples(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir)).select(
        "check", "row_id", "code", "variable", "value", "rank")


@query("category_spellings", f"WITH {REGISTRY}, {s_variants('registry', COLS)} SELECT variable, key, spelling FROM spell")
def category_spellings(spark, sf_dir):
    """V6: every spelling, as rows."""
    return V.category_spellings(registry(spark, sf_dir), DEMO).drop("position")


@query("duplicate_examples", f"""WITH {REGISTRY}
SELECT row_id, {', '.join(COLS)}, copies FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(COLS)}) AS copies
  FROM registry) WHERE copies > 1 ORDER BY row_id LIMIT 5""")
def duplicate_examples(spark, sf_dir):
    return V.duplicate_examples(registry(spark, sf_dir), DEMO)


def _s_summary(src: str, columns: list[str], schema_errors: int) -> str:
    checks = ("exact_duplicates", "text_spaces", "phone_format", "official_places", "schema_and_types",
              "category_variants", "invalid_values")
    values = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(checks))
    return f"""{s_violations(src, columns)}, {s_variants(src, columns)}, checks(position, name) AS (VALUES {values}),
found AS (SELECT check_name AS name, variable, count(*) AS n FROM violations GROUP BY ALL
  UNION ALL SELECT 'category_variants', variable, count(*) FROM variants GROUP BY ALL
  UNION ALL SELECT 'schema_and_types', 'schema', {schema_errors}
  UNION ALL SELECT 'exact_duplicates', 'row', CAST(sum(n - 1) AS BIGINT) FROM
    (SELECT count(*) AS n FROM {src} GROUP BY {', '.join(columns)})),
told AS (SELECT name, CAST(sum(n) AS BIGINT) AS n, string_agg(variable || '=' || n, '; ' ORDER BY variable || '=' || n) AS detail
  FROM found WHERE n > 0 GROUP BY name)
SELECT position, name AS "check", CASE WHEN coalesce(n, 0) = 0 THEN 'APROBADO' ELSE 'FALLIDO' END AS state,
  coalesce(n, 0) AS errors, detail FROM checks LEFT JOIN told USING (name)"""


@query("validation_summary", f"WITH {REGISTRY}, {CATALOGUE}, {_s_summary('registry', COLS, 1)}")
def validation_summary(spark, sf_dir):
    return V.summary(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))


@query("validation_summary_cleaned", f"{BASE}, {_s_summary('cleaned', OUT, 0)}")
def validation_summary_cleaned(spark, sf_dir):
    data = clean(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir)).data
    return V.summary(data, DEMO, catalogue(spark, sf_dir))


@query("category_variants", f"WITH {REGISTRY}, {s_variants('registry', COLS)} SELECT * FROM variants")
def category_variants(spark, sf_dir):
    return V.category_variants(registry(spark, sf_dir), DEMO).drop("position")


_SRC_COUNTERS = {
    "extra_spaces": " + ".join(f"count(*) FILTER (WHERE regexp_matches({c}, '{SPACE}'))" for c in COLS),
    "residual_texts": " + ".join(f"count(*) FILTER (WHERE {s_residual(c)})" for c in ("name", "address", "director")),
    "invalid_phones": f"count(*) FILTER (WHERE NOT regexp_full_match(phone, '{PHONES}'))",
    "invalid_codes": f"count(*) FILTER (WHERE NOT regexp_full_match(code, '{CODE}'))",
    "invalid_districts": f"count(*) FILTER (WHERE NOT regexp_full_match(district, '{DISTRICT}'))",
    "invalid_parents": f"count(*) FILTER (WHERE {s_place('parent')} NOT IN (SELECT parent FROM catalogue))",
    "invalid_children": f"count(*) FILTER (WHERE ({s_place('parent')}, {s_place('child')}) "
                        "NOT IN (SELECT (parent, child) FROM catalogue))",
    "invalid_relations": f"count(*) FILTER (WHERE NOT {s_fits('parent', 'office')})",
    "absent_columns": "count(DISTINCT 1)",
}


@query("quality_counters", f"WITH {REGISTRY}, {CATALOGUE} " + " UNION ALL ".join(
    f"SELECT '{k}' AS counter, CAST({v} AS BIGINT) AS errors FROM registry" for k, v in _SRC_COUNTERS.items())
    + f" UNION ALL SELECT 'exact_duplicates', CAST(sum(n - 1) AS BIGINT) FROM "
      f"(SELECT count(*) AS n FROM registry GROUP BY {', '.join(COLS)})")
def quality_counters(spark, sf_dir):
    return V.quality_counters(registry(spark, sf_dir), DEMO, catalogue(spark, sf_dir))


# --- before / after ---------------------------------------------------------------


def s_uneven(c: str) -> str:
    return f"({c} IS NOT NULL AND ({s_void(s_canonical(c))} OR {s_residual(c)}))"


def s_stage(src: str, columns: list[str], review: str, *, raw: bool) -> str:
    """CTE <src>_m: (metric, value, columns) of one stage."""
    blank = " AND ".join(s_missing(c) for c in columns)
    formats = {
        "district": f"district IS NOT NULL AND NOT regexp_full_match(district, '{DISTRICT}')",
        "address": s_uneven("address"),
        "phone": f"NOT {s_missing('phone')} AND NOT regexp_full_match(phone, '{PHONES}')",
        "director": s_uneven("director"),
        "office": f"office IS NOT NULL AND {s_canonical('office')} <> {s_ascii(s_canonical('office'))}",
    }
    voids = [f"count(*) FILTER (WHERE {s_missing(c)}) AS v_{c}" for c in columns]
    fmts = [f"count(*) FILTER (WHERE NOT ({blank}) AND {f}) AS f_{c}" for c, f in formats.items()]
    hits = f"SELECT count(DISTINCT {s_canonical('child')}) FROM {src} WHERE {s_canonical('child')} IN " \
           f"(SELECT a FROM (VALUES {CHILD_MAP_SQL}) m(a, b))" if raw else "SELECT 0"
    total = " + ".join(f"v_{c}" for c in columns)
    common = " + ".join(f"v_{c}" for c in COLS)

    def names(prefix: str, cs) -> str:
        inner = ", ".join(f"CASE WHEN {prefix}_{c} > 0 THEN '{c}' END" for c in cs)
        return f"array_to_string(list_filter([{inner}], lambda k: k IS NOT NULL), ', ')"

    def n_of(prefix: str, cs) -> str:
        return " + ".join(f"CAST({prefix}_{c} > 0 AS BIGINT)" for c in cs)

    rows = [
        ("records", "n", "''"), ("variables", str(len(columns)), "''"),
        ("missing_cells", total, "''"), ("total_cells", f"n * {len(columns)}", "''"),
        ("missing_percent", s_percent(total, f"(n * {len(columns)})"), "''"),
        ("comparable_missing_cells", common, "''"), ("comparable_total_cells", f"n * {len(COLS)}", "''"),
        ("comparable_missing_percent", s_percent(common, f"(n * {len(COLS)})"), "''"),
        ("variables_with_missing", n_of("v", columns), names("v", columns)),
        ("inconsistent_format", n_of("f", formats), names("f", formats)),
        ("wrong_type", "0", "''"), ("inconsistent_categories", "capital + hits", "''"),
        ("exact_duplicates", "dups", "''"), ("duplicate_pairs", "pairs", "''"),
        ("duplicate_records", "records", "''"),
    ]
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({v} AS DOUBLE) AS value, {k} AS columns FROM {src}_w" for m, v, k in rows)
    return f"""{src}_w AS (SELECT *, (SELECT CAST(sum(k - 1) AS BIGINT) FROM
    (SELECT count(*) AS k FROM {src} GROUP BY {', '.join(columns)})) AS dups, ({hits}) AS hits,
    (SELECT count(*) FROM {review}) AS pairs,
    (SELECT count(*) FROM (SELECT row_id_1 FROM {review} UNION SELECT row_id_2 FROM {review})) AS records
  FROM (SELECT count(*) AS n, {', '.join(voids + fmts)},
    CAST(count(*) FILTER (WHERE {s_canonical('parent')} = 'CAPITAL CITY') > 0 AS BIGINT) AS capital FROM {src})),
{src}_m AS ({union})"""


QUALITY = f"""{BASE}, real_raw AS (SELECT * FROM registry WHERE NOT ({' AND '.join(s_missing(c) for c in COLS)})),
{s_review('real_raw', 'r_')}, {s_review('cleaned', 'c_')}, {s_stage('registry', COLS, 'r_review', raw=True)},
{s_stage('cleaned', OUT, 'c_review', raw=False)}"""


_CORRECTIONS = {
    "removed_rows": ("TODAS", "drop_empty"), "district_to_null": ("district", "identifier"),
    "phones_reformatted": ("phone", "identifier"), "dashes_removed": ("director", "dashes"),
    "parents_normalised": ("parent", "parent"), "children_normalised": ("child", "child"),
    "zones_kept": ("zone", "zone"), "segment_normalised": ("segment", "category"),
    "office_normalised": ("office", "category"),
}


def s_odd(c: str) -> str:
    t = s_canonical(c)
    return (f"count(*) FILTER (WHERE {t} <> '' AND NOT regexp_matches({t}, '[\\p{{L}}\\p{{N}}]') AND NOT "
            f"({t} IN ('-', '.', '--', '---') OR regexp_full_match({t}, '-+')))")


CORRECTIONS = f"SELECT 'punctuation_to_null' AS correction, {s_odd('address')} + {s_odd('director')} AS affected FROM real_raw" + "".join(
    f" UNION ALL SELECT '{k}', CAST(coalesce(sum(affected) FILTER (WHERE variable = '{v}' AND step = '{s}'), 0) AS BIGINT) FROM audit"
    for k, (v, s) in _CORRECTIONS.items())


@query("corrections_from_log", f"""{BASE}, {LOG}, real_raw AS (SELECT * FROM registry WHERE NOT
  ({' AND '.join(s_missing(c) for c in COLS)})) {CORRECTIONS}""")
def corrections_from_log(spark, sf_dir):
    raw = registry(spark, sf_dir)
    wide, log = clean_stages(raw, DEMO, catalogue(spark, sf_dir))
    return M.corrections(raw, audit_log(wide, log, None), DEMO)


@query("quality_before_after", f"""{QUALITY}, {LOG.replace(s_review('cleaned') + ', ', '').replace('FROM review', 'FROM c_review')}, report AS ({CORRECTIONS})
SELECT list_position([{', '.join(repr(m) for m in M.METRICS)}], b.metric) AS position, b.metric, b.value AS before,
  a.value AS after, b.columns AS before_columns, a.columns AS after_columns
FROM registry_m b JOIN cleaned_m a ON a.metric = b.metric
UNION ALL SELECT {len(M.METRICS)}, 'corrections', 0, CAST(sum(affected) AS DOUBLE), '',
  string_agg(correction || '=' || affected, '; ' ORDER BY correction || '=' || affected) FROM report""")
def quality(spark, sf_dir):
    return quality_before_after(stored(registry(spark, sf_dir)), DEMO, catalogue(spark, sf_dir))


@query("stream_repeated_codes", f"""WITH {REGISTRY}, b AS (SELECT code, row_id, CASE WHEN row_id % 2 = 0 THEN 1 ELSE 2 END AS batch FROM registry),
n AS (SELECT code, batch, count(*) AS n, min(row_id) AS low FROM b GROUP BY ALL),
t AS (SELECT n.*, coalesce(o.n, 0) AS before, coalesce(o.low, n.low) AS first FROM n LEFT JOIN n o ON o.code = n.code AND o.batch < n.batch)
SELECT code AS "key", first AS first_row_id, before AS seen_before, n AS seen_now FROM t WHERE before + n > 1""")
def stream_repeated_codes(spark, sf_dir):
    """V7 over two micro-batches, the query being started anew for the second."""
    root, rows = scratch_path(spark, "stream"), registry(spark, sf_dir).select("row_id", "code", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"))

    def run(name, part):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        query = repeated_codes(stream, "code", "row_id", "at").writeStream.outputMode("update").option(
            "checkpointLocation", f"{root}/checkpoint").foreachBatch(
            lambda found, batch: found.write.mode("overwrite").parquet(f"{root}/out/batch={name}-{batch}")).trigger(availableNow=True).start()
        query.awaitTermination()

    for name, rest in (("even", 0), ("odd", 1)):
        run(name, rows.where(F.col("row_id") % 2 == rest))
    return spark.read.parquet(f"{root}/out").drop("batch")
