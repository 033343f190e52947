"""Text, identifier and page operators (T*, P*, S12, S13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    query, s_ascii, s_canonical, s_clean, s_compare, s_missing, s_place, s_void, table,
)
from checks.demo import DEMO, REGISTRY, registry
from pulcra.functions import predicates as P
from pulcra.functions import text as T
from pulcra.operators.catalog import map_column
from pulcra.sources.pages import attribute, field_by_id, rows_of

# Every document whole, plus a second row per document with planted dirt.
DIRTY_SQL = """
SELECT doc_id * 2 AS id, text FROM {documents}
UNION ALL
SELECT doc_id * 2 + 1, CASE doc_id % 23 WHEN 0 THEN '' WHEN 1 THEN ' N/A ' WHEN 2 THEN '...'
  WHEN 3 THEN concat('-- ', text) WHEN 4 THEN concat('  ', text, '   x') WHEN 5 THEN 'Sin  información'
  WHEN 6 THEN '--- ' ELSE concat('¿', text, ' Ø 5°. Æsir, ', CAST(doc_id AS STRING)) END FROM {documents}
"""
DIRTY = "dirty AS (" + DIRTY_SQL.format(documents="documents") + ")"


def dirty(spark, sf_dir):
    return spark.sql(DIRTY_SQL, documents=table(spark, sf_dir, "documents"))


@query("text_canonical", f"WITH {DIRTY} SELECT id, {s_canonical('text')} AS canonical FROM dirty")
def text_canonical(spark, sf_dir):
    return T.nfkc_columns(dirty(spark, sf_dir), ["text"]).select(
        "id", T.canonical(F.col("text")).alias("canonical"))


@query("text_missing_mask", f"""
WITH {DIRTY}, c AS (SELECT id, text, {s_canonical('text')} AS t FROM dirty)
SELECT id, (text IS NULL OR {s_void('t')}) AS missing, {s_missing('text')} AS blank_like FROM c""")
def text_missing_mask(spark, sf_dir):
    c = F.col("text")
    return T.nfkc_columns(dirty(spark, sf_dir), ["text"]).select(
        "id", T.is_missing(c).alias("missing"), T.is_blank_like(c).alias("blank_like"))


@query("text_ascii_keys", f"""
WITH {DIRTY}, c AS (SELECT id, text, {s_canonical('text')} AS t FROM dirty)
SELECT id, {s_ascii('t')} AS ascii, {s_place('text')} AS place_key,
  replace(replace({s_ascii('t')}, '.', ''), ',', '') AS similarity_key,
  trim(regexp_replace({s_ascii('t')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS category_key FROM c""")
def text_ascii_keys(spark, sf_dir):
    return T.with_ascii_keys(T.nfkc_columns(dirty(spark, sf_dir), ["text"]), "text").select(
        "id", "ascii", "place_key", "similarity_key", "category_key")


@query("text_decorative_prefix", f"""
WITH {DIRTY}, c AS (SELECT id, {s_clean('text')} AS t FROM dirty)
SELECT id, regexp_replace(t, '^-{{2,}} *([\\p{{L}}\\p{{N}}_])', '\\1') AS stripped FROM c""")
def text_decorative_prefix(spark, sf_dir):
    return T.nfkc_columns(dirty(spark, sf_dir), ["text"]).select(
        "id", T.strip_leading_dashes(F.col("text")).alias("stripped"))


@query("text_nfkc", """
SELECT doc_id, concat('fin A1 é 3o ', text, ' 1⁄2') AS composed, concat('fin ', lang) AS tag FROM documents""")
def text_nfkc(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("ﬁn Ａ１ é 3º "), "text", F.lit(" ½")).alias("composed"),
        F.concat(F.lit("ﬁn "), "lang").alias("tag"))
    return T.nfkc_columns(docs, ["composed", "tag"])


@query("clean_columns", f"""
WITH {DIRTY} SELECT id, {s_clean('text')} AS cleaned, {s_compare('text')} AS compared FROM dirty""")
def clean_columns(spark, sf_dir):
    rows = dirty(spark, sf_dir).withColumn("cleaned", F.col("text"))
    return T.clean_columns(rows, ["cleaned"]).select(
        "id", "cleaned", T.comparison_text(F.col("text")).alias("compared"))


CODE = r"CUSTOMER#\p{Nd}{9}"
DISTRICT = r"\p{Nd}{2}-\p{Nd}{3}|\p{Nd}{2}-\p{Nd}{2}-\p{Nd}{4}"


@query("identifier_repair", f"""
WITH {REGISTRY}, c AS (SELECT row_id, code, district, replace({s_clean('code')}, ' ', '') AS k,
  replace({s_clean('district')}, ' ', '') AS d FROM registry)
SELECT row_id, CASE WHEN regexp_full_match(k, '{CODE}') THEN k END AS clean_code,
  CASE WHEN regexp_full_match(d, '{DISTRICT}') THEN d END AS clean_district,
  regexp_full_match(code, '{CODE}') AS code_ok, regexp_full_match(district, '{DISTRICT}') AS district_ok FROM c""")
def identifier_repair(spark, sf_dir):
    r = T.nfkc_columns(registry(spark, sf_dir), ["code", "district"])
    shapes = DEMO.identifiers["district"]
    return r.select(
        "row_id", T.clean_identifier(F.col("code"), *DEMO.code_patterns).alias("clean_code"),
        T.clean_identifier(F.col("district"), *shapes).alias("clean_district"),
        P.matches_or_null(F.col("code"), *DEMO.code_patterns).alias("code_ok"),
        P.matches_or_null(F.col("district"), *shapes).alias("district_ok"))


def s_phone_list(x: str) -> str:
    """Distinct complete phones in order, over a column of canonical text."""
    found = (f"list_filter(regexp_extract_all({x}, '\\p{{Nd}}+'), "
             f"lambda q: length(q) = 8 AND regexp_matches(q, '^[2-7]'))")
    return f"list_filter({found}, lambda v, i: list_position({found}, v) = i)"


@query("phone_extract", f"""
WITH {REGISTRY}, c AS (SELECT row_id, phone, {s_clean('phone')} AS t FROM registry)
SELECT row_id, nullif(array_to_string({s_phone_list('t')}, ' / '), '') AS phones,
  regexp_full_match(phone, '[2-7]\\p{{Nd}}{{7}}( / [2-7]\\p{{Nd}}{{7}})*') AS phone_ok,
  NOT {s_missing('phone')} AND NOT regexp_full_match(phone, '[2-7]\\p{{Nd}}{{7}}') AS odd_phone FROM c""")
def phone_extract(spark, sf_dir):
    r = T.nfkc_columns(registry(spark, sf_dir), ["phone"])
    c = F.col("phone")
    return r.select("row_id", T.clean_phone(c).alias("phones"), P.is_phone_list(c).alias("phone_ok"),
                    P.is_odd_phone(c).alias("odd_phone"))


@query("phone_extract_documents", f"""
WITH c AS (SELECT doc_id, {s_clean('text')} AS t FROM documents)
SELECT doc_id, nullif(array_to_string({s_phone_list('t')}, ' / '), '') AS phones,
  len({s_phone_list('t')}) AS n_phones FROM c""")
def phone_extract_documents(spark, sf_dir):
    docs = T.nfkc_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])
    phones = T.extract_phones(F.col("text"))
    return docs.select("doc_id", T.clean_phone(F.col("text")).alias("phones"),
                       F.size(phones).cast("bigint").alias("n_phones"))


@query("category_map", """
WITH m(a, b) AS (VALUES ('SMALL', 'COMPACT'), ('LARGE', 'BIG'), ('PROMO', 'PROMO'))
SELECT p_partkey, p_name, coalesce(b, upper(p_type)) AS category FROM part LEFT JOIN m ON upper(p_type) = a""")
def category_map(spark, sf_dir):
    mapping = {"SMALL": "COMPACT", "LARGE": "BIG", "PROMO": "PROMO"}
    rows = spark.createDataFrame(list(mapping.items()), "a string, b string")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return map_column(T.nfkc_columns(part, ["p_type"]), "p_type", rows, "category").select(
        "p_partkey", "p_name", "category")


@query("predicate_flags", f"""
WITH {REGISTRY}
SELECT row_id, regexp_matches(child, '^[\\s]|[\\s]$|[\\s]{{2}}') AS extra_space,
  (regexp_matches(director, '^\\s*[^\\p{{L}}\\p{{N}}\\s][^\\p{{L}}\\p{{N}}]*$')
   OR regexp_matches(director, '^\\s*-{{2,}}\\s*[\\p{{L}}\\p{{N}}_]')) AS residual,
  ({s_place('office')} = {s_place('parent')} OR starts_with({s_place('office')}, {s_place('parent')} || ' '))
    AS label_fits, regexp_matches(name, '[a-záéíóúüñ]') AS lower_case,
  segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') AS outside_domain,
  NOT regexp_full_match(child, '\\s*') AS nonblank FROM registry""")
def predicate_flags(spark, sf_dir):
    r = registry(spark, sf_dir)
    return r.select(
        "row_id", P.has_extra_space(F.col("child")).alias("extra_space"),
        P.is_residual(F.col("director")).alias("residual"),
        P.label_fits_parent(F.col("parent"), F.col("office")).alias("label_fits"),
        P.has_lowercase(F.col("name")).alias("lower_case"),
        P.outside(F.col("segment"), DEMO.domains["segment"], nullable=False).alias("outside_domain"),
        P.is_nonblank(F.col("child")).alias("nonblank"))


@query("conversation_roles", """
SELECT conv_id, turn, role NOT IN ('user', 'assistant') AS outside_domain,
  regexp_matches(text, '[\\p{Cc}\\p{Cf}]') AS control_char FROM conversations""")
def conversation_roles(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", P.outside(F.col("role"), ("user", "assistant"), nullable=False)
        .alias("outside_domain"), T.has_control_char(F.col("text")).alias("control_char"))


@query("page_attributes", """
SELECT page_id, regexp_extract(html, '<html\\b[^>]*\\blang="([^"]*)"', 1) AS lang,
  regexp_extract(html, '<meta\\b[^>]*\\bcharset="([^"]*)"', 1) AS charset,
  regexp_extract(html, '<form\\b[^>]*\\baction="([^"]*)"', 1) AS form_action FROM pages""")
def page_attributes(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", attribute(html, "html", "lang").alias("lang"),
        attribute(html, "meta", "charset").alias("charset"),
        attribute(html, "form", "action").alias("form_action"))


# Each page with a form field and a table of its own before its other markup.
PLANT = ("concat('<input type=\"hidden\" id=\"__state\" value=\"s', page_id, '\"><table class=\"x\" id=\"result\"><tr><td>', "
         "page_id, '</td></tr><tr><td>', url, '</td></tr></table><table id=\"other\"><tr><td>no</td></tr></table>', html)")


@query("page_fields_by_id", """SELECT page_id, 's' || page_id AS state, '' AS absent FROM pages""")
def page_fields_by_id(spark, sf_dir):
    """S12 by id."""
    html = F.expr(PLANT)
    return table(spark, sf_dir, "pages").select(
        "page_id", field_by_id(html, "__state").alias("state"), field_by_id(html, "__none").alias("absent"))


@query("page_rows_by_id", """SELECT page_id, 0 AS row_no, CAST(page_id AS VARCHAR) AS cell FROM pages
UNION ALL SELECT page_id, 1, url FROM pages""")
def page_rows_by_id(spark, sf_dir):
    """Rows of the element with an id only."""
    pages = table(spark, sf_dir, "pages").withColumn("html", F.expr(PLANT))
    return rows_of(pages, "page_id", "html", "<tr>.*?</tr>", {"cell": "<td>([^<]*)</td>"}, within=("table", "result"))[0]


# A table in a table's cell, a commented tag, and an empty element of the name.
NESTED = ("concat('<table><tr><td>before</td></tr></table><TABLE id=\"outer\"><tr><td>', page_id, '</td></tr><tr><td>', "
          "'<table class=\"inner\"><tr><td>in ', page_id, '</td></tr></table><!-- </table> --><table/></td></tr><tr><td>', url, "
          "'</td></tr></TABLE><table><tr><td>after</td></tr></table>', html)")


@query("page_nested_rows", """SELECT page_id, 0 AS row_no, CAST(page_id AS VARCHAR) AS cell FROM pages
UNION ALL SELECT page_id, 1, 'in ' || page_id FROM pages UNION ALL SELECT page_id, 2, url FROM pages""")
def page_nested_rows(spark, sf_dir):
    """All rows of an element that holds one of its own name."""
    pages = table(spark, sf_dir, "pages").withColumn("html", F.expr(NESTED))
    return rows_of(pages, "page_id", "html", "<td>[^<]*</td>", {"cell": "<td>([^<]*)</td>"}, within=("table", "outer"))[0]


ROW = '<li><a href="[^"]*">[^<]*</a></li>'


@query("page_rows", f"""
WITH f AS (SELECT page_id, regexp_extract_all(html, '{ROW}') AS r FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS row_no, regexp_extract(r[i], 'href="([^"]*)"', 1) AS href,
  regexp_extract(r[i], '>([^<]*)</a>', 1) AS label, FALSE AS rejected
FROM (SELECT page_id, r, unnest(range(1, len(r) + 1)) AS i FROM f)
UNION ALL SELECT page_id, NULL, NULL, NULL, TRUE FROM f WHERE len(r) = 0""")
def page_rows(spark, sf_dir):
    rows, rejects = rows_of(table(spark, sf_dir, "pages"), "page_id", "html", ROW,
                            {"href": 'href="([^"]*)"', "label": ">([^<]*)</a>"})
    return rows.withColumn("rejected", F.lit(False)).unionByName(
        rejects.withColumn("rejected", F.lit(True)), allowMissingColumns=True)
