"""Near-duplicate operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.base import query, s_ascii, s_canonical, s_lcs, s_tokens
from checks.demo import DEMO, REGISTRY, catalogue, registry
from pulcra.functions.similarity import tokens, with_token_set_score
from pulcra.operators import dedup as D
from pulcra.plans.cleaning import clean

UNIT = ("parent", "child", "segment", "status", "office")
COMPARED = ("district", "name", "address", "phone", "director", *UNIT)


def s_key(x: str) -> str:
    return f"replace(replace({s_ascii(s_canonical(x))}, '.', ''), ',', '')"


def s_ratio_columns(name: str, a: str, b: str) -> tuple[str, str, str]:
    """Three layers that turn two token lists into a token-set score."""
    sect, x, y = f"{name}_s", f"{name}_x", f"{name}_y"
    first = (f"len({a}) = 0 OR len({b}) = 0 AS {name}_empty, "
             f"length(array_to_string(list_filter({a}, lambda k: list_contains({b}, k)), ' ')) AS {sect}, "
             f"array_to_string(list_filter({a}, lambda k: NOT list_contains({b}, k)), ' ') AS {x}, "
             f"array_to_string(list_filter({b}, lambda k: NOT list_contains({a}, k)), ' ') AS {y}")
    gap = f"(CASE WHEN {sect} > 0 THEN 1 ELSE 0 END)"
    second = (f"{sect} + {gap} + length({x}) AS {name}_la, {sect} + {gap} + length({y}) AS {name}_lb, "
              f"{s_lcs(x, y)} AS {name}_lcs")
    third = f"""CASE WHEN {name}_empty THEN 0.0
      WHEN {sect} > 0 AND ({x} = '' OR {y} = '') THEN 100.0
      ELSE greatest(
        100.0::DOUBLE - 100.0::DOUBLE * (length({x}) + length({y}) - 2 * {name}_lcs) / ({name}_la + {name}_lb)::DOUBLE,
        CASE WHEN {sect} > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * ({gap} + length({x})) / ({sect} + {name}_la)::DOUBLE ELSE 0 END,
        CASE WHEN {sect} > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * ({gap} + length({y})) / ({sect} + {name}_lb)::DOUBLE ELSE 0 END)
      END::DOUBLE AS {name}_score"""
    return first, second, third


def s_pairs(src: str, pre: str = "", title_limit: int | None = 80, phone_limit: int | None = 40) -> str:
    """CTEs up to the candidate pairs of table ``src``; prefix for reuse. A limit
    of None leaves no block out."""
    title_cut, phone_cut = ("" if limit is None else f" AND s.n <= {limit}" for limit in (title_limit, phone_limit))
    return f"""
{pre}keys AS (SELECT *, {s_key('name')} AS tk, {s_key('address')} AS ak, coalesce(phone, '') AS ph FROM {src}),
{pre}blk AS (SELECT *, concat(coalesce(parent, ''), '|', coalesce(child, ''), '|', substr(tk, 1, 18)) AS ba FROM {pre}keys),
{pre}size_a AS (SELECT ba, count(*) AS n FROM {pre}blk GROUP BY ba),
{pre}size_b AS (SELECT parent, child, ph, count(*) AS n FROM {pre}blk WHERE ph <> '' GROUP BY ALL),
{pre}pairs AS (
  SELECT a.row_id AS i, b.row_id AS j FROM {pre}blk a JOIN {pre}size_a s ON a.ba = s.ba{title_cut}
    JOIN {pre}blk b ON a.ba = b.ba AND a.row_id < b.row_id
  UNION
  SELECT a.row_id, b.row_id FROM {pre}blk a
    JOIN {pre}size_b s ON a.parent IS NOT DISTINCT FROM s.parent AND a.child IS NOT DISTINCT FROM s.child
      AND a.ph = s.ph{phone_cut}
    JOIN {pre}blk b ON a.parent IS NOT DISTINCT FROM b.parent AND a.child IS NOT DISTINCT FROM b.child
      AND a.ph = b.ph AND a.row_id < b.row_id)"""


def s_review(src: str, pre: str = "", **limits: int | None) -> str:
    """CTEs ending in ``<pre>review``: accepted pairs of table ``src``."""
    t1, t2, t3 = s_ratio_columns("t", "tl", "tr")
    a1, a2, a3 = s_ratio_columns("a", "al", "ar")
    unit = " AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in UNIT)
    diff = ", ".join(f"CASE WHEN l.{c} IS DISTINCT FROM r.{c} THEN '{c}' END" for c in COMPARED)

    def said(what: str) -> str:
        return f"'{what}=' || format('{{:.2f}}', round_even({what[0]}_score, 2))"

    return s_pairs(src, pre, **limits) + f""",
{pre}cand AS (SELECT l.row_id AS row_id_1, r.row_id AS row_id_2, l.code AS code_1, r.code AS code_2,
    l.name AS title_1, r.name AS title_2, l.address AS address_1, r.address AS address_2,
    l.phone AS phone_1, r.phone AS phone_2, l.ph <> '' AND l.ph = r.ph AS same_phone,
    l.ak <> '' AND l.ak = r.ak AS same_address, {s_tokens('l.tk')} AS tl, {s_tokens('r.tk')} AS tr,
    {s_tokens('l.ak')} AS al, {s_tokens('r.ak')} AS ar,
    coalesce(nullif(array_to_string(list_filter([{diff}], lambda k: k IS NOT NULL), ', '), ''), 'NINGUNO') AS differing_fields
  FROM {pre}pairs p JOIN {pre}blk l ON l.row_id = p.i JOIN {pre}blk r ON r.row_id = p.j AND {unit}),
{pre}c1 AS (SELECT *, {t1}, {a1} FROM {pre}cand), {pre}c2 AS (SELECT *, {t2}, {a2} FROM {pre}c1),
{pre}c3 AS (SELECT *, {t3}, {a3} FROM {pre}c2),
{pre}review AS (SELECT row_id_1, row_id_2, code_1, code_2, title_1, title_2, address_1, address_2, phone_1, phone_2,
    round_even(t_score, 2) AS title_similarity, round_even(a_score, 2) AS address_similarity, same_phone,
    differing_fields, CASE WHEN t_score = 100 AND a_score = 100 AND same_phone THEN 'MUY ALTA' ELSE 'ALTA' END AS match_level,
    'CONSERVAR' AS decision,
    {said('title')} || '; ' || {said('address')} || '; phone=' || CASE WHEN same_phone THEN 'equal' ELSE 'not equal' END
      || '; differs=' || differing_fields AS justification
  FROM {pre}c3 WHERE t_score >= 94 AND (a_score >= 85 OR same_phone OR same_address))"""


@query("block_sizes", f"""
WITH {REGISTRY}, {s_pairs('registry')}
SELECT 'title' AS blocking, size_a.n AS size, count(*) AS blocks FROM size_a GROUP BY ALL
UNION ALL SELECT 'phone', n, count(*) FROM size_b GROUP BY ALL""")
def block_sizes(spark, sf_dir):
    sizes = D.block_sizes(D.with_keys(registry(spark, sf_dir), DEMO))
    return sizes.groupBy(F.col("_how").alias("blocking"), "size").agg(F.count(F.lit(1)).alias("blocks"))


SMALL = replace(DEMO, title_block_limit=6, phone_block_limit=3)


@query("oversized_blocks", f"""
WITH {REGISTRY}, {s_pairs('registry')}
SELECT 'title' AS blocking, ba AS block, n AS size FROM size_a WHERE n > 6
UNION ALL SELECT 'phone', concat(length(parent), ':', parent, length(child), ':', child, length(ph), ':', ph), n
FROM size_b WHERE n > 3""")
def oversized_blocks(spark, sf_dir):
    return D.oversized_blocks(registry(spark, sf_dir), SMALL)


@query("oversized_copies", f"""
WITH {REGISTRY}, {s_pairs('registry')}
SELECT ba AS block, tk AS title_key, ak AS address_key, ph AS phone, min(row_id) AS first_row_id, count(*) AS copies
FROM blk WHERE tk <> '' AND ba IN (SELECT ba FROM size_a WHERE n > 3)
GROUP BY ba, tk, ak, ph, parent, child, segment, status, office HAVING count(*) > 1""")
def oversized_copies(spark, sf_dir):
    return D.oversized_copies(registry(spark, sf_dir), replace(DEMO, title_block_limit=3))


@query("block_pairs", f"WITH {REGISTRY}, {s_pairs('registry')} SELECT i AS row_id_1, j AS row_id_2 FROM pairs")
def block_pairs(spark, sf_dir):
    return D.block_pairs(registry(spark, sf_dir), DEMO)


_T1, _T2, _T3 = s_ratio_columns("t", "tl", "tr")
_A1, _A2, _A3 = s_ratio_columns("a", "al", "ar")


@query("token_set_score", f"""
WITH {REGISTRY}, {s_pairs('registry')},
c0 AS (SELECT i, j, {s_tokens('l.tk')} AS tl, {s_tokens('r.tk')} AS tr, {s_tokens('l.ak')} AS al, {s_tokens('r.ak')} AS ar
  FROM pairs JOIN blk l ON l.row_id = i JOIN blk r ON r.row_id = j),
c1 AS (SELECT *, {_T1}, {_A1} FROM c0), c2 AS (SELECT *, {_T2}, {_A2} FROM c1)
SELECT i AS row_id_1, j AS row_id_2, {_T3}, {_A3} FROM c2""")
def token_set_score(spark, sf_dir):
    keyed = D.with_keys(registry(spark, sf_dir), DEMO)
    lists = keyed.select("row_id", tokens(F.col("_title")).alias("t"), tokens(F.col("_address")).alias("a"))
    pairs = D.block_pairs(registry(spark, sf_dir), DEMO)
    left = lists.select(*[F.col(c).alias(f"{c}1") for c in lists.columns])
    right = lists.select(*[F.col(c).alias(f"{c}2") for c in lists.columns])
    both = pairs.join(left, pairs.row_id_1 == left.row_id1).join(right, pairs.row_id_2 == right.row_id2)
    scored = with_token_set_score(both, "t1", "t2", "t_score")
    return with_token_set_score(scored, "a1", "a2", "a_score").select(
        "row_id_1", "row_id_2", "t_score", "a_score")


@query("near_dup_review", f"WITH {REGISTRY}, {s_review('registry')} SELECT * FROM review")
def near_dup_review(spark, sf_dir):
    return D.near_duplicates(registry(spark, sf_dir), DEMO).orderBy("row_id_1", "row_id_2")


_TOGETHER = " AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in UNIT)


# Every pair of different entries of a unit is scored: no candidates, no blocks.
ALL_PAIRS = f"""{s_pairs('registry')},
e AS (SELECT {', '.join(UNIT)}, tk, ak, ph, min(row_id) AS first, count(*) AS copies FROM blk WHERE tk <> '' GROUP BY ALL),
c0 AS (SELECT l.first AS i, r.first AS j, l.copies AS copies_1, r.copies AS copies_2, l.ph <> '' AND l.ph = r.ph AS same_phone,
    l.ak <> '' AND l.ak = r.ak AS same_address, {s_tokens('l.tk')} AS tl, {s_tokens('r.tk')} AS tr,
    {s_tokens('l.ak')} AS al, {s_tokens('r.ak')} AS ar
  FROM e l JOIN e r ON {_TOGETHER} AND l.first < r.first),
c1 AS (SELECT *, {_T1}, {_A1} FROM c0), c2 AS (SELECT *, {_T2}, {_A2} FROM c1), c3 AS (SELECT *, {_T3}, {_A3} FROM c2),
linked AS (SELECT * FROM c3 WHERE t_score >= 94 AND (a_score >= 85 OR same_phone OR same_address))"""
SAME = "copies > 1 AND (ph <> '' OR ak <> '')"


@query("near_dup_review_complete", f"""
WITH {REGISTRY}, {ALL_PAIRS}
SELECT i AS first_row_id_1, j AS first_row_id_2, copies_1, copies_2, t_score AS title_score, a_score AS address_score, same_phone
FROM linked
UNION ALL SELECT first, first, copies, copies, 100.0::DOUBLE,
  CASE WHEN len({s_tokens('ak')}) > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END, ph <> ''
FROM e WHERE {SAME}""")
def near_dup_review_complete(spark, sf_dir):
    """Every pair of a unit is compared by the SQL; the joins find the same."""
    return D.review_groups(registry(spark, sf_dir), DEMO)


@query("duplicate_clusters", f"""
WITH RECURSIVE {REGISTRY}, {ALL_PAIRS},
both_ways AS (SELECT i, j FROM linked UNION ALL SELECT j, i FROM linked),
reach AS (SELECT first AS a, first AS b FROM e UNION SELECT a, j FROM reach JOIN both_ways ON b = i),
found AS (
  SELECT e.*, (SELECT count(*) FROM both_ways WHERE i = first) AS n_links, (SELECT min(b) FROM reach WHERE a = first) AS root
  FROM e WHERE ({SAME}) OR first IN (SELECT i FROM both_ways)),
sizes AS (SELECT root, sum(copies)::BIGINT AS n FROM found GROUP BY 1)
SELECT row_id, f.root AS cluster_id, s.n AS cluster_rows, f.first AS entry_id, f.copies AS entry_rows, f.n_links AS entry_links
FROM blk l JOIN found r ON {_TOGETHER} AND l.tk = r.tk AND l.ak = r.ak AND l.ph = r.ph
JOIN found f ON f.first = r.first JOIN sizes s ON s.root = f.root""")
def duplicate_clusters(spark, sf_dir):
    return D.duplicate_clusters(registry(spark, sf_dir), DEMO)


@query("review_totals", f"""
WITH {REGISTRY}, {ALL_PAIRS},
ends AS (SELECT i FROM linked UNION SELECT j FROM linked)
SELECT ((SELECT coalesce(sum(copies_1 * copies_2), 0) FROM linked)
     + (SELECT coalesce(sum(copies * (copies - 1) // 2), 0) FROM e WHERE {SAME}))::BIGINT AS pairs,
  (SELECT coalesce(sum(copies), 0) FROM e WHERE ({SAME}) OR first IN (SELECT i FROM ends))::BIGINT AS records""")
def review_totals(spark, sf_dir):
    return D.review_totals(registry(spark, sf_dir), DEMO)


DECIDED = """decided AS (SELECT row_id_1, row_id_2, CASE WHEN row_id_2 % 3 = 0 THEN 'ELIMINAR'
  WHEN row_id_2 % 3 = 1 THEN 'Corregir' ELSE 'CONSERVAR' END AS decision FROM review)"""


def decided(review):
    return review.withColumn(
        "decision", F.when(F.col("row_id_2") % 3 == 0, "ELIMINAR")
        .when(F.col("row_id_2") % 3 == 1, "Corregir").otherwise("CONSERVAR"))


@query("apply_decisions", f"""
WITH {REGISTRY}, {s_review('registry')}, {DECIDED}
SELECT row_id, code, name FROM registry WHERE row_id NOT IN (SELECT row_id_2 FROM decided WHERE decision = 'ELIMINAR')""")
def apply_decisions(spark, sf_dir):
    rows = registry(spark, sf_dir)
    ledger = decided(D.near_duplicates(rows, DEMO))
    return D.apply_decisions(rows, ledger, DEMO).select("row_id", "code", "name")


@query("decision_summary", f"""
WITH {REGISTRY}, {s_review('registry')}, {DECIDED}
SELECT count(*) FILTER (WHERE upper(decision) = 'CONSERVAR') AS kept,
  count(*) FILTER (WHERE upper(decision) = 'CORREGIR') AS fixed,
  count(*) FILTER (WHERE upper(decision) = 'FUSIONAR') AS merged,
  count(*) FILTER (WHERE upper(decision) = 'ELIMINAR') AS dropped FROM decided""")
def decision_summary(spark, sf_dir):
    return D.decision_summary(decided(D.near_duplicates(registry(spark, sf_dir), DEMO)), DEMO)


@query("records_involved", f"""
WITH {REGISTRY}, {s_review('registry')}
SELECT (SELECT count(*) FROM review) AS pairs,
  (SELECT count(*) FROM (SELECT row_id_1 FROM review UNION SELECT row_id_2 FROM review)) AS records""")
def records_involved(spark, sf_dir):
    return D.pair_totals(D.near_duplicates(registry(spark, sf_dir), DEMO))


def near_dup_before_after(spark, sf_dir):
    """The same detector on the raw and on the cleaned table."""
    raw = registry(spark, sf_dir)
    cleaned = clean(raw, DEMO, catalogue(spark, sf_dir))

    def stage(review, name):
        return D.pair_totals(review).select(F.lit(name).alias("stage"), "pairs", "records")

    return stage(D.near_duplicates(raw, DEMO), "before").unionByName(stage(cleaned.review, "after"))
