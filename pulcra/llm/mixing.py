"""Mix sources to target weights along a time-varying curriculum.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share 150 % of all words; a target stops at twice its source's words and the
excess is reshared by weight (solved in closed form over one row per source).

What is taken: a source's documents form a stream in the order of the MD5 of
their ids, run through at most twice, and cut at the target, so every source
meets its whole-word target exactly and all but one document of it is taken
whole. Stream offsets are two-level prefix sums: word counts per (source,
leading hash digits), summed over at most 4096 rows per source, then inside
one such bucket. So a source with a third of all rows is spread over thousands
of groups, and no task sees a whole source.

When it is trained on: each weight class has a piecewise linear rate over
training time 0..1. Its integral, scaled to the target, is the source's
cumulative token demand; the middle of each taken copy is sent through the
inverse, which gives its training position, and rows are range-sorted by it.

Defined cases: null text has size 0; documents of size 0 take nothing but have
a position; a null source is a source; rows that repeat an id follow each other
in the order of their sizes; empty tables give empty results. Only the id,
source and text columns are read, others are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.llm._base import query, stored, table

WEIGHTS, SHARE, REPEATS, BUCKET_DIGITS = (5, 2, 1), 1.5, 2, 3
# (time, rate) knots per weight: heavy sources early, light ones late.
CURRICULUM = {
    5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    1: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
}


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, in the order of sources with null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            repeats: int = REPEATS) -> DataFrame:
    """``totals`` (_src, source_size), one row per source, with weight and target."""
    every = Window.orderBy("_src")
    table_ = totals.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1).cast("int")))
    cap = F.col("source_size") * repeats
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("_ratio"), "_src").rowsBetween(Window.unboundedPreceding, -1)
    table_ = table_.withColumn("_ratio", cap / F.col("weight")).select(
        "*", (F.sum("source_size").over(whole) * F.lit(share)).alias("_all"), F.sum("weight").over(whole).alias("_w"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("_cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("_w_before"))
    capped = (F.col("_all") - F.col("_cap_before")) / (F.col("_w") - F.col("_w_before")) >= F.col("_ratio")
    table_ = table_.withColumn("_capped", capped)
    rest = F.try_divide(
        F.col("_all") - F.sum(F.when(F.col("_capped"), cap).otherwise(0)).over(whole),
        (F.col("_w") - F.sum(F.when(F.col("_capped"), F.col("weight")).otherwise(0)).over(whole)).cast("double"))
    return table_.select("_src", "source_size", "weight",
                         F.when(F.col("_capped"), cap.cast("double")).otherwise(rest * F.col("weight")).alias("target"))


def inverse_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Training time at which a source with this rate has used ``share`` (0..1)
    of its tokens: the inverse of the integral of a piecewise linear rate."""
    areas = [0.0]
    for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
        areas.append(areas[-1] + (t1 - t0) * (r0 + r1) / 2)
    used, out = share * F.lit(areas[-1]), None
    for i, ((t0, r0), (t1, r1)) in enumerate(zip(knots, knots[1:], strict=False)):
        d = F.greatest(used - F.lit(areas[i]), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * (r1 - r0) / (t1 - t0)) * d, F.lit(0.0)))
        time = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * d, F.lit(r0) + root), F.lit(0.0))
        out = time if out is None else F.when(used >= F.lit(areas[i]), time).otherwise(out)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        carry: bool = False, curriculum: dict = CURRICULUM) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken, and
    per pass over the source the words taken (take_1, take_2) and the training
    position (position_1, position_2; null if nothing is taken in that pass).
    ``carry=True`` adds the input row as the struct ``row``."""
    rows = docs.select(
        F.col(id_col).alias("_id"), source_key(F.col(source_col)).alias("_src"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("_order"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    if not carry:
        rows = stored(rows, "sizes")
    buckets = stored(rows.groupBy("_src", "_bucket").agg(F.sum("size").alias("_words")), "buckets")
    plan = targets(buckets.groupBy("_src").agg(F.sum("_words").alias("source_size")))
    earlier = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("_src", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"))
    placed = offsets.join(plan, "_src")
    inside = Window.partitionBy("_src", "_bucket").orderBy("_order", "_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(placed, ["_src", "_bucket"])
    start, quota = F.col("_offset") + F.col("_at"), F.floor("target")
    takes = [F.greatest(F.least(quota - F.col("source_size") * k - start, F.col("size")), F.lit(0)).cast("long")
             for k in range(REPEATS)]
    positions = []
    for k, take in enumerate(takes):
        middle = (F.col("source_size") * k + start).cast("double") + take.cast("double") / 2
        share = F.coalesce(F.least(F.try_divide(middle, quota.cast("double")), F.lit(1.0)), F.lit(0.0))
        shape = None
        for weight, knots in curriculum.items():
            time = inverse_demand(share, knots)
            shape = F.when(F.col("weight") == weight, time) if shape is None else shape.when(F.col("weight") == weight, time)
        positions.append(F.when((take > 0) | ((F.col("size") == 0) & F.lit(k == 0)), shape.otherwise(share)))
    return rows.select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        sum(takes[1:], takes[0]).alias("taken"), takes[0].alias("take_1"), takes[1].alias("take_2"),
        positions[0].alias("position_1"), positions[1].alias("position_2"), *(["row"] if carry else []))


def sequence(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The training sequence: the columns of ``docs`` plus position, pass and
    words, one row per taken copy, range-sorted by position. Where a target
    ends inside a document, that copy holds the words taken. The three new
    columns replace input columns of these names."""
    mixed = mix(docs, id_col, source_col, text_col, carry=True)
    copies = mixed.select("row", "size", F.explode(F.array(*[
        F.struct(F.col(f"take_{k}").alias("words"), F.col(f"position_{k}").alias("position"), F.lit(k).alias("pass"))
        for k in (1, 2)])).alias("copy")).filter("copy.words > 0")
    text = F.col(f"row.`{text_col}`")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0), 1, F.col("copy.words").cast("int")), " ")
    whole = F.col("copy.words") == F.col("size")
    columns = [F.when(whole, text).otherwise(cut).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
               for c in docs.columns if c not in ("mix_position", "mix_pass", "mix_words")]
    return copies.select(*columns, F.col("copy.position").alias("mix_position"), F.col("copy.pass").alias("mix_pass"),
                         F.col("copy.words").alias("mix_words")).orderBy("mix_position", id_col, "mix_pass")


def _inverse_sql(knots) -> str:
    areas = [0.0]
    for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
        areas.append(areas[-1] + (t1 - t0) * (r0 + r1) / 2)
    used, out = f"(s * {areas[-1]}::DOUBLE)", ""
    for i in reversed(range(len(knots) - 1)):
        (t0, r0), (t1, r1) = knots[i], knots[i + 1]
        d = f"greatest({used} - {areas[i]}::DOUBLE, 0::DOUBLE)"
        root = f"sqrt(greatest({r0 * r0}::DOUBLE + {2 * (r1 - r0) / (t1 - t0)}::DOUBLE * {d}, 0::DOUBLE))"
        time = f"({t0}::DOUBLE + (2::DOUBLE * {d}) / ({r0}::DOUBLE + {root}))"
        out += f"WHEN {used} >= {areas[i]}::DOUBLE THEN {time} " if i else f"ELSE {time} END"
    return f"CASE {out}" if len(knots) > 2 else out.removeprefix("ELSE ").removesuffix(" END")


MIXING_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS weight FROM s),
r AS (SELECT *, (2 * source_size)::DOUBLE / weight AS ratio FROM w),
p AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total, sum(weight) OVER () AS wt,
             coalesce(sum(2 * source_size) OVER b, 0) AS cap_before, coalesce(sum(weight) OVER b, 0) AS w_before
      FROM r WINDOW b AS (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (total - CAST(cap_before AS DOUBLE)) / CAST(wt - w_before AS DOUBLE) >= ratio AS capped FROM p),
t AS (SELECT src, source_size, weight, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE
        (total - CAST(sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER () AS DOUBLE))
        / CAST(wt - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS DOUBLE) * weight END AS target FROM c),
a AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.weight, CAST(floor(t.target) AS BIGINT) AS quota,
        coalesce(CAST(sum(d.size) OVER (PARTITION BY d.src ORDER BY d.o, d.doc_id, d.size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS off
      FROM d JOIN t ON d.src = t.src),
k AS (SELECT *, greatest(least(quota - off, size), 0) AS take_1,
                greatest(least(quota - source_size - off, size), 0) AS take_2 FROM a),
u AS (SELECT *, coalesce(least((CAST(off AS DOUBLE) + CAST(take_1 AS DOUBLE) / 2) / CAST(nullif(quota, 0) AS DOUBLE), 1), 0) AS s1,
                coalesce(least((CAST(source_size + off AS DOUBLE) + CAST(take_2 AS DOUBLE) / 2) / CAST(nullif(quota, 0) AS DOUBLE), 1), 0) AS s2 FROM k)
SELECT doc_id, size, source_size, target, take_1 + take_2 AS taken, take_1, take_2,
  CASE WHEN take_1 > 0 OR size = 0 THEN {{P1}} END AS position_1,
  CASE WHEN take_2 > 0 THEN {{P2}} END AS position_2
FROM u
"""
for _k in (1, 2):
    _case = " ".join(f"WHEN weight = {w} THEN {_inverse_sql(kn)}" for w, kn in CURRICULUM.items())
    MIXING_SQL = MIXING_SQL.replace(f"{{P{_k}}}", f"CASE {_case} END".replace("(s * ", f"(s{_k} * "))


@query("op10_mixing", MIXING_SQL)
def op10(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).orderBy("position_1", "doc_id")
