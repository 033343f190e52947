"""Before/after quality metrics.

Every stage is measured by one pass that counts identical rows by digest and
carries each row's flags along, plus the review's pairs; the results are long
rows, combined by a grouped union - no cross joins between scalar results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.functions import text
from pulcra.functions import predicates as P
from pulcra.functions.rowhash import row_digest
from pulcra.operators.dedup import near_duplicates, pair_totals
from pulcra.operators.profiling import percent, real_rows
from pulcra.profile import Profile

METRICS = (
    "records", "variables", "missing_cells", "total_cells", "missing_percent",
    "comparable_missing_cells", "comparable_total_cells", "comparable_missing_percent",
    "variables_with_missing", "exact_duplicates", "duplicate_pairs", "duplicate_records",
    "inconsistent_format", "wrong_type", "inconsistent_categories", "corrections",
)


def _real(columns: list[str]) -> Column:
    return ~reduce(lambda a, b: a & b, [text.is_blank_like(F.col(f"folded|{c}")) for c in columns])


def _uneven(c: str) -> Column:
    """Present, but a missing-value marker or leftover punctuation."""
    return F.col(c).isNotNull() & (text.is_missing(F.col(f"folded|{c}")) | P.is_residual(F.col(c)))


def format_rules(p: Profile, columns: list[str]) -> dict[str, Column]:
    """M3: what makes a column's format inconsistent, in reporting order."""
    out: dict[str, Column] = {}
    for c, shapes in p.identifiers.items():
        out[c] = ~P.matches_or_null(F.col(c), *shapes)
    out[p.address] = _uneven(p.address)
    out[p.phone] = ~text.is_blank_like(F.col(f"folded|{p.phone}")) & ~P.is_phone_list(F.col(p.phone))
    if p.dashed:
        out[p.dashed] = _uneven(p.dashed)
    if p.label:
        plain = text.canonical(F.col(f"folded|{p.label}"))
        out[p.label] = F.col(p.label).isNotNull() & (plain != text.to_ascii(plain))
    return {c: rule for c, rule in out.items() if c in columns}


def stage_metrics(df: DataFrame, p: Profile, *, raw: bool, review: DataFrame | None = None) -> DataFrame:
    """(metric, value, columns) of one stage. Pass the review when
    it exists already; otherwise the detector runs on the real rows."""
    columns = [c for c in df.columns if c != p.row_id]
    folded = df.select("*", *[F.col(c).alias(f"folded|{c}") for c in columns])
    folded = text.nfkc_columns(folded, [f"folded|{c}" for c in columns])
    folded = text.pinned(folded, {
        "real": _real(columns),
        **{f"void|{c}": text.is_blank_like(F.col(f"folded|{c}")) for c in columns},
    })
    formats = format_rules(p, columns)
    capital = seen = F.lit(None).cast("string")
    if p.zone is not None:
        is_capital = F.col(p.parent).isNotNull() & (text.canonical(F.col(f"folded|{p.parent}")) == p.zone.capital)
        capital = F.when(is_capital, F.lit("1"))
    if raw and p.child_map:
        key = text.canonical(F.col(f"folded|{p.child}"), ascii_only=True)
        seen = F.when(key.isin(*p.child_map), key)

    def flags(conditions: list[Column]) -> Column:
        return F.concat(F.lit(""), *[F.when(c, "1").otherwise("0") for c in conditions])

    # Identical rows have identical flags, so digests are counted and flags
    # carried along in one pass; all numbers are sums over these groups.
    groups = folded.select(
        row_digest(columns).alias("digest"), flags([F.col(f"void|{c}") for c in columns]).alias("void"),
        flags([F.col("real") & rule for rule in formats.values()]).alias("format"), capital.alias("capital"), seen.alias("seen"),
    ).groupBy("digest", "void", "format", "capital", "seen").agg(F.count(F.lit(1)).alias("n"))

    def marked(kind: str, names: list[str]) -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.substring(kind, i + 1, 1) == "1", F.col("n"))), F.lit(0)).alias(f"{kind}|{c}")
                for i, c in enumerate(names)]

    wide = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        *marked("void", columns), *marked("format", list(formats)),
        # A set bounded by the number of map keys.
        (F.count_if(F.col("capital").isNotNull()).cast("boolean").cast("int") + F.size(F.collect_set("seen"))).cast("bigint").alias("categories"),
    )

    def listed(prefix: str, names: list[str]) -> Column:
        return F.concat_ws(", ", *[F.when(F.col(f"`{prefix}|{c}`") > 0, F.lit(c)) for c in names])

    def how_many(prefix: str, names: list[str]) -> Column:
        return sum(((F.col(f"`{prefix}|{c}`") > 0).cast("int") for c in names), F.lit(0))

    def voids(names: list[str]) -> Column:
        return sum((F.col(f"`void|{c}`") for c in names), F.lit(0).cast("bigint"))

    common = [c for c in p.columns if c in columns]
    cells = {True: F.col("records") * len(columns), False: F.col("records") * len(common)}
    wrong = [f.name for f in df.schema.fields
             if f.name in columns and not isinstance(f.dataType, T.StringType)]
    none = F.lit("")
    values: dict[str, tuple[Column, Column]] = {
        "records": (F.col("records"), none),
        "variables": (F.lit(len(columns)), none),
        "missing_cells": (voids(columns), none),
        "total_cells": (cells[True], none),
        "missing_percent": (percent(voids(columns), cells[True]), none),
        "comparable_missing_cells": (voids(common), none),
        "comparable_total_cells": (cells[False], none),
        "comparable_missing_percent": (percent(voids(common), cells[False]), none),
        "variables_with_missing": (how_many("void", columns), listed("void", columns)),
        "inconsistent_format": (how_many("format", list(formats)), listed("format", list(formats))),
        "wrong_type": (F.lit(len(wrong)), F.lit(", ".join(wrong))),
        "inconsistent_categories": (F.col("categories"), none),
        "exact_duplicates": (F.col("duplicates"), none),
    }

    def row(metric: str, value: Column, names: Column = none) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"),
                        names.alias("columns"))

    out = wide.select(F.inline(F.array(*[row(m, v, names) for m, (v, names) in values.items()])))
    if review is None:
        review = near_duplicates(real_rows(df, columns), p)
    totals = pair_totals(review)
    return out.unionByName(totals.select(F.inline(F.array(
        row("duplicate_pairs", F.col("pairs")), row("duplicate_records", F.col("records"))))))


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two stages side by side, one row per metric."""
    both = before.withColumn("stage", F.lit(0)).unionByName(after.withColumn("stage", F.lit(1)))

    def side(column: str, stage: int) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col(column)))

    at = F.create_map(*[F.lit(x) for i, m in enumerate(METRICS) for x in (m, i + 1)])
    return both.groupBy("metric").agg(
        side("value", 0).alias("before"), side("value", 1).alias("after"),
        side("columns", 0).alias("before_columns"), side("columns", 1).alias("after_columns"),
    ).select(at[F.col("metric")].alias("position"), "metric", "before", "after",
             "before_columns", "after_columns")


def correction_total(report: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The corrections (M9) as a metric: their sum, and each of them as
    ``correction=affected``, sorted. Without a report nothing was corrected."""
    if report is None:
        return spark.sql("SELECT 'corrections' AS metric, 0D AS value, '' AS columns")
    said = F.concat("correction", F.lit("="), F.col("affected"))  # one line per correction
    return report.agg(
        F.coalesce(F.sum("affected"), F.lit(0)).cast("double").alias("value"),
        F.array_join(F.array_sort(F.collect_list(said)), "; ").alias("columns"),
    ).select(F.lit("corrections").alias("metric"), "value", "columns")


def affected(audit: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """M7: sum of affected rows per (variable, step code); non-numeric counts
    as zero."""
    number = F.coalesce(F.col("affected").cast("string").try_cast("double"), F.lit(0.0))
    wide = audit.agg(*[
        F.coalesce(F.sum(F.when((F.col("variable") == variable) & (F.col("step") == step), number)), F.lit(0.0))
        .cast("bigint").alias(label)
        for label, (variable, step) in wanted.items()
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("correction"), F.col(k).alias("affected")) for k in wanted
    ])))


def punctuation_to_null(raw: DataFrame, columns: list[str], p: Profile) -> DataFrame:
    """M8: punctuation-only cells that are neither a marker nor just hyphens,
    over real rows."""
    every = [c for c in raw.columns if c != p.row_id]
    folded = raw.select(*[F.col(c).alias(f"folded|{c}") for c in every])
    folded = text.nfkc_columns(folded, [f"folded|{c}" for c in every])
    real = _real(every)

    def odd(c: str) -> Column:
        t = text.canonical(F.col(f"folded|{c}"))
        only = (t != "") & ~text.has_alnum(t)
        return real & only & ~(t.isin(*p.markers) | t.rlike(r"\A-+\z"))

    total = sum((F.count_if(odd(c)) for c in columns), F.lit(0).cast("bigint"))
    return folded.agg(total.alias("affected")).select(
        F.lit("punctuation_to_null").alias("correction"), "affected")


def corrections(raw: DataFrame, audit: DataFrame, p: Profile) -> DataFrame:
    """M9: the labelled corrections, from the audit log and the raw table."""
    wanted = {"removed_rows": ("TODAS", "drop_empty")}
    for c in p.identifiers:
        wanted[f"{c}_to_null"] = (c, "identifier")
    wanted["phones_reformatted"] = (p.phone, "identifier")
    if p.dashed:
        wanted["dashes_removed"] = (p.dashed, "dashes")
    wanted["parents_normalised"] = (p.parent, "parent")
    wanted["children_normalised"] = (p.child, "child")
    if p.zone:
        wanted["zones_kept"] = (p.zone.column, "zone")
    for c in p.reported_categories:
        wanted[f"{c}_normalised"] = (c, "category")
    punctuated = [c for c in p.free_text if c != p.title]
    return affected(audit, wanted).unionByName(punctuation_to_null(raw, punctuated, p))


