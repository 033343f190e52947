"""Cleaning with an audit log.

All steps are stages of one narrow plan. Each step keeps its before and after
columns side by side, so the audit log - every change count of every step - is
one aggregate over one scan, and the cleaned table is a projection of the same
plan. Only the duplicate review shuffles rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulcra.functions import text
from pulcra.operators.catalog import flag_places
from pulcra.operators.dedup import apply_decisions, near_duplicates
from pulcra.profile import Profile
from pulcra.session import written

ALL_COLUMNS = "TODAS"

# What each step counts, what it does to the cell, and the rules it applies
# (operator ids). The step code is the key of a line; these texts describe it.
STEPS = {
    "standardise": ("cell is not in canonical form", "canonical text, or NULL where only a marker or signs are left", "T1, T2, T3"),
    "drop_empty": ("every column is NULL", "row is left out", "C2"),
    "identifier": ("no accepted shape matches the cell as it is", "matching part kept, else NULL", "T5, T6, T7, T8"),
    "zone": ("child has the zone shape under the capital", "copied to the zone column", "T18"),
    "parent": ("parent differs from its mapped value", "mapped value", "T9"),
    "child": ("child differs from its mapped value", "mapped value, or the capital's child", "T9, T13"),
    "dashes": ("two or more hyphens, then a letter or digit", "hyphens cut off", "T4"),
    "category": ("cell is not upper-case ASCII", "transliterated", "T16"),
    "catalogue": ("pair is not in the catalogue", "child becomes NULL", "P8"),
    "review": ("pair accepted by the detector", "listed with a decision, table unchanged", "D8, D13"),
}


@dataclass(frozen=True)
class Logged:
    """One line of the audit log: which before/after columns it compares."""

    variable: str
    step: str
    count: Column            # a boolean per row
    only_real: bool = True   # rows already removed do not count
    always: bool = True      # written even when nothing changed


@dataclass
class Cleaned:
    data: DataFrame
    audit: DataFrame
    review: DataFrame
    wide: DataFrame = field(repr=False)


def _changed(before: str, after: str) -> Column:
    """C14."""
    return ~F.col(before).eqNullSafe(F.col(after))


def clean_stages(df: DataFrame, p: Profile, catalogue: DataFrame) -> tuple[DataFrame, list[Logged]]:
    """C1-C9 as columns. For each profile column ``c`` the result holds the raw
    ``c`` and the final ``out|c``; ``real`` is false for empty rows. Row-level
    except for the catalogue lookup, so it also runs on a stream."""
    log: list[Logged] = []
    m = p.markers

    # Standardise every column once. The raw values stay for the log.
    std = {c: f"std|{c}" for c in p.columns}
    wide = df.select(p.row_id, *p.columns, *[F.col(c).alias(std[c]) for c in p.columns])
    wide = text.nfkc_columns(wide, list(std.values()))
    wide = text.pinned(wide, {s: text.canonical(F.col(s)) for s in std.values()})
    wide = wide.withColumns({s: text.keep_present(F.col(s), m) for s in std.values()})
    for c in p.columns:
        log.append(Logged(c, "standardise", _changed(c, std[c]), only_real=False, always=False))

    # Flag instead of filter, the log needs both counts.
    empty = reduce(and_, [F.col(s).isNull() for s in std.values()])
    wide = wide.withColumn("real", ~empty)
    log.append(Logged(ALL_COLUMNS, "drop_empty", ~F.col("real"), only_real=False))

    # From here on every input is canonical and present, or NULL.
    # Identifiers and phone.
    out = {}
    shapes = {p.code: p.code_patterns, **p.identifiers}
    for c, patterns in shapes.items():
        out[f"out|{c}"] = text.keep_shape(F.col(std[c]), *patterns)
        log.append(Logged(c, "identifier", _changed(std[c], f"out|{c}")))
    out[f"out|{p.phone}"] = text.clean_phone(F.col(std[p.phone]))
    log.append(Logged(p.phone, "identifier", _changed(std[p.phone], f"out|{p.phone}")))

    # The zone is read from the places before they are repaired.
    parent, child = F.col(std[p.parent]), F.col(std[p.child])
    in_capital = F.lit(False)
    if p.zone is not None:
        z = p.zone
        in_capital = parent.eqNullSafe(F.lit(z.capital))
        out[f"out|{z.column}"] = text.derive_when(parent, z.capital, child, z.derive_pattern)
        log.append(Logged(z.column, "zone", F.col(f"out|{z.column}").isNotNull()))
    out[f"out|{p.parent}"] = text.map_key(text.to_ascii(parent), p.parent_map)
    log.append(Logged(p.parent, "parent", _changed(std[p.parent], f"out|{p.parent}")))
    mapped = text.map_key(text.to_ascii(child), p.child_map)
    if p.zone is not None:
        mapped = F.when(in_capital, F.lit(p.zone.child)).otherwise(mapped)
    out["mapped_child"] = mapped
    log.append(Logged(p.child, "child", _changed(std[p.child], "mapped_child")))

    # Free text and categories.
    for c in p.free_text:
        done = F.col(std[c])  # standardising again would change nothing
        if c == p.dashed:
            done = text.drop_dashes(done)
            log.append(Logged(c, "dashes", _changed(std[c], f"out|{c}"), always=False))
        out[f"out|{c}"] = done
    for c in p.categories:
        out[f"out|{c}"] = text.to_ascii(F.col(std[c]))
        log.append(Logged(c, "category", _changed(std[c], f"out|{c}"), always=False))
    for c in p.columns:
        if c != p.child:
            out.setdefault(f"out|{c}", F.col(std[c]))
    wide = wide.withColumns(out)

    # Children outside the catalogue of their parent become NULL.
    wide = flag_places(wide, f"out|{p.parent}", "mapped_child", catalogue)
    outside = (
        F.col("mapped_child").isNotNull() & F.col(f"out|{p.parent}").isNotNull()
        & ~F.col("pair_known")
    )
    wide = wide.withColumn("outside", outside).withColumn(
        f"out|{p.child}", F.when(~F.col("outside"), F.col("mapped_child"))
    )
    log.append(Logged(p.child, "catalogue", F.col("outside")))
    return wide, log


def cleaned_rows(wide: DataFrame, p: Profile) -> DataFrame:
    """Real rows in contractual column order, all text."""
    return wide.where("real").select(
        p.row_id, *[F.col(f"`out|{c}`").alias(c) for c in p.clean_columns]
    )


def log_counts(log: list[Logged]) -> list[Column]:
    """C14 for all row-level steps, as aggregates n0, n1, ..."""
    return [F.count_if(F.col("real") & x.count if x.only_real else x.count).alias(f"n{i}")
            for i, x in enumerate(log)]


def audit_log(
    wide: DataFrame, log: list[Logged], review: DataFrame | None, counts: DataFrame | None = None
) -> DataFrame:
    """(step_no, variable, step, problem, transformation, affected,
    justification). One aggregate for all row-level steps, unless its row was
    observed already while the table was written."""
    counts = wide.agg(*log_counts(log)) if counts is None else counts

    def line(i: int, variable: str, step: str, affected: Column, always: bool) -> Column:
        condition, effect, applied = STEPS[step]
        return F.struct(
            F.lit(i + 1).alias("step_no"), F.lit(variable).alias("variable"), F.lit(step).alias("step"),
            F.lit(condition).alias("problem"), F.lit(effect).alias("transformation"),
            affected.cast("bigint").alias("affected"), F.lit(applied).alias("justification"),
            F.lit(always).alias("always"),
        )

    lines = counts.select(F.inline(F.array(*[
        line(i, x.variable, x.step, F.col(f"n{i}"), x.always) for i, x in enumerate(log)
    ])))
    if review is not None:
        pairs = review.agg(F.count(F.lit(1)).alias("n"))
        lines = lines.unionByName(pairs.select(
            F.inline(F.array(line(len(log), ALL_COLUMNS, "review", F.col("n"), True)))
        ))
    return lines.where(F.col("always") | (F.col("affected") > 0)).drop("always")


def clean(
    df: DataFrame, p: Profile, catalogue: DataFrame, *, materialize: bool = True
) -> Cleaned:
    """The whole cleaning: data, audit log and duplicate review.

    The review only ever proposes keeping both records, so the data does not
    depend on it; pass an edited review to ``apply_decisions`` to act on it.
    The cleaned table feeds several later passes (block sizes, pairing,
    validation, metrics), so it is written once to the shared folder and read
    back column by column instead of being cleaned again for each of them; the
    audit counts are observed in the same pass (no shuffle lies between them
    and the write, so a repeated task is counted once).
    """
    wide, log = clean_stages(df, p, catalogue)
    if materialize:
        seen = Observation()
        data = written(cleaned_rows(wide.observe(seen, *log_counts(log)), p), "cleaned")
        names = [f"n{i}" for i in range(len(log))]
        counts = df.sparkSession.createDataFrame(
            [tuple(seen.get.get(n, 0) for n in names)], ", ".join(f"{n} bigint" for n in names))
    else:
        data, counts = cleaned_rows(wide, p), None
    review = near_duplicates(data, p)
    return Cleaned(data, audit_log(wide, log, review, counts), review, wide)


def clean_with_decisions(
    df: DataFrame, p: Profile, catalogue: DataFrame, decided: DataFrame, cleaned: Cleaned | None = None
) -> DataFrame:
    """C11: the cleaned table after an edited review was applied. Pass the
    result of :func:`clean` the review came from, and its table is read back
    instead of being cleaned again."""
    data = cleaned_rows(clean_stages(df, p, catalogue)[0], p) if cleaned is None else cleaned.data
    return apply_decisions(data, decided, p)
