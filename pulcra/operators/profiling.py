"""Column profiles.

Per-column numbers come from one wide aggregate: a single scan, one partial row
per task, no data shuffle. Only distinct counts need a shuffle, and those move
pre-aggregated (column, value) pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.functions import predicates as P
from pulcra.functions import text
from pulcra.functions.rowhash import row_digest


def percent(part: Column, whole: Column) -> Column:
    """``100*part/whole`` to two decimals, ties to even, decided in integers;
    zero for an empty table."""
    n = F.greatest(whole, F.lit(1))
    scaled = part * F.lit(10000)
    down, rest = F.call_function("div", scaled, n), F.pmod(scaled, n)
    up = (rest * 2 > n) | ((rest * 2 == n) & (F.pmod(down, F.lit(2)) == 1))
    return (down + up.cast("bigint")).cast("double") / F.lit(100.0)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def unwide(row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "variable") -> DataFrame:
    """Turn one wide row of ``field|name`` columns into one row per name."""
    structs = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(name).alias(key),
            *[F.col(f"`{f}|{name}`").alias(f) for f in fields],
        )
        for i, name in enumerate(names)
    ]
    return row.select(F.inline(F.array(*structs)))


def missing_by_column(
    df: DataFrame, columns: Sequence[str] | None = None, *, nfkc: bool = True
) -> DataFrame:
    """A1: (position, variable, missing, percent), to be ordered by
    ``missing`` descending and then ``position``."""
    columns = list(columns or df.columns)
    base = text.nfkc_columns(df.select(*columns), columns) if nfkc else df
    wide = base.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(text.is_blank_like(F.col(c))).alias(f"missing|{c}") for c in columns],
    )
    long = wide.select(
        "rows",
        F.inline(F.array(*[
            F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("variable"),
                     F.col(f"`missing|{c}`").alias("missing"))
            for i, c in enumerate(columns)
        ])),
    )
    return long.select(
        "position", "variable", "missing", percent(F.col("missing"), F.col("rows")).alias("percent"),
        "rows",
    )


def missing_total(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: one row with missing cells, cells, percent, columns with missing."""
    per = missing_by_column(df, columns)
    totals = per.agg(
        F.sum("missing").alias("missing_cells"),
        F.sum("rows").alias("total_cells"),
        F.count_if(F.col("missing") > 0).alias("columns_with_missing"),
    )
    return totals.withColumn("percent", percent(F.col("missing_cells"), F.col("total_cells")))


def column_types(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """A3: observed against expected type; metadata only."""
    rows = [
        (i + 1, f.name, f.dataType.simpleString(), expected.get(f.name, "no definido"))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, variable string, observed_type string, expected_type string"
    )


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per non-null cell: (variable, value)."""
    cells = df.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]))
    )
    return cells.where(F.col("value").isNotNull())


def distinct_values(
    df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False
) -> DataFrame:
    """A4: distinct non-missing raw values per column.

    Exact by default: (variable, value) pairs are made distinct on the map side
    first, and again after one shuffle keyed by the pair, so a constant column
    costs one row per task. Missing is decided once per distinct value.
    """
    columns = list(columns or df.columns)
    if approximate:
        base = df.select(*columns)
        wide = base.agg(*[
            F.approx_count_distinct(F.when(~text.is_blank_like(F.col(c)), F.col(c)))
            .alias(f"distinct_values|{c}") for c in columns
        ])
        return unwide(wide, columns, ["distinct_values"]).drop("position")
    pairs = _cells(df, columns).distinct()
    judged = text.nfkc_columns(pairs.withColumn("folded", F.col("value")), ["folded"])
    counts = judged.groupBy("variable").agg(
        F.count_if(~text.is_blank_like(F.col("folded"))).alias("distinct_values")
    )
    # Columns without a single non-null cell still get their zero.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "variable string")
    return names.join(counts, "variable", "left").select(
        "variable", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values")
    )


def schema_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: type, NULL count and distinct non-null values per column."""
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls|{c}") for c in columns])
    nulls = unwide(wide, columns, ["nulls"])
    distinct = _cells(df, columns).distinct().groupBy("variable").agg(
        F.count(F.lit(1)).alias("distinct_values")
    )
    typed = F.create_map(*[F.lit(x) for c in columns for x in (c, kinds[c])])
    return nulls.join(distinct, "variable", "left").select(
        "position", "variable", typed[F.col("variable")].alias("observed_type"), "nulls",
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
    )


def text_format(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A5: edge spaces, repeated spaces, invisible characters and lower case,
    counted on the raw value of non-missing cells."""
    columns = list(columns or df.columns)
    both = df.select(*columns, *[F.col(c).alias(f"folded|{c}") for c in columns])
    both = text.nfkc_columns(both, [f"folded|{c}" for c in columns])
    tests = {
        "edge_spaces": P.has_edge_space,
        "repeated_spaces": P.has_space_run,
        "invisible_characters": lambda c: P.sure(text.has_control_char(c)),
        "lower_case": P.has_lowercase,
    }
    wide = both.agg(*[
        F.count_if(test(F.col(c)) & ~text.is_blank_like(F.col(f"folded|{c}"))).alias(f"{name}|{c}")
        for c in columns for name, test in tests.items()
    ])
    return unwide(wide, columns, list(tests)).drop("position")


def identifier_patterns(df: DataFrame, patterns: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Values matching the shape, and non-missing values that do not."""
    columns = list(patterns)
    both = df.select(*columns, *[F.col(c).alias(f"folded|{c}") for c in columns])
    both = text.nfkc_columns(both, [f"folded|{c}" for c in columns])
    aggs = []
    for c in columns:
        fits = P.sure(text.full_match(F.col(c), *patterns[c]))
        aggs += [
            F.count_if(fits).alias(f"valid|{c}"),
            F.count_if(~fits & ~text.is_blank_like(F.col(f"folded|{c}"))).alias(f"invalid_present|{c}"),
        ]
    return unwide(both.agg(*aggs), columns, ["valid", "invalid_present"]).drop("position")


def frequencies(df: DataFrame, *keys: str, top: int | None = None, where: Column | None = None) -> DataFrame:
    """How often each value occurs; ``top`` is a top-k report."""
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if top is None:
        return counted
    return counted.orderBy(F.desc("n"), *[F.asc_nulls_first(k) for k in keys]).limit(top)


def relation_mismatches(
    df: DataFrame, parent: str, label: str, parent_map: Mapping[str, str]
) -> DataFrame:
    """Literal differences of two columns, and labels that do not fit
    the parent after the parent map, over rows where both are non-blank."""
    both = text.nfkc_columns(df.select(parent, label), [parent, label]).where(
        P.is_nonblank(F.col(parent)) & P.is_nonblank(F.col(label))
    )
    mapped = F.col(parent)
    for old, new in parent_map.items():
        mapped = F.when(F.col(parent) == old, F.lit(new)).otherwise(mapped)
    return both.agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if(F.col(parent) != F.col(label)).alias("literal_differences"),
        F.count_if(~P.label_fits_parent(mapped, F.col(label))).alias("relation_errors"),
    )


def all_blank(columns: Sequence[str]) -> Column:
    """Missing (T12) in every column; expects NFKC input."""
    return reduce(and_, [text.is_blank_like(F.col(c)) for c in columns])


def real_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M1: rows that are not missing in all of the columns."""
    keys = [f"__f{i}" for i in range(len(columns))]
    folded = df.select("*", *[F.col(c).alias(k) for c, k in zip(columns, keys)])
    # Pinned: otherwise the long condition is pushed down, copied into every
    # branch that reads these rows, and multiplied by constraint inference.
    flagged = text.pinned(text.nfkc_columns(folded, keys), {"__real": ~all_blank(keys)})
    return flagged.where("__real").select(*df.columns)


def exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Surplus copies of identical rows, from digests counted map-side."""
    groups = df.select(row_digest(columns).alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wholly missing rows, and duplicates with and without them.

    One pass: identical rows are equally empty, so each digest group carries
    the flag and the three totals follow from the groups.
    """
    keys = [f"__f{i}" for i in range(len(columns))]
    folded = df.select(
        row_digest(columns).alias("d"), *[F.col(c).alias(k) for c, k in zip(columns, keys)]
    )
    flagged = text.nfkc_columns(folded, keys).select("d", all_blank(keys).alias("blank"))
    groups = flagged.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("blank").alias("blank")
    )
    zero = F.lit(0)
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), zero).alias("empty_rows"),
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicates"),
        F.coalesce(F.sum(F.when(~F.col("blank"), F.col("n") - 1)), zero).alias("duplicates_without_empty"),
    )
