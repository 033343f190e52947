"""Token-set similarity, 0-100.

The published definition: compare two texts as token sets; 100 when one set
contains the other, otherwise the best of three InDel ratios over the shared
tokens and the two remainders. Set algebra and the two easy ratios are native;
only the common-subsequence length of the remainders needs an Arrow kernel,
and only for pairs the arithmetic has not settled already.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.functions.text import pinned

# Ship the Arrow kernel with the task: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tokens(key: Column) -> Column:
    """Sorted distinct tokens; build once per row, before any pairing."""
    return F.array_sort(F.array_distinct(F.array_remove(F.split(key, " "), "")))


def common_subsequence(x: str, y: str) -> int:
    """Length of the longest common subsequence, bit-parallel: a table row is
    one integer with a bit per letter of x, cleared where the row grows, and
    the addition's carry moves the growth along; a letter of y is five integer
    operations, whatever the length of x."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for c in y:
        here = row & places.get(c, 0)
        if here:
            row = (row + here | row - here) & full
    return len(x) - row.bit_count()


@F.arrow_udf(T.IntegerType())
def lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    """Length of the longest common subsequence; NULL in, NULL out."""
    both = zip(left.to_pylist(), right.to_pylist(), strict=True)
    return pa.array([None if x is None or y is None else common_subsequence(x, y) for x, y in both], pa.int32())


def lcs_length_native(x: Column, y: Column) -> Column:
    """The same number as nested folds: slower, but needs no Python worker."""

    def letters(c: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))),
            lambda i: F.substr(c, i, F.lit(1)),
        )

    def next_row(row: Column, a: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(letters(y).alias("b"), F.slice(row, 1, F.length(y)).alias("diag"),
                         F.slice(row, 2, F.length(y)).alias("up")),
            F.array(F.lit(0)),
            lambda acc, z: F.array_append(
                acc,
                F.greatest(z["up"], F.element_at(acc, -1), z["diag"] + (z["b"] == a).cast("int")),
            ),
        )

    table = F.aggregate(letters(x), F.array_repeat(F.lit(0), F.length(y) + 1), next_row)
    return F.when((F.length(x) == 0) | (F.length(y) == 0), F.lit(0)).otherwise(
        F.element_at(table, -1)
    )


def with_token_set_score(
    df: DataFrame, a: str, b: str, out: str, *,
    at_least: float | None = None, native: bool = False,
) -> DataFrame:
    """Add ``out`` = token-set score of the token arrays ``a`` and ``b``.

    With ``at_least``, rows that cannot reach the threshold are filtered by
    arithmetic before the kernel runs, and the rest by their score.
    """
    only_a, only_b = F.array_except(a, b), F.array_except(b, a)
    shared = F.array_join(F.array_intersect(a, b), " ")
    df = pinned(
        df,
        {
            "__x": F.array_join(only_a, " "),
            "__y": F.array_join(only_b, " "),
            "__s": F.char_length(shared),
            "__empty": (F.size(a) == 0) | (F.size(b) == 0),
        },
    )
    s, gap = F.col("__s"), (F.col("__s") > 0).cast("int")
    x_len, y_len = F.char_length("__x"), F.char_length("__y")
    len_a, len_b = s + gap + x_len, s + gap + y_len
    total = (len_a + len_b).cast("double")

    def ratio(distance: Column, of: Column) -> Column:
        return F.lit(100.0) - F.lit(100.0) * distance / of

    easy = F.when(
        s > 0, F.greatest(ratio(gap + x_len, s + len_a), ratio(gap + y_len, s + len_b))
    ).otherwise(F.lit(0.0))
    df = df.withColumns(
        {
            "__subset": (s > 0) & ((x_len == 0) | (y_len == 0)),
            "__total": total,
            "__easy": F.when(F.col("__empty"), F.lit(0.0)).otherwise(easy),
            "__best": F.when(F.col("__empty"), F.lit(0.0)).otherwise(
                ratio(F.abs(x_len - y_len), total)
            ),
        }
    )
    if at_least is not None:
        df = df.where(
            F.col("__subset") | (F.greatest("__easy", "__best") >= F.lit(float(at_least)))
        )
    undecided = ~F.col("__subset") & (F.col("__best") > F.col("__easy"))
    df = df.withColumns(
        {"__x": F.when(undecided, F.col("__x")), "__y": F.when(undecided, F.col("__y"))}
    )
    kernel = lcs_length_native if native else lcs_length
    df = df.withColumn("__lcs", kernel(F.col("__x"), F.col("__y")))
    hard = ratio(x_len + y_len - 2 * F.col("__lcs"), F.col("__total"))
    df = df.withColumn(
        out,
        F.when(F.col("__subset"), F.lit(100.0)).otherwise(
            F.greatest(F.col("__easy"), F.coalesce(hard, F.lit(0.0)))
        ),
    ).drop("__x", "__y", "__s", "__empty", "__subset", "__total", "__easy", "__best", "__lcs")
    return df if at_least is None else df.where(F.col(out) >= F.lit(float(at_least)))
