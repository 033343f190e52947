"""Text and identifier canonicalisation.

Everything here is a native expression except NFKC, which has no Spark
builtin. NFKC is applied once per plan with :func:`nfkc_columns` (it is
idempotent), so the remaining functions stay in generated code.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import or_

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.functions import chars

# Ship the Arrow helper with the task: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Markers that mean "no value".
MISSING_MARKERS = (
    "", "-", ".", "--", "---", "N/A", "NA", "NAN", "NULL", "NONE",
    "SIN DATO", "SIN DATOS", "SIN INFORMACION", "SIN INFORMACIÓN", "NO DISPONIBLE",
)

# A phone has eight digits and starts with 2 to 7.
PHONE = rf"[2-7]{chars.DIGIT}{{7}}"
PHONE_SEPARATOR = " / "

_NFKC_STABLE = r"[^\x00-\x7F\x{C0}-\x{131}]"


def full_match(c: Column, *patterns: str) -> Column:
    """True where the whole value matches one pattern; ``$`` would also accept
    a trailing newline, hence the absolute anchors."""
    return c.rlike(rf"\A(?:{'|'.join(patterns)})\z")


# --- Unicode -------------------------------------------------------------


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkc_arrays(values: pa.Array) -> pa.Array:
    # Not pyarrow's own kernel: its NFKC leaves the marks decomposed.
    def fix(v: str | None) -> str | None:
        return v if v is None else unicodedata.normalize("NFKC", v)

    return pa.array(
        [None if row is None else [fix(v) for v in row] for row in values.to_pylist()],
        pa.list_(pa.string()),
    )


def may_change_under_nfkc(c: Column) -> Column:
    """Cheap gate: pure ASCII is decided by length, the rest by one regex."""
    return (F.octet_length(c) != F.char_length(c)) & c.rlike(_NFKC_STABLE)


def nfkc_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Normalise several columns with a single Arrow UDF call.

    Only rows holding a character outside the stable range send their values
    to Python; all others send one NULL. The gate is on the *input*, because a
    UDF inside ``when`` is evaluated for every row.
    """
    if not columns:
        return df
    gate = reduce(or_, (F.coalesce(may_change_under_nfkc(F.col(c)), F.lit(False)) for c in columns))
    packed = F.when(gate, F.array(*[F.col(c) for c in columns]))
    fixed = df.withColumn("__nfkc", _nfkc_arrays(packed))
    return fixed.withColumns(
        {c: F.coalesce(F.col("__nfkc")[i], F.col(c)) for i, c in enumerate(columns)}
    ).drop("__nfkc")


def pinned(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain projection is inlined into every filter and join condition that is
    pushed below it, which multiplies costly expressions layer by layer. Rows
    of a generator are not: ``inline`` of a one-element array keeps the values
    and stays in generated code.
    """
    return df.select(
        *[c for c in df.columns if c not in columns],
        F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))),
    )


# --- canonical text --------------------------------------------------------


def collapse(c: Column) -> Column:
    """Whitespace runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{chars.UNICODE}[{chars.SPACE}]+", " "))


def drop_zero_width(c: Column) -> Column:
    """Looked for first: hardly any value has one."""
    zero_width = f"[{chars.ZERO_WIDTH}]"
    return F.when(c.rlike(zero_width), F.regexp_replace(c, zero_width, "")).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Drop Latin diacritics; ASCII values skip the table. ``translate``
    deletes what has no counterpart, here the combining marks."""
    accented, plain = chars.accent_table()
    folded = F.translate(c, accented + chars.MARKS, plain)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(folded)


def to_ascii(c: Column) -> Column:
    """Transliterate Latin text; other scripts pass through unchanged.
    One table pass does single letters, and only values holding a letter with
    a longer spelling go through the replacements."""
    single = {k: v for k, v in chars.ASCII_SPELLING.items() if len(v) == 1}
    longer = {k: v for k, v in chars.ASCII_SPELLING.items() if len(v) > 1}
    accented, plain = chars.accent_table()
    folded = F.translate(
        c, accented + "".join(single) + chars.MARKS, plain + "".join(single.values())
    )
    spelled = folded
    for letter, spelling in longer.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    return (
        F.when(F.octet_length(c) == F.char_length(c), c)
        .when(c.rlike(f"[{''.join(longer)}]"), spelled)
        .otherwise(folded)
    )


def canonical(c: Column, *, upper: bool = True, ascii_only: bool = False) -> Column:
    """T1 (input already NFKC): no zero-width characters, single spaces,
    trimmed, optionally upper case and optionally ASCII. NULL becomes ''."""
    out = collapse(drop_zero_width(F.coalesce(c, F.lit(""))))
    if upper:
        out = F.upper(out)
    return to_ascii(out) if ascii_only else out


def has_alnum(c: Column) -> Column:
    return c.rlike(f"[{chars.ALNUM}]")


def _may_be_marker(c: Column, markers: Sequence[str]) -> Column:
    """Gate: the first visible character starts some marker, in any case."""
    starts = "".join(sorted({re.escape(m[0]) for m in markers if m}))
    skip = f"[{chars.SPACE}{chars.ZERO_WIDTH}]*"
    return c.rlike(rf"(?iuU)\A{skip}(?:[{starts}]|\z)")


def equals_marker(
    c: Column, markers: Sequence[str] = MISSING_MARKERS, folded: Column | None = None
) -> Column:
    """The folded value (default: canonical) is one of the markers. Folding
    runs only for values that pass the gate."""
    folded = canonical(c) if folded is None else folded
    return F.coalesce(
        F.when(_may_be_marker(c, markers), folded.isin(*markers)), F.lit(False)
    )


def _void(t: Column, markers: Sequence[str]) -> Column:
    """On canonical text. Markers without a letter or digit need no lookup."""
    return ~has_alnum(t) | t.isin(*[m for m in markers if any(ch.isalnum() for ch in m)])


def is_missing(c: Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """NULL, a marker, or no letter or digit at all (cleaning sense)."""
    return c.isNull() | ~has_alnum(c) | equals_marker(c, markers)


def keep_present(t: Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """Canonical text, or NULL where it means "no value"."""
    return F.when(~_void(t, markers), t)


def clean_text(
    c: Column, *, ascii_only: bool = False, markers: Sequence[str] = MISSING_MARKERS
) -> Column:
    """Canonical text, or NULL where the value is missing."""
    cleaned = keep_present(canonical(c), markers)
    return to_ascii(cleaned) if ascii_only else cleaned


def clean_columns(
    df: DataFrame, columns: Sequence[str], *, ascii_only: bool = False,
    markers: Sequence[str] = MISSING_MARKERS,
) -> DataFrame:
    """NFKC + T3 over a list of columns."""
    return nfkc_columns(df, columns).withColumns(
        {c: clean_text(F.col(c), ascii_only=ascii_only, markers=markers) for c in columns}
    )


# The next four come in pairs: the operator on a raw value, and its core on
# text that T3 has been through already.


def drop_dashes(t: Column) -> Column:
    return F.regexp_replace(
        t, rf"{chars.UNICODE}\A-{{2,}}[{chars.SPACE}]*(?=[{chars.WORD}])", ""
    )


def strip_leading_dashes(c: Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """T4: a decorative run of two or more hyphens before a word goes away."""
    return drop_dashes(clean_text(c, markers=markers))


def keep_shape(t: Column, *patterns: str) -> Column:
    squeezed = F.replace(t, F.lit(" "), F.lit(""))
    return F.when(full_match(squeezed, *patterns), squeezed)


def clean_identifier(
    c: Column, *patterns: str, markers: Sequence[str] = MISSING_MARKERS
) -> Column:
    """Canonical text without spaces, kept only in one of the shapes."""
    return keep_shape(clean_text(c, markers=markers), *patterns)


def extract_phones(c: Column) -> Column:
    """Distinct complete phone numbers in order of appearance. A maximal
    digit run of length eight is what lookarounds would find; of the canonical
    form only the removal of zero-width characters can affect digits."""
    runs = F.regexp_extract_all(drop_zero_width(c), F.lit(f"({chars.DIGIT}{{8,}})"), 1)
    return F.array_distinct(F.filter(runs, lambda run: full_match(run, PHONE)))


def clean_phone(c: Column) -> Column:
    """Phones joined by the separator, NULL when there is none."""
    return F.nullif(F.array_join(extract_phones(c), PHONE_SEPARATOR), F.lit(""))


def map_key(key: Column, mapping: Mapping[str, str]) -> Column:
    if not mapping:
        return key
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(literal[key], key)


def map_category(
    c: Column, mapping: Mapping[str, str], markers: Sequence[str] = MISSING_MARKERS
) -> Column:
    """T9 with a small literal map; use ``catalog.map_column`` for a table."""
    return map_key(clean_text(c, ascii_only=True, markers=markers), mapping)


# --- comparison keys ---------------------------------------------------------


def comparison_text(c: Column) -> Column:
    """Like T1 in upper case, but zero-width characters stay."""
    return F.upper(collapse(F.coalesce(c, F.lit(""))))


def is_blank_like(c: Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """The profiling sense of missing."""
    return c.isNull() | ~has_alnum(c) | equals_marker(c, markers, comparison_text(c))


def place_key(c: Column) -> Column:
    """Accent-free upper-case place name; NULL becomes ''."""
    return collapse(F.upper(strip_accents(F.coalesce(c, F.lit("")))))


def similarity_key(c: Column) -> Column:
    """ASCII canonical text without full stops and commas."""
    return F.translate(canonical(c, ascii_only=True), ".,", "")


def category_key(c: Column) -> Column:
    """ASCII canonical text, everything but letters and digits as a space."""
    return F.trim(
        F.regexp_replace(canonical(c, ascii_only=True), f"[^{chars.ALNUM}]+", " ")
    )


def with_ascii_keys(df: DataFrame, column: str) -> DataFrame:
    """Add ascii, place_key, similarity_key and category_key of a column (NFKC
    input). The canonical text and its ASCII form are computed once a row."""
    once = pinned(df, {"__canonical": canonical(F.col(column))})
    once = pinned(once, {"ascii": to_ascii(F.col("__canonical"))})
    plain = F.col("ascii")
    return once.drop("__canonical").withColumns({
        "place_key": place_key(F.col(column)), "similarity_key": F.translate(plain, ".,", ""),
        "category_key": F.trim(F.regexp_replace(plain, f"[^{chars.ALNUM}]+", " "))})


# --- small helpers -----------------------------------------------------------


def has_control_char(c: Column) -> Column:
    """A control or format character anywhere."""
    return c.rlike(r"[\p{Cc}\p{Cf}]")


def derive_when(parent: Column, parent_value: str, child: Column, pattern: str) -> Column:
    """Keep ``child`` only under one parent and only in the given shape."""
    return F.when(parent.eqNullSafe(F.lit(parent_value)) & full_match(child, pattern), child)


def two_decimals(c: Column) -> Column:
    """``%.2f`` with ties to even (``format_string`` rounds ties up)."""
    return F.format_string("%.2f", F.bround(c, 2))


def joined_or(values: Column, default: str) -> Column:
    """Comma list, or ``default`` when the array is empty."""
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(F.lit(default))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
