"""Row-level tests (P1-P14). Every predicate is two-valued: NULL in, a definite
true or false out, so they can be negated and counted safely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulcra.functions import chars, text


def sure(c: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(c, F.lit(False))


def matches_or_null(c: Column, *patterns: str) -> Column:
    """NULL or one of the shapes; the empty string is not NULL."""
    return c.isNull() | sure(text.full_match(c, *patterns))


def is_phone_list(c: Column) -> Column:
    """NULL, or phones joined by exactly the separator. Written as one
    regex: a lambda over ``split`` would leave generated code."""
    one = text.PHONE
    return matches_or_null(c, f"{one}(?:{text.PHONE_SEPARATOR}{one})*")


def has_extra_space(c: Column) -> Column:
    """Whitespace at an end, or two in a row."""
    s = f"[{chars.SPACE}]"
    return sure(c.rlike(rf"{chars.UNICODE}\A{s}|{s}\z|{s}{{2}}"))


def has_edge_space(c: Column) -> Column:
    s = f"[{chars.SPACE}]"
    return sure(c.rlike(rf"{chars.UNICODE}\A{s}|{s}\z"))


def has_space_run(c: Column) -> Column:
    return sure(c.rlike(f"{chars.UNICODE}[{chars.SPACE}]{{2}}"))


def is_residual(c: Column) -> Column:
    """P5: only punctuation, or a dash run before a word. Blank is not flagged."""
    s = f"[{chars.SPACE}]"
    return sure(
        c.rlike(rf"{chars.UNICODE}\A{s}*[^{chars.ALNUM}{chars.SPACE}][^{chars.ALNUM}]*\z")
        | c.rlike(rf"{chars.UNICODE}\A{s}*-{{2,}}{s}*[{chars.WORD}]")
    )


def label_fits_parent(parent: Column, label: Column) -> Column:
    """The label is the parent or starts with it and a space."""
    p, q = text.place_key(parent), text.place_key(label)
    return (
        parent.isNull() | label.isNull() | (q == p) | q.startswith(F.concat(p, F.lit(" ")))
    )


def differs(a: Column, b: Column) -> Column:
    """P9, negated: null-safe inequality."""
    return ~a.eqNullSafe(b)


def outside(c: Column, domain: Sequence[str], *, nullable: bool) -> Column:
    """P10: not literally in the domain; NULL is outside unless nullable."""
    out = ~sure(c.isin(*domain))
    return c.isNotNull() & out if nullable else out


def bad_numbered_label(
    label: Column, pattern: str, parent: Column, parent_value: str, child: Column, child_value: str
) -> Column:
    """A label present but out of range or under the wrong parents."""
    fits = sure(text.full_match(label, pattern))
    home = parent.eqNullSafe(F.lit(parent_value)) & child.eqNullSafe(F.lit(child_value))
    return label.isNotNull() & ~(fits & home)


def has_lowercase(c: Column) -> Column:
    """P12 (fixed value: the Spanish lower-case alphabet)."""
    return sure(c.rlike("[a-záéíóúüñ]"))


def is_odd_phone(c: Column, markers: Sequence[str] = text.MISSING_MARKERS) -> Column:
    """Something is there, but not exactly one phone."""
    return ~text.is_blank_like(c, markers) & ~sure(text.full_match(c, text.PHONE))


def is_nonblank(c: Column) -> Column:
    """At least one non-whitespace character."""
    return sure(c.rlike(f"{chars.UNICODE}[^{chars.SPACE}]"))
