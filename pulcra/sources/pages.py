"""Fields and repeated rows of web pages held in a table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute(html: Column, element: str, name: str) -> Column:
    """The first value of an attribute of an element, '' when absent."""
    return F.coalesce(F.regexp_extract(html, rf'<{re.escape(element)}\b[^>]*\b{re.escape(name)}="([^"]*)"', 1), F.lit(""))


def field_by_id(html: Column, element_id: str) -> Column:
    """The value of the form field with this id, '' when absent."""
    # Fixed pattern: the id and the value are neighbours in the served form.
    return F.coalesce(
        F.regexp_extract(html, rf'id="{re.escape(element_id)}" value="([^"]*)"', 1), F.lit(""))


_MARK, _OTHER = "\x01", "\x02"


def closed_content(rest: Column, element: str) -> Column:
    """The beginning of ``rest`` up to the closing tag that matches an element
    opened just before it: a fold over the element's tags counts the depth.
    Tags in comments do not count; an element that is never closed is ''."""
    name = re.escape(element)
    # Marks stand around comments and tags, so that every second piece is one;
    # lengths of pieces are positions in ``rest``, which has marks of its own replaced.
    clean = F.when(F.instr(rest, _MARK) > 0, F.translate(rest, _MARK, _OTHER)).otherwise(rest)
    pieces = F.split(F.regexp_replace(clean, rf"(?is)<!--.*?-->|</?{name}\b[^>]*>", f"{_MARK}$0{_MARK}"), _MARK, -1)
    state = F.struct(F.lit(0).alias("at"), F.lit(1).alias("depth"), F.lit(False).alias("tag"), F.lit(-1).alias("end"))

    def step(acc: Column, piece: Column) -> Column:
        change = (
            F.when(~acc["tag"] | piece.startswith("<!--") | piece.endswith("/>"), 0)
            .when(piece.startswith("</"), -1).otherwise(1))
        depth = acc["depth"] + change
        return F.struct(
            (acc["at"] + F.char_length(piece)).alias("at"), depth.alias("depth"), (~acc["tag"]).alias("tag"),
            F.when((acc["end"] < 0) & (depth == 0), acc["at"]).otherwise(acc["end"]).alias("end"))

    return F.substr(rest, F.lit(1), F.greatest(F.aggregate(pieces, state, step)["end"], F.lit(0)))


def element_by_id(html: Column, element: str, element_id: str) -> Column:
    """The content of the first such element with this id, '' when absent.
    Elements of the same name may be nested in it."""
    name = re.escape(element)
    rest = F.regexp_extract(html, rf'(?is)<{name}\b[^>]*\bid="{re.escape(element_id)}"[^>]*>(.*)', 1)
    return F.coalesce(closed_content(rest, element), F.lit(""))


def rows_of(
    pages: DataFrame, key: str, html: str, row_pattern: str, cells: dict[str, str], *,
    within: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Every match of ``row_pattern`` as a row of cells, each cell being
    the first group of its own pattern. Pages without rows are the second
    table, so an empty result is visible. ``within`` takes rows only from the
    element with this name and id, up to the closing tag that matches it."""
    source = pages.select(key, (F.col(html) if within is None else element_by_id(F.col(html), *within)).alias("__source"))
    found = source.select(
        key, F.regexp_extract_all("__source", F.lit(f"({row_pattern})"), 1).alias("__rows"))
    rows = found.select(key, F.posexplode("__rows").alias("row_no", "__row"))
    out = rows.select(key, "row_no", *[
        F.regexp_extract("__row", pattern, 1).alias(name) for name, pattern in cells.items()
    ])
    return out, found.where(F.size("__rows") == 0).select(key)
