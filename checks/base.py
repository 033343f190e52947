"""Registration of queries and the SQL building blocks of their oracles.

The SQL here is written from the definitions in DuckDB idiom (its own accent
stripping, list functions and regex engine) and shares no code with the
library, so agreement means something.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL building blocks ------------------------------------------------------

WS = (
    r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
MARKERS = (
    "'', '-', '.', '--', '---', 'N/A', 'NA', 'NAN', 'NULL', 'NONE', 'SIN DATO', "
    "'SIN DATOS', 'SIN INFORMACION', 'SIN INFORMACIÓN', 'NO DISPONIBLE'"
)


def s_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def s_upper(x: str) -> str:
    return f"upper(replace({x}, 'ß', 'ss'))"


def s_canonical(x: str) -> str:
    """Canonical upper-case text; give it a column, it is used once."""
    no_zw = rf"regexp_replace(coalesce({x}, ''), '[\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g')"
    return s_upper(s_collapse(no_zw))


def s_compare(x: str) -> str:
    return s_upper(s_collapse(f"coalesce({x}, '')"))


def s_void(t: str) -> str:
    """Marker or no letter/digit, on already canonical text ``t``."""
    return rf"({t} IN ({MARKERS}) OR NOT regexp_matches({t}, '[\p{{L}}\p{{N}}]'))"


def s_missing(x: str) -> str:
    return f"({x} IS NULL OR {s_void(s_compare(x))})"


def s_clean(x: str) -> str:
    t = s_canonical(x)
    return f"CASE WHEN {x} IS NULL OR {s_void(t)} THEN NULL ELSE {t} END"


def s_ascii(x: str) -> str:
    """Latin letters of the test alphabet to ASCII."""
    out = f"strip_accents({x})"
    for a, b in (("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("Ø", "O"), ("ø", "o"), ("Œ", "OE"),
                 ("œ", "oe"), ("°", "deg"), ("¿", "?"), ("¡", "!"), ("«", "<<"), ("»", ">>")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


def s_place(x: str) -> str:
    return s_collapse(s_upper(f"strip_accents(coalesce({x}, ''))"))


def s_percent(part: str, whole: str) -> str:
    """100*part/whole to two decimals, ties to even, in integers."""
    n = f"greatest({whole}, 1)"
    q, r = f"((10000 * ({part})) // {n})", f"((10000 * ({part})) % {n})"
    return (
        f"CAST({q} + CASE WHEN 2*{r} > {n} OR (2*{r} = {n} AND {q} % 2 = 1) THEN 1 ELSE 0 END "
        f"AS DOUBLE) / 100.0"
    )


def s_tokens(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split({x}, ' '), lambda k: k <> '')))"


def s_lcs(x: str, y: str) -> str:
    """Longest common subsequence as two nested folds."""
    return f"""
    CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 ELSE
      list_extract(list_reduce(
        list_concat([list_transform(range(length({y}) + 1), lambda z: 0)],
                    list_transform(range(1, length({x}) + 1), lambda i: [CAST(i AS INTEGER)])),
        lambda prev, cur: list_reduce(
          list_concat([[0]], list_transform(range(1, length({y}) + 1), lambda j: [CAST(j AS INTEGER)])),
          lambda acc, jj: list_append(acc, greatest(
            prev[jj[1] + 1], acc[-1],
            prev[jj[1]] + CASE WHEN substr({x}, cur[1], 1) = substr({y}, jj[1], 1) THEN 1 ELSE 0 END))
        )), -1) END"""


def with_clause(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
