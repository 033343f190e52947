import pytest
from pyspark.sql import functions as F

from pulcra.functions import predicates as P
from pulcra.functions import text as T
from pulcra.profiles.schools import CODE_SHAPE, DISTRICT_SHAPES

ZW = "​"


def run(spark, fn, values, nfkc=True):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    if nfkc:
        df = T.nfkc_columns(df, ["v"])
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


CASES = [
    ("T1", T.canonical, [f"  liceo  san{ZW} josé ", " a\x1cb\t", None], ["LICEO SAN JOSÉ", "A B", ""]),
    ("T1 ascii", lambda c: T.canonical(c, ascii_only=True), ["niño", "straße 5°", "Øre Æsir"],
     ["NINO", "STRASSE 5deg", "ORE AESIR"]),
    ("T1a", lambda c: c, ["ﬁn", "Ａ１", "é", "3º", None], ["fin", "A1", "é", "3o", None]),
    ("T2 true", T.is_missing, [None, "", "...", " n/a ", "Sin  Información", "- . -", f"N{ZW}A", " "], [True] * 8),
    ("T2 false", T.is_missing, ["0", "SIN JORNADA", "½", "NADA"], [False] * 4),
    ("T12", T.is_blank_like, [f"N{ZW}A", "n/a", "__", None, "x"], [False, True, True, True, False]),
    ("T3", T.clean_text, ["  a  b", "null", "--"], ["A B", None, None]),
    ("T4", T.strip_leading_dashes, ["-- ANA-MARIA", "-X", "---", "--_a"], ["ANA-MARIA", "-X", None, "_A"]),
    ("T5", lambda c: T.clean_identifier(c, CODE_SHAPE), ["01-02-0003-46", "01 - 02-0003-46", "1-2-3-4", "01-02-0003-46\n"],
     ["01-02-0003-46", "01-02-0003-46", None, "01-02-0003-46"]),
    ("T6", lambda c: T.clean_identifier(c, *DISTRICT_SHAPES), ["01-403", "01-01-0001", "01-"], ["01-403", "01-01-0001", None]),
    ("T8", T.clean_phone, ["55551234/55551234 y 23456789 123456789", "TEL55551234X", "12345678", "5555-1234", "7755123"],
     ["55551234 / 23456789", "55551234", None, None, None]),
    ("T9", lambda c: T.map_category(c, {"CIUDAD": "PUEBLO"}), ["ciudad ", "Petén", "n/a"], ["PUEBLO", "PETEN", None]),
    ("T13", T.place_key, ["  Petén ", "San  José", None], ["PETEN", "SAN JOSE", ""]),
    ("T14", T.similarity_key, ["Col. San José, S.A."], ["COL SAN JOSE SA"]),
    ("T15", T.category_key, ["DIARIO(REGULAR)", "diario  regular"], ["DIARIO REGULAR"] * 2),
    ("T17", T.has_control_char, ["a\tb", f"a{ZW}", "ab"], [True, True, False]),
    ("P2", lambda c: P.matches_or_null(c, *DISTRICT_SHAPES), ["", None, "01-403\n"], [False, True, False]),
    ("P3", P.is_phone_list, ["55551234 / 23456789", "55551234/23456789", None, ""], [True, False, True, False]),
    ("P4", P.has_extra_space, [" a", "a ", "a  b", "a b", "a ", None, ""], [True, True, True, False, True, False, False]),
    ("P5", P.is_residual, ["...", "--ANA", "-ANA", "", "  ", "- . -", "a."], [True, True, False, False, False, True, False]),
    ("P12", P.has_lowercase, ["ABC", "aBC", "ÑÁ", "ñ", None], [False, True, False, True, False]),
    ("P13", P.is_odd_phone, ["55551234", "", "123", "n/a"], [False, False, True, False]),
    ("P14", P.is_nonblank, ["", " \t", "x", None], [False, False, True, False]),
]


@pytest.mark.parametrize("name,fn,values,expected", CASES, ids=[c[0] for c in CASES])
def test_scalar(spark, name, fn, values, expected):
    assert run(spark, fn, values, nfkc=name not in ("P4",)) == expected


def test_label_relation(spark):
    rows = [("GUATEMALA", "GUATEMALA NORTE"), ("QUICHE", "QUICHÉ"), ("QUICHE", "QUICHES"), (None, "X")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.x for r in df.select(P.label_fits_parent(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [True, True, False, True]


def test_number_rendering(spark):
    df = spark.createDataFrame([(90.625,), (95.0,), (97.95918367,)], "v double")
    assert [r.x for r in df.select(T.two_decimals(F.col("v")).alias("x")).collect()] == ["90.62", "95.00", "97.96"]


def test_cleaning_a_column_twice_changes_nothing(spark):
    values = [" Ñandú  x", "-- a", "ﬁ", "½", "null", f"a{ZW}b", " "]
    once = run(spark, T.clean_text, values)
    assert run(spark, T.clean_text, once) == once


def test_nfkc_keeps_nulls_in_mixed_rows(spark):
    df = spark.createDataFrame([("ﬁ", None), (None, "é"), ("a", "b")], "a string, b string")
    assert [tuple(r) for r in T.nfkc_columns(df, ["a", "b"]).collect()] == [("fi", None), (None, "é"), ("a", "b")]
