"""Goldens of FIXTURES.md §4 and properties of the scalar functions."""

import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sectorpulse.functions import (axis_bound, compose_key, date_br, format_int_br, format_variation,
                                   lenient_short, normalize_name, normalize_name_udf, parse_capital,
                                   parse_registry_date, truncate_label)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def _definition(s):
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().strip().upper()


def test_normalize_name_goldens(spark):
    rows = [(" São Sebastião do Caí ",), ("Gravataí",), ("½ß",), (None,)]
    want = ["SAO SEBASTIAO DO CAI", "GRAVATAI", "12", None]
    assert _one(spark, rows, "x string", normalize_name("x")) == want
    assert _one(spark, rows, "x string", normalize_name_udf("x")) == want


def test_normalize_name_all_latin1_code_points(spark):
    texts = [f"a{chr(cp)}b" for cp in range(256)] + [chr(cp) for cp in range(256)] + \
            [f" {chr(cp)} " for cp in range(256)]
    rows = [(t,) for t in texts]
    got = _one(spark, rows, "x string", normalize_name("x"))
    assert got == [_definition(t) for t in texts]


def test_normalize_name_udf_beyond_latin1(spark):
    texts = ["ﬁlé", "Ōsaka…", "ﬀ  ", "Straße", "Ĳssel"]
    got = _one(spark, [(t,) for t in texts], "x string", normalize_name_udf("x"))
    assert got == [_definition(t) for t in texts]


def test_parse_registry_date(spark):
    rows = [("20240229",), ("20240231",), ("00000000",), ("0",), ("2024013",), ("",), (None,)]
    got = _one(spark, rows, "x string", parse_registry_date("x"))
    assert [str(g) if g else None for g in got] == ["2024-02-29", None, None, None, None, None, None]


def test_lenient_short(spark):
    got = _one(spark, [("02",), ("",), ("x",), ("2.0",)], "x string", lenient_short("x"))
    assert got == [2, None, None, None]


def test_parse_capital(spark):
    got = _one(spark, [("1000,00",), ("1,2,3",), ("1.234,56",), ("",)], "x string", parse_capital("x"))
    assert got == [Decimal("1000.00"), None, None, None]


def test_compose_key(spark):
    rows = [("12345678", "0001", "95"), ("12345678", None, "95")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert [r[0] for r in df.select(compose_key("a", "b", "c")).collect()] == ["12345678000195", None]


def test_truncate_label(spark):
    got = _one(spark, [("abcde",), ("abcdef",), (None,)], "x string", truncate_label("x", 5))
    assert got == ["abcde", "abcd…", None]


@pytest.mark.parametrize("value,text", [
    ("12.34", "+12,3%"), ("1234.5", "+1.234,5%"), ("0", "0,0%"), ("0.25", "+0,3%"),
    ("-7.05", "-7,1%"), ("0.04", "+0,0%"), ("-0.04", "-0,0%"), (None, "—")])
def test_format_variation(spark, value, text):
    v = Decimal(value) if value is not None else None
    got = _one(spark, [(v,)], "v decimal(6,2)", format_variation("v"))
    assert got == [text]


def test_format_int_and_date(spark):
    df = spark.createDataFrame([(1234567, "2024-03-05")], "n long, d string")
    r = df.select(format_int_br("n"), date_br(F.to_date("d"))).first()
    assert tuple(r) == ("1.234.567", "05/03/2024")


@pytest.mark.parametrize("values,bound", [([], 2), ([Decimal("0.5")], 2),
                                          ([Decimal("-200"), Decimal("100")], 230)])
def test_axis_bound(spark, values, bound):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(6,2)")
    assert df.agg(axis_bound("v")).first()[0] == bound
