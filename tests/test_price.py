"""Locale price parsing goldens (the ten documented cases + guard cases)."""

import math

from pyspark.sql import functions as F

from shelfscan.functions.price import parse_price, strip_text

CASES = [
    ("0,95€ / UN", 0.95),
    ("2,99€/kg", 2.99),
    ("3.5", 3.5),
    ("1.234.567", None),
    ("", None),
    (None, None),
    ("1.234,56€", 1234.56),
    ("1.234", 1.234),          # dot alone is a decimal mark
    ("1,234.56", 1.23456),     # US form is misread, on purpose
    ("1,234,567", None),       # becomes 1.234.567
    ("12€ - 15€", None),
    # decided differences from Python float(): these are NULL, never NaN/inf
    ("nan", None), ("inf", None), ("1_000", None), ("1.5d", None), ("2f", None),
    (" 4,50€ ", 4.5),  # NBSP stripped like str.strip()
    (".5", 0.5), ("1.", 1.0), ("-2,5", -2.5), ("1e3", 1000.0),
]


def test_price_goldens(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.p for r in df.select("i", parse_price("s").alias("p")).collect()}
    for i, (s, want) in enumerate(CASES):
        if want is None:
            assert got[i] is None, (s, got[i])
        else:
            assert math.isclose(got[i], want, rel_tol=0, abs_tol=1e-12), (s, got[i])


def test_numeric_input_rendered_as_text(spark):
    df = spark.createDataFrame([(3.5,), (None,)], "x double")
    assert [r.p for r in df.select(parse_price("x").alias("p")).collect()] == [3.5, None]


def test_strip_matches_python(spark):
    samples = [" a ", "\t\nb ", " c　", "d"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.t for r in df.select(strip_text("s").alias("t")).collect()]
    assert got == [s.strip() for s in samples]
