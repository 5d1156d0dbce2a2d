"""Shape of optimized plans: what is searched once, pushed or pruned."""

import pytest

import __spark_entry__ as E
from shelfscan.functions.text import parse_stamp
from tests.conftest import SF_SMALL


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("name,most", [("price_parse", 1), ("drop_missing", 2), ("min_price_filter", 2)])
def test_price_text_is_searched_once_per_operator(spark, name, most):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert p.count("regexp_") <= most


@pytest.mark.parametrize("name,most", [("qty_weight", 4), ("parse_quantity", 20), ("price_per_unit", 20)])
def test_each_pattern_searches_the_name_once(spark, name, most):
    """One search per pattern, and one per group over the short match."""
    assert plan(E.queries()[name](spark, SF_SMALL)).count("regexp_extract(") <= most


def test_price_filter_reaches_the_scan(spark):
    p = plan(E.queries()["min_price_pushed"](spark, SF_SMALL), "executedPlan")
    assert "GreaterThanOrEqual(p_retailprice,950.0)" in p


def test_category_list_prunes_directories(spark):
    p = plan(E.queries()["category_pruned"](spark, SF_SMALL), "executedPlan")
    assert "PartitionFilters: [category" in p and "IN (small,promo)" in p


def test_stamp_keeps_the_wall_clock_in_a_clock_change(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("20240310_023000",), ("20241301_000000",), ("20240310_250000",),
                                    ("20240310",), (None,)], "s string")
        got = [r.t for r in df.select(parse_stamp("s").cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-03-10 02:30:00", None, None, None, None]
