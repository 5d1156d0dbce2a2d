"""What a listing should hold: counters with thousands marks, expected pages, missing ranges."""

from collections import Counter

import pytest

from shelfscan.functions.text import max_digit_run, max_grouped_number
from shelfscan.operators import extract as X
from shelfscan.operators.ordering import expected_pages
from shelfscan.operators.report import completeness_audit, last_pages, missing_pages

HUGE = 99999999999


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("text,grouped,run", [
    ("216 de 1.234", 1234, 234), ("12 345 produtos", 12345, 345), ("1 234 567", 1234567, 567),
    ("24 de 24", 24, 24), ("1.2345", 2345, 2345), ("1.234.56 x", 1234, 234), ("nada", None, None), (None, None, None),
    ("99999999999999999999", None, None), ("7 de 0", 7, 7)])
def test_grouped_numbers(spark, text, grouped, run):
    df = spark.createDataFrame([(text,)], "t string").select(
        max_grouped_number("t").alias("g"), max_digit_run("t").alias("r"))
    assert tuple(df.first()) == (grouped, run)


def page(n_tiles, counter="", pager=()):
    head = f'<div class="search-results-products-counter d-flex justify-content-center">{counter}</div>' if counter else ""
    nodes = "".join(f'<div class="page js-change-page" data-page="{p}">{p}</div>' for p in pager)
    return head + nodes + '<div class="product" data-pid="1"></div>' * n_tiles


@pytest.fixture
def audited(spark):
    rows = [("marked", 0, page(2, "2 de 1.234")), ("marked", 2, page(2)),
            ("exact", 0, page(2, "2 de 3")), ("exact", 2, page(1)),
            ("surplus", 0, page(2, "2 de 3")), ("surplus", 2, page(2)),
            ("huge", 0, page(2, pager=["1", "2", HUGE])), ("huge", 2, page(1)),
            ("paged", 0, page(2, pager=["1", "2"])), ("paged", 2, page(2)),
            ("short", 0, page(2)), ("short", 2, page(1)), ("open", 0, page(2))]
    pages = spark.createDataFrame(rows, "category string, page_start int, html string")
    return pages, X.explode_tiles(pages, "tile_attr", keys=["category", "page_start"])


def test_complete_only_without_missing_rows(audited):
    got = {r.category: (r.missing_rows, r.complete) for r in completeness_audit(
        *audited, ["category"], "page_start", 2).collect()}
    assert got == {"marked": (1230, False), "exact": (0, True), "surplus": (-1, False), "huge": (None, False),
                   "paged": (None, True), "short": (None, True), "open": (None, False)}


def test_last_pages_by_all_three_rules(audited):
    pages, tiles = audited
    numbered = [df.selectExpr("*", "page_start div 2 + 1 AS page_no") for df in (pages, tiles)]
    got = {r.category: r.last_page for r in last_pages(*numbered, ["category"], "page_no", 2).collect()}
    assert got == {"marked": 617, "exact": 2, "surplus": 2, "huge": HUGE, "paged": 2, "short": 2, "open": None}


def test_expected_pages(spark):
    df = spark.createDataFrame([("none", None), ("zero", 0), ("minus", -4), ("one", 1), ("many", 2500),
                                ("huge", HUGE)], "category string, last_page long")
    rows = expected_pages(df).collect()
    pages = {}
    for r in rows:
        pages.setdefault(r.category, []).append((r.page_no, r.page_error))
    assert set(pages) == {"none", "one", "many", "huge"}
    assert pages["none"] == pages["one"] == [(1, None)]
    assert sorted(pages["many"]) == [(i, None) for i in range(1, 2501)]
    assert pages["huge"] == [(None, f"pager: last page {HUGE}")]
    assert expected_pages(df, max_pages=2499).where("page_error is not null").count() == 2


def test_missing_ranges(spark):
    landed = [("a", 1), ("a", 2), ("a", 5), ("a", 5), ("a", 9), ("b", 3), ("c", 1), ("c", 2), ("d", 2), ("d", 4),
              ("e", 7), ("f", None), ("f", 0), ("f", -2), (None, 2), ("g", 1)]
    last = [("a", 10), ("b", HUGE), ("c", 2), ("d", None), ("e", 3), ("f", 2), (None, 2), ("h", 4), ("g", 0)]
    df = spark.createDataFrame(landed, "k string, page_no int")
    ends = spark.createDataFrame(last, "k string, last_page long")
    assert bag(missing_pages(df, ["k"], last=ends)) == Counter([
        ("a", 3, 4), ("a", 6, 8), ("a", 10, 10), ("b", 1, 2), ("b", 4, HUGE), ("d", 1, 1), ("d", 3, 3),
        ("d", 5, None), ("e", 1, 3), ("f", 1, 2), (None, 1, 1), ("h", 1, 4)])
    assert bag(missing_pages(df.where("k = 'a'"), ["k"])) == Counter([
        ("a", 3, 4), ("a", 6, 8), ("a", 10, None)])
    assert missing_pages(df.limit(0), ["k"]).count() == 0
