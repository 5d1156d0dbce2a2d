"""Distributed row index / ranks / paging against a brute-force sort, with a
hot group holding a third of the rows and ties."""

import random

import pytest
from pyspark.sql import functions as F

from shelfscan.operators import ordering
from shelfscan.operators.ordering import (cheapest_first, expected_pages, page_numbers,
                                          page_slice, with_row_index)


def _data(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"
        rows.append((i, g, float(rnd.randint(0, 50))))   # many price ties
    return rows


def test_global_index_dense_and_ordered(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "id long, grp string, price double")
    out = with_row_index(df, ["price", "id"], None, "rn").collect()
    got = {r.id: r.rn for r in out}
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert got == want


def test_grouped_index_with_hot_group(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "id long, grp string, price double")
    out = with_row_index(df, [F.col("price").desc(), F.col("id").asc()], ["grp"], "rn",
                         num_partitions=7).collect()
    got = {r.id: r.rn for r in out}
    want = {}
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for g, rs in groups.items():
        for i, r in enumerate(sorted(rs, key=lambda r: (-r[2], r[0]))):
            want[r[0]] = i
    assert got == want


def test_null_group_keys(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 1.0), (3, "a", 1.0)],
                               "id long, grp string, price double")
    got = {r.id: r.rn for r in with_row_index(df, ["price"], ["grp"], "rn").collect()}
    assert got == {2: 0, 1: 1, 3: 0}


def test_cheapest_first_nulls_last(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", 2.0), ("a", "z", 1.0)],
                               "category string, product_id string, price double")
    got = {r.product_id: r.price_rank for r in cheapest_first(df, partition_by=["category"]).collect()}
    assert got == {"z": 0, "y": 1, "x": 2}


def test_page_numbers_and_slice(spark):
    rows = [(i, float(i % 17)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, price double")
    pn = page_numbers(df, 212, ["price", "id"]).collect()
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = {r[0]: (i // 212, i % 212) for i, r in enumerate(order)}
    assert {r.id: (r.page_no, r.pos_in_page) for r in pn} == want
    sl = page_slice(df, 212, 212, ["price", "id"]).collect()
    assert [r.id for r in sl] == [r[0] for r in order[212:424]]


def test_expected_pages(spark):
    df = spark.createDataFrame([("a", 3), ("b", None)], "category string, last_page long")
    got = sorted((r.category, r.page_no) for r in expected_pages(df).collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_many_groups_path_matches(spark):
    """The index comes from per-task runs plus the offsets of groups that cross task borders; same answer as brute force."""
    rng = random.Random(17)
    rows = []
    for i in range(4000):
        g = "hot" if i % 3 == 0 else (None if i % 97 == 0 else f"g{rng.randint(0, 300)}")
        rows.append((i, g, float(rng.randint(0, 20))))
    df = spark.createDataFrame(rows, "id long, grp string, price double")
    out = with_row_index(df, ["price", "id"], ["grp"], "rn", num_partitions=9).collect()
    got = {r.id: r.rn for r in out}
    want, groups = {}, {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for g, rs in groups.items():
        for i, r in enumerate(sorted(rs, key=lambda r: (r[2], r[0]))):
            want[r[0]] = i
    assert got == want


def test_many_groups_path_multi_key_small_batches(spark):
    rng = random.Random(23)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), float(rng.randint(0, 9)))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, g1 string, g2 int, price double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")   # runs cross batches
    try:
        out = with_row_index(df, ["price", "id"], ["g1", "g2"], "rn", num_partitions=5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got = {r.id: r.rn for r in out}
    want, groups = {}, {}
    for r in rows:
        groups.setdefault((r[1], r[2]), []).append(r)
    for rs in groups.values():
        for i, r in enumerate(sorted(rs, key=lambda r: (r[3], r[0]))):
            want[r[0]] = i
    assert got == want


def test_many_groups_path_nan_and_null_double_keys(spark):
    rows = [(i, [float("nan"), None, 1.5][i % 3], float(i % 11)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g double, price double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        out = with_row_index(df, ["price", "id"], ["g"], "rn", num_partitions=3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got = {r.id: r.rn for r in out}
    want = {}
    for k in range(3):
        rs = sorted((r for r in rows if r[0] % 3 == k), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(rs):
            want[r[0]] = i
    assert got == want


def _task_rows(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_tied_keys_spread_over_tasks(spark):
    """A third of all keys missing: the largest task stays near the mean."""
    df = spark.range(30000).selectExpr("id", "if(id % 3 = 0, null, cast(id as double)) price")
    out = with_row_index(df, ["price"], None, "rn", num_partitions=6)
    sizes = _task_rows(out)
    assert sorted(r.rn for r in out.select("rn").collect()) == list(range(30000))
    assert max(sizes) < 1.6 * 30000 / len(sizes)


@pytest.mark.parametrize("rows_of_a_key", [10_000, 500])
def test_a_third_of_the_rows_equal(spark, rows_of_a_key):
    """Equal rows are numbered one after the other and come from many tasks, none of which has them all."""
    rows = [(None, None, "R1")] * 6000 + [(f"n{i}", float(i % 40), "R2") for i in range(12_000)]
    df = spark.createDataFrame(rows, "name string, price double, source string").repartition(6)
    out = with_row_index(df, [F.col("name").asc_nulls_last(), "price"], ["source"], "rn",
                         rows_of_a_key=rows_of_a_key)
    got = out.collect()
    assert sorted(r.rn for r in got if r.source == "R1") == list(range(6000))
    assert sorted(r.rn for r in got if r.source == "R2") == list(range(12_000))
    assert sum(r.name is None and r.price is None for r in got) == 6000
    if rows_of_a_key == 500:
        equal = out.where("name is null")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert max(_task_rows(equal)) < 6000 * 0.6
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_only_keys_are_checkpointed(spark, monkeypatch):
    """The rows are not copied to the checkpoint folder, and cross one exchange."""
    seen = []
    keep = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df: seen.append(df.columns) or keep(df))
    df = spark.range(500).selectExpr("id % 7 AS g", "id AS x", "repeat('wide ', 50) AS wide")
    out = with_row_index(df, ["x"], ["g"], "rn")
    assert out.count() == 500 and seen == [["g", "_h1", "_h2", "_m", "_pid"]]


def test_index_evaluates_its_input_for_keys_and_for_rows(spark):
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    df = spark.range(3000).selectExpr("id % 5 AS g", "id AS x")
    out = with_row_index(df.mapInArrow(count, df.schema), ["x"], ["g"], "rn")
    assert out.count() == 3000 and acc.value == 6000


def test_a_page_of_a_stored_listing(spark, tmp_path):
    """Pages equal slices of the sorted rows; a deep one reads only its directories."""
    path = str(tmp_path / "listing")
    rows = [(i, float((i * 37) % 101) if i % 9 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, price double")
    ordering.store_ordered(df, path, [F.col("price").asc_nulls_last(), "id"], rows_per_block=64)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    stored = spark.read.parquet(path)
    for start, size in ((0, 10), (60, 10), (640, 130), (995, 50), (2000, 5)):
        got = ordering.stored_page(stored, start, size, 64).collect()
        assert [(r.id, r.price) for r in got] == want[start:start + size]
        assert [r.row_index for r in got] == list(range(start, min(start + size, 1000)))
    page = ordering.stored_page(stored, 700, 10, 64)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "row_index" in plan.split("PushedFilters")[1]
    files = stored.where("block = 10").select(F.input_file_name()).distinct().count()
    assert files == 1 and len({r[0] for r in stored.select("block").distinct().collect()}) == 16
