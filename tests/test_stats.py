"""Exact quantiles / describe against NumPy (linear interpolation)."""

import random

import numpy as np
import pytest

from shelfscan.operators.stats import describe, exact_quantiles, null_profile, row_counts


def test_global_quantiles_match_numpy(spark):
    rnd = random.Random(11)
    vals = [round(rnd.uniform(0, 100), 2) for _ in range(5001)] + [None] * 7
    vals += [42.0] * 2000            # one hot value holding a large share
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", (0.1, 0.25, 0.5, 0.75, 0.9)).first()
    arr = np.array([v for v in vals if v is not None])
    for p, c in [(0.1, "q10"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (0.9, "q90")]:
        assert got[c] == pytest.approx(np.percentile(arr, p * 100), abs=1e-9)


def test_grouped_describe_with_skew(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        rows.append((g, rnd.choice([None, float(rnd.randint(0, 300)) / 4])))
    rows.append(("only_null", None))
    rows.append(("single", 7.0))
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in describe(df, "x", ["g"]).collect()}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    for g, xs in groups.items():
        arr = np.array([x for x in xs if x is not None])
        r = got[g]
        assert r["count"] == len(arr)
        if len(arr) == 0:
            assert r["mean"] is None and r["q50"] is None
            continue
        assert r["mean"] == pytest.approx(arr.mean())
        assert r["min"] == arr.min() and r["max"] == arr.max()
        for p in (25, 50, 75):
            assert r[f"q{p}"] == pytest.approx(np.percentile(arr, p), abs=1e-9)
        if len(arr) > 1:
            assert r["std"] == pytest.approx(arr.std(ddof=1))
        else:
            assert r["std"] is None


def test_describe_goldens(spark):
    """Quartiles of a known price list (sample std, linear interpolation)."""
    prices = [0.95, 0.99, 1.69, 2.79, 4.29, 69.90, 3.29]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    r = describe(df, "price").first()
    arr = np.array(prices)
    assert r["count"] == 7
    assert r["q25"] == pytest.approx(np.percentile(arr, 25))
    assert r["q75"] == pytest.approx(np.percentile(arr, 75))
    assert r["std"] == pytest.approx(arr.std(ddof=1))


def test_null_profile_and_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, None, None)],
                               "id long, s string, t string")
    got = {r.column_name: (r.n_null, r.n_rows) for r in null_profile(df).collect()}
    assert got == {"id": (0, 3), "s": (2, 3), "t": (2, 3)}
    rc = {r.t: r.n_rows for r in row_counts(df, ["t"]).collect()}
    assert rc == {"a": 1, None: 2}


@pytest.mark.parametrize("parts", ["1", "60"])
def test_describe_is_the_same_at_any_partitioning(spark, parts):
    """Slices of a hot group on one task and on many; results match NumPy."""
    rnd = random.Random(21)
    rows = [("hot", rnd.randint(0, 900) / 4) for _ in range(2400)]
    rows += [(None, rnd.randint(0, 90) / 2) for _ in range(120)]
    rows += [(f"s{i % 30}", float(rnd.randint(0, 99))) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double")
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], parts)
    spark.conf.set(keys[1], "false")
    try:
        got = {r.g: r for r in describe(df, "x", ["g"]).collect()}
        whole = describe(df, "x").first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        arr = np.array(xs)
        assert got[g]["count"] == len(arr)
        assert got[g]["std"] == pytest.approx(arr.std(ddof=1))
        for p in (25, 50, 75):
            assert got[g][f"q{p}"] == pytest.approx(np.percentile(arr, p), abs=1e-9)
    arr = np.array([x for _, x in rows])
    assert whole["q50"] == np.percentile(arr, 50) and whole["mean"] == pytest.approx(arr.mean())


def test_describe_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "x double")
    r = describe(empty, "x").first()
    assert r["count"] == 0 and r["mean"] is None and r["q50"] is None
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a")], "count double, mean string")
    r = describe(df, "count", ["mean"]).first()
    assert r["count"] == 2 and r["q50"] == 2.0


def test_describe_reads_its_input_once(spark):
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    df = spark.range(2000).selectExpr("id % 3 g", "cast(id % 50 as double) x")
    describe(df.mapInArrow(count, df.schema).repartition(4), "x", ["g"]).collect()
    assert acc.value == 2000


def test_null_profile_from_parquet_footers(spark):
    """On a bare Parquet table with the V2 reader and aggregate pushdown, the
    whole profile is answered from footers (no column data is read)."""
    from tests.conftest import SF_SMALL
    keys = ["spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    try:
        d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
        prof = null_profile(d)
        plan = prof._jdf.queryExecution().executedPlan().toString()
        got = {r.column_name: (r.n_null, r.n_rows) for r in prof.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "PushedAggregation" in plan
    n = d.count()
    assert got["text"] == (d.where("text is null").count(), n)
