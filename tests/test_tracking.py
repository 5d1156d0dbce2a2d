"""Price periods, days compared, latest-wins merge and offers linked across retailers."""

import datetime as dt
import glob
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfscan.operators import history, linkage
from shelfscan.operators.history import compare_days, price_periods, store_day
from shelfscan.sources.merge import merge_latest, partition_filter

DAY = dt.date(2024, 1, 1)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def brute_periods(rows, max_gap):
    lowest = {}
    for s, p, at, price in rows:
        if at is not None:
            lowest.setdefault((s, p), {}).setdefault(at, []).append(price)
    out = []
    for (s, p), seen in lowest.items():
        runs = []
        for at in sorted(seen):
            price = min((x for x in seen[at] if x is not None), default=None)
            near = runs and (max_gap is None or at - runs[-1][2] <= dt.timedelta(days=max_gap))
            if near and runs[-1][0] == price:
                runs[-1][2], runs[-1][3] = at, runs[-1][3] + 1
            else:
                runs.append([price, at, at, 1])
        before = [None, *(r[0] for r in runs)]
        out += [(s, p, r[0], b, i == 0, *r[1:]) for i, (r, b) in enumerate(zip(runs, before))]
    return Counter(out)


@pytest.mark.parametrize("parts,max_gap", [(1, None), (3, 2), (25, 2), (40, None), (60, 0.5)])
def test_price_periods(spark, parts, max_gap):
    """A gap, a return to an old price, NULL prices, NULL ids and days, and a hot product."""
    rng = random.Random(parts)
    rows = []
    for product in ("a", "b", None, "hot"):
        for d in range(200 if product == "hot" else 40):
            for _ in range(rng.randrange(3)):
                price = rng.choice([1.0, 1.0, 1.0, 2.5, None]) if d % 30 > 9 else 4.0
                rows.append(("r1", product, DAY + dt.timedelta(days=d), price))
    rows += [("r2", "hot", DAY, None), ("r2", "a", None, 1.0), (None, "a", DAY, 2.0)]
    df = spark.createDataFrame(rows, "source string, product_id string, snapshot_date date, price double")
    got = price_periods(df, ["source", "product_id"], max_gap_days=max_gap, num_partitions=parts)
    assert got.columns == ["source", "product_id", "price", "prev_price", "is_first", "first_at",
                           "last_at", "n_seen"]
    assert bag(got) == brute_periods(rows, max_gap)


def test_periods_of_timestamps_over_many_batches(spark):
    """One product seen very often: its observations are dealt to all tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        seen = spark.range(60_000).select(
            F.lit("x").alias("product_id"), F.timestamp_seconds(F.col("id") * 60).alias("at"),
            F.floor(F.col("id") / 7000).cast("double").alias("price"))
        got = price_periods(seen, ["product_id"], "at", num_partitions=16).orderBy("first_at").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.price, r.prev_price, r.n_seen) for r in got] == [
        (float(i), i - 1.0 if i else None, 7000 if i < 8 else 4000) for i in range(9)]
    sizes = (seen.repartitionByRange(16, "product_id", "at").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 3 * 60_000 / 16


def test_periods_of_nothing(spark):
    df = spark.createDataFrame([], "product_id string, snapshot_date date, price double")
    assert price_periods(df, ["product_id"]).count() == 0


def test_only_border_runs_meet_in_one_window(spark, monkeypatch):
    seen = []
    settle = history._settle
    monkeypatch.setattr(history, "_settle", lambda e, k, g: seen.append(e.count()) or settle(e, k, g))
    df = spark.range(5000).select((F.col("id") % 50).alias("p"), F.timestamp_seconds("id").alias("at"),
                                  (F.col("id") % 7).cast("double").alias("price"))
    assert price_periods(df, ["p"], "at", num_partitions=10).count() == 5000 and seen[0] <= 20


# two days ------------------------------------------------------------------

KEYS = ["source", "product_id"]


@pytest.fixture
def stored_days(spark, tmp_path):
    schema = "source string, product_id string, price double"
    one = [("r1", "a", 1.0), ("r1", "a", 3.0), ("r1", "b", 2.0), ("r1", None, 5.0), (None, None, 1.0),
           ("r1", "c", None), ("r1", "d", None)]
    two = [("r1", "a", 1.0), ("r1", None, 6.0), ("r1", "c", None), ("r1", "d", 4.0), ("r2", "b", 2.0)]
    for name, rows in (("day_one", one), ("day_two", two)):
        store_day(spark.createDataFrame(rows, schema), name, str(tmp_path / name), KEYS, buckets=4)
    yield spark.table("day_one"), spark.table("day_two")
    for name in ("day_one", "day_two"):
        spark.sql(f"DROP TABLE {name}")


def test_days_compared(stored_days):
    assert bag(compare_days(*stored_days, KEYS)) == Counter([
        ("r1", "a", "same", 1.0, 1.0, 2, 1), ("r1", "b", "disappeared", 2.0, None, 1, 0),
        ("r1", None, "changed", 5.0, 6.0, 1, 1), (None, None, "disappeared", 1.0, None, 1, 0),
        ("r1", "c", "same", None, None, 1, 1), ("r1", "d", "changed", None, 4.0, 1, 1),
        ("r2", "b", "appeared", None, 2.0, 0, 1)])


def test_stored_days_meet_without_a_shuffle(spark, stored_days):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compare_days(*stored_days, KEYS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2


# merge -----------------------------------------------------------------------

SCHEMA = "source string, product_id string, day date, seen int, price double"


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def merge(df, path):
    merge_latest(df, path, ["source", "product_id", "day"], ["seen", "price"], ["source", "day"])


def test_merge_keeps_the_latest(spark, tmp_path):
    path, other = str(tmp_path / "t"), DAY + dt.timedelta(days=1)
    first = batch(spark, ("r1", "a", DAY, 3, 1.0), ("r1", "a", DAY, 2, 9.0), ("r1", None, DAY, 1, 1.0),
                  ("r2", "a", other, 1, 1.0), (None, "z", DAY, None, 1.0))
    late = batch(spark, ("r1", "a", DAY, 1, 7.0), ("r1", "b", DAY, 1, 2.0), ("r1", None, DAY, 2, None),
                 (None, "z", DAY, 0, None))
    merge(first, path)
    untouched = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/source=r2/*/*.parquet")}
    merge(late, path)
    want = {("r1", "a", DAY, 3, 1.0), ("r1", "b", DAY, 1, 2.0), ("r1", None, DAY, 2, None),
            ("r2", "a", other, 1, 1.0), (None, "z", DAY, 0, None)}
    rows = lambda: Counter(tuple(r) for r in spark.read.parquet(path).select(
        "source", "product_id", "day", "seen", "price").collect())
    assert rows() == Counter(want)
    assert untouched == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/source=r2/*/*.parquet")}
    for again in (first, late, first):          # replays change nothing
        merge(again, path)
        assert rows() == Counter(want)
    once = str(tmp_path / "once")
    merge(late.unionByName(first), once)
    assert Counter(tuple(r) for r in spark.read.parquet(once).select(
        "source", "product_id", "day", "seen", "price").collect()) == Counter(want)


def test_merge_reads_touched_directories_only(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [DAY + dt.timedelta(days=i) for i in range(6)]
    merge(batch(spark, *[(s, "a", d, 1, 1.0) for s in ("r1", "r2") for d in days]), path)
    cond = partition_filter(["source", "day"], [("r1", days[0]), ("r1", days[1]), (None, days[2])])
    df = spark.read.parquet(path).where(cond)
    assert len({r.f for r in df.select(F.input_file_name().alias("f")).collect()}) == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    with pytest.raises(ValueError):
        merge_latest(df, path, ["product_id"], ["seen"], ["source"])


# linkage ---------------------------------------------------------------------

def test_name_words(spark):
    names = ["Maçã Golden 1,5 kg", "GOLDEN, maca (6x25cl)", "", None, "2 x 500 g Arroz arroz"]
    got = [r.w for r in spark.createDataFrame([(n,) for n in names], "n string")
           .select(linkage.name_words("n").alias("w")).collect()]
    assert got == [["golden", "maca"], ["golden", "maca"], [], None, ["arroz"]]


def brute_links(classes, percent):
    out = set()
    for x in classes:
        for y in classes:
            if x.c < y.c and x.size_value == y.size_value and x.size_unit == y.size_unit:
                both = len(set(x.words) & set(y.words))
                if 100 * both >= percent * (len(x.words) + len(y.words) - both):
                    out.add((x.c, y.c))
    return out


@pytest.mark.parametrize("hot", [200, 3, 1])
def test_no_link_is_lost(spark, hot):
    rng = random.Random(4)
    common, rare = ["leite", "bio", "fresco"], [f"w{i}" for i in range(40)]
    rows = [("r%d" % rng.randrange(3), str(i),
             " ".join(rng.sample(common, rng.randrange(4)) + rng.sample(rare, rng.randrange(1, 5)))
             + rng.choice([" 500 g", " 1kg", ""]), 1.0) for i in range(300)]
    rows += [("r1", "x", "leite", 1.0), ("r2", "y", "leite", 1.0), ("r2", "z", "", 1.0), ("r2", "n", None, 1.0)]
    df = spark.createDataFrame(rows, "source string, product_id string, product_name string, price double")
    classes = linkage.product_classes(linkage.offers(df))
    got = bag(linkage.similar_classes(classes, 60, hot))
    assert set(got) == brute_links(classes.collect(), 60) and max(got.values()) == 1


def test_planted_matches_and_ties(spark):
    """Names in another order, case or with one word more are found, other products are not."""
    rng = random.Random(9)
    noise = ["bio"]
    rows, truth = [], {}
    for i in range(400):
        words = [f"marca{i % 20}", f"tipo{i % 7}", f"sabor{i}", f"linha{i % 11}"]
        for source in ("r1", "r2", "r3"):
            w = words + ([rng.choice(noise)] if rng.random() < 0.3 else [])
            rng.shuffle(w)
            rows.append((source, f"{source}-{i}", " ".join(w).upper() + " 250 g", float(rng.randrange(1, 9))))
            truth[source, i] = rows[-1]
    df = spark.createDataFrame(rows, "source string, product_id string, product_name string, price double")
    classes = linkage.product_classes(linkage.offers(df))
    links = linkage.similar_classes(classes)
    words = {r.c: set(r.words) for r in classes.collect()}
    flavour = lambda c: next(w for w in words[c] if w.startswith("sabor"))
    found = {(r.a, r.b) for r in links.collect()}
    planted = defaultdict(set)
    for c in words:
        planted[flavour(c)].add(c)
    true = {(a, b) for cs in planted.values() for a in cs for b in cs if a < b}
    assert len(found & true) >= 0.9 * len(true) and len(found & true) >= 0.9 * len(found)
    for r in linkage.cheapest_sources(df).collect():
        i = int(next(w for w in r.product.split() if w.startswith("sabor"))[5:])
        best = min((truth[s, i][3] / 250, s, f"{s}-{i}") for s in ("r1", "r2", "r3"))
        assert r.unit_price >= best[0]
        if r.n_sources == 3 and all(len(set(words[c])) == 4 for c in planted[f"sabor{i}"]):
            assert (r.unit_price, r.cheapest_source, r.cheapest_id) == best


def test_offers_without_a_price(spark):
    df = spark.createDataFrame([("r1", "a", "arroz 1 kg", None), ("r2", "b", "Arroz 1kg", 2.0),
                                ("r1", "c", "sal 1 kg", None)],
                               "source string, product_id string, product_name string, price double")
    got = {r.product: (r.n_sources, r.cheapest_source, r.unit_price) for r in linkage.cheapest_sources(df).collect()}
    assert got == {"arroz": (2, "r2", 0.002), "sal": (1, None, None)}
    assert linkage.cheapest_sources(df.limit(0)).count() == 0
