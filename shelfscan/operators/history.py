"""Prices over time: unchanged periods, and what came and went between two days.

``price_periods`` compares each observation of a product with the one before it.  A window
partitioned by product would put all observations of one product into one task, however many
there are; here the observations are sorted by (product, time) in ranges, runs of equal prices are
found inside each task in one streaming pass, and only the first and last run of a task are
compared with those of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .ordering import changes, materialize


def observations(rows: DataFrame, keys: list[str], at: str, price: str) -> DataFrame:
    """One row per key and time: the lowest price given then, NULL if there is none.
    Repeated listings are combined before the shuffle."""
    return rows.groupBy(*keys, at).agg(F.min(price).alias(price))


def price_periods(rows: DataFrame, keys: list[str], at: str = "snapshot_date",
                  price: str = "price", max_gap_days: float | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """One row per period in which a product's price did not change.

    ``keys, price, prev_price, is_first, first_at, last_at, n_seen``: the price (NULL where none
    was given, which is a period like any other), that of the product's period before, whether
    there is none before, the first and last observation and their number.  ``at`` is a date
    or a timestamp.  Two observations more than ``max_gap_days`` apart belong to different
    periods, even at one price; without it a gap does not end a period.  A return to an old price
    is a new period.  NULL keys are a product like any other; rows without ``at`` are left out.
    """
    ship_package(rows.sparkSession)
    seen = observations(rows.where(F.col(at).isNotNull()), keys, at, price)
    order = [F.col(k) for k in keys] + [F.col(at)]
    ranged = seen.repartitionByRange(num_partitions, *order) if num_partitions \
        else seen.repartitionByRange(*order)
    fields = {f.name: f.dataType for f in seen.schema.fields}
    out = T.StructType(
        [T.StructField(k, fields[k]) for k in keys]
        + [T.StructField("price", fields[price]), T.StructField("prev_price", fields[price]),
           T.StructField("is_first", T.BooleanType()), T.StructField("first_at", fields[at]),
           T.StructField("last_at", fields[at]), T.StructField("n_seen", T.LongType()),
           T.StructField("_place", T.IntegerType())])
    runs = materialize(ranged.sortWithinPartitions(*order)
                       .mapInArrow(_runs(keys, at, price, _microseconds(max_gap_days)), out)
                       .withColumn("_task", F.spark_partition_id()))
    inner = runs.where(F.col("_place") == INNER).drop("_place", "_task")
    return inner.unionByName(_settle(runs.where(F.col("_place") != INNER), keys, max_gap_days))


INNER, FIRST, LAST, ONLY = 0, 1, 2, 3       # where in its task a run stands


def _microseconds(days: float | None) -> int | None:
    return None if days is None else int(days * 86_400_000_000)


def _far(days: float | None, later: Column, earlier: Column) -> Column:
    if days is None:
        return F.lit(False)
    at = [F.unix_micros(c.cast("timestamp")) for c in (later, earlier)]
    return at[0] - at[1] > _microseconds(days)


def _settle(edges: DataFrame, keys: list[str], max_gap_days: float | None) -> DataFrame:
    """The first and last runs of all tasks, at most two a task: those that go on in the next task
    become one period, and a product's first run in a task learns the price before it."""
    w = Window.partitionBy(*keys).orderBy("first_at", "_task")
    before = edges.withColumns({
        "_other": F.lag("_task").over(w).isNotNull() & (F.lag("_task").over(w) != F.col("_task")),
        "_price": F.lag("price").over(w), "_last": F.lag("last_at").over(w)})
    goes_on = (F.col("_other") & F.col("price").eqNullSafe(F.col("_price"))
               & ~_far(max_gap_days, F.col("first_at"), F.col("_last")))
    learnt = before.withColumns({
        "prev_price": F.when(F.col("_other") & F.col("is_first"), F.col("_price"))
                       .otherwise(F.col("prev_price")),
        "is_first": F.col("is_first") & ~F.col("_other"), "_new": (~goes_on).cast("int")})
    numbered = learnt.withColumn("_run", F.sum("_new").over(w))
    head = F.struct("first_at", "_task")
    return numbered.groupBy(*keys, "_run").agg(
        F.first("price").alias("price"), F.min_by("prev_price", head).alias("prev_price"),
        F.min_by("is_first", head).alias("is_first"), F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"), F.sum("n_seen").alias("n_seen")).drop("_run")


def _runs(keys: list[str], at: str, price: str, gap: int | None):
    """Arrow pass over one sorted task: its runs of equal key and price.  ``is_first`` means first
    of its product in this task."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = [*keys, "price", "prev_price", "is_first", "first_at", "last_at", "n_seen", "_place"]
        held = None         # the last run so far, as a one-row table: it may go on
        made = 0            # runs given out

        def give(table, place_of_last):
            nonlocal made
            n = table.num_rows
            place = np.zeros(n, np.int32)
            if n:
                place[0] = FIRST if made == 0 else INNER
                if place_of_last:
                    place[-1] = ONLY if made == 0 and n == 1 else LAST
            made += n
            table = table.append_column("_place", pa.array(place, pa.int32()))
            return table.select(names).combine_chunks().to_batches()

        for b in batches:
            if b.num_rows == 0:
                continue
            new_key, new_price = changes(b, keys), changes(b, [price])
            if gap is not None:
                days = b.column(at).cast(pa.timestamp("us")).to_numpy(zero_copy_only=False)
                new_price[1:] |= np.diff(days).astype(np.int64) > gap
            start = np.flatnonzero(new_key | new_price)
            end = np.r_[start[1:], b.num_rows] - 1
            first = new_key[start]
            prices = b.column(price).take(pa.array(start))
            prior = pa.array(np.where(first, -1, start - 1))
            prev = b.column(price).take(pa.compute.if_else(pa.compute.less(prior, 0),
                                                           pa.scalar(None, prior.type), prior))
            t = pa.table([*(b.column(k).take(pa.array(start)) for k in keys), prices, prev,
                          pa.array(first), b.column(at).take(pa.array(start)),
                          b.column(at).take(pa.array(end)), pa.array(end - start + 1)],
                         names=names[:-1])
            if held is not None:
                both = pa.concat_tables([held, t.slice(0, 1)]).combine_chunks().to_batches()[0]
                if not changes(both, keys)[1]:
                    row = t.slice(0, 1).to_pylist()[0]
                    last = held.to_pylist()[0]
                    row["is_first"], row["prev_price"] = False, last["price"]
                    far = gap is not None and _between(last["last_at"], row["first_at"]) > gap
                    if not changes(both, ["price"])[1] and not far:
                        row |= {k: last[k] for k in ("first_at", "is_first", "prev_price")}
                        row["n_seen"] += last["n_seen"]
                        held = None
                    t = pa.concat_tables([pa.Table.from_pylist([row], t.schema), t.slice(1)])
                if held is not None:
                    yield from give(held, False)
            if t.num_rows > 1:
                yield from give(t.slice(0, t.num_rows - 1), False)
            held = t.slice(t.num_rows - 1)
        if held is not None:
            yield from give(held, True)

    return run


def _between(earlier, later) -> int:
    """Microseconds between two dates or timestamps."""
    d = later - earlier
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


# Two days ---------------------------------------------------------------------

DAY_KEY = "day_key"     # what a stored day is bucketed by: a hash of the keys, never NULL


def store_day(rows: DataFrame, table: str, path: str, keys: list[str], price: str = "price",
              buckets: int = 8) -> None:
    """Store one day's listings as ``table`` at ``path``: one row per product with its lowest
    price and number of listings, bucketed and sorted by a hash of the keys.  Days stored with
    the same number of buckets are compared without a shuffle.  ``buckets`` is the number of tasks that
    compare: about one per 100 MB of a day."""
    day = rows.groupBy(*keys).agg(F.min(price).alias("price"), F.count(F.lit(1)).alias("n_listings"))
    (day.withColumn(DAY_KEY, F.xxhash64(*keys)).repartition(buckets, DAY_KEY)
        .write.mode("overwrite").option("path", path).format("parquet")
        .bucketBy(buckets, DAY_KEY).sortBy(DAY_KEY).saveAsTable(table))


def compare_days(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, status, price_before, price_after, n_before, n_after`` for every product of two
    stored days: ``appeared``, ``disappeared``, ``changed`` or ``same`` (NULL prices compare as
    equal).  NULL keys match NULL keys.  Every product is one row on either side, so no key is hot."""
    a, b = before.alias("a"), after.alias("b")
    same = F.col(f"a.{DAY_KEY}") == F.col(f"b.{DAY_KEY}")
    for k in keys:      # spelled out: a null-safe equality would become a join key, and shuffle
        x, y = F.col(f"a.{k}"), F.col(f"b.{k}")
        same &= F.coalesce(x == y, x.isNull() & y.isNull())
    gone, new = F.col("b.n_listings").isNull(), F.col("a.n_listings").isNull()
    status = (F.when(new, F.lit("appeared")).when(gone, F.lit("disappeared"))
              .when(F.col("a.price").eqNullSafe(F.col("b.price")), F.lit("same"))
              .otherwise(F.lit("changed")))
    return a.join(b, same, "full").select(
        *[F.when(new, F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in keys],
        status.alias("status"), F.col("a.price").alias("price_before"),
        F.col("b.price").alias("price_after"),
        F.coalesce("a.n_listings", F.lit(0)).alias("n_before"),
        F.coalesce("b.n_listings", F.lit(0)).alias("n_after"))
