"""Registered queries on prices over time and across retailers, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import compare_days, price_periods, store_day
from ..operators.linkage import PERCENT, cheapest_sources
from ..operators.ordering import store_ordered, stored_page
from ..operators.report import log_runs, parse_log_lines
from ..session import scratch_path
from ..sources.merge import merge_latest
from ..sources.sinks import write_measured
from . import driver_inputs as D

MAX_GAP_DAYS = 60
LOG_GAP = "20 minutes"


def q_price_periods(spark, sf):
    return price_periods(D.price_observations(spark, sf), ["source", "product_id"], "snapshot_date",
                         "price", MAX_GAP_DAYS)


def _stored_day(spark, rows: DataFrame):
    path = scratch_path(spark, "day")
    table = path.rpartition("/")[2].replace("-", "_")
    store_day(rows, table, path, ["source", "product_id"])
    return spark.table(table)


def q_day_changes(spark, sf):
    before, after = (_stored_day(spark, d) for d in D.two_days(spark, sf))
    return compare_days(before, after, ["source", "product_id"])


def q_latest_per_day(spark, sf):
    """Observations land in batches, late ones among them; the first batch lands twice."""
    rows, path = D.dated_observations(spark, sf), scratch_path(spark, "latest")
    keys, parts = ["source", "product_id", "snapshot_date"], ["source", "snapshot_date"]
    order = ["observed_at", "price", "listing"]
    for batch in (0, 1, 2, 0):
        merge_latest(rows.where(F.col("batch") == batch).drop("batch"), path, keys, order, parts)
    return spark.read.parquet(path).select(*keys, *order)


def q_cheapest_source(spark, sf):
    return cheapest_sources(D.retailer_offers(spark, sf))


def q_log_runs(spark, sf):
    """Runs of three crawlers that log into one file, several a day."""
    log = parse_log_lines(D.log_lines(spark, sf)).withColumn("crawler", F.col("line") % 3)
    return log_runs(log, LOG_GAP, ["crawler"]).select(
        "crawler", F.date_format("run_start", "yyyy-MM-dd HH:mm:ss.SSS").alias("run_start"), "elapsed_s",
        "n_records", "n_errors")


DEEP_PAGE = 40          # of pages of a hundredth of the table


def q_stored_page(spark, sf):
    """A deep page of the price list, from a table stored in that order."""
    orders, path = D.table(spark, sf, "orders"), scratch_path(spark, "ordered")
    rows = orders.select("o_orderkey", F.round("o_totalprice", -3).alias("price"))
    size = max(1, rows.count() // 100)
    store_ordered(rows, path, [F.col("price").asc_nulls_last(), "o_orderkey"], rows_per_block=size * 3)
    return stored_page(spark.read.parquet(path), DEEP_PAGE * size, size, size * 3)


def q_write_metrics(spark, sf):
    """Metrics taken while a snapshot is written."""
    part = D.product_snapshot_rows(spark, sf)
    rows = part.withColumn("price", F.when(F.col("product_id").cast("int") % 6 != 0, F.col("price")))
    got = write_measured(rows, scratch_path(spark, "measured"), columns=["product_id", "price", "category"])
    return spark.createDataFrame([(k, v) for k, v in got.items()], "metric string, value bigint")


QUERIES = {
    "price_periods": q_price_periods,
    "day_changes": q_day_changes,
    "latest_per_day": q_latest_per_day,
    "cheapest_source": q_cheapest_source,
    "log_runs": q_log_runs,
    "stored_page": q_stored_page,
    "write_metrics": q_write_metrics,
}

# A third of all listings are of one product; some have no product id.
_LISTED = """
SELECT CASE l_suppkey % 3 WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' ELSE 'r3' END AS source,
  CASE WHEN l_partkey % 3 = 0 THEN 'hot' WHEN l_partkey % 40 = 1 THEN NULL
       ELSE 'item-' || l_partkey END AS product_id, l_partkey, l_orderkey, l_linenumber,
  l_quantity, l_shipdate FROM lineitem"""

ORACLE = {
    "price_periods": f"""
WITH seen AS (
  SELECT source, product_id, CAST(l_shipdate AS DATE) AS snapshot_date,
    min(CASE WHEN month(l_shipdate) IN (3, 4) THEN NULL
             ELSE CAST(10 AS DOUBLE) + CASE WHEN product_id = 'hot' THEN 0 ELSE l_partkey % 50 END
                  + CASE WHEN month(l_shipdate) > 8 THEN 2.5 ELSE 0.0 END END) AS price
  FROM ({_LISTED}) GROUP BY ALL),
cut AS (
  SELECT *, CASE WHEN snapshot_date - lag(snapshot_date) OVER w <= {MAX_GAP_DAYS}
                  AND price IS NOT DISTINCT FROM lag(price) OVER w THEN 0 ELSE 1 END AS starts
  FROM seen WINDOW w AS (PARTITION BY source, product_id ORDER BY snapshot_date)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY source, product_id ORDER BY snapshot_date) AS i FROM cut),
period AS (
  SELECT source, product_id, i, any_value(price) AS price, min(snapshot_date) AS first_at,
    max(snapshot_date) AS last_at, count(*) AS n_seen FROM numbered GROUP BY source, product_id, i)
SELECT source, product_id, price, lag(price) OVER w AS prev_price, i = 1 AS is_first, first_at, last_at, n_seen
FROM period WINDOW w AS (PARTITION BY source, product_id ORDER BY i)""",
    "day_changes": """
WITH listed AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' ELSE 'r3' END AS source, p_partkey % 10 AS k,
    CASE WHEN p_partkey % 4 = 0 THEN 'hot' WHEN p_partkey % 25 <> 3 THEN 'item-' || p_partkey END AS product_id,
    CASE WHEN p_partkey % 8 <> 1 THEN p_retailprice END AS price,
    CASE WHEN p_partkey % 8 <> 1 THEN p_retailprice + CASE WHEN p_partkey % 5 = 2 THEN 1 ELSE 0 END END AS later
  FROM part),
a AS (SELECT source, product_id, min(price) AS price, 2 * count(*) AS n FROM listed WHERE k <> 3 GROUP BY ALL),
b AS (SELECT source, product_id, min(later) AS price, count(*) AS n FROM listed WHERE k <> 7 GROUP BY ALL)
SELECT coalesce(a.source, b.source) AS source, coalesce(a.product_id, b.product_id) AS product_id,
  CASE WHEN a.n IS NULL THEN 'appeared' WHEN b.n IS NULL THEN 'disappeared'
       WHEN a.price IS NOT DISTINCT FROM b.price THEN 'same' ELSE 'changed' END AS status,
  a.price AS price_before, b.price AS price_after, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after
FROM a FULL JOIN b ON a.source = b.source AND a.product_id IS NOT DISTINCT FROM b.product_id""",
    "latest_per_day": f"""
SELECT source, product_id, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS snapshot_date,
  CAST(l_shipdate AS DATE) AS observed_at, CASE WHEN l_quantity > 5 THEN l_quantity END AS price,
  l_orderkey * 8 + l_linenumber AS listing
FROM ({_LISTED})
QUALIFY row_number() OVER (PARTITION BY source, product_id, snapshot_date
                           ORDER BY observed_at DESC, price DESC NULLS LAST, listing DESC) = 1""",
    "log_runs": """
WITH r AS (SELECT user_id % 3 AS crawler, date_trunc('millisecond', ts) AS t, event_type = 'error' AS bad
           FROM events WHERE event_id % 10 <> 0),
n AS (SELECT *, sum(CASE WHEN t - before <= INTERVAL 20 MINUTES THEN 0 ELSE 1 END)
               OVER (PARTITION BY crawler ORDER BY t) AS run
      FROM (SELECT *, lag(t) OVER (PARTITION BY crawler ORDER BY t) AS before FROM r))
SELECT crawler, strftime(min(t), '%Y-%m-%d %H:%M:%S.%g') AS run_start,
  (epoch_ms(max(t)) - epoch_ms(min(t))) / 1000.0 AS elapsed_s, count(*) AS n_records,
  count(*) FILTER (WHERE bad) AS n_errors
FROM n GROUP BY crawler, run""",
    "stored_page": f"""
WITH k AS (SELECT greatest(1, count(*) // 100) AS size FROM orders),
o AS (SELECT o_orderkey, round(o_totalprice, -3) AS price,
        row_number() OVER (ORDER BY round(o_totalprice, -3) NULLS LAST, o_orderkey) - 1 AS row_index FROM orders)
SELECT o_orderkey, price, row_index FROM o, k
WHERE row_index >= {DEEP_PAGE} * size AND row_index < {DEEP_PAGE + 1} * size""",
    "write_metrics": """
WITH m AS (SELECT count(*) AS n, count(*) FILTER (WHERE p_partkey % 6 = 0 OR p_retailprice IS NULL) AS missing FROM part)
SELECT 'n_rows' AS metric, n AS value FROM m UNION ALL SELECT 'null_product_id', 0
UNION ALL SELECT 'null_price', missing FROM m UNION ALL SELECT 'null_category', 0
UNION ALL SELECT 'n_null', missing FROM m""",
    # every pair of one pack size is compared here, from the words the names were built of
    "cheapest_source": f"""
WITH shop(source) AS (VALUES ('r1'), ('r2'), ('r3')),
offer AS (
  SELECT source, source || '-' || p_partkey AS product_id, p_size * 10.0::DOUBLE AS grams,
    list_sort(list_distinct(list_filter(str_split(p_name, ' ') || [
      lower(replace(p_brand, '#', '')),
      CASE WHEN source = 'r3' AND p_partkey % 5 = 0 THEN 'm' ELSE 'n' END || p_partkey,
      CASE WHEN p_partkey % 9 = 0 THEN 'maca' END,
      CASE WHEN source = 'r3' AND p_partkey % 4 = 1 THEN 'bio' END], lambda w: w IS NOT NULL))) AS words,
    p_retailprice * CASE source WHEN 'r1' THEN 1
      WHEN 'r2' THEN CASE WHEN p_partkey % 3 = 0 THEN 0.5 ELSE 2 END
      ELSE CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 0.25 ELSE 1 END END
      / (p_size * 10) AS unit_price
  FROM part, shop),
class AS (SELECT words, grams FROM offer GROUP BY ALL),
met AS (
  SELECT c.words, c.grams, o.source, o.product_id, o.unit_price FROM class c JOIN offer o ON c.grams = o.grams
  WHERE 100 * len(list_intersect(c.words, o.words))
        >= {PERCENT} * (len(c.words) + len(o.words) - len(list_intersect(c.words, o.words))))
SELECT array_to_string(words, ' ') AS product, grams AS size_value, 'g' AS size_unit,
  CAST(NULL AS BIGINT) AS quantity, count(DISTINCT source) AS n_sources,
  first(source ORDER BY unit_price, source, product_id) FILTER (WHERE unit_price IS NOT NULL) AS cheapest_source,
  first(product_id ORDER BY unit_price, source, product_id) FILTER (WHERE unit_price IS NOT NULL) AS cheapest_id,
  min(unit_price) AS unit_price
FROM met GROUP BY words, grams""",
}
