"""Metrics of runs: from the log, by idle gaps, and taken while a table is written."""

import datetime as dt

from pyspark.sql import functions as F

from shelfscan.operators.report import log_runs, parse_log_lines, pipeline_metrics
from shelfscan.sources.sinks import write_csv, write_measured
from shelfscan.sources.snapshots import read_csv_snapshots

LINE = "2024-11-{day:02d} {h:02d}:{m:02d}:00,{ms:03d} - scraper - {level} - crawl.py:1 - run - x"


def log(spark, *times):
    lines = [LINE.format(day=d, h=h, m=m, ms=ms, level=level) for d, h, m, ms, level in times]
    return parse_log_lines(spark.createDataFrame([(x,) for x in [*lines, "Traceback"]], "value string"))


def test_runs_end_after_an_idle_gap(spark):
    df = log(spark, (13, 9, 0, 0, "INFO"), (13, 9, 29, 0, "ERROR"), (13, 9, 58, 500, "INFO"),     # one run
             (13, 10, 28, 501, "INFO"),                                 # more than 30 minutes later
             (13, 23, 50, 0, "INFO"), (14, 0, 10, 0, "ERROR"), (14, 0, 10, 0, "ERROR"))   # over midnight
    got = [(str(r.run_start), str(r.run_end), r.elapsed_s, r.n_records, r.n_errors)
           for r in log_runs(df).orderBy("run_start").collect()]
    assert got == [
        ("2024-11-13 09:00:00", "2024-11-13 09:58:00.500000", 3480.5, 3, 1),
        ("2024-11-13 10:28:00.501000", "2024-11-13 10:28:00.501000", 0.0, 1, 0),
        ("2024-11-13 23:50:00", "2024-11-14 00:10:00", 1200.0, 3, 2)]
    assert log_runs(df, "1 minute").count() == 6
    assert log_runs(df, "1800001 milliseconds").count() == 2
    assert log_runs(df.limit(0)).count() == 0


def test_the_session_window_sees_slots_not_records(spark):
    """A log with very many records of one run goes into the session window as a few rows."""
    busy = spark.range(20_000).select(F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")),
                                                    "yyyy-MM-dd HH:mm:ss,SSS").alias("logged_at"), F.lit("INFO").alias("level"))
    row = log_runs(busy).collect()
    assert len(row) == 1 and (row[0].elapsed_s, row[0].n_records) == (19_999.0, 20_000)
    plan = log_runs(busy)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MergingSessions") < plan.rindex("partial_count")     # counted below the session


def test_two_files_of_a_category_are_two_files(spark, tmp_path):
    for name in ("a", "b"):
        rows = spark.createDataFrame([(name, "n", None)], "product_id string, product_name string, product_rating string")
        write_csv(rows.coalesce(1), str(tmp_path / "20241113" / "category=x" / name))
    rows = read_csv_snapshots(spark, str(tmp_path), "r2")
    m = pipeline_metrics(rows, ["file_path"], log(spark, (13, 9, 0, 0, "INFO")), ["product_rating"]).first()
    assert (m.n_files, m.n_rows, m.n_null, m.elapsed_s) == (2, 2, 2, 0.0)


def test_metrics_while_writing(spark, tmp_path):
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    day = dt.date(2024, 11, 13)
    df = spark.createDataFrame([(str(i), None if i % 3 == 0 else 1.0, "r1", day, "c") for i in range(30)],
                               "product_id string, price double, source string, snapshot_date date, category string")
    path = str(tmp_path / "t")
    got = write_measured(df.mapInArrow(count, df.schema), path, columns=["product_id", "price"])
    assert acc.value == 30                      # one evaluation
    back = spark.read.parquet(path)
    assert got == {"n_rows": back.count(), "null_product_id": 0,
                   "null_price": back.where("price is null").count(), "n_null": 10}
