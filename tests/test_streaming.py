"""The daily run as a stream: late and replayed pages, failures, and what a batch reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscan.schemas import PAGES_RAW, PARTITION_COLUMNS
from shelfscan.sources.merge import partition_filter
from shelfscan.sources.pages import read_pages_table
from shelfscan.streaming import incremental
from shelfscan.streaming.incremental import start_incremental_ingest, touched_pages

DAYS = [dt.date(2024, 11, 13) + dt.timedelta(days=i) for i in range(4)]


def page(day, category, number, *ids):
    tiles = "".join(f'<div class="product" data-pid="{i}"></div>' for i in ids)
    return ("r3", category, day, None, number, f"<html><body>{tiles}</body></html>")


def land(spark, path, *rows):
    (spark.createDataFrame(list(rows), PAGES_RAW).coalesce(1).write.mode("append")
     .partitionBy("source", "snapshot_date").parquet(path))


class Table:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.pages, self.out, self.ck = (str(tmp_path / n) for n in ("pages", "out", "ck"))

    def run(self, **options):
        start_incremental_ingest(self.spark, self.pages, self.out, self.ck, **options).awaitTermination()

    def rows(self):
        return sorted((str(r.snapshot_date)[-2:], r.category, r.product_id) for r in
                      self.spark.read.parquet(self.out).collect())


@pytest.fixture
def table(spark, tmp_path):
    t = Table(spark, tmp_path)
    land(spark, t.pages, *[page(d, c, 0, f"{c}1", f"{c}2") for d in DAYS for c in "ab"])
    t.run()
    return t


ALL = sorted((str(d)[-2:], c, f"{c}{i}") for d in DAYS for c in "ab" for i in (1, 2))


def test_late_pages_and_corrections(spark, table, monkeypatch):
    seen = []
    touched = incremental.touched_pages
    monkeypatch.setattr(incremental, "touched_pages",
                        lambda s, p, t: seen.append(sorted((r.snapshot_date, r.category) for r in t)) or touched(s, p, t))
    assert table.rows() == ALL
    land(spark, table.pages, page(DAYS[1], "a", 24, "a3"))              # a late page
    table.run()
    assert table.rows() == sorted([*ALL, ("14", "a", "a3")]) and seen == [[(DAYS[1], "a")]]
    land(spark, table.pages, page(DAYS[1], "a", 0, "a1", "x"))          # a page lands again, corrected
    table.run()
    assert table.rows() == sorted([*(r for r in ALL if r != ("14", "a", "a2")), ("14", "a", "a3"), ("14", "a", "x")])


def test_replayed_pages_touch_nothing(spark, table, monkeypatch):
    calls = []
    monkeypatch.setattr(incremental, "write_snapshot", lambda df, path: calls.append(path))
    land(spark, table.pages, page(DAYS[0], "a", 0, "a1", "a2"), page(DAYS[2], "b", 0, "b1", "b2"))
    table.run()
    assert calls == [] and table.rows() == ALL


def test_a_batch_reads_touched_directories_only(spark, table):
    some = [("r3", DAYS[0], "a"), ("r3", DAYS[2], "b")]
    df = touched_pages(spark, table.pages, some)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == plan.count("FileScan") == 2
    assert "PartitionFilters: []" not in plan
    files = (read_pages_table(spark, table.pages).where(partition_filter(PARTITION_COLUMNS, some))
             .select(F.input_file_name().alias("f")).distinct().collect())
    read = {r.f.split("snapshot_date=")[1][:10] for r in files}
    assert read == {str(DAYS[0]), str(DAYS[2])}
    assert {(r.snapshot_date, r.category) for r in df.collect()} == {(DAYS[0], "a"), (DAYS[2], "b")}


def test_a_failed_batch_runs_again(spark, table, monkeypatch):
    land(spark, table.pages, page(DAYS[3], "b", 24, "b3"))
    write = incremental.write_snapshot

    def broken(df, path):
        write(df, path)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(incremental, "write_snapshot", broken)
    with pytest.raises(Exception, match="lost after the write"):
        table.run()
    monkeypatch.setattr(incremental, "write_snapshot", write)
    table.run()
    assert table.rows() == sorted([*ALL, ("16", "b", "b3")])


def test_batch_then_stream_then_replay(spark, table):
    """A stream that starts anew (its checkpoint is lost) builds the same table."""
    table.ck += "-new"
    table.run(max_files_per_trigger=2)
    assert table.rows() == ALL
