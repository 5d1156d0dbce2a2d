"""Incremental ingest: the daily run as a stream over newly landed pages.

Each crawl lands page files under ``pages_raw``; instead of re-reading every
day's folder, a Structured Streaming query picks up only the files it has not
seen (file-source log in the checkpoint).  A page that lands again unchanged is
dropped by ``dropDuplicatesWithinWatermark`` on the page's key and content, so it
touches nothing.  For every micro-batch the touched categories (source, date,
category) are built anew from all their landed pages and written with the batch
writer, which replaces just those partitions.  Only the touched directories are
read: their values are few, and the scan is filtered by them as literals.  So a
replayed micro-batch, or one that runs again after a failure, changes nothing, a
late page makes its category whole, and batch and stream share one table.
``availableNow`` processes what is there and stops, so a scheduler can run it
once a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import PAGE_KEYS, build_product_snapshot
from ..schemas import PAGES_RAW, PARTITION_COLUMNS
from ..sources.merge import partition_filter, touched_partitions
from ..sources.pages import latest_pages, read_pages_table
from ..sources.sinks import write_snapshot

REPLAY_WINDOW = "7 days"        # how long a page is remembered after it landed


def landing_stream(spark: SparkSession, pages_path: str, max_files_per_trigger: int | None = None,
                   replay_window: str = REPLAY_WINDOW) -> DataFrame:
    """The partition columns of newly landed pages, each page and content once within
    ``replay_window`` of its landing.  NULL keys are kept as values of their own."""
    reader = spark.readStream.schema(PAGES_RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = reader.parquet(pages_path).select(
        *PARTITION_COLUMNS, F.xxhash64(*PAGE_KEYS).alias("page_key"), F.xxhash64("html").alias("content"),
        F.col("_metadata.file_modification_time").alias("landed_at"))
    return (landed.withWatermark("landed_at", replay_window)
            .dropDuplicatesWithinWatermark(["page_key", "content"]).select(*PARTITION_COLUMNS))


def touched_pages(spark: SparkSession, pages_path: str, touched: list) -> DataFrame:
    """All landed pages of the touched partitions, the latest landing of each page."""
    return latest_pages(read_pages_table(spark, pages_path), PAGE_KEYS,
                        partition_filter(PARTITION_COLUMNS, touched))


def start_incremental_ingest(spark: SparkSession, pages_path: str, out_path: str,
                             checkpoint_location: str, run_stamp: str | None = None,
                             max_files_per_trigger: int | None = None,
                             available_now: bool = True,
                             replay_window: str = REPLAY_WINDOW) -> StreamingQuery:
    """Start the stream; call ``.awaitTermination()`` (availableNow) or
    ``.processAllAvailable()`` on the returned query."""

    def land(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        touched = touched_partitions(batch, PARTITION_COLUMNS)
        if touched:
            write_snapshot(build_product_snapshot(
                touched_pages(session, pages_path, touched), run_stamp), out_path)

    w = (landing_stream(spark, pages_path, max_files_per_trigger, replay_window)
         .writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def main(argv: list[str] | None = None) -> None:
    """``python -m shelfscan.streaming.incremental --pages P --out O --checkpoint C``"""
    import argparse

    from ..session import job_session

    ap = argparse.ArgumentParser(description="incremental ingest of newly landed pages")
    ap.add_argument("--pages", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True, help="stream checkpoint (shared storage)")
    ap.add_argument("--run-stamp", default=None)
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    a = ap.parse_args(argv)
    spark = job_session("shelfscan-incremental")
    start_incremental_ingest(spark, a.pages, a.out, a.checkpoint, a.run_stamp,
                             a.max_files_per_trigger).awaitTermination()


if __name__ == "__main__":
    main()
