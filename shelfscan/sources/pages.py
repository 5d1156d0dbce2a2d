"""Landed catalogue pages (bronze ``pages_raw``).

A crawler (outside this library) lands one page per request; this module reads
them as rows: from a Parquet table with the ``PAGES_RAW`` schema, or from
loose HTML files laid out as
``<base>/<source>/<yyyyMMdd>/<category>/<page>.html``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_dir_date
from ..schemas import PAGES_RAW

# File layout of landed page files.
PAGE_FILE = r"/([^/]+)/(\d{8})/([^/]+)/(?:page-)?(\d+)\.html?$"


def read_pages_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet ``pages_raw`` table, partitioned by source / snapshot_date."""
    return spark.read.schema(PAGES_RAW).parquet(path)


def latest_pages(pages: DataFrame, keys: list[str], where: Column) -> DataFrame:
    """The pages of a stored table that fulfil ``where``, each key once: as it landed last (by file
    time, then file name).  Finding the files reads the keys only; the markup is
    read once and not sorted.  Files hold a page once."""
    landed = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"))
    some = pages.where(where).withColumn("_landed", landed)
    last = some.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("_landed").alias("_last"))
    same = F.col("_landed") == F.col("_last")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return some.join(last, same, "left_semi").drop("_landed")


def read_page_files(spark: SparkSession, path: str, offset_paged: bool = False,
                    page_size: int | None = None) -> DataFrame:
    """Whole HTML files → one row per page with keys parsed from the path.

    The file's number is the page number (1-based) or, with
    ``offset_paged``, the result offset; the other key is derived when a page
    size is given.
    """
    raw = spark.read.option("wholetext", "true").text(path)
    fp = F.col("_metadata.file_path")
    num = F.regexp_extract(fp, PAGE_FILE, 4).try_cast("int")
    if offset_paged:
        start = num
        page_no = (F.floor(num / F.lit(page_size)) + 1).cast("int") if page_size else F.lit(None)
    else:
        page_no = num
        start = ((num - 1) * F.lit(page_size)).cast("int") if page_size else F.lit(None)
    return raw.select(
        F.regexp_extract(fp, PAGE_FILE, 1).alias("source"),
        F.regexp_extract(fp, PAGE_FILE, 3).alias("category"),
        parse_dir_date(F.regexp_extract(fp, PAGE_FILE, 2)).alias("snapshot_date"),
        page_no.cast("int").alias("page_no"), start.cast("int").alias("page_start"),
        F.col("value").alias("html"))
