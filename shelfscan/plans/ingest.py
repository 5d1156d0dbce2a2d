"""Ingest job: landed pages (``pages_raw``) → typed ``product_snapshot``.

One job for every source, category and page: each source's pages are selected
by its partition value (directory pruning), walked with that source's tile
layout, projected to the canonical columns natively and unioned; the result is
written partitioned by (source, snapshot_date, category) with dynamic
overwrite, so re-landing one category of one day replaces just that category.

    python -m shelfscan.plans.ingest --pages <pages_raw> --out <product_snapshot> \
        [--run-stamp 20241113_173405]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..functions.text import parse_stamp
from ..operators import extract as X
from ..operators.conform import conform
from ..schemas import PRODUCT_SNAPSHOT
from ..sources.pages import read_pages_table
from ..session import job_session
from ..sources.sinks import write_snapshot

UNKNOWN_SOURCE = "page: unknown source"
PAGE_KEYS = ["source", "category", "snapshot_date", "page_no", "page_start"]


def _nn_array(*cols):
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def _canonical_tile_json(t: DataFrame) -> DataFrame:
    return t.select(
        *PAGE_KEYS, "tile_pos", "product_id", "product_name", "brand",
        _nn_array(F.col("category_name")).alias("category_path"),
        F.col("price").cast("string").alias("price_raw"), "price",
        F.lit("shelf").alias("price_basis"),
        "unit_price_raw", "min_quantity", "image_url", "product_url", "parse_error")


def _canonical_card(t: DataFrame) -> DataFrame:
    return t.select(*PAGE_KEYS, "tile_pos", "product_id", "product_name", "price_raw", "price",
                    F.lit("shelf").alias("price_basis"), "image_url", "product_url",
                    "rating", "parse_error")


def _canonical_tile_attr(t: DataFrame) -> DataFrame:
    return t.select(
        *PAGE_KEYS, "tile_pos", "product_id", "product_name",
        _nn_array("category_l1", "category_l2", "category_l3").alias("category_path"),
        "price_raw", "price", F.lit("shelf").alias("price_basis"),
        "image_url", F.col("product_urls").alias("product_url"), "rating", "labels",
        "promotion", "parse_error")


CANONICAL = {"tile_json": _canonical_tile_json, "card": _canonical_card,
             "tile_attr": _canonical_tile_attr}


def build_product_snapshot(pages: DataFrame, run_stamp: str | None = None,
                           num_partitions: int | None = None) -> DataFrame:
    """Every landed page → one canonical row per product tile.

    ``pages`` has the ``PAGES_RAW`` columns; ``source`` values are the keys of
    ``specs.SOURCES``.  A page of any other source, or one that cannot be read,
    is one row with a ``parse_error`` and no product, which the run report
    counts.  ``run_stamp`` (``yyyyMMdd_HHmmss``) fills
    ``observed_at`` — the run time is a job argument, never ``now()``.
    """
    parts = []
    for spec in specs.SOURCES:
        mine = pages.where(F.col("source") == F.lit(spec.key))
        tiles = X.extract_products(mine, spec.layout, keys=PAGE_KEYS,
                                   num_partitions=num_partitions)
        parts.append(CANONICAL[spec.layout](tiles))
    known = F.col("source").isin([spec.key for spec in specs.SOURCES])
    parts.append(pages.where(~F.coalesce(known, F.lit(False)))
                 .select(*PAGE_KEYS, F.lit(UNKNOWN_SOURCE).alias("parse_error")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    observed = parse_stamp(F.lit(run_stamp)) if run_stamp else F.lit(None)
    return conform(out.withColumn("observed_at", observed.cast("timestamp_ntz")),
                   PRODUCT_SNAPSHOT)


def run(spark: SparkSession, pages_path: str, out_path: str,
        run_stamp: str | None = None) -> None:
    pages = read_pages_table(spark, pages_path)
    # Parquet answers count() from file footers, so sizing the parse by page
    # count costs no scan of the markup.
    n = X.walk_partitions(pages.count(), spark)
    write_snapshot(build_product_snapshot(pages, run_stamp, n), out_path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--pages", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-stamp", default=None)
    a = ap.parse_args(argv)
    spark = job_session("shelfscan-ingest")
    run(spark, a.pages, a.out, a.run_stamp)


if __name__ == "__main__":
    main()
