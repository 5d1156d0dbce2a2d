"""Batch jobs over snapshot CSV folders: harmonise + describe, and unit price.

    python -m shelfscan.plans.jobs harmonise --r1 <dir> --r2 <dir> --r3 <dir> --out <path>
    python -m shelfscan.plans.jobs unit-price --input <dir> --schema r3 --out <path>

Paths are arguments (any Hadoop URI such as ``s3a://…``); outputs never land
inside an input folder, so a re-run cannot read its own output.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators.harmonise import harmonise, unit_price, with_harmonised_index
from ..operators.stats import describe
from ..session import job_session
from ..sources.snapshots import read_csv_snapshots


def harmonise_snapshots(spark: SparkSession, dirs: dict[str, str],
                        drop_missing: bool = False, with_index: bool = False) -> DataFrame:
    """Read each source's dated CSV folder(s) and harmonise them."""
    frames = {k: read_csv_snapshots(spark, p, k) for k, p in dirs.items() if p}
    h = harmonise(frames, drop_missing=drop_missing, with_rank=with_index)
    return with_harmonised_index(h) if with_index else h


def run_harmonise(spark: SparkSession, dirs: dict[str, str], out: str,
                  drop_missing: bool = False) -> DataFrame:
    """Write the harmonised table (with its ordered row index) and return the
    price description."""
    h = harmonise_snapshots(spark, dirs, drop_missing, with_index=True)
    h.write.mode("overwrite").parquet(out)
    written = spark.read.parquet(out)
    return describe(written, "price")


def run_unit_price(spark: SparkSession, input_dir: str, schema: str, out: str) -> None:
    snaps = read_csv_snapshots(spark, input_dir, schema)
    unit_price(snaps).write.mode("overwrite").parquet(out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="shelfscan batch jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    h = sub.add_parser("harmonise")
    for k in ("r1", "r2", "r3"):
        h.add_argument(f"--{k}")
    h.add_argument("--out", required=True)
    h.add_argument("--drop-missing", action="store_true")
    u = sub.add_parser("unit-price")
    u.add_argument("--input", required=True)
    u.add_argument("--schema", default="r3")
    u.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = job_session(f"shelfscan-{a.cmd}")
    if a.cmd == "harmonise":
        stats = run_harmonise(spark, {"r1": a.r1, "r2": a.r2, "r3": a.r3}, a.out, a.drop_missing)
        stats.show(truncate=False)
    else:
        run_unit_price(spark, a.input, a.schema, a.out)


if __name__ == "__main__":
    main()
