"""Writers: partitioned Parquet snapshot tables and CSV interchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_COLUMNS


def write_measured(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   columns: list[str] | None = None, mode: str = "overwrite") -> dict[str, int]:
    """``write_snapshot``, and what was written, taken while it was: ``n_rows``, and the missing
    values per column (``null_<column>``) and together (``n_null``).  Neither the rows nor the
    table are read again."""
    cols = columns or df.columns
    seen = Observation()
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in cols]
    write_snapshot(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *nulls), path, partition_by, mode)
    got = seen.get
    return {**got, "n_null": sum(got[f"null_{c}"] for c in cols)}


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite") -> None:
    """Write a snapshot table partitioned by source / date / category.

    Overwrite is *dynamic*: only the partitions present in ``df`` are
    replaced, so re-running one category of one day replaces that category
    only.  Rows are rebalanced by the partition columns: each task writes few
    files, and adaptive execution splits a hot partition value (say one source
    holding a third of all rows) over several tasks.  ``df`` is evaluated once.
    Partition values with ``/`` are escaped by Spark and read back intact.
    """
    parts = partition_by or PARTITION_COLUMNS
    (cluster_for_write(df, parts)
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def cluster_for_write(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rebalance by the partition columns before a partitioned write: few files
    per task, hot values split by size at run time.  Unlike a range exchange it
    samples nothing, so the upstream runs once."""
    return df.hint("rebalance", *parts)


PAGE_PARTITIONS = ["source", "snapshot_date", "category"]


def write_pages(pages: DataFrame, path: str) -> None:
    """Land raw pages into the bronze ``pages_raw`` table.

    Partitioned by source / snapshot date / category with dynamic overwrite:
    re-landing one category of one day replaces only those pages, every page
    of every other run survives (the original tool kept only the last page in
    a single overwritten file).
    """
    write_snapshot(pages, path, PAGE_PARTITIONS)


def to_csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns → JSON text (CSV holds no arrays/maps/structs)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV interchange: nested columns as JSON text, header, ``"`` escaping."""
    out = to_csv_ready(df)
    if partition_by:
        out = cluster_for_write(out, partition_by)
    w = out.write.mode("overwrite").option("header", "true").option("escape", '"')
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.csv(path)
