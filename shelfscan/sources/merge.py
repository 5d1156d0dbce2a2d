"""Merging new rows into a stored, partitioned table: the latest row of each key wins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .sinks import write_snapshot


def touched_partitions(rows: DataFrame, partition_by: list[str]) -> list[T.Row]:
    """The partition values in ``rows``: as many as a batch has directories to write."""
    return rows.select(*partition_by).distinct().collect()


def partition_filter(partition_by: list[str], values: list) -> Column:
    """A condition of literals that holds in just these partitions, so that a scan lists and
    reads no other directory.  The last column's values are listed per combination of the others."""
    if not values:
        return F.lit(False)
    lists: dict[tuple, list] = {}
    for v in values:
        lists.setdefault(tuple(v[:-1]), []).append(v[-1])
    last = F.col(partition_by[-1])
    out = None
    for head, tails in lists.items():
        some = [t for t in tails if t is not None]
        hit = last.isin(some) if some else F.lit(False)
        if len(some) < len(tails):
            hit = hit | last.isNull()
        for c, v in zip(partition_by, head):
            hit = (F.col(c).isNull() if v is None else F.col(c) == F.lit(v)) & hit
        out = hit if out is None else out | hit
    return out


def latest(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order_by`` (NULLs least), of equal ones that
    with the greatest row hash.  Rows of a key are combined before the shuffle, so a key with very
    many rows is no hot key."""
    hashable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    rank = F.struct(*order_by, F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*keys).agg(F.max_by(whole, rank).alias("_row")).select("_row.*")


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The stored table, None before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def merge_latest(new: DataFrame, path: str, keys: list[str], order_by: list[str],
                 partition_by: list[str]) -> None:
    """Merge ``new`` into the table at ``path`` so that it holds one row per ``keys``, the latest by
    ``order_by``, whatever the order and number of merges: late and replayed rows change
    nothing they should not.

    ``keys`` must contain ``partition_by``.  Only the directories that ``new`` touches are read and
    replaced; the merged rows are written to the scratch folder first, since a directory cannot be
    read while it is replaced.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("a key must lie in one partition: keys have to contain partition_by")
    spark = new.sparkSession
    stage = scratch_path(spark, "merge-new")
    new.write.parquet(stage)                    # read twice below: evaluated once
    fresh = spark.read.schema(new.schema).parquet(stage)
    parts = touched_partitions(fresh, partition_by)
    stored = read_stored(spark, path, new.schema)
    both = fresh if stored is None else fresh.unionByName(
        stored.where(partition_filter(partition_by, parts)).select(*new.columns))
    merged = scratch_path(spark, "merged")
    latest(both, keys, order_by).write.parquet(merged)
    write_snapshot(spark.read.schema(new.schema).parquet(merged), path, partition_by)
