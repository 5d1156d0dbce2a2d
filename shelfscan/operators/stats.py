"""Describe, row counts and null profiles.

``describe`` returns count, mean, sample standard deviation, min, exact
quartiles (linear interpolation, the pandas/NumPy default) and max per group.
There is one plan for every size.  Values are collapsed to (group, value, count) with
map-side partial aggregation (prices repeat a lot) and range-partitioned on (group,
value), so a hot group spreads over many tasks; that table is stored and is
all that later steps read.  Moments are grouped sums over it.  For the quartiles, counts
run inside each (task, group) slice, slices get the counts of earlier tasks, and only the
few rows that hold a wanted rank reach the final aggregate.  The table is stored as Parquet, so
each of these steps reads its own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import stored

DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def _group_cols(by: list[str] | None) -> dict:
    """Reserved name -> group column; the whole table is the group 0."""
    return {f"_g{i}": F.col(f"`{g}`") for i, g in enumerate(by)} if by else {"_g0": F.lit(0)}


def _join_ns(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (a NULL group is a group)."""
    ren = {k: f"_r{k}" for k in keys}
    r = right.withColumnsRenamed(ren)
    cond = [F.col(k).eqNullSafe(F.col(v)) for k, v in ren.items()]
    return left.join(r, on=cond, how=how).drop(*ren.values())


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Stored ``_g0 .. , _v, _c, _task``: how often each group holds each
    value (NULL values are one row), range-partitioned and sorted by (group, value)."""
    groups = _group_cols(by)
    v = F.col(f"`{value}`").cast("double")
    keys = [*groups, "_v"]
    counts = (df.select(*[c.alias(n) for n, c in groups.items()], v.alias("_v"))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")))
    return stored(counts.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("_task", F.spark_partition_id()), "values")


def _quantiles(counts: DataFrame, keys: list[str], probs, prefix: str) -> DataFrame:
    """``keys`` + one column per probability, from ``value_counts``."""
    vc = counts.where("_v is not null")
    slices = vc.groupBy(*keys, "_task").agg(F.sum("_c").alias("_s"))
    w = Window.partitionBy(*keys).orderBy("_task")
    slices = slices.select(
        *keys, "_task",
        F.coalesce(F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_earlier"),
        F.sum("_s").over(Window.partitionBy(*keys)).alias("_n"))
    inside = Window.partitionBy(*keys, "_task").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = vc.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    ranked = _join_ns(rows, slices, [*keys, "_task"]).withColumn(
        "_before", F.col("_earlier") + F.col("_in"))
    # Wanted ranks: floor and ceil of (n-1)p; a row holds rank r when
    # before <= r < before + count.
    holds = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_c"))
    aggs, outs, wanted = [], [], F.lit(False)
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        wanted = wanted | holds(lo) | holds(hi)
        aggs += [F.min(F.when(holds(lo), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(holds(hi), F.col("_v"))).alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_part{i}")]
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}"))
                    .alias(f"{prefix}{int(round(p * 100))}"))
    return ranked.where(wanted).groupBy(*keys).agg(*aggs).select(*keys, *outs)


def exact_quantiles(df: DataFrame, value: str, probs=DESCRIBE_PROBS,
                    by: list[str] | None = None, prefix: str = "q") -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group.

    Output: group columns + ``{prefix}{int(p*100)}`` DOUBLE per probability.
    NULL values are ignored; a group with no values has no row.
    """
    out = _quantiles(value_counts(df, value, by), list(_group_cols(by)), probs, prefix)
    return out.withColumnsRenamed(dict(zip(_group_cols(by), by))) if by else out.drop("_g0")


def describe(df: DataFrame, value: str, by: list[str] | None = None,
             probs=DESCRIBE_PROBS) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max of ``value`` per group.

    Missing values are skipped (``count`` counts present values).  A group
    whose values are all missing reports count 0 and NULL statistics.  ``df``
    is read by one aggregate only.
    """
    keys = list(_group_cols(by))
    counts = value_counts(df, value, by)
    n = F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")))
    first = counts.groupBy(*keys).agg(
        F.coalesce(n, F.lit(0)).cast("bigint").alias("count"),
        (F.sum(F.col("_v") * F.col("_c")) / n).alias("mean"),
        F.min("_v").alias("min"), F.max("_v").alias("max"))
    # squared distances from the mean in a second sum: no cancellation
    off = F.col("_v") - F.col("mean")
    spread = (_join_ns(counts, first.select(*keys, "mean"), keys)
              .groupBy(*keys).agg(F.sum(off * off * F.col("_c")).alias("_ss")))
    q = _quantiles(counts, keys, probs, "q")
    out = _join_ns(_join_ns(first, spread, keys), q, keys, "left")
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))
    stats = ["mean", std.alias("std"), "min", *[f"q{int(round(p * 100))}" for p in probs], "max"]
    if by:
        return out.select(*[F.col(k).alias(g) for k, g in zip(keys, by)], "count", *stats)
    # an empty table still has a description
    whole = df.sparkSession.range(1).select(F.lit(0).alias("_g0"))
    return whole.join(out, "_g0", "left").select(
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"), *stats)


def row_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Row count per group (BIGINT ``n_rows``)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: ``column_name``, ``n_null``, ``n_rows``.

    A single aggregate pass (one partial-aggregated counter per column), then
    unpivoted; never one job per column.
    """
    cols = columns or df.columns
    # count(*) and count(c) only: over a bare Parquet table read through the
    # DataSource V2 reader (parquet not in spark.sql.sources.useV1SourceList)
    # with spark.sql.parquet.aggregatePushdown=true, Spark answers them from
    # file footers, so a wide text column is never read to count its NULLs.
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _rows - `_c{i}`" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, n_null)",
                          "_rows as n_rows").select(
        "column_name", F.col("n_null").cast("bigint").alias("n_null"),
        F.col("n_rows").cast("bigint").alias("n_rows"))
