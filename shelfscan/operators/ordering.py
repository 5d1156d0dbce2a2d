"""Row index, ranking within groups, paging and price order — without an
unpartitioned window.

``row_number() over (order by …)`` with no partition pulls every row into one
task, and ``partition by category`` puts a hot category (possibly a third of
all rows) into one task.  ``with_row_index`` instead sorts a small table of
keys: one row per different (group, order key, row hash) with the number of rows
that have it, range-partitioned, so a hot group or a run of equal keys is split
across many tasks.  Each task numbers its keys, the rows held by earlier tasks
are added, and the rows get their number by a join on the hash.

Only the key table is checkpointed to the shared checkpoint folder: it is read
twice (for the per-task sums and for the numbering), range bounds are sampled per
exchange, so two evaluations could split the keys differently.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (set from the session
    conf when the context has none yet)."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Evaluated once, as a Parquet table under the shared checkpoint folder: for rows that are read
    several times by different columns."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_OF_A_KEY = 10_000      # equal rows that may meet in one task


def _referenced(df: DataFrame, order_by: list[Column | str]) -> list[str]:
    """The columns that ``order_by`` names; all of them if it holds other expressions."""
    out = []
    for c in order_by:
        plain = re.fullmatch(r"Column<'(.+?)(?: (?:ASC|DESC) NULLS (?:FIRST|LAST))?'>", str(c))
        name = c if isinstance(c, str) else plain[1].strip("`") if plain else None
        if name not in df.columns:
            return list(df.columns)
        out.append(name)
    return list(dict.fromkeys(out))


def with_row_index(df: DataFrame, order_by: list[Column | str],
                   partition_by: list[str] | None = None, name: str = "row_index",
                   num_partitions: int | None = None,
                   rows_of_a_key: int = ROWS_OF_A_KEY) -> DataFrame:
    """Add a dense 0-based BIGINT position per ``partition_by`` group.

    ``order_by`` should be a total order; rows tied on every key get
    consecutive positions, ordered among themselves by a 128-bit hash of the row.
    Equal rows count as one key with a number: a row that stands there more than
    ``rows_of_a_key`` times (a third of all, say) is not sent anywhere so often but
    once, and written out as often by many tasks.

    ``df`` is evaluated twice, first for the columns that order it and its hashes
    alone; its rows cross one exchange.  Only groups that cross a task
    border need an offset: at most two per task, so that table is bounded by
    the task count and broadcast.
    """
    from pyspark.sql import types as T

    from ..session import ship_package
    ship_package(df.sparkSession)
    groups = list(partition_by or [])
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    hashes = {"_h1": F.xxhash64(*hashable), "_h2": F.xxhash64(F.lit(1), *reversed(hashable))}
    keyed = df.withColumns(hashes)
    used = list(dict.fromkeys([*groups, *_referenced(df, order_by)]))
    order: list[Column] = [F.col(g) for g in groups] + [
        F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col("_h1"), F.col("_h2")]
    counted = keyed.groupBy(*[F.col(f"`{c}`") for c in used], "_h1", "_h2").agg(F.count(F.lit(1)).alias("_m"))
    # No fixed count by default: adaptive execution sizes the range partitions
    # by bytes at run time (coalescing adjacent ranges keeps them ordered).
    rp = counted.repartitionByRange(num_partitions, *order) if num_partitions \
        else counted.repartitionByRange(*order)
    ranged = materialize(rp.sortWithinPartitions(*order).select(*groups, "_h1", "_h2", "_m")
                         .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(list(ranged.schema.fields) + [T.StructField("_gpos", T.LongType())])
    numbered = ranged.mapInArrow(_group_runs(groups), schema)

    # Rows of each group per task; groups of more than one task cross a border.
    stats = ranged.groupBy("_pid", *groups).agg(F.sum("_m").alias("_n"))
    ren = {g: f"_k{i}" for i, g in enumerate(groups)}
    spans = (stats.groupBy(*groups).agg(F.count(F.lit(1)).alias("_tasks"))
             .where(F.col("_tasks") > 1)
             .select(*[F.col(g).alias(ren[g]) for g in groups], "_tasks"))
    cond_s = [F.col(g).eqNullSafe(F.col(ren[g])) for g in groups]
    spanning = stats.join(F.broadcast(spans), on=cond_s or F.lit(True), how="left_semi")
    w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spanning.select(F.col("_pid").alias("_opid"),
                              *[F.col(g).alias(ren[g]) for g in groups],
                              F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    cond = [F.col("_pid") == F.col("_opid")] + [
        F.col(g).eqNullSafe(F.col(ren[g])) for g in groups]
    starts = numbered.join(F.broadcast(offsets), on=cond, how="left").select(
        "_h1", "_h2", "_m", (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_gpos")).alias("_start"))
    own = [F.col(f"`{c}`") for c in df.columns]

    # equal rows, of which there are few, are told apart by a number
    copy = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy("_start")) - 1
    few = (keyed.join(starts.where(F.col("_m") <= rows_of_a_key), ["_h1", "_h2"])
           .select(*own, (F.col("_start") + copy).cast("bigint").alias(name)))
    # at most a row per ``rows_of_a_key``: a bounded list
    often = ranged.where(F.col("_m") > rows_of_a_key).select("_h1", "_h2")
    if often.isEmpty():
        return few
    few = (keyed.join(F.broadcast(often), ["_h1", "_h2"], "left_anti").join(starts, ["_h1", "_h2"])
           .select(*own, (F.col("_start") + copy).cast("bigint").alias(name)))
    one = keyed.join(F.broadcast(often), ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"])
    steps = F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1, F.lit(rows_of_a_key).cast("bigint"))
    blocks = one.join(starts, ["_h1", "_h2"]).withColumn("_from", F.explode(steps))
    many = (blocks.repartition("_h1", "_from").withColumn("_at", F.explode(F.sequence(
        "_from", F.least(F.col("_from") + (rows_of_a_key - 1), F.col("_m") - 1))))
        .select(*own, (F.col("_start") + F.col("_at")).cast("bigint").alias(name)))
    return few.unionByName(many)


def _same_key(a: tuple, b: tuple) -> bool:
    """Group-key equality as grouping sees it: NULL equals NULL, NaN equals NaN."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def changes(batch, columns: list[str]):
    """Where an Arrow batch's row differs from the row before in any of ``columns``, as grouping
    sees it; the first row counts as a change."""
    import numpy as np

    out = np.zeros(batch.num_rows, dtype=bool)
    for g in columns:
        col = batch.column(g)
        valid = ~np.asarray(col.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        vals = col.to_numpy(zero_copy_only=False)
        ne = np.asarray(vals[1:] != vals[:-1], dtype=bool)
        if vals.dtype.kind == "f":
            ne &= ~(np.isnan(vals[1:]) & np.isnan(vals[:-1]))
        both = valid[1:] & valid[:-1]
        out[1:] |= (ne & both) | (valid[1:] != valid[:-1])
    out[:1] = True
    return out


def _group_runs(groups: list[str]):
    """Arrow pass over one sorted task of keys: the rows (``_m`` a key) of its run of equal group
    keys that stand before each key (continuing across batch borders)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last = None     # group key of the previous row (across batches)
        before = 0      # rows of its run so far
        for b in batches:
            n = b.num_rows
            if n == 0:
                yield b.append_column("_gpos", pa.array([], pa.int64()))
                continue
            change = changes(b, groups)
            first = tuple(b.column(g)[0].as_py() for g in groups)
            goes_on = last is not None and _same_key(first, last)      # no groups: one run
            rows = b.column("_m").to_numpy()
            until = np.cumsum(rows) - rows
            start = np.maximum.accumulate(np.where(change, np.arange(n), 0))
            gpos = until - until[start] + np.where(start == 0, before if goes_on else 0, 0)
            before = int(gpos[-1] + rows[-1])
            last = tuple(b.column(g)[n - 1].as_py() for g in groups)
            yield b.append_column("_gpos", pa.array(gpos, pa.int64()))

    return run


def cheapest_first(df: DataFrame, price: str = "price", tie: str = "product_id",
                   partition_by: list[str] | None = None, name: str = "price_rank") -> DataFrame:
    """Cheapest-first position (0-based) per group: price ascending (NULLs
    last), then ``tie`` for a total order."""
    return with_row_index(df, [F.col(price).asc_nulls_last(), F.col(tie).asc_nulls_last()],
                          partition_by, name)


def page_numbers(df: DataFrame, page_size: int, order_by: list[Column | str],
                 partition_by: list[str] | None = None) -> DataFrame:
    """Whole-table paging: ``page_no`` (0-based) and ``pos_in_page`` per group,
    the same rows an offset/limit crawl of ``page_size`` would return."""
    idx = with_row_index(df, order_by, partition_by, "_idx")
    return (idx.withColumn("page_no", F.floor(F.col("_idx") / F.lit(page_size)).cast("bigint"))
               .withColumn("pos_in_page", (F.col("_idx") % F.lit(page_size)).cast("bigint"))
               .drop("_idx"))


def page_slice(df: DataFrame, start: int, size: int, order_by: list[Column | str]) -> DataFrame:
    """One page of a sorted listing: ``ORDER BY … OFFSET start LIMIT size``.

    The limit is the feature here (one page); Spark plans it as a bounded
    top-k per task.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*keys).offset(start).limit(size)


MAX_PAGES = 100_000     # more pages than this are no listing: the pager was misread
PAGE_STEP = 1_000       # pages written out at a time


def expected_pages(df: DataFrame, last_page_col: str = "last_page", default: int = 1,
                   max_pages: int = MAX_PAGES) -> DataFrame:
    """One row per page number 1..last_page (missing last page → ``default``), with
    ``page_error`` NULL.  A last page below 1 gives no row.  One above ``max_pages`` is not
    believed: it gives one row without a page number and with a ``page_error``."""
    last = F.coalesce(F.col(last_page_col), F.lit(default)).cast("bigint")
    error = F.when(F.col("_last") > max_pages, F.concat(F.lit("pager: last page "),
                                                        F.col("_last").cast("string")))
    believed = df.withColumn("_last", last).where("_last >= 1").withColumn("page_error", error)
    # in two steps, so that no row holds a long list
    firsts = F.when(F.col("page_error").isNull(), F.sequence(
        F.lit(1).cast("bigint"), F.least("_last", F.lit(max_pages).cast("bigint")),
        F.lit(PAGE_STEP).cast("bigint")))
    stepped = believed.withColumn("_from", F.explode_outer(firsts))
    step = F.when(F.col("_from").isNotNull(), F.sequence(
        "_from", F.least(F.col("_from") + (PAGE_STEP - 1), "_last")))
    return (stepped.withColumn("page_no", F.explode_outer(step))
            .select(*df.columns, "page_no", "page_error"))


# A listing stored in order -------------------------------------------------------

ROWS_PER_BLOCK = 1_000_000


def store_ordered(df: DataFrame, path: str, order_by: list[Column | str],
                  rows_per_block: int = ROWS_PER_BLOCK) -> None:
    """Store ``df`` with its ``row_index`` in this order, ``rows_per_block`` rows to a directory
    ``block=…``, sorted.  A row's directory follows from its index, so a page needs no look-up."""
    idx = with_row_index(df, order_by, None, "row_index")
    blocks = idx.withColumn("block", F.expr(f"row_index div {int(rows_per_block)}"))
    (blocks.repartition("block").sortWithinPartitions("block", "row_index")
           .write.mode("overwrite").partitionBy("block").parquet(path))


def stored_page(stored: DataFrame, start: int, size: int,
                rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Rows ``start`` to ``start + size`` of a table that ``store_ordered`` wrote, in order: however
    deep the page, only its one or two directories are read, and nothing else is sorted."""
    last = start + size - 1
    here = F.col("block").between(start // rows_per_block, last // rows_per_block)
    return (stored.where(here & F.col("row_index").between(start, last)).drop("block")
            .orderBy("row_index"))
