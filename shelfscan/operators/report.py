"""Run status, completeness audit and log-line fields.

These replace the crawlers' control flow (stop at a short page, loop to the
last page, log "fetched k of n") with group-bys over what actually landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LOG_TIME_FORMAT, log_fields, max_grouped_number
from ..session import ship_package
from .extract import head_facts
from .ordering import materialize, with_row_index


def _n_tiles(tiles: DataFrame) -> F.Column:
    """Rows that are tiles: a page that could not be read has no position."""
    return F.count("tile_pos" if "tile_pos" in tiles.columns else F.lit(1))


def _n_unreadable(tiles: DataFrame) -> F.Column:
    """Rows that stand for a page that could not be read."""
    if not {"tile_pos", "parse_error"} <= set(tiles.columns):
        return F.sum(F.lit(0))
    return F.count_if(F.col("tile_pos").isNull() & F.col("parse_error").isNotNull())


def run_report(pages: DataFrame, tiles: DataFrame, keys: list[str],
               page_key: str) -> DataFrame:
    """Per ``keys`` group: pages landed, rows extracted, rows with a parse
    error, and a status — ``error`` (some row or page could not be read),
    ``empty`` (no rows) or ``saved``.

    ``pages`` has one row per landed page (``keys`` + ``page_key``); ``tiles``
    one row per extracted tile with the same columns and ``parse_error``.
    """
    p = pages.groupBy(*keys).agg(F.countDistinct(page_key).alias("n_pages"))
    t = tiles.groupBy(*keys).agg(
        _n_tiles(tiles).alias("n_rows"),
        F.count_if(F.col("parse_error").isNotNull()).alias("n_errors"))
    cond = [p[k].eqNullSafe(t[k]) for k in keys]
    j = p.join(t, on=cond, how="left")
    rows = F.coalesce(t["n_rows"], F.lit(0)).cast("bigint")
    errs = F.coalesce(t["n_errors"], F.lit(0)).cast("bigint")
    status = (F.when(errs > 0, F.lit("error")).when(rows == 0, F.lit("empty"))
              .otherwise(F.lit("saved")))
    return j.select(*[p[k] for k in keys], p["n_pages"].cast("bigint").alias("n_pages"),
                    rows.alias("n_rows"), errs.alias("n_errors"), status.alias("status"))


def _heads(pages: DataFrame, keys: list[str], page_key: str, first_page: Column | None = None,
           html_col: str = "html") -> DataFrame:
    """``expected_total, last_page, _error`` per group, read from first pages only."""
    ship_package(pages.sparkSession)
    fp = first_page if first_page is not None else (F.col(page_key) <= F.lit(1))
    facts = head_facts(F.col(html_col))
    return (pages.where(fp)
            .select(*keys, max_grouped_number(facts["counter"]).alias("_exp"),
                    F.try_element_at(facts["pager"], F.lit(-1)).try_cast("bigint").alias("_last"),
                    facts["parse_error"].alias("_error"))
            .groupBy(*keys).agg(F.max("_exp").alias("expected_total"),
                                F.max("_last").alias("last_page"), F.max("_error").alias("_error")))


def last_pages(pages: DataFrame, tiles: DataFrame, keys: list[str], page_col: str,
               page_size: int) -> DataFrame:
    """``keys, last_page``: the number of each listing's last page (pages count from 1), by its
    counter, else its pager, else its last landed page if that is short; NULL if none tells."""
    heads = _heads(pages, keys, page_col)
    rows = tiles.groupBy(*keys, page_col).agg(_n_tiles(tiles).alias("_rows"))
    got = rows.groupBy(*keys).agg(F.max(page_col).cast("bigint").alias("_max"),
                                  F.max_by("_rows", page_col).alias("_last_rows"))
    groups = pages.select(*keys).distinct()
    j = groups
    for other in (heads, got):
        names = {k: f"_{i}" for i, k in enumerate(keys)}
        right = other.withColumnsRenamed(names)
        j = j.join(right, [j[k].eqNullSafe(right[n]) for k, n in names.items()], "left").drop(*names.values())
    return j.select(*keys, F.coalesce(
        F.ceil(F.col("expected_total") / page_size), "last_page",
        F.when(F.col("_last_rows") < page_size, F.col("_max"))).alias("last_page"))


def completeness_audit(pages: DataFrame, tiles: DataFrame, keys: list[str], page_key: str,
                       page_size: int, first_page: F.Column | None = None,
                       html_col: str = "html") -> DataFrame:
    """Expected versus fetched, per ``keys`` group, for all three crawl styles.

    * ``expected_total`` — the result counter of the group's first page, thousands marks read;
    * ``last_page`` — the last pager entry of the first page;
    * ``fetched_rows`` / ``n_pages`` — what landed and was extracted;
    * ``progress`` — ``least(fetched, expected)`` (the "k of n" of a crawl);
    * ``short_pages`` — landed pages holding fewer than ``page_size`` rows (a
      crawl stops at the first one);
    * ``missing_rows`` and ``complete`` — by the counter: just as many rows as it
      says (a surplus, a negative number of missing rows, means that the listing changed
      while it was fetched); without one by the pager: as many pages as it says; without
      either by the last landed page: a short one ends a listing.  A group with a page
      that could not be read is never complete.

    ``first_page`` tells first pages; by default offset 0 or page number 1.  The
    counter and pager are read only from first pages, so the markup is
    parsed once more for one page per group, not for every page.
    """
    heads = _heads(pages, keys, page_key, first_page, html_col)
    per_page = tiles.groupBy(*keys, page_key).agg(_n_tiles(tiles).alias("_rows"),
                                                      _n_unreadable(tiles).alias("_bad"))
    landed = pages.select(*keys, page_key).distinct()
    cond_p = [landed[k].eqNullSafe(per_page[k]) for k in keys + [page_key]]
    pg = landed.join(per_page, on=cond_p, how="left").select(
        *[landed[k] for k in keys], landed[page_key],
        F.coalesce(per_page["_rows"], F.lit(0)).alias("_rows"),
        F.coalesce(per_page["_bad"], F.lit(0)).alias("_bad"))
    got = pg.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("_rows").cast("bigint").alias("fetched_rows"),
        F.max_by("_rows", page_key).alias("_last_rows"),
        F.count_if(F.col("_rows") < F.lit(page_size)).alias("short_pages"),
        F.sum("_bad").alias("_bad"))
    cond = [got[k].eqNullSafe(heads[k]) for k in keys]
    j = got.join(heads, on=cond, how="left")
    exp, last = heads["expected_total"], heads["last_page"]
    readable = (got["_bad"] == 0) & heads["_error"].isNull()
    complete = (F.when(~readable, F.lit(False)).when(exp.isNotNull(), got["fetched_rows"] == exp)
                .when(last.isNotNull(), got["n_pages"] == last)
                .otherwise(got["_last_rows"] < F.lit(page_size)))
    return j.select(
        *[got[k] for k in keys],
        exp.cast("bigint").alias("expected_total"),
        heads["last_page"].cast("bigint").alias("last_page"),
        got["n_pages"].cast("bigint").alias("n_pages"),
        got["fetched_rows"],
        F.least(got["fetched_rows"], exp).cast("bigint").alias("progress"),
        got["short_pages"].cast("bigint").alias("short_pages"),
        (exp - got["fetched_rows"]).cast("bigint").alias("missing_rows"),
        complete.alias("complete"))


def missing_pages(landed: DataFrame, keys: list[str], page_col: str = "page_no",
                  last: DataFrame | None = None, last_col: str = "last_page") -> DataFrame:
    """Pages that should have landed and did not, as ranges: ``keys, from_page, to_page``.

    ``landed`` has a row per landed page (numbers from 1; others and NULL are not pages), ``last``
    the number of the last page per group.  A group that landed nothing misses all its pages; one
    whose last page is unknown (NULL, or not in ``last``) misses the pages between landed ones, and
    those after the last landed one with an open end (``to_page`` NULL).  Pages beyond the last
    one count for nothing.

    No range is written out page by page, so a pager that names a huge page number costs one
    row.  A range begins after a page whose next one is missing and ends before one whose previous
    one is: both come from an anti join on (group, page).  The i-th beginning of a group belongs
    to its i-th end; a group with very many ranges is numbered by several tasks.
    """
    names = {k: f"_k{i}" for i, k in enumerate(keys)}

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed(names)

    def match(a: DataFrame, b: DataFrame) -> list[Column]:
        return [a[k].eqNullSafe(b[n]) for k, n in names.items()]

    unknown = F.lit(None).cast("bigint").alias("_end")
    groups = landed.select(*keys, unknown)
    if last is not None:
        groups = groups.unionByName(last.select(*keys, F.col(last_col).cast("bigint").alias("_end")))
    groups = groups.groupBy(*keys).agg(F.max("_end").alias("_end")).where("_end is null or _end >= 1")
    page = landed.select(*keys, F.col(page_col).cast("bigint").alias("_p")).where("_p >= 1").distinct()
    of = renamed(groups)
    there = page.join(of, match(page, of)).where("_end is null or _p <= _end").select(*keys, "_p", "_end")
    # page 0 stands before every listing, and a page after the last one behind it
    border = groups.select(*keys, F.explode(F.array(F.lit(0).cast("bigint"), F.col("_end") + 1))
                           .alias("_p"), "_end").where("_p is not null")
    pages = materialize(there.unionByName(border))
    at = renamed(pages.select(*keys, F.col("_p").alias("_q")))

    def alone(step: int) -> DataFrame:
        return pages.join(at, [*match(pages, at), pages["_p"] + step == at["_q"]], "left_anti")

    starts = alone(1).where("_end is null or _p < _end").select(*keys, (F.col("_p") + 1).alias("from_page"))
    stops = alone(-1).where("_p > 1").select(*keys, (F.col("_p") - 1).alias("to_page"))
    a = with_row_index(starts, ["from_page"], keys, "_i")
    b = renamed(with_row_index(stops, ["to_page"], keys, "_j"))
    return a.join(b, [*match(a, b), a["_i"] == b["_j"]], "left").select(*keys, "from_page", "to_page")


def pipeline_metrics(rows: DataFrame, file_keys: list[str], log: DataFrame,
                     columns: list[str] | None = None) -> DataFrame:
    """One row about a run: ``n_files`` (different ``file_keys``: the files' paths), ``n_rows``,
    ``n_null`` (missing values in ``columns``) and ``elapsed_s`` (from the first
    to the last record of the run's log, whose lines ``parse_log_lines`` split)."""
    cols = columns or rows.columns
    nulls = [F.count_if(F.col(f"`{c}`").isNull()) for c in cols]
    total = nulls[0]
    for n in nulls[1:]:
        total = total + n
    # distinct files first, so that no key's rows meet in one task
    files = rows.select(*file_keys).distinct().agg(F.count(F.lit(1)).alias("n_files"))
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("n_null"))
    at = F.unix_millis(F.try_to_timestamp(F.col("logged_at"), F.lit(LOG_TIME_FORMAT)))
    span = log.agg(((F.max(at) - F.min(at)) / 1000.0).alias("elapsed_s"))
    return files.join(counts, on=F.lit(True)).join(span, on=F.lit(True))


IDLE_GAP = "30 minutes"


def log_runs(log: DataFrame, gap: str = IDLE_GAP, keys: list[str] | None = None) -> DataFrame:
    """The runs that a log holds, one row each: ``keys, run_start, run_end, elapsed_s, n_records,
    n_errors``.  A run ends when nothing is logged for longer than
    ``gap``; lines without a time (tracebacks)
    belong to none.

    Records are counted per ``gap``-wide slot of time first, combined before the shuffle, so the
    session window sees one row a slot and not the log: records of one slot are of one run.
    """
    keys = keys or []
    at = F.try_to_timestamp(F.col("logged_at"), F.lit(LOG_TIME_FORMAT))
    slots = (log.withColumn("_at", at).where("_at is not null")
             .groupBy(*keys, F.window("_at", gap).alias("_slot"))
             .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n"),
                  F.count_if(F.col("level") == "ERROR").alias("_errors")).drop("_slot"))
    span = "cast((unix_micros(_last) - unix_micros(_first)) / 1000000 as decimal(18, 6))"
    until = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, {span}) + cast('{gap}' as interval)")
    runs = slots.groupBy(*keys, F.session_window("_first", until).alias("_run")).agg(
        F.min("_first").alias("run_start"), F.max("_last").alias("run_end"),
        F.sum("_n").alias("n_records"), F.sum("_errors").alias("n_errors"))
    elapsed = (F.unix_millis("run_end") - F.unix_millis("run_start")) / 1000.0
    return runs.select(*keys, "run_start", "run_end", elapsed.alias("elapsed_s"), "n_records", "n_errors")


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split ``asctime - name - level - file:line - func - message`` lines."""
    return lines.select(*log_fields(col))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Read log files (any Hadoop path/glob) and split their fields."""
    return parse_log_lines(spark.read.text(path))
