"""Registered queries: one per operator of the blueprint, each over whole
benchmark tables.  Every function takes ``(spark, sf_dir)`` and returns a
DataFrame whose column names match the SQL check in ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..functions import quantity as Q
from ..functions.price import parse_price
from ..functions.text import (format_column_date, format_dir_date, format_stamp, json_fields,
                              log_fields, parse_column_date, parse_dir_date, parse_stamp, slug,
                              url_key)
from ..operators import extract as X
from ..operators import filters as FL
from ..operators.conform import conform
from ..operators.harmonise import harmonise, unit_price, with_harmonised_index
from ..operators.ordering import cheapest_first as _cheapest, expected_pages as _exp_pages
from ..operators.ordering import page_numbers, page_slice
from ..operators.report import completeness_audit as _audit, parse_log_lines, pipeline_metrics
from ..operators.report import last_pages, missing_pages, run_report as _run_report
from ..operators.stats import describe, null_profile as _null_profile, row_counts as _row_counts
from ..schemas import PAGES_RAW, UNIT_PRICE
from ..session import scratch_path
from ..sources.sinks import write_csv, write_snapshot
from ..sources.snapshots import read_csv_snapshots, read_name_column
from . import driver_inputs as D
from . import tracking

Query = Callable[[SparkSession, str], DataFrame]

# --------------------------------------------------------------------------
# Prices


def q_price_parse(spark, sf):
    t = D.price_texts(D.table(spark, sf, "part"))
    return t.select("p_partkey", "price_text", parse_price("price_text").alias("price"))


def q_drop_missing(spark, sf):
    return FL.drop_missing(q_price_parse(spark, sf).select("p_partkey", "price"))


def q_min_price_filter(spark, sf):
    return FL.min_price(q_price_parse(spark, sf).select("p_partkey", "price"), "price", 950.0)


def q_harmonise(spark, sf):
    return harmonise(D.snapshot_frames(spark, sf))


def q_row_counts(spark, sf):
    fr = D.snapshot_frames(spark, sf)
    u = (fr["r1"].select("source", F.col("cgid").alias("category"))
         .unionByName(fr["r2"].select("source", "category"))
         .unionByName(fr["r3"].select("source", F.col("product_category").alias("category"))))
    return _row_counts(u, ["source", "category"])


def q_row_index(spark, sf):
    return with_harmonised_index(harmonise(D.snapshot_frames(spark, sf), with_rank=True))


def q_lineage_columns(spark, sf):
    part = D.table(spark, sf, "part")
    return part.select("p_partkey", F.lower("p_type").alias("cgid")).withColumns({
        "tracking_date": F.lit(D.RUN_DATE).cast("date"),
        "source": F.lit("R1"),
    })


def q_price_describe(spark, sf):
    li = D.table(spark, sf, "lineitem")
    d = describe(li, "l_extendedprice")
    return _round_stats(d)


def q_price_describe_by_source(spark, sf):
    h = harmonise(D.snapshot_frames(spark, sf))
    return _round_stats(describe(h, "price", ["source"]))


def _round_stats(d: DataFrame) -> DataFrame:
    out = []
    for c in d.columns:
        if c in ("mean", "std", "min", "max", "q25", "q50", "q75"):
            out.append(F.round(c, 6).alias(c))
        else:
            out.append(F.col(c))
    return d.select(*out)


# --------------------------------------------------------------------------
# Pack sizes and unit prices


def _names(spark, sf):
    return D.pack_names(D.table(spark, sf, "part"))


def _flat(df, triple, prefix=""):
    # the triple is one column first, so that it is worked out once
    return df.select("p_partkey", "product_name", triple.alias("t")).select(
        "p_partkey", "product_name", F.col("t.weight_value").alias(f"{prefix}weight_value"),
        F.col("t.weight_unit").alias(f"{prefix}weight_unit"),
        F.col("t.quantity").alias(f"{prefix}quantity"))


def q_parse_quantity(spark, sf):
    n = _names(spark, sf)
    return _flat(n, Q.parse_quantity("product_name"))


def q_qty_weight(spark, sf):
    n = _names(spark, sf)
    return _flat(n, Q.match_weight("product_name"))


def q_qty_multipack(spark, sf):
    n = _names(spark, sf)
    return _flat(n, Q.match_multipack("product_name"))


def q_qty_volume_pack(spark, sf):
    n = _names(spark, sf)
    return _flat(n, Q.match_volume_pack("product_name"))


def q_qty_length(spark, sf):
    n = _names(spark, sf)
    return _flat(n, Q.match_length("product_name"))


def q_qty_units(spark, sf):
    n = _names(spark, sf)
    u, d, p = (Q.match_units("product_name"), Q.match_doses("product_name"),
               Q.match_pairs("product_name"))
    return n.select("p_partkey", "product_name", u.alias("u"), d.alias("d"), p.alias("p")).select(
        "p_partkey", "product_name", F.col("u.weight_unit").alias("unit"),
        F.col("u.quantity").alias("unit_quantity"), F.col("d.quantity").alias("dose_quantity"),
        F.col("p.quantity").alias("pair_quantity"))


def q_qty_dozen(spark, sf):
    n = _names(spark, sf)
    u = Q.match_units("product_name")
    return n.select("p_partkey", u.alias("u")).select(
        "p_partkey", F.col("u.weight_unit").alias("unit"), F.col("u.quantity").alias("quantity"),
        F.col("u.weight_value").alias("items"))


def q_to_base_unit(spark, sf):
    v = D.value_units(D.table(spark, sf, "part"))
    return v.select("p_partkey", "weight_value", "weight_unit",
                    Q.to_base_unit("weight_value", "weight_unit").alias("base_value"))


def q_to_ml(spark, sf):
    v = D.value_units(D.table(spark, sf, "part"))
    return v.select("p_partkey", "weight_value", "weight_unit",
                    Q.to_ml("weight_value", "weight_unit").alias("ml_value"))


def q_standardise_quantity(spark, sf):
    v = D.value_units(D.table(spark, sf, "part"))
    s = Q.standardise(F.struct("weight_value", "weight_unit", "quantity"))
    return v.select("p_partkey", s["weight_value"].alias("std_value"),
                    s["weight_unit"].alias("std_unit"), s["quantity"].alias("std_quantity"))


def q_price_per_unit(spark, sf):
    return unit_price(_names(spark, sf))


# --------------------------------------------------------------------------
# Extraction


def _json_tiles(spark, sf):
    return X.explode_tiles(D.json_tile_pages(spark, sf), "tile_json")


def q_tile_explode(spark, sf):
    return _json_tiles(spark, sf).select("page_id", "tile_pos", "product_url")


def q_extract_json_tiles(spark, sf):
    t = X.type_tile_json(_json_tiles(spark, sf))
    return t.select("page_id", "tile_pos", "product_id", "product_name", "price", "brand",
                    "category_name", "image_url", "unit_price_raw", "min_quantity", "product_url")


NODE_TEXT = specs.TileLayout(
    name="node_text",
    tile=specs.TILE_JSON.tile,
    picks=(specs.Pick("text_tight", (specs.Step("div", "pwc-tile--price-secondary"),), "tight"),
           specs.Pick("text_ends", (specs.Step("div", "pwc-tile--price-secondary"),), "text")),
)


def q_node_text(spark, sf):
    t = X.explode_tiles(D.json_tile_pages(spark, sf), NODE_TEXT)
    return t.select("page_id", "tile_pos", "text_tight", "text_ends")


def _attr_tiles(spark, sf):
    return X.extract_products(D.attr_tile_pages(spark, sf), "tile_attr")


def q_extract_attr_tiles(spark, sf):
    t = _attr_tiles(spark, sf)
    return t.select("page_id", "tile_pos", "product_id", "product_name", "price",
                    "category_l1", "category_l2", "category_l3", "image_url", "rating",
                    "promotion", F.size("labels").cast("bigint").alias("n_labels"),
                    "parse_error")


def q_label_explode(spark, sf):
    t = _attr_tiles(spark, sf)
    return t.select("product_id", F.posexplode_outer("labels").alias("label_pos", "label")).select(
        "product_id", F.col("label_pos").cast("bigint").alias("label_pos"),
        F.col("label.alt").alias("alt"), F.col("label.title").alias("title"))


def q_labels_to_json(spark, sf):
    t = _attr_tiles(spark, sf)
    return t.select("product_id", F.to_json("labels").alias("labels_json"))


def q_extract_cards(spark, sf):
    t = X.extract_products(D.card_pages(spark, sf), "card")
    return t.select("page_id", "tile_pos", "product_id", "product_name", "price",
                    "image_url", "rating")


def q_category_levels(spark, sf):
    s = D.table(spark, sf, "supplier")
    n = D.table(spark, sf, "nation")
    r = D.table(spark, sf, "region")
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    js = F.to_json(F.struct(F.col("r_name").alias("item_category"),
                            F.col("n_name").alias("item_category2"),
                            F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("item_category3")))
    c = json_fields(js, specs.CATEGORY_JSON_FIELDS)
    return j.select("s_suppkey", c["item_category"].alias("category_l1"),
                    c["item_category2"].alias("category_l2"),
                    c["item_category3"].alias("category_l3"))


def q_nutrition_record(spark, sf):
    n = X.nutrition(D.nutrition_pages(spark, sf))
    return n.select("p_partkey", "reference_intake", "serving_size", "uom",
                    F.size("nutrients").cast("bigint").alias("n_nutrients"),
                    F.size("description").cast("bigint").alias("n_description"))


def q_nutrient_rows(spark, sf):
    n = X.nutrition(D.nutrition_pages(spark, sf))
    return n.select("p_partkey", F.posexplode("nutrients").alias("pos", "r")).select(
        "p_partkey", F.col("pos").cast("bigint").alias("pos"),
        F.col("r.nutrient").alias("nutrient"), F.col("r.quantity").alias("quantity"),
        F.col("r.unit").alias("unit"))


def q_description_entries(spark, sf):
    n = X.nutrition(D.nutrition_pages(spark, sf))
    return n.select("p_partkey", F.explode("description").alias("key", "value"))


def q_expected_count(spark, sf):
    p = X.spread_pages(D.counter_pages(spark, sf), ["category"])
    return p.select("category", X.expected_count("html").alias("expected_total"))


def q_last_page(spark, sf):
    p = X.spread_pages(D.pager_pages_html(spark, sf), ["category"])
    lp = X.last_page("html")
    return p.select("category", lp.alias("last_page_raw"),
                    F.coalesce(lp, F.lit(1).cast("bigint")).alias("last_page"))


def q_expected_pages(spark, sf):
    p = X.spread_pages(D.pager_pages_html(spark, sf), ["category"]).select(
        "category", X.last_page("html").alias("last_page"))
    return _exp_pages(p).select("category", "page_no", "page_error")


def q_page_links(spark, sf):
    return X.page_links(D.table(spark, sf, "pages"), ["page_id"])


def q_landed_pages(spark, sf):
    p = D.table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    segment = F.regexp_extract("url", r"^https?://[^/?#]+/([^/?#]+)", 1)
    page_no = F.coalesce(F.regexp_extract("url", r"[?&]page=(\d+)", 1).try_cast("int"), F.lit(1))
    return p.select("page_id", host.alias("source"), segment.alias("category"),
                    page_no.alias("page_no"), F.length("html").cast("bigint").alias("n_chars"))


def q_url_key(spark, sf):
    p = D.table(spark, sf, "pages")
    return p.select("page_id", url_key("url").alias("url_key"))


def q_slug(spark, sf):
    p = D.table(spark, sf, "part")
    return p.select("p_partkey", slug(F.concat(F.col("p_name"), F.lit(": "), F.col("p_type")))
                    .alias("slug"))


# --------------------------------------------------------------------------
# Filters, ordering, paging


def q_attr_filter(spark, sf):
    p = D.table(spark, sf, "part")
    return FL.attr_equals(p, "p_brand", "Brand#12").select("p_partkey", "p_brand")


def q_category_filter(spark, sf):
    p = D.table(spark, sf, "part").withColumn("category", F.lower("p_type"))
    return FL.categories(p, ["small", "promo"]).select("p_partkey", "category")


def _priced(spark, sf):
    p = D.table(spark, sf, "part")
    return p.select(F.lower("p_type").alias("category"), "p_partkey",
                    F.col("p_retailprice").alias("price"))


def q_cheapest_first(spark, sf):
    return _cheapest(_priced(spark, sf), "price", "p_partkey", ["category"])


def q_page_slice(spark, sf):
    return page_numbers(_priced(spark, sf), specs.PAGE_SIZE_TILE_ATTR,
                        [F.col("price").asc(), F.col("p_partkey").asc()], ["category"])


def q_page_offset(spark, sf):
    return page_slice(_priced(spark, sf), specs.PAGE_SIZE_TILE_ATTR, specs.PAGE_SIZE_TILE_ATTR,
                      [F.col("price").asc(), F.col("p_partkey").asc()])


# --------------------------------------------------------------------------
# Schemas, profiles, dates, files


EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, promo string"


def q_conform_schema(spark, sf):
    from pyspark.sql.types import _parse_datatype_string
    return conform(D.table(spark, sf, "events"), _parse_datatype_string(EVENT_SCHEMA))


def q_null_profile(spark, sf):
    d = D.table(spark, sf, "documents")
    lab = D.table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return _null_profile(j, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])


def q_snapshot_date_parse(spark, sf):
    li = D.table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        parse_dir_date(format_dir_date("l_shipdate")).alias("d_dir"),
        parse_column_date(format_column_date("l_shipdate")).alias("d_col"),
        F.date_format(parse_stamp(format_stamp("l_shipdate")),
                      "yyyy-MM-dd HH:mm:ss").alias("observed_at"))


def q_snapshot_roundtrip(spark, sf):
    rows = D.product_snapshot_rows(spark, sf)
    path = scratch_path(spark, "snapshot")
    write_snapshot(rows, path)
    # Re-land one day of one source: dynamic overwrite replaces only those
    # partitions and leaves every other one in place.
    write_snapshot(rows.where((F.col("source") == "r2")
                              & (F.col("snapshot_date") == F.lit(D.RUN_DATE).cast("date"))), path)
    back = spark.read.parquet(path)
    return back.select("source", "snapshot_date", "category", "product_id", "product_name", "price")


def q_scan_union_csv(spark, sf):
    rows = D.r2_csv_rows(spark, sf)
    path = scratch_path(spark, "csv")
    write_csv(rows, path, ["snapshot_dir", "category_file"])
    back = read_csv_snapshots(spark, path, "r2")
    return back.select("product_id", "product_name", "product_price", "source", "timestamp",
                       "snapshot_date", "category")


def q_log_fields(spark, sf):
    lines = D.log_lines(spark, sf)
    return lines.select("event_id", *log_fields("value"))


def _stored(spark, pages: DataFrame) -> DataFrame:
    """The constructed pages stand in for a stored pages_raw table: written
    once as Parquet, then read by both branches, each its own columns."""
    path = scratch_path(spark, "pages")
    pages.write.parquet(path)
    return spark.read.schema(pages.schema).parquet(path)


def q_run_report(spark, sf):
    pages = _stored(spark, D.attr_tile_pages(spark, sf, with_category=True))
    tiles = X.extract_products(pages, "tile_attr")
    return _run_report(pages, tiles, ["category"], "page_id")


def q_completeness_audit(spark, sf):
    pages = _stored(spark, D.audit_pages(spark, sf))
    tiles = X.explode_tiles(pages, "tile_json", keys=["category", "page_start"])
    return _audit(pages, tiles, ["category"], "page_start", specs.PAGE_SIZE_TILE_JSON)


def q_ingest_snapshot(spark, sf):
    """The ingest job end to end: landed pages of all three layouts →
    canonical product_snapshot rows."""
    from ..plans.ingest import build_product_snapshot
    from ..schemas import PAGES_RAW
    day = F.lit(D.RUN_DATE).cast("date")

    def landed(df, source, numbered):
        pid = F.col("page_id").cast("int")
        none = F.lit(None).cast("int")
        return df.select(F.lit(source).alias("source"), F.lit("catalogue").alias("category"),
                         day.alias("snapshot_date"),
                         (pid if numbered else none).alias("page_no"),
                         (none if numbered else pid).alias("page_start"), "html")

    pages = (landed(D.json_tile_pages(spark, sf), "r1", False)
             .unionByName(landed(D.card_pages(spark, sf), "r2", True))
             .unionByName(landed(D.attr_tile_pages(spark, sf), "r3", False)))
    snap = build_product_snapshot(conform(pages, PAGES_RAW), run_stamp="20241113_173405")
    n_cat = F.when(F.col("category_path").isNull(), F.lit(0)).otherwise(F.size("category_path"))
    return snap.select(
        "source", "category", "snapshot_date",
        F.coalesce("page_no", "page_start").cast("bigint").alias("page"),
        "product_id", "product_name", "price", "unit_price_raw", "image_url", "product_url",
        "rating", "promotion", "parse_error",
        F.try_element_at("category_path", F.lit(1)).alias("category_l1"),
        n_cat.cast("bigint").alias("n_categories"),
        F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss").alias("observed_at"))


def q_harmonise_snapshot(spark, sf):
    """Landed pages → product_snapshot → harmonised (name, price, source)."""
    from ..operators.harmonise import harmonise_products
    from ..plans.ingest import build_product_snapshot
    from ..schemas import PAGES_RAW
    day = F.lit(D.RUN_DATE).cast("date")

    def landed(df, source):
        return df.select(F.lit(source).alias("source"), F.lit("catalogue").alias("category"),
                         day.alias("snapshot_date"), F.col("page_id").cast("int").alias("page_no"),
                         F.lit(None).cast("int").alias("page_start"), "html")

    pages = (landed(D.json_tile_pages(spark, sf), "r1")
             .unionByName(landed(D.card_pages(spark, sf), "r2"))
             .unionByName(landed(D.attr_tile_pages(spark, sf), "r3")))
    return harmonise_products(build_product_snapshot(conform(pages, PAGES_RAW)))


def q_min_price_pushed(spark, sf):
    """Over a stored numeric price: the predicate reaches the Parquet scan."""
    part = D.table(spark, sf, "part")
    return FL.min_price(part.select("p_partkey", F.col("p_retailprice").alias("price")), "price", 950.0)


def q_category_pruned(spark, sf):
    """Over a table stored by category: the list prunes directories."""
    path = scratch_path(spark, "by-category")
    write_snapshot(D.table(spark, sf, "part").select(
        "p_partkey", "p_retailprice", F.lower("p_type").alias("category")), path, ["category"])
    return FL.categories(spark.read.parquet(path), ["small", "promo"]).select("p_partkey", "category")


def q_scan_union_drift(spark, sf):
    """CSV files of many shapes under one folder, read as one table; a file with a foreign header
    is one row with an error."""
    path = scratch_path(spark, "csv-drift")
    for i, rows in enumerate(D.drifted_csv_rows(spark, sf)):
        write_csv(rows, f"{path}/{i}", ["snapshot_dir", "category_file"])
    folder = ["snapshot_dir", "category_file"]
    (D.odd_csv_lines(spark, sf).repartition(*folder).sortWithinPartitions(*folder, "at").drop("at")
     .write.option("sep", "\u0001").option("quote", "\u0002").option("emptyValue", "")
     .partitionBy(*folder).csv(f"{path}/odd"))
    back = read_csv_snapshots(spark, path, "r2", error_rows=True)
    return back.select("product_id", "product_name", "product_price", "product_rating", "source",
                       "timestamp", "snapshot_date", "category", "file_error")


def q_name_column(spark, sf):
    path = scratch_path(spark, "csv-names")
    write_csv(D.r2_csv_rows(spark, sf), path, ["snapshot_dir", "category_file"])
    return read_name_column(spark, path, "r2")


def q_unit_price_job(spark, sf):
    """The unit-price job: CSV folder in, Parquet table out."""
    from .jobs import run_unit_price
    path, out = scratch_path(spark, "csv-packs"), scratch_path(spark, "unit-price")
    write_csv(D.pack_csv_rows(spark, sf), path, ["snapshot_dir", "category_file"])
    run_unit_price(spark, path, "r2", out)
    return spark.read.schema(UNIT_PRICE).parquet(out)


def q_pages_roundtrip(spark, sf):
    """Raw pages landed in ``pages_raw``, one retailer's twice, and read back."""
    from ..sources.pages import read_pages_table
    from ..sources.sinks import write_pages
    pages, path = conform(D.mixed_landing(spark, sf), PAGES_RAW), scratch_path(spark, "pages-raw")
    write_pages(pages, path)
    write_pages(pages.where(F.col("source") == "elsewhere"), path)
    back = read_pages_table(spark, path)
    return back.select("source", "category", "snapshot_date", "page_start",
                       F.when(F.col("category") != "catalogue", F.length("html")).cast("bigint")
                       .alias("n_chars"))


def q_ingest_run_report(spark, sf):
    """The ingest of a day with unreadable pages and an unknown retailer."""
    from .ingest import build_product_snapshot
    pages = _stored(spark, conform(D.mixed_landing(spark, sf), PAGES_RAW))
    return _run_report(pages, build_product_snapshot(pages), ["source", "category"], "page_start")


def q_completeness_by_pager(spark, sf):
    pages = _stored(spark, D.pager_audit_pages(spark, sf))
    tiles = X.explode_tiles(pages, "card", keys=["category", "page_no"])
    return _audit(pages, tiles, ["category"], "page_no", D.TILES_PER_PAGE)


def q_completeness_by_short_page(spark, sf):
    pages = _stored(spark, D.short_page_audit_pages(spark, sf))
    tiles = X.explode_tiles(pages, "tile_attr", keys=["category", "page_start"])
    return _audit(pages, tiles, ["category"], "page_start", D.TILES_PER_PAGE)


def q_missing_pages(spark, sf):
    """Listings of all three crawl styles: by the counter, by the pager, by a short last page."""
    parts = []
    for style, pages, layout, size, start in (
            ("counter", D.audit_pages(spark, sf), "tile_json", specs.PAGE_SIZE_TILE_JSON, "page_start"),
            ("pager", D.pager_audit_pages(spark, sf), "card", D.TILES_PER_PAGE, None),
            ("short", D.short_page_audit_pages(spark, sf), "tile_attr", D.TILES_PER_PAGE, "page_start")):
        number = F.expr(f"{start} div {size} + 1").cast("int") if start else F.col("page_no")
        pages = _stored(spark, pages.select(F.lit(style).alias("style"), "category",
                                            number.alias("page_no"), "html"))
        keys = ["style", "category"]
        tiles = X.explode_tiles(pages, layout, keys=[*keys, "page_no"])
        last = last_pages(pages, tiles, keys, "page_no", size)
        parts.append(missing_pages(tiles.where("tile_pos is not null"), keys, "page_no", last))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_pipeline_metrics(spark, sf):
    """Metrics of the day's CSV folders and of the run's log."""
    path = scratch_path(spark, "csv-metrics")
    write_csv(D.r2_csv_rows(spark, sf), path, ["snapshot_dir", "category_file"])
    rows = read_csv_snapshots(spark, path, "r2")
    log = parse_log_lines(D.log_lines(spark, sf))
    return pipeline_metrics(rows, ["file_path"], log,
                            ["product_id", "product_name", "product_rating"])


QUERIES: dict[str, Query] = {
    "price_parse": q_price_parse,
    "drop_missing": q_drop_missing,
    "min_price_filter": q_min_price_filter,
    "harmonise": q_harmonise,
    "row_counts": q_row_counts,
    "row_index": q_row_index,
    "lineage_columns": q_lineage_columns,
    "price_describe": q_price_describe,
    "price_describe_by_source": q_price_describe_by_source,
    "parse_quantity": q_parse_quantity,
    "qty_weight": q_qty_weight,
    "qty_multipack": q_qty_multipack,
    "qty_volume_pack": q_qty_volume_pack,
    "qty_length": q_qty_length,
    "qty_units": q_qty_units,
    "qty_dozen": q_qty_dozen,
    "to_base_unit": q_to_base_unit,
    "to_ml": q_to_ml,
    "standardise_quantity": q_standardise_quantity,
    "price_per_unit": q_price_per_unit,
    "tile_explode": q_tile_explode,
    "extract_json_tiles": q_extract_json_tiles,
    "node_text": q_node_text,
    "extract_attr_tiles": q_extract_attr_tiles,
    "label_explode": q_label_explode,
    "labels_to_json": q_labels_to_json,
    "extract_cards": q_extract_cards,
    "category_levels": q_category_levels,
    "nutrition_record": q_nutrition_record,
    "nutrient_rows": q_nutrient_rows,
    "description_entries": q_description_entries,
    "expected_count": q_expected_count,
    "last_page": q_last_page,
    "expected_pages": q_expected_pages,
    "page_links": q_page_links,
    "landed_pages": q_landed_pages,
    "url_key": q_url_key,
    "slug": q_slug,
    "attr_filter": q_attr_filter,
    "category_filter": q_category_filter,
    "cheapest_first": q_cheapest_first,
    "page_slice": q_page_slice,
    "page_offset": q_page_offset,
    "conform_schema": q_conform_schema,
    "null_profile": q_null_profile,
    "snapshot_date_parse": q_snapshot_date_parse,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "scan_union_csv": q_scan_union_csv,
    "log_fields": q_log_fields,
    "run_report": q_run_report,
    "completeness_audit": q_completeness_audit,
    "ingest_snapshot": q_ingest_snapshot,
    "harmonise_snapshot": q_harmonise_snapshot,
    "min_price_pushed": q_min_price_pushed,
    "category_pruned": q_category_pruned,
    "scan_union_drift": q_scan_union_drift,
    "name_column": q_name_column,
    "unit_price_job": q_unit_price_job,
    "pages_roundtrip": q_pages_roundtrip,
    "ingest_run_report": q_ingest_run_report,
    "completeness_by_pager": q_completeness_by_pager,
    "completeness_by_short_page": q_completeness_by_short_page,
    "missing_pages": q_missing_pages,
    "pipeline_metrics": q_pipeline_metrics,
    **tracking.QUERIES,
}
