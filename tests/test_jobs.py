"""End-to-end jobs: landed pages → product_snapshot (batch and incremental),
snapshot folders → harmonised table + describe, unit-price table, reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscan.operators import extract as X
from shelfscan.operators.report import completeness_audit, run_report
from shelfscan.plans import ingest, jobs
from shelfscan.schemas import PAGES_RAW, PRODUCT_SNAPSHOT
from shelfscan.streaming.incremental import start_incremental_ingest


def r1_tile(i, name, price):
    js = (f'{{&quot;name&quot;:&quot;{name}&quot;,&quot;id&quot;:&quot;{i}&quot;,'
          f'&quot;price&quot;:{price},&quot;brand&quot;:&quot;B&quot;,&quot;category&quot;:&quot;Frescos&quot;}}')
    return (f'<div class="product-tile" data-product-tile-impression="{js}"><a href="/p/{i}">x</a>'
            f'<div class="pwc-tile--price-secondary">{str(price).replace(".", ",")}€/kg</div></div>')


def r2_card(slug, name, price):
    return (f'<div class="product-cards"><a class="product-cards__link" href="https://s/p/{slug}/">'
            f'<h3 class="product-cards__title">{name}</h3></a>'
            f'<span class="product-cards_price">{price}€ / UN</span>'
            f'<img class="product-cards__image" src="https://i/{slug}.jpg"></div>')


def r3_tile(pid, name, price):
    return (f'<div class="product" data-pid="{pid}"><div class="product-tile" data-urls="u" '
            f'data-gtm-new="{{&quot;item_category&quot;:&quot;A&quot;}}">'
            f'<div class="image-container"><img src="i.png"></div>'
            f'<div class="pdp-link"><a>{name}</a></div><span class="value" content="{price}"></span>'
            f'<div class="auc-product-tile__bazaarvoice--ratings" data-bv-product-id="{pid}"></div>'
            f'</div></div>')


def counter(n):
    return ('<div class="search-results-products-counter d-flex justify-content-center">'
            f'{n} produtos</div>')


def landed(spark):
    d = dt.date(2024, 11, 13)
    rows = [
        ("r1", "frescos", d, 1, 0, counter(3) + r1_tile(1, "Queijo 200g", 2.49) + r1_tile(2, "Fiambre", 1.99)),
        ("r1", "frescos", d, 2, 2, r1_tile(3, "Manteiga 250 g", 1.5)),
        ("r2", "refeicoes", d, 1, None, r2_card("lasanha-1kg", "Lasanha 1kg", "4,49")),
        ("r3", "saude/acne/", d, None, 0, r3_tile("P1", "Gel 200 ml", "7.99") + r3_tile("P2", "Creme", "x")),
    ]
    return spark.createDataFrame(rows, PAGES_RAW)


def test_ingest_batch(spark, tmp_path):
    pages_path = str(tmp_path / "pages")
    landed(spark).write.partitionBy("source", "snapshot_date").parquet(pages_path)
    out = str(tmp_path / "snap")
    ingest.run(spark, pages_path, out, run_stamp="20241113_173405")
    snap = spark.read.parquet(out)
    rows = {r.product_id: r for r in snap.collect()}
    assert set(rows) == {"1", "2", "3", "lasanha-1kg", "P1", "P2"}
    assert rows["1"].price == 2.49 and rows["1"].unit_price_raw == "2,49€/kg"
    assert rows["lasanha-1kg"].price == 4.49 and rows["lasanha-1kg"].source == "r2"
    assert rows["P1"].category == "saude/acne/" and rows["P1"].category_path == ["A"]
    assert rows["P2"].price is None                       # "x" is not a number
    assert rows["1"].observed_at == dt.datetime(2024, 11, 13, 17, 34, 5)
    assert set(snap.columns) == set(PRODUCT_SNAPSHOT.names)
    # filters reach the scan: partition pruning and pushed price predicate
    plan = snap.where((F.col("source") == "r2") & (F.col("price") >= 0.01))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters: [IsNotNull(price), GreaterThanOrEqual(price,0.01)]" in plan


def test_reports_over_landed_pages(spark):
    pages = landed(spark).where("source = 'r1'")
    tiles = X.explode_tiles(pages, "tile_json")
    audit = completeness_audit(pages, tiles, ["source", "category"], "page_start", 2).first()
    assert (audit.expected_total, audit.fetched_rows, audit.n_pages, audit.short_pages,
            audit.complete) == (3, 3, 2, 1, True)
    allp = landed(spark)
    r3 = X.extract_products(allp.where("source = 'r3'"), "tile_attr")
    rep = {r.category: r for r in run_report(allp.where("source = 'r3'"), r3, ["category"],
                                             "page_start").collect()}
    assert rep["saude/acne/"].status == "saved" and rep["saude/acne/"].n_rows == 2


def test_harmonise_and_unit_price_jobs(spark, tmp_path):
    hdr = "product_id,product_name,product_price,product_image,product_url,product_rating,source,timestamp\n"
    d = tmp_path / "r2" / "20241113"
    d.mkdir(parents=True)
    (d / "refeicoes.csv").write_text(hdr + 'a,Lasanha 1kg,"4,49€ / UN",,,,r2,20241113_101500\n'
                                           'b,Sopa 500 ml,"1,00€ / UN",,,,r2,20241113_101500\n',
                                     encoding="utf-8")
    stats = jobs.run_harmonise(spark, {"r2": str(tmp_path / "r2")}, str(tmp_path / "h"))
    s = stats.first()
    assert s["count"] == 2 and s["q50"] == pytest.approx(2.745)
    jobs.run_unit_price(spark, str(tmp_path / "r2"), "r2", str(tmp_path / "u"))
    u = {r.product_name: r.price_per_unit for r in spark.read.parquet(str(tmp_path / "u")).collect()}
    assert u["Lasanha 1kg"] == pytest.approx(0.00449) and u["Sopa 500 ml"] == pytest.approx(0.002)


def test_incremental_ingest(spark, tmp_path):
    land = tmp_path / "landing"
    out, ck = str(tmp_path / "snap"), str(tmp_path / "ck")
    pages = landed(spark)
    pages.where("source = 'r1'").write.parquet(str(land / "batch1"))
    q = start_incremental_ingest(spark, str(land / "*"), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    pages.where("source <> 'r1'").write.parquet(str(land / "batch2"))
    q = start_incremental_ingest(spark, str(land / "*"), out, ck)
    q.awaitTermination()
    # only the new files were processed; nothing from batch1 was repeated
    got = sorted(r.product_id for r in spark.read.parquet(out).collect())
    assert got == ["1", "2", "3", "P1", "P2", "lasanha-1kg"]


def test_batch_and_stream_share_a_table(spark, tmp_path):
    """Batch, stream, batch over one table: every row is there, and a category
    that lands again (in two files, one per micro-batch) is replaced whole."""
    land, out, ck = tmp_path / "landing", str(tmp_path / "snap"), str(tmp_path / "ck")
    pages = landed(spark)
    pages.where("source = 'r1'").write.parquet(str(land / "a"))
    ingest.run(spark, str(land / "*"), out)
    pages.where("source = 'r2'").write.parquet(str(land / "b"))
    pages.where("source = 'r3'").coalesce(1).write.parquet(str(land / "c"))
    start_incremental_ingest(spark, str(land / "*"), out, ck, max_files_per_trigger=1).awaitTermination()
    ids = lambda: sorted(r.product_id for r in spark.read.parquet(out).collect())
    assert ids() == ["1", "2", "3", "P1", "P2", "lasanha-1kg"]
    ingest.run(spark, str(land / "a"), out)
    assert ids() == ["1", "2", "3", "P1", "P2", "lasanha-1kg"]


def test_bad_pages_are_rows(spark):
    """A page the tokenizer fails on and a page of an unknown source are error rows."""
    day = dt.date(2024, 11, 13)
    pages = landed(spark).unionByName(spark.createDataFrame(
        [("r1", "broken", day, None, 0, "<![foo[bar]]>"), ("r9", "x", day, 1, None, "<p>hi</p>"),
         (None, "x", day, 1, None, None)], PAGES_RAW))
    snap = ingest.build_product_snapshot(pages)
    errors = {(r.source, r.category): r.parse_error for r in snap.where("tile_pos is null").collect()}
    assert errors["r1", "broken"].startswith("page: AssertionError")
    assert errors["r9", "x"] == errors[None, "x"] == ingest.UNKNOWN_SOURCE
    rep = {(r.source, r.category): (r.n_pages, r.n_rows, r.status) for r in run_report(
        pages.withColumn("page", F.coalesce("page_no", "page_start")), snap,
        ["source", "category"], "page").collect()}
    assert rep["r1", "broken"] == (1, 0, "error") and rep["r9", "x"] == (1, 0, "error")
    with pytest.raises(ValueError):
        jobs.harmonise({"r9": pages})


def test_unreadable_pages_are_not_complete(spark):
    """An unreadable first or last page, whichever way the listing is judged."""
    bad, tile = "<![foo[bar]]>", '<div class="product" data-pid="1"></div>'
    counter = '<div class="search-results-products-counter d-flex justify-content-center">1 de 2</div>'
    full, short = tile * 2, tile
    pages = spark.createDataFrame(
        [("last", 0, full), ("last", 2, bad), ("first", 0, bad), ("first", 2, short),
         ("middle", 0, counter + full), ("middle", 2, bad), ("good", 0, full), ("good", 2, short)],
        "category string, page_start int, html string")
    tiles = X.explode_tiles(pages, "tile_attr", keys=["category", "page_start"])
    for t in (tiles, tiles.drop("parse_error")):
        got = {r.category: r for r in completeness_audit(
            pages, t, ["category"], "page_start", 2).collect()}
        assert not got["first"].complete and got["good"].complete
        if "parse_error" in t.columns:
            assert not got["last"].complete and not got["middle"].complete
            assert (got["last"].n_pages, got["last"].fetched_rows, got["last"].short_pages) == (2, 2, 1)
    n = {r.page_start: r for r in X.nutrition(pages.where("category = 'last'")).collect()}
    assert n[0].parse_error is None and n[2].parse_error.startswith("page: ")


def test_harmonise_from_product_snapshot(spark, tmp_path):
    from shelfscan.operators.harmonise import harmonise_products
    from shelfscan.operators.stats import describe
    pages_path, out = str(tmp_path / "pages"), str(tmp_path / "snap")
    landed(spark).write.partitionBy("source", "snapshot_date").parquet(pages_path)
    ingest.run(spark, pages_path, out)
    snap = spark.read.parquet(out)
    h = harmonise_products(snap, with_basis=True)
    got = sorted((r.product_name, r.price, r.source, r.price_basis) for r in h.collect())
    assert ("Queijo 200g", 2.49, "R1", "unit") in got          # from the unit-price text
    assert ("Lasanha 1kg", 4.49, "R2", "shelf") in got
    assert ("Creme", None, "R3", "shelf") in got               # kept with a missing price
    assert len(got) == snap.count()
    only_r2 = harmonise_products(snap.where(F.col("source") == "r2"))
    plan = only_r2._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    d = describe(harmonise_products(snap, drop_missing=True), "price", ["source"]).collect()
    assert {r.source for r in d} == {"R1", "R2", "R3"}
