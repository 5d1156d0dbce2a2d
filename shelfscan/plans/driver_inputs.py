"""Retail-shaped inputs derived from the benchmark tables.

The benchmark tables hold no grocery data, so each registered query first
derives retailer-like text (price strings, product names with pack sizes,
catalogue pages, snapshot files) from them with native expressions, then runs
the library operator on it.  Every construction reads whole tables, so its
work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_row_index

RUN_DATE = "2024-11-13"          # job argument of the daily run (fixed for tests)
TILES_PER_PAGE = 50              # tiles per constructed catalogue page
AUDIT_PAGE_SIZE = 216            # page size of the JSON-tile crawl
PAGER_PAGE_SIZE = 212            # page size used to derive pager links


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def esc(c: Column) -> Column:
    """HTML-escape text for an attribute or text node."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit('"'),
                               F.lit("&quot;")), F.lit("<"), F.lit("&lt;"))


def cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def key_mod(n: int) -> Column:
    return F.col("p_partkey") % F.lit(n)


def dec_text(c: Column) -> Column:
    """Two-decimal text with a dot: 900.1 → '900.10'."""
    return c.cast("decimal(12,2)").cast("string")


def comma_text(c: Column) -> Column:
    return F.replace(dec_text(c), F.lit("."), F.lit(","))


def price_texts(part: DataFrame) -> DataFrame:
    """Six price spellings chosen by key: comma/UN, thousands/kg (ten times
    the price, so it has a thousands group), plain dot, two dots, empty,
    missing."""
    d10 = dec_text(F.col("p_retailprice") * F.lit(10))
    base = part.select("p_partkey", dec_text(F.col("p_retailprice")).alias("_d"),
                       F.split_part(d10, F.lit("."), F.lit(1)).alias("_ip"),
                       F.split_part(d10, F.lit("."), F.lit(2)).alias("_fp"))
    grouped = F.when(F.length("_ip") > 3, F.expr(
        "concat(substr(_ip, 1, length(_ip) - 3), '.', substr(_ip, length(_ip) - 2))")
    ).otherwise(F.col("_ip"))
    d = F.col("_d")
    k = key_mod(6)
    text = (F.when(k == 0, cat(F.replace(d, F.lit("."), F.lit(",")), "€ / UN"))
            .when(k == 1, cat(grouped, ",", F.col("_fp"), "€/kg"))
            .when(k == 2, d)
            .when(k == 3, cat("1.", d))
            .when(k == 4, F.lit("")))
    return base.select("p_partkey", text.alias("price_text"))


# --------------------------------------------------------------------------
# Snapshot frames shaped like the three retailers' CSVs.


def snapshot_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The whole ``part`` catalogue listed by each of three retailers, in each
    retailer's snapshot shape (the same products at three shops)."""
    part = table(spark, sf_dir, "part")
    cat_col = F.lower(F.col("p_type"))
    r1 = part.select(
        F.col("p_name").alias("Product Name"),
        F.col("p_partkey").cast("string").alias("Product ID"),
        F.col("p_retailprice").alias("Price"),
        cat(comma_text(F.col("p_retailprice")), "€/kg").alias("Price per unit"),
        F.col("p_brand").alias("Brand"), F.col("p_type").alias("Category"),
        cat_col.alias("cgid"), F.lit(RUN_DATE).alias("tracking_date"),
        F.lit("R1").alias("source"))
    r2 = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(key_mod(7) == 0, F.lit("esgotado"))
         .otherwise(cat(comma_text(F.col("p_retailprice")), "€ / UN")).alias("product_price"),
        cat_col.alias("category"), F.lit("R2").alias("source"))
    r3 = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("product_price"),
        cat_col.alias("product_category"), F.lit("R3").alias("source"))
    return {"r1": r1, "r2": r2, "r3": r3}


# --------------------------------------------------------------------------
# Product names with pack sizes.


def pack_names(part: DataFrame) -> DataFrame:
    """``p_name`` + one of sixteen pack-size spellings (by key), sized by ``p_size``."""
    s = F.col("p_size").cast("string")
    k = key_mod(16)
    suffix = (F.when(k == 0, cat(s, ".75l"))
              .when(k == 1, cat(s, ",75l"))
              .when(k == 2, cat("4x", s, " g"))
              .when(k == 3, cat("2×", s, " g"))
              .when(k == 4, cat("6x", s, "cl"))
              .when(k == 5, cat(s, " un"))
              .when(k == 6, cat(s, "nun"))
              .when(k == 7, cat(s, " units"))
              .when(k == 8, cat(s, " dozen"))
              .when(k == 9, cat(s, " meia dúzia"))
              .when(k == 10, cat(s, " L"))
              .when(k == 11, cat(s, "m"))
              .when(k == 12, cat(s, " ml"))
              .when(k == 13, cat("2 massas ", s, "g"))
              .when(k == 14, cat(s, " garrafas"))
              .otherwise(cat(s, " para")))
    return part.select("p_partkey", cat(F.col("p_name"), " ", suffix).alias("product_name"),
                       F.col("p_retailprice").alias("product_price"))


UNIT_CYCLE = ["kg", "g", "l", "ml", "cl", "un", "dozen", "m", "meia dúzia"]


def value_units(part: DataFrame) -> DataFrame:
    """(value, unit, quantity) triples: value = size (0 for every 11th key),
    unit cycling through nine spellings, quantity = key mod 5 (NULL at 0)."""
    unit = F.element_at(F.array(*[F.lit(u) for u in UNIT_CYCLE]),
                        (key_mod(len(UNIT_CYCLE)) + 1).cast("int"))
    value = F.when(key_mod(11) == 0, F.lit(0.0)).otherwise(F.col("p_size").cast("double"))
    qty = F.when(key_mod(5) != 0, key_mod(5))
    return part.select("p_partkey", value.alias("weight_value"), unit.alias("weight_unit"),
                       qty.cast("bigint").alias("quantity"))


# --------------------------------------------------------------------------
# Catalogue pages.


def _pages_of(tiles: DataFrame, page_cols: list[str], key: str = "p_partkey",
              tile_col: str = "tile") -> DataFrame:
    """Group tile markup into pages in key order.  A page holds a bounded
    number of tiles by construction, so the per-page list is bounded."""
    grouped = tiles.groupBy(*page_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"),
                                             F.col(tile_col).alias("t")))).alias("_ts"))
    body = F.array_join(F.transform("_ts", lambda x: x["t"]), "")
    return grouped.select(*page_cols, cat("<html><head><title>catalogue</title></head><body>",
                                          '<div class="grid">', body,
                                          "</div></body></html>").alias("html"))


def json_tile_markup() -> Column:
    """One JSON-tile for a ``part`` row, with its documented edge cases:
    every 17th key has no JSON attribute, every 13th bad JSON, every 7th an
    apostrophe in the name, every 11th an ampersand; every 5th has no image,
    every 4th no secondary price."""
    name = (F.when(key_mod(7) == 0, cat(F.col("p_name"), "'s"))
            .when(key_mod(11) == 0, cat(F.col("p_name"), " & co"))
            .otherwise(F.col("p_name")))
    js = F.to_json(F.struct(name.alias("name"), F.col("p_partkey").cast("string").alias("id"),
                            F.col("p_retailprice").alias("price"),
                            F.col("p_brand").alias("brand"), F.col("p_type").alias("category")))
    js = F.when(key_mod(13) == 0, cat('{"name": "', F.col("p_name"), '", broken')).otherwise(js)
    attr = F.when(key_mod(17) == 0, F.lit("")).otherwise(
        cat(' data-product-tile-impression="', esc(js), '"'))
    k = F.col("p_partkey").cast("string")
    img = F.when(key_mod(5) == 0, F.lit("")).otherwise(
        cat('<img class="ct-tile-image lazy" data-src="https://img.example/', k, '.jpg">'))
    second = F.when(key_mod(4) == 0, F.lit("")).otherwise(
        cat('<div class="pwc-tile--price-secondary"> <span>', comma_text(F.col("p_retailprice")),
            "€</span> / <span>kg </span></div>"))
    return cat('<div class="product-tile"', attr, '><a href="/p/', k, '">',
               img, "</a>", '<div class="product-tile-info">info</div>', second,
               '<p class="pwc-tile--quantity"> ', F.col("p_size").cast("string"), " un </p>",
               '<a href="/other/', k, '">more</a></div>')


def json_tile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    tiles = part.select("p_partkey", F.floor(F.col("p_partkey") / TILES_PER_PAGE)
                        .cast("bigint").alias("page_id"), json_tile_markup().alias("tile"))
    return _pages_of(tiles, ["page_id"])


def card_markup() -> Column:
    k = F.col("p_partkey").cast("string")
    slug = cat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), "-", k)
    rating = F.when(key_mod(6) == 0, cat('<div class="bv_text"> ', F.col("p_size").cast("string"),
                                         " </div>")).otherwise(F.lit(""))
    return cat('<div class="product-cards"><a class="product-cards__link" '
               'href="https://shop.example/produtos/', slug, '/">',
               '<h3 class="product-cards__title">  ', esc(F.col("p_name")), " ",
               F.col("p_size").cast("string"), " g </h3></a>",
               '<span class="product-cards_price"> ', comma_text(F.col("p_retailprice")),
               "€ / UN </span>",
               '<img class="product-cards__image" src="https://img.example/c/', k, '.jpg">',
               rating, "</div>")


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    tiles = part.select("p_partkey", F.floor(F.col("p_partkey") / TILES_PER_PAGE)
                        .cast("bigint").alias("page_id"), card_markup().alias("tile"))
    return _pages_of(tiles, ["page_id"])


def attr_tile_markup(broken_class: Column | None = None) -> Column:
    """Attribute tile: every 29th key lacks its price node; key mod 3 labels;
    every 4th has a promotion; every 2nd lacks the third category level."""
    k = F.col("p_partkey").cast("string")
    gtm = F.to_json(F.struct(F.col("p_type").alias("item_category"),
                             F.col("p_brand").alias("item_category2"),
                             F.when(key_mod(2) == 1, F.col("p_name")).alias("item_category3")))
    urls = F.to_json(F.struct(cat("/p/", k).alias("productUrl")))
    price = F.when(key_mod(29) == 0, F.lit("")).otherwise(
        cat('<span class="sales"><span class="value" content="',
            F.col("p_retailprice").cast("string"), '">', comma_text(F.col("p_retailprice")),
            " €</span></span>"))
    labels = F.array_join(F.transform(
        F.sequence(F.lit(0), (key_mod(3) - 1).cast("int")),
        lambda i: cat('<img class="auc-product-labels__icon" src="/l.png" alt="',
                      F.col("p_brand"), '" title="L', i.cast("string"), '">')), "")
    labels = F.when(key_mod(3) == 0, F.lit("")).otherwise(labels)
    promo = F.when(key_mod(4) == 0, cat('<div class="auc-price__promotion__label"> -',
                                        F.col("p_size").cast("string"), "% </div>")
                   ).otherwise(F.lit(""))
    outer = broken_class if broken_class is not None else F.lit("product")
    return cat('<div class="', outer, '" data-pid="', k, '">',
               '<div class="product-tile" data-urls="', esc(urls), '" data-gtm-new="', esc(gtm), '">',
               '<div class="image-container"><img src="https://img.example/a/', k, '.png"></div>',
               '<div class="pdp-link"><a href="/p/', k, '">  ', esc(F.col("p_name")), "  </a></div>",
               price,
               '<div class="auc-product-tile__bazaarvoice--ratings" data-bv-product-id="', k,
               '"></div>', labels, promo, "</div></div>")


def attr_tile_pages(spark: SparkSession, sf_dir: str, with_category: bool = False) -> DataFrame:
    part = table(spark, sf_dir, "part")
    category = F.lower(F.col("p_type"))
    # In the run-report construction one category's markup drifted (the tile
    # class changed), so its pages land but yield nothing.
    broken = F.when(category == "promo", F.lit("product-card")).otherwise(F.lit("product")) \
        if with_category else None
    tiles = part.select("p_partkey", category.alias("category"),
                        F.floor(F.col("p_partkey") / TILES_PER_PAGE).cast("bigint").alias("page_id"),
                        attr_tile_markup(broken).alias("tile"))
    cols = ["category", "page_id"] if with_category else ["page_id"]
    return _pages_of(tiles, cols)


def audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-tile crawl per category with ``AUDIT_PAGE_SIZE`` tiles a page; two thirds of the rows
    are of one category.  The first page carries the result counter, large numbers with a
    thousands mark (a dot, blank or no-break blank); that of one category is five rows short of
    what landed.  Of the others, every page whose number is 1 mod 3 landed as an error response
    (the page is there, its tiles are not); every row of ``part`` is read and placed."""
    category = F.when(key_mod(3) == 0, F.lower(F.col("p_type"))).otherwise(F.lit("tudo"))
    part = table(spark, sf_dir, "part").withColumn("category", category)
    ranked = with_row_index(part, ["p_partkey"], ["category"], "_r")
    tiles = ranked.select(
        "p_partkey", "category",
        (F.floor(F.col("_r") / AUDIT_PAGE_SIZE) * AUDIT_PAGE_SIZE).cast("int").alias("page_start"),
        json_tile_markup().alias("tile"))
    surplus = F.when(F.col("category") == "promo", F.lit(5)).otherwise(F.lit(0))
    totals = part.groupBy("category").agg(F.count(F.lit(1)).alias("_n")).select(
        "category", (F.col("_n") - surplus).alias("_total"))
    pages = _pages_of(tiles, ["category", "page_start"])
    pages = pages.join(totals, "category")
    total = F.col("_total")
    mark = F.element_at(F.array(F.lit("."), F.lit(" "), F.lit("\u00a0")), ((total % 3) + 1).cast("int"))
    counted = F.when(total >= 1000, cat(F.floor(total / 1000).cast("string"), mark, F.lpad(
        (total % 1000).cast("string"), 3, "0"))).otherwise(total.cast("string"))
    counter = cat('<div class="search-results-products-counter">0</div>'
                  '<div class="search-results-products-counter d-flex justify-content-center">'
                  "A mostrar ", F.least(total, F.lit(AUDIT_PAGE_SIZE)).cast("string"),
                  " de ", counted, " produtos</div>")
    html = F.when(F.col("page_start") == 0,
                  F.regexp_replace("html", "<body>", F.concat(F.lit("<body>"), counter)))
    html = html.otherwise(F.col("html"))
    page_no = F.floor(F.col("page_start") / AUDIT_PAGE_SIZE)
    failed = F.lit("<html><body><h1>503 Service Unavailable</h1></body></html>")
    html = F.when((page_no % 3 == 1) & (F.col("category") != "promo"), failed).otherwise(html)
    return pages.select("category", "page_start", html.alias("html"))


def order_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 'category' per customer for the counter and pager constructions; its
    size is the customer's order volume in thousands."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (orders.groupBy("o_custkey").agg(F.sum(cents).alias("cents"))
                  .select(cat("customer-", F.col("o_custkey").cast("string")).alias("category"),
                          "o_custkey", F.expr("cents div 100000").alias("n")))


def counter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every category with its result counter; every second
    one of a thousand or more is written with a thousands mark."""
    g = order_groups(spark, sf_dir)
    n = F.col("n")
    total = F.when((F.col("o_custkey") % 2 == 0) & (n >= 1000),
                   cat(F.floor(n / 1000).cast("string"), ".",
                       F.lpad((n % 1000).cast("string"), 3, "0"))).otherwise(n.cast("string"))
    html = cat("<html><body>",
               '<div class="search-results-products-counter">99999</div>',
               '<div class="search-results-products-counter d-flex justify-content-center">',
               "<span>A mostrar ", F.least(n, F.lit(AUDIT_PAGE_SIZE)).cast("string"),
               "</span> de <b>", total, "</b> produtos</div></body></html>")
    return g.select("category", "n", html.alias("html"))


def pager_nodes(last: Column) -> Column:
    """Pager links of a listing with ``last`` pages: the last five, as shops
    show them; none for a single page."""
    nodes = F.array_join(F.transform(
        F.sequence(F.greatest(F.lit(1), last - 4), F.greatest(F.lit(1), last)), lambda i: cat(
            '<div class="page js-change-page" data-page="', i.cast("string"), '">',
            i.cast("string"), "</div>")), "")
    return F.when(last > 1, nodes).otherwise(F.lit(""))


HUGE_PAGE = 99999999999         # what a misread pager may say


def pager_pages_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every category with its pager: of some the last entry is 0, negative or
    huge."""
    g = order_groups(spark, sf_dir)
    pages = F.ceil(F.col("n") / F.lit(PAGER_PAGE_SIZE)).cast("int")
    k = F.col("o_custkey") % 50
    odd = F.when(k == 7, F.lit("0")).when(k == 8, F.lit("-3")).when(k == 9, F.lit(str(HUGE_PAGE)))
    extra = F.when(odd.isNotNull(), cat('<div class="page js-change-page" data-page="', odd, '">', odd,
                                        "</div>")).otherwise(F.lit(""))
    html = cat('<html><body><div class="pager"><div class="page" data-page="999">x</div>',
               pager_nodes(pages), extra, "</div></body></html>")
    return g.select("category", "n", html.alias("html"))


def _listing(spark: SparkSession, sf_dir: str, markup: Column) -> DataFrame:
    """``category, page (from 0), pages, html``: all of ``part`` listed by
    category, ``TILES_PER_PAGE`` tiles a page."""
    part = table(spark, sf_dir, "part").withColumn("category", F.lower(F.col("p_type")))
    ranked = with_row_index(part, ["p_partkey"], ["category"], "_r")
    tiles = ranked.select("p_partkey", "category", F.floor(F.col("_r") / TILES_PER_PAGE)
                          .cast("int").alias("page"), markup.alias("tile"))
    n = part.groupBy("category").agg(
        F.ceil(F.count(F.lit(1)) / TILES_PER_PAGE).cast("int").alias("pages"))
    return _pages_of(tiles, ["category", "page"]).join(n, "category")


def pager_audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards by page number from 1 with a pager on the first page; of one
    category every third page never landed, and another's pager ends with a huge number."""
    p = _listing(spark, sf_dir, card_markup())
    misread = F.when(F.col("category") == "economy", F.lit(
        f'<div class="page js-change-page" data-page="{HUGE_PAGE}">&raquo;</div>')).otherwise(F.lit(""))
    pager = F.concat(pager_nodes(F.col("pages")), misread)
    html = F.when(F.col("page") == 0, F.regexp_replace(
        "html", "<body>", F.concat(F.lit("<body>"), pager))).otherwise(F.col("html"))
    gone = (F.col("category") == "promo") & (F.col("page") % 3 == 2)
    return p.where(~gone).select("category", (F.col("page") + 1).alias("page_no"), html.alias("html"))


def short_page_audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute tiles by offset, without counter or pager; of one category the
    last page never landed."""
    p = _listing(spark, sf_dir, attr_tile_markup())
    gone = (F.col("category") == "promo") & (F.col("page") == F.col("pages") - 1)
    return p.where(~gone).select("category", (F.col("page") * TILES_PER_PAGE).alias("page_start"), "html")


def mixed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``PAGES_RAW`` rows of a day that went partly wrong: good JSON-tile pages,
    for every page of the ``pages`` table one of an unknown retailer, and for every
    supplier one that no tokenizer reads."""
    day, none = F.lit(RUN_DATE).cast("date"), F.lit(None).cast("int")
    row = lambda df, source, category, number, html: df.select(
        F.lit(source).alias("source"), F.lit(category).alias("category"), day.alias("snapshot_date"),
        none.alias("page_no"), number.cast("int").alias("page_start"), html.alias("html"))
    good = row(json_tile_pages(spark, sf_dir), "r1", "catalogue", F.col("page_id"), F.col("html"))
    odd = row(table(spark, sf_dir, "pages"), "elsewhere", "web", F.col("page_id"), F.col("html"))
    bad = row(table(spark, sf_dir, "supplier"), "r1", "broken", F.col("s_suppkey"),
              F.lit("<![foo[bar]]>"))
    return good.unionByName(odd).unionByName(bad)


def nutrition_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product page per ``part`` row.  Every 4th lacks the reference
    intake, every 5th has a one-paragraph unit block, every 3rd a malformed
    two-cell nutrient row, every 2nd a repeated description header."""
    part = table(spark, sf_dir, "part")
    s = F.col("p_size").cast("string")

    def cell(x):
        return cat('<div class="nutriInfo-details">', x, "</div>")

    def row(*cells):
        return cat('<div class="nutrients-row">', *cells, "</div>")

    ref = F.when(key_mod(4) == 0, F.lit("")).otherwise(cat(
        '<div class="daily-value-intake-reference"><p>Referência</p><p> ', s, "% </p></div>"))
    serving = cat('<div class="serving-size"><p>Porção</p><p>', (F.col("p_size") * 10).cast("string"),
                  " g</p></div>")
    uom = F.when(key_mod(5) == 0, F.lit('<div class="serving-size--uom"><p>UOM</p></div>')).otherwise(
        F.lit('<div class="serving-size--uom"><p>UOM</p><p> g </p></div>'))
    bad = F.when(key_mod(3) == 0, row(cell(F.lit("Sal")), cell(F.lit("0,1")))).otherwise(F.lit(""))
    table_html = cat('<div class="nutrients-table">',
                     row(cell(F.lit("Nutriente")), cell(F.lit("Qtd")), cell(F.lit("Un"))),
                     row(cell(F.lit("Energia")), cell((F.col("p_size") * 4).cast("string")),
                         cell(F.lit("kcal"))),
                     bad,
                     row(cell(F.lit("Lípidos")), cell(dec_text(F.col("p_retailprice"))),
                         cell(F.lit("g"))),
                     "</div>")
    dup = F.when(key_mod(2) == 0, cat('<p class="mb-0">Tipo:</p><p>', F.col("p_type"), " v2</p>")
                 ).otherwise(F.lit(""))
    desc = cat('<div class="ct-pdp--description-content">',
               '<p class="mb-0">Tipo:</p><p>', F.col("p_type"), "</p>",
               '<p class="mb-0">Marca:</p><p>', esc(F.col("p_brand")), "</p>", dup, "</div>")
    return part.select("p_partkey", cat("<html><body>", ref, serving, uom, table_html, desc,
                                        "</body></html>").alias("html"))


def product_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed snapshot rows over all of ``part``: three sources, two dates,
    category from the type (with ``/`` inside for the third source)."""
    part = table(spark, sf_dir, "part")
    k3 = key_mod(3)
    source = F.when(k3 == 0, F.lit("r1")).when(k3 == 1, F.lit("r2")).otherwise(F.lit("r3"))
    category = F.when(k3 == 2, cat(F.lower(F.col("p_type")), "/bem-estar/")).otherwise(
        F.lower(F.col("p_type")))
    date = F.date_add(F.lit(RUN_DATE).cast("date"), key_mod(2).cast("int"))
    return part.select(F.col("p_partkey").cast("string").alias("product_id"),
                       F.col("p_name").alias("product_name"),
                       F.col("p_retailprice").alias("price"),
                       source.alias("source"), date.alias("snapshot_date"),
                       category.alias("category"))


def r2_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2-shaped CSV rows for two snapshot days, one file per category a day."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    day = F.when(key_mod(2) == 0, F.lit("20241113")).otherwise(F.lit("20241114"))
    stamp = cat(day, "_", F.when(key_mod(2) == 0, F.lit("173405")).otherwise(F.lit("165838")))
    return part.select(
        cat("item-", k).alias("product_id"), F.col("p_name").alias("product_name"),
        cat(comma_text(F.col("p_retailprice")), "€ / UN").alias("product_price"),
        cat("https://img.example/", k, ".jpg").alias("product_image"),
        cat("https://shop.example/p/item-", k, "/").alias("product_url"),
        F.lit(None).cast("string").alias("product_rating"),
        F.lit("r2").alias("source"), stamp.alias("timestamp"),
        day.alias("snapshot_dir"), F.lower(F.col("p_type")).alias("category_file"))


def odd_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of files that no reader of one header can take: some begin with a blank line and a
    padded header in other case, some have a header of other names."""
    rows = r2_csv_rows(spark, sf_dir).withColumn("k", F.regexp_extract("product_id", r"(\d+)", 1).cast("int"))
    rows = rows.where(F.col("k") % 3 == 2)
    foreign = F.lower("category_file").isin("promo", "small")
    folder = F.when(foreign, F.concat(F.lit("foreign-"), "category_file")).otherwise(
        F.concat(F.lit("padded-"), "category_file"))
    lines = rows.select("snapshot_dir", folder.alias("category_file"), F.lit(2).alias("at"), cat(
        F.col("product_name"), ",", F.col("product_id"), ',"', F.col("product_price"), '",',
        F.col("timestamp"), ",r2").alias("line"))
    heads = lines.select("snapshot_dir", "category_file").distinct().select("*", F.explode(F.when(
        F.col("category_file").startswith("foreign"), F.array(
            F.struct(F.lit(1).alias("at"), F.lit("nome;codigo;preco;hora;loja").alias("line"))))
        .otherwise(F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("line")), F.struct(
            F.lit(1).alias("at"), F.lit(" Product_Name , product_id,product_price ,timestamp, source").alias(
                "line"))))).alias("h")).select("snapshot_dir", "category_file", "h.at", "h.line")
    return lines.unionByName(heads)


def drifted_csv_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the rows in two shapes: the usual one, and one in another column
    order, without the rating, with a column more and odd category names."""
    rows = r2_csv_rows(spark, sf_dir).withColumn("k", F.regexp_extract("product_id", r"(\d+)", 1).cast("int"))
    usual = rows.where(F.col("k") % 3 == 1).drop("k")
    name = cat("processed_Água e/ou ", F.col("category_file"), " 100%+")
    other = rows.where(F.col("k") % 3 == 0).select(
        "timestamp", "source", F.lit("x").alias("stock"), "product_price", "product_name", "product_id",
        "snapshot_dir", name.alias("category_file"))
    return usual, other


def pack_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2-shaped CSV rows whose names hold pack sizes."""
    names = pack_names(table(spark, sf_dir, "part"))
    return names.select(
        F.col("p_partkey").cast("string").alias("product_id"), "product_name",
        cat(comma_text(F.col("product_price")), "€ / UN").alias("product_price"),
        F.lit("r2").alias("source"), F.lit("20241113").alias("snapshot_dir"),
        F.lit("packs").alias("category_file"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event (every 10th a traceback line that is not a
    log record)."""
    ev = table(spark, sf_dir, "events")
    level = (F.when(F.col("event_type") == "error", F.lit("ERROR"))
             .when(F.col("event_type") == "signup", F.lit("WARNING")).otherwise(F.lit("INFO")))
    line = cat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), " - shelfscan - ", level, " - ",
               F.col("event_type"), ".py:", F.col("user_id").cast("string"), " - handle_",
               F.col("event_type"), " - event ", F.col("event_id").cast("string"), " - k=",
               F.get_json_object("props", "$.k"))
    line = F.when(F.col("event_id") % 10 == 0, F.lit("Traceback (most recent call last):")
                  ).otherwise(line)
    return ev.select("event_id", line.alias("value"))


# --------------------------------------------------------------------------
# Listings over time.


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per order line: a third are of one product, some have no product id."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    product = (F.when(k % 3 == 0, F.lit("hot")).when(k % 40 == 1, F.lit(None).cast("string"))
               .otherwise(cat("item-", k.cast("string"))))
    source = F.element_at(F.array(*map(F.lit, ("r1", "r2", "r3"))), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return li.withColumns({"source": source, "product_id": product})


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with a price that falls, rises back and is missing for two months of a year."""
    month = F.month("l_shipdate")
    price = (F.lit(10.0) + F.when(F.col("product_id") == "hot", F.lit(0)).otherwise(F.col("l_partkey") % 50)
             + F.when(month > 8, F.lit(2.5)).otherwise(F.lit(0.0)))
    return _listings(spark, sf_dir).select(
        "source", "product_id", F.col("l_shipdate").cast("date").alias("snapshot_date"),
        F.when(~month.isin(3, 4), price).alias("price"))


def dated_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings by quarter with the day they were seen, in three batches: the second holds late
    rows of the quarters of the first."""
    x = _listings(spark, sf_dir)
    late = F.col("l_linenumber") == 3
    batch = F.when(F.year("l_shipdate") >= 1996, F.lit(2)).when(late, F.lit(1)).otherwise(F.lit(0))
    return x.select("source", "product_id",
                    F.date_trunc("quarter", "l_shipdate").cast("date").alias("snapshot_date"),
                    F.col("l_shipdate").cast("date").alias("observed_at"),
                    F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("price"),
                    (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("listing"),
                    batch.alias("batch"))


def two_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The catalogue on two days: some products come, some go, some prices rise, some have no price
    or no id, a quarter of the rows are listings of one product; the first day lists all twice."""
    part = table(spark, sf_dir, "part")
    source = F.element_at(F.array(*map(F.lit, ("r1", "r2", "r3"))), (key_mod(3) + 1).cast("int"))
    product = (F.when(key_mod(4) == 0, F.lit("hot"))
               .when(key_mod(25) != 3, cat("item-", F.col("p_partkey").cast("string"))))
    price = F.when(key_mod(8) != 1, F.col("p_retailprice"))
    first = part.where(key_mod(10) != 3).select(source.alias("source"), product.alias("product_id"),
                                                price.alias("price"))
    dearer = first.withColumn("price", F.col("price") + 0.5)
    second = part.where(key_mod(10) != 7).select(
        source.alias("source"), product.alias("product_id"),
        (price + F.when(key_mod(5) == 2, F.lit(1)).otherwise(F.lit(0))).alias("price"))
    return first.unionByName(dearer), second


def retailer_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue at three retailers that spell names and pack sizes in their own way; the third
    has another product in place of every fifth, and no price for every eleventh."""
    part = table(spark, sf_dir, "part")
    k, code = F.col("p_partkey").cast("string"), cat("n", F.col("p_partkey").cast("string"))
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))
    grams = (F.col("p_size") * 10).cast("string")
    fruit = F.when(key_mod(9) == 0, F.lit("maçã ")).otherwise(F.lit(""))
    kilos = (F.col("p_size") / 100).cast("decimal(6,2)").cast("string")
    price = F.col("p_retailprice")
    row = lambda source, name, cost: part.select(
        F.lit(source).alias("source"), cat(source, "-", k).alias("product_id"),
        name.alias("product_name"), cost.alias("price"))
    third = F.when(key_mod(5) == 0, cat("m", k)).otherwise(code)
    extra = F.when(key_mod(4) == 1, F.lit(" bio")).otherwise(F.lit(""))
    return (row("r1", cat(fruit, F.col("p_name"), " ", brand, " ", code, ", ", grams, " g"), price)
            .unionByName(row("r2", cat(F.upper(F.concat(brand, F.lit(" "), code)), " - ",
                                       F.upper(F.concat(fruit, F.col("p_name"))), " ", kilos, "kg"),
                             price * F.when(key_mod(3) == 0, F.lit(0.5)).otherwise(F.lit(2.0))))
            .unionByName(row("r3", cat(F.col("p_name"), " ", fruit, "(", third, "/", brand, ")", extra,
                                       " ", grams, "g"),
                             F.when(key_mod(11) != 0, price * F.when(key_mod(7) == 0, F.lit(0.25))
                                    .otherwise(F.lit(1.0))))))
