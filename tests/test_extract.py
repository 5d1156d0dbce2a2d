"""Hand-written pages per layout, with the documented edge cases."""

from pyspark.sql import functions as F

from shelfscan.operators import extract as X

R1_PAGE = """
<html><body>
<div class="search-results-products-counter">999</div>
<div class="search-results-products-counter d-flex justify-content-center">A mostrar 1-216 de 1.234 produtos</div>
<div class="product-tile" data-product-tile-impression="{&quot;name&quot;:&quot;Vinho D'Ouro&quot;,&quot;id&quot;:&quot;11&quot;,&quot;price&quot;:3.99,&quot;brand&quot;:&quot;Q&quot;,&quot;category&quot;:&quot;Bebidas&quot;}">
  <a href="/p/11"><img class="ct-tile-image" data-src="https://i/11.jpg"></a>
  <div class="pwc-tile--price-secondary"> <span>5,32€</span> / <span>lt </span></div>
  <p class="pwc-tile--quantity"> 0,75 lt </p>
</div>
<div class="product-tile" data-product-tile-impression="{&quot;name&quot;: broken">
  <a href="/p/12">x</a>
</div>
<div class="product-tile">
  <a>no href</a><a href="/p/13">13</a>
</div>
<div class="product-tile-info">not a tile</div>
<div class="product-tile" data-product-tile-impression="">
</div>
</body></html>"""

R2_PAGE = """
<div class="product-cards">
 <a class="product-cards__link" href="https://shop/p/rucula-70-g/">
  <h3 class="product-cards__title">  Rúcula 70 g </h3></a>
 <span class="product-cards_price"> 0,95€ / UN </span>
 <img class="product-cards__image" src="https://img/1.jpg">
</div>
<div class="product-cards">
 <a class="product-cards__link" href="https://shop/p/cafe-16-un/"><h3 class="product-cards__title">Café 16 un</h3></a>
 <span class="product-cards_price">2,69€ / UN</span>
 <img class="product-cards__image" src="https://img/2.jpg">
 <div class="bv_text"> 4.5 </div>
</div>
<div class="page js-change-page" data-page="1">1</div>
<div class="page js-change-page" data-page="2">2</div>
<div class="page js-change-page" data-page="3">3</div>
"""

R3_PAGE = """
<div class="product" data-pid="P1">
 <div class="product-tile" data-urls='{"productUrl":"/p1"}'
      data-gtm-new='{"item_category":"Alimentacao","item_category2":"Leite"}'>
  <div class="image-container"><img src="https://img/p1.png"></div>
  <div class="pdp-link"><a href="/p1">  Leite 1 L  </a></div>
  <span class="sales"><span class="value" content="0.89">0,89 €</span></span>
  <div class="auc-product-tile__bazaarvoice--ratings" data-bv-product-id="P1"></div>
  <img class="auc-product-labels__icon" alt="Bio" title="Biológico">
  <img class="auc-product-labels__icon" alt="PT" title="Nacional">
  <div class="auc-price__promotion__label"> -20% </div>
 </div>
</div>
<div class="product" data-pid="P2">
 <div class="product-tile" data-urls='{}' data-gtm-new='{}'>
  <div class="image-container"><img src="https://img/p2.png"></div>
  <div class="pdp-link"><a href="/p2">Sem preço</a></div>
  <div class="auc-product-tile__bazaarvoice--ratings" data-bv-product-id="P2"></div>
 </div>
</div>
"""


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id long, html string")


def test_json_tiles(spark):
    t = X.extract_products(pages(spark, R1_PAGE, "<html></html>"), "tile_json").orderBy("tile_pos")
    rows = t.collect()
    assert len(rows) == 4                      # empty page gives no rows; info div not a tile
    a, b, c, d = rows
    assert (a.product_name, a.product_id, a.price, a.brand) == ("Vinho D'Ouro", "11", 3.99, "Q")
    assert a.unit_price_raw == "5,32€/lt" and a.min_quantity == "0,75 lt"
    assert a.image_url == "https://i/11.jpg" and a.product_url == "/p/11"
    # bad JSON: row kept, decoded fields NULL (never the previous tile's values)
    assert b.product_name is None and b.price is None and b.product_url == "/p/12"
    # no JSON attribute, first link *with* href, absent image → NULL
    assert c.product_id is None and c.product_url == "/p/13" and c.image_url is None
    assert d.product_name is None


def test_cards_and_pager(spark):
    df = pages(spark, R2_PAGE)
    t = X.extract_products(df, "card").orderBy("tile_pos").collect()
    assert [r.product_id for r in t] == ["rucula-70-g", "cafe-16-un"]
    assert [r.product_name for r in t] == ["Rúcula 70 g", "Café 16 un"]
    assert [r.price for r in t] == [0.95, 2.69]
    assert [r.rating for r in t] == [None, "4.5"]
    assert all(r.parse_error is None for r in t)
    lp = df.select(X.last_page("html").alias("lp")).first().lp
    assert lp == 3
    none = pages(spark, "<div class='page'>1</div>").select(X.last_page("html").alias("lp"))
    assert none.first().lp is None


def test_attr_tiles_labels_and_errors(spark):
    t = X.extract_products(pages(spark, R3_PAGE), "tile_attr").orderBy("tile_pos").collect()
    p1, p2 = t
    assert p1.product_id == "P1" and p1.product_name == "Leite 1 L" and p1.price == 0.89
    assert (p1.category_l1, p1.category_l2, p1.category_l3) == ("Alimentacao", "Leite", None)
    assert [(x.alt, x.title) for x in p1.labels] == [("Bio", "Biológico"), ("PT", "Nacional")]
    assert p1.promotion == "-20%" and p1.rating == "P1" and p1.parse_error is None
    # a missing mandatory node is recorded on the row instead of failing the page
    assert p2.price is None and p2.labels == [] and p2.promotion is None
    assert p2.parse_error == "missing: price_raw"


def test_counter_reads_max_digit_run(spark):
    df = pages(spark, R1_PAGE, "<div>none</div>")
    got = [r.n for r in df.orderBy("page_id").select(X.expected_count("html").alias("n")).collect()]
    assert got == [234, None]   # "1.234" reads as 234; the decoy with a partial class is skipped


NUTRITION = """
<div class="daily-value-intake-reference"><p>Ref</p><p> 2000 kcal </p></div>
<div class="serving-size"><p>Porção</p></div>
<div class="nutrients-table">
 <div class="nutrients-row"><div class="nutriInfo-details">N</div><div class="nutriInfo-details">Q</div><div class="nutriInfo-details">U</div></div>
 <div class="nutrients-row"><div class="nutriInfo-details">Energia</div><div class="nutriInfo-details">250</div><div class="nutriInfo-details">kcal</div></div>
 <div class="nutrients-row"><div class="nutriInfo-details">Sal</div><div class="nutriInfo-details">0,1</div></div>
</div>
<div class="ct-pdp--description-content">
 <p class="mb-0">Origem:</p><p>PT</p><p class="mb-0">Origem:</p><p>ES</p><p class="mb-0">Fim:</p>
</div>"""


def test_nutrition_record(spark):
    n = X.nutrition(pages(spark, NUTRITION, "<p>nothing</p>")).orderBy("page_id").collect()
    a, b = n
    assert a.reference_intake == "2000 kcal"
    assert a.serving_size is None and a.uom is None   # one <p> only / absent block
    assert [(r.nutrient, r.quantity, r.unit) for r in a.nutrients] == [("Energia", "250", "kcal")]
    assert a.description == {"Origem": "ES", "Fim": None}   # last duplicate wins
    assert b.nutrients is None and b.description is None and b.reference_intake is None


def test_link_facts(spark):
    df = pages(spark, '<a>x</a><a href="/1">1</a><a href="/2">2</a>', "<p>no links</p>")
    got = df.orderBy("page_id").select(X.link_facts("html").alias("f")).collect()
    assert (got[0].f.first_href, got[0].f.n_links) == ("/1", 2)
    assert (got[1].f.first_href, got[1].f.n_links) == (None, 0)


def test_optional_nfc_normalisation(spark):
    from shelfscan.functions.quantity import parse_quantity
    decomposed = "Ovos 6 meia dúzia"          # 'ú' as u + combining accent
    page = ('<div class="product-cards"><a class="product-cards__link" href="/p/ovos/">'
            f'<h3 class="product-cards__title">{decomposed}</h3></a>'
            '<span class="product-cards_price">1,99€</span>'
            '<img class="product-cards__image" src="i.jpg"></div>')
    df = pages(spark, page)
    raw = X.explode_tiles(df, "card").select(parse_quantity("product_name").alias("q")).first().q
    nfc = X.explode_tiles(df, "card", normalize="NFC").select(
        parse_quantity("product_name").alias("q")).first().q
    # decomposed: 'dúzia' is missed and the length rule takes "6 m" of "meia"
    assert (raw.weight_unit, raw.quantity) == ("m", 6)
    assert (nfc.weight_unit, nfc.quantity, nfc.weight_value) == ("meia dúzia", 6, 72.0)


def test_spread_exchange_survives_upstream_grouping(spark):
    """Pages built by a groupBy on the page key must still be spread by the
    derived hash right before the Python walk (an exchange on the bare key was
    once dropped as redundant, pinning the parse to one task)."""
    from pyspark.sql import functions as F
    tiles = spark.range(0, 400).select((F.col("id") % 40).alias("page_id"),
                                       F.lit('<div class="product-tile"><a href="/x">x</a></div>')
                                       .alias("t"))
    pages = tiles.groupBy("page_id").agg(F.concat_ws("", F.collect_list("t")).alias("html"))
    out = X.explode_tiles(pages, "tile_json")
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert "MapInArrow" in plan
    assert "Exchange hashpartitioning(xxhash64(page_id" in plan
    assert out.count() == 400
    parts = out.groupBy(F.spark_partition_id()).count().count()
    assert parts > 1
