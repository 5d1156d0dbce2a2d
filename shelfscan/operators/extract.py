"""Landed pages → rows.

A per-page Python walk (``mapInArrow``: Arrow batches in and out) reads the
markup of each page and yields one row per tile with *string* fields;
everything after that (JSON decoding, number parsing, ids from URLs,
defaults) is a native projection, so Catalyst sees and prunes it.  Pages are
independent, so the work is spread over tasks by page; nothing is gathered per
category or per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .. import specs
from ..functions import html as dom
from ..functions.price import parse_price, strip_text, to_number
from ..functions.text import json_fields, max_digit_run, url_key
from ..session import default_parallelism, ship_package

# --------------------------------------------------------------------------
# Python side: small, per-page helpers executed inside the tasks.


def _follow(node, path):
    for st in path:
        node = node.find(st.tag, st.cls, st.attr)
        if node is None:
            return None
    return node


def _take(node, take: str):
    if take.startswith("attr:"):
        return node.get(take[5:])
    if take == "text":
        return node.text()
    if take == "tight":
        return node.text_tight()
    raise ValueError(f"unknown take mode {take!r}")


def read_tiles(html: str | None, layout: specs.TileLayout):
    """Yield ``(pos, *fields, *items, parse_error)`` per tile of a page."""
    root = dom.parse(html)
    t = layout.tile
    for pos, tile in enumerate(root.find_all(t.tag, t.cls, t.attr)):
        errors = []
        row = [pos]
        for p in layout.picks:
            node = _follow(tile, p.path)
            value = _take(node, p.take) if node is not None else None
            if value is None and p.required:
                errors.append(p.name)
            row.append(value)
        for it in layout.items:
            entries = []
            for n in tile.find_all(it.step.tag, it.step.cls, it.step.attr):
                vals = {a: n.get(a) for a in it.attrs}
                if it.required_attrs and any(v is None for v in vals.values()):
                    errors.append(it.name)
                entries.append(vals)
            row.append(entries)
        row.append(("missing: " + ", ".join(errors)) if errors else None)
        yield tuple(row)


def tile_fields(layout: specs.TileLayout) -> list[T.StructField]:
    f = [T.StructField("tile_pos", T.LongType())]
    f += [T.StructField(p.name, T.StringType()) for p in layout.picks]
    for it in layout.items:
        inner = T.StructType([T.StructField(a, T.StringType()) for a in it.attrs])
        f.append(T.StructField(it.name, T.ArrayType(inner)))
    f.append(T.StructField("parse_error", T.StringType()))
    return f


def read_nutrition(html):
    """Nutrition page → (reference_intake, serving_size, uom, cells, description, parse_error)."""
    root = dom.parse(html)

    def second_p(step):
        block = root.find(step.tag, step.cls)
        if block is None:
            return None
        ps = block.find_all("p")
        return ps[1].text_tight() if len(ps) > 1 else None

    rows = None
    table = root.find(specs.NUTRITION_TABLE.tag, specs.NUTRITION_TABLE.cls)
    if table is not None:
        rows = [[c.text_tight() for c in r.find_all(specs.NUTRITION_CELL.tag,
                                                    specs.NUTRITION_CELL.cls)]
                for r in table.find_all(specs.NUTRITION_ROW.tag, specs.NUTRITION_ROW.cls)]
    desc = None
    block = root.find(specs.DESCRIPTION_BLOCK.tag, specs.DESCRIPTION_BLOCK.cls)
    if block is not None:
        desc = {}
        for h in block.find_all(specs.DESCRIPTION_HEADER.tag, specs.DESCRIPTION_HEADER.cls):
            sib = h.next_sibling("p")
            desc[h.text_tight().replace(":", "")] = sib.text_tight() if sib is not None else None
    return (second_p(specs.NUTRITION_REFERENCE), second_p(specs.NUTRITION_SERVING),
            second_p(specs.NUTRITION_UOM), rows, desc, None)


NUTRITION_SCHEMA = T.StructType([
    T.StructField("reference_intake", T.StringType()),
    T.StructField("serving_size", T.StringType()),
    T.StructField("uom", T.StringType()),
    T.StructField("nutrient_cells", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("description", T.MapType(T.StringType(), T.StringType())),
    T.StructField("parse_error", T.StringType()),
])


def _tree(html):
    """The page's tree; a page the tokenizer fails on reads as empty here (the
    tile walk reports it)."""
    try:
        return dom.parse(html)
    except dom.BadMarkup:
        return dom.parse(None)


@pandas_udf(T.StringType())
def counter_text(html):
    """Text of the result-counter node (exact class string), NULL if absent."""
    st = specs.RESULT_COUNTER

    def one(h):
        n = _tree(h).find(st.tag, st.cls)
        return "".join(n.strings()) if n is not None else None
    return html.map(one)


@pandas_udf(T.ArrayType(T.StringType()))
def pager_pages(html):
    """``data-page`` of every pager node in document order (empty if none)."""
    st = specs.PAGER_NODE

    def one(h):
        return [n.get(specs.PAGER_ATTR) for n in _tree(h).find_all(st.tag, st.cls, st.attr)]
    return html.map(one)


@pandas_udf(T.StructType([T.StructField("counter", T.StringType()),
                          T.StructField("pager", T.ArrayType(T.StringType())),
                          T.StructField("parse_error", T.StringType())]))
def head_facts(html):
    """Result-counter text and pager ``data-page`` list from one parse; a page that
    cannot be read has neither, but a ``parse_error``."""
    import pandas as pd
    cs, ps = specs.RESULT_COUNTER, specs.PAGER_NODE
    counters, pagers, errors = [], [], []
    for h in html:
        try:
            root, error = dom.parse(h), None
        except dom.BadMarkup as e:
            root, error = dom.parse(None), f"page: {e}"
        errors.append(error)
        n = root.find(cs.tag, cs.cls)
        counters.append("".join(n.strings()) if n is not None else None)
        pagers.append([x.get(specs.PAGER_ATTR) for x in root.find_all(ps.tag, ps.cls, ps.attr)])
    return pd.DataFrame({"counter": counters, "pager": pagers,
                         "parse_error": pd.Series(errors, dtype=object)})


@pandas_udf(T.StructType([T.StructField("first_href", T.StringType()),
                          T.StructField("n_links", T.LongType())]))
def link_facts(html):
    """First ``<a href>`` in document order and the number of such links."""
    import pandas as pd

    def one(h):
        links = _tree(h).find_all("a", None, "href")
        return (links[0].get("href") if links else None, len(links))
    vals = [one(h) for h in html]
    return pd.DataFrame({"first_href": [v[0] for v in vals], "n_links": [v[1] for v in vals]})


# --------------------------------------------------------------------------
# Spark side.

_OUT_ROWS = 4096  # rows per output Arrow batch


def spread_pages(pages: DataFrame, keys: list[str], html_col: str = "html",
                 num_partitions: int | None = None) -> DataFrame:
    """Hash-spread pages over ``num_partitions`` tasks before the Python walk.

    Parsing markup in Python costs on the order of 100x more per byte than
    moving it through a shuffle, so evening out the parse work beats saving
    the exchange: a few large or skewed input splits (one retailer's dump, a
    single small file) would otherwise pin the parse to a few cores.  The hash
    is of the page key (or the markup), so a retried task sees the same rows.
    """
    spark = pages.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              default_parallelism(spark))
    # A derived hash, not the bare key: an upstream ``groupBy(key)`` would
    # otherwise make this exchange look redundant, and adaptive execution may
    # have coalesced that upstream shuffle down to a single task.
    cols = [F.col(f"`{k}`") for k in keys] if keys else [F.col(f"`{html_col}`")]
    return pages.repartition(n, F.xxhash64(*cols))


def walk_pages(pages: DataFrame, keys: list[str], html_col: str, rows_of,
               out_fields: list[T.StructField], spread: bool = True,
               num_partitions: int | None = None, normalize: str | None = None) -> DataFrame:
    """Run ``rows_of(html) -> iterable of tuples`` over every page.

    Arrow batches in, Arrow batches out (``mapInArrow``): the page keys are
    carried to each output row with a vectorised ``take`` and only the markup
    crosses into Python.  ``normalize`` (e.g. ``"NFC"``) applies Unicode
    normalisation to the markup first, so decomposed accents read like
    composed ones (Spark SQL has no normaliser); off by default.

    A page that cannot be read does not end the job: it gives one row whose
    fields are NULL but for ``parse_error`` (where the layout has one).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(pages.sparkSession)
    if spread:
        pages = spread_pages(pages, keys, html_col, num_partitions)
    src = pages.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{html_col}`").alias("_html"))
    out_schema = T.StructType([src.schema[k] for k in keys] + list(out_fields))
    arrow_schema = to_arrow_schema(out_schema)
    is_map = [isinstance(f.dataType, T.MapType) for f in out_fields]
    width = len(out_fields)
    nkeys = len(keys)
    names = [f.name for f in out_fields]

    def safe_rows(h):
        try:
            return list(rows_of(h))
        except dom.BadMarkup as e:
            return [tuple(f"page: {e}" if n == "parse_error" else None for n in names)]

    def run(batches):
        import pyarrow as pa

        def emit(batch, idx, cols):
            take = pa.array(idx, pa.int64())
            arrays = [batch.column(k).take(take) for k in keys]
            for j in range(width):
                vals = cols[j]
                if is_map[j]:
                    vals = [None if v is None else list(v.items()) for v in vals]
                arrays.append(pa.array(vals, type=arrow_schema.field(nkeys + j).type))
            return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

        for batch in batches:
            htmls = batch.column("_html").to_pylist()
            if normalize:
                import unicodedata
                htmls = [None if h is None else unicodedata.normalize(normalize, h)
                         for h in htmls]
            idx: list[int] = []
            cols: list[list] = [[] for _ in range(width)]
            for i, h in enumerate(htmls):
                for row in safe_rows(h):
                    idx.append(i)
                    for j in range(width):
                        cols[j].append(row[j])
                if len(idx) >= _OUT_ROWS:
                    yield emit(batch, idx, cols)
                    idx, cols = [], [[] for _ in range(width)]
            if idx:
                yield emit(batch, idx, cols)

    return src.mapInArrow(run, out_schema)


def explode_tiles(pages: DataFrame, layout: str | specs.TileLayout, html_col: str = "html",
                  keys: list[str] | None = None, num_partitions: int | None = None,
                  normalize: str | None = None) -> DataFrame:
    """One row per product tile of every page (raw string fields).

    ``keys`` are the page columns carried onto each tile row (default: every
    column but the markup).  A page without tiles yields no row.
    """
    lay = specs.LAYOUTS[layout] if isinstance(layout, str) else layout
    keys = [c for c in pages.columns if c != html_col] if keys is None else keys
    return walk_pages(pages, keys, html_col, lambda h: read_tiles(h, lay), tile_fields(lay),
                      num_partitions=num_partitions, normalize=normalize)


def nutrition(pages: DataFrame, html_col: str = "html", keys: list[str] | None = None) -> DataFrame:
    """One nutrition record per product page.

    ``nutrients`` keeps the table's rows after the header that have exactly
    three cells (native filter); ``description`` maps header → text, last
    duplicate header winning.  Absent blocks are NULL.  A page that cannot be read is
    a record of NULLs with a ``parse_error``.
    """
    keys = [c for c in pages.columns if c != html_col] if keys is None else keys
    raw = walk_pages(pages, keys, html_col, lambda h: (read_nutrition(h),),
                     list(NUTRITION_SCHEMA.fields))
    rows = F.filter(F.col("nutrient_cells"), lambda c, i: (i > 0) & (F.size(c) == 3))
    nutrients = F.transform(rows, lambda c: F.struct(c[0].alias("nutrient"),
                                                     c[1].alias("quantity"),
                                                     c[2].alias("unit")))
    return raw.select(*keys, "reference_intake", "serving_size", "uom",
                      nutrients.alias("nutrients"), "description", "parse_error")


def type_tile_json(tiles: DataFrame) -> DataFrame:
    """Raw JSON-tile rows → typed columns (JSON decoded natively)."""
    j = json_fields("impression", specs.TILE_JSON_FIELDS)
    return tiles.withColumn("_j", j).select(
        *[c for c in tiles.columns if c not in ("impression",)],
        F.col("_j.name").alias("product_name"),
        F.col("_j.id").alias("product_id"),
        F.col("_j.price").alias("price"),
        F.col("_j.brand").alias("brand"),
        F.col("_j.category").alias("category_name"),
    )


def type_card(tiles: DataFrame) -> DataFrame:
    return tiles.select("*", url_key("product_url").alias("product_id"),
                        parse_price("price_raw").alias("price"))


def type_tile_attr(tiles: DataFrame) -> DataFrame:
    c = json_fields("gtm_json", specs.CATEGORY_JSON_FIELDS)
    return tiles.withColumn("_c", c).select(
        *[x for x in tiles.columns if x != "gtm_json"],
        to_number(strip_text("price_raw")).alias("price"),
        F.col("_c.item_category").alias("category_l1"),
        F.col("_c.item_category2").alias("category_l2"),
        F.col("_c.item_category3").alias("category_l3"),
    )


TYPERS = {"tile_json": type_tile_json, "card": type_card, "tile_attr": type_tile_attr}


def extract_products(pages: DataFrame, layout: str, html_col: str = "html",
                     keys: list[str] | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Explode + type in one go."""
    return TYPERS[layout](explode_tiles(pages, layout, html_col, keys, num_partitions))


# Pages per parse task when a job sizes the page walk from the page count:
# a few hundred catalogue pages is tens of seconds of parsing per task.
PAGES_PER_TASK = 400


def walk_partitions(n_pages: int, spark) -> int:
    """Parse-task count for ``n_pages`` pages (at least the default parallelism)."""
    return max(default_parallelism(spark), -(-n_pages // PAGES_PER_TASK))


def page_links(pages: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """Per page: first ``<a href>`` in document order and the number of links."""
    ship_package(pages.sparkSession)
    f = link_facts(F.col(f"`{html_col}`"))
    return spread_pages(pages, keys, html_col).select(
        *[F.col(f"`{k}`") for k in keys], f["first_href"].alias("first_href"),
        f["n_links"].alias("n_links"))


def expected_count(html: Column | str) -> Column:
    """Largest digit run in the result counter (``1.234`` reads as 234)."""
    return max_digit_run(counter_text(F.col(html) if isinstance(html, str) else html))


def last_page(html: Column | str) -> Column:
    """``data-page`` of the last pager node as BIGINT; NULL when there is none."""
    pages = pager_pages(F.col(html) if isinstance(html, str) else html)
    return F.try_element_at(pages, F.lit(-1)).try_cast("bigint")
