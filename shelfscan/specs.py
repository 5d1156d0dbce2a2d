"""Per-source configuration.  Sources are data, not code: a layout names the
tile node and, per output field, where it sits inside the tile and how it is
read.  The page walk (mapInArrow) interprets these; the typed projection after it is
native Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Step:
    """One ``find`` step: first descendant with this tag / class token / attribute."""
    tag: str | None
    cls: str | None = None
    attr: str | None = None


@dataclass(frozen=True)
class Pick:
    """A string field of a tile.

    ``path`` is a chain of find steps from the tile (empty → the tile itself);
    ``take`` is ``attr:<name>``, ``text`` (joined then stripped at the ends) or
    ``tight`` (every fragment stripped, joined with nothing).  A missing
    ``required`` node or attribute records a ``parse_error`` on the row.
    """
    name: str
    path: tuple[Step, ...]
    take: str
    required: bool = False


@dataclass(frozen=True)
class Items:
    """A repeated node under the tile read as ``array<struct<...attrs>>``."""
    name: str
    step: Step
    attrs: tuple[str, ...]
    required_attrs: bool = True


@dataclass(frozen=True)
class TileLayout:
    name: str
    tile: Step
    picks: tuple[Pick, ...]
    items: tuple[Items, ...] = field(default_factory=tuple)


# ---------------------------------------------------------------------------
# The markup each retailer layout uses (tags, class names and
# attribute names must equal the pages' own).
TILE_JSON = TileLayout(
    name="tile_json",
    tile=Step("div", "product-tile"),
    picks=(
        Pick("impression", (), "attr:data-product-tile-impression"),
        Pick("image_url", (Step("img", "ct-tile-image"),), "attr:data-src"),
        Pick("unit_price_raw", (Step("div", "pwc-tile--price-secondary"),), "tight"),
        Pick("min_quantity", (Step("p", "pwc-tile--quantity"),), "tight"),
        Pick("product_url", (Step("a", None, "href"),), "attr:href"),
    ),
)

CARD = TileLayout(
    name="card",
    tile=Step("div", "product-cards"),
    picks=(
        Pick("product_url", (Step("a", "product-cards__link"),), "attr:href", True),
        Pick("product_name", (Step("h3", "product-cards__title"),), "text", True),
        Pick("price_raw", (Step("span", "product-cards_price"),), "text", True),
        Pick("image_url", (Step("img", "product-cards__image"),), "attr:src", True),
        Pick("rating", (Step("div", "bv_text"),), "text"),
    ),
)

TILE_ATTR = TileLayout(
    name="tile_attr",
    tile=Step("div", "product"),
    picks=(
        Pick("product_id", (), "attr:data-pid", True),
        Pick("product_urls", (Step("div", "product-tile"),), "attr:data-urls", True),
        Pick("product_name", (Step("div", "pdp-link"), Step("a")), "text", True),
        Pick("price_raw", (Step("span", "value"),), "attr:content", True),
        Pick("gtm_json", (Step("div", "product-tile"),), "attr:data-gtm-new", True),
        Pick("image_url", (Step("div", "image-container"), Step("img")), "attr:src", True),
        Pick("rating", (Step("div", "auc-product-tile__bazaarvoice--ratings"),),
             "attr:data-bv-product-id", True),
        Pick("promotion", (Step("div", "auc-price__promotion__label"),), "text"),
    ),
    items=(Items("labels", Step("img", "auc-product-labels__icon"), ("alt", "title")),),
)

LAYOUTS = {lay.name: lay for lay in (TILE_JSON, CARD, TILE_ATTR)}

# Page-level nodes.
RESULT_COUNTER = Step("div", "search-results-products-counter d-flex justify-content-center")
PAGER_NODE = Step("div", "page js-change-page", "data-page")
PAGER_ATTR = "data-page"

# Product detail (nutrition) page.
NUTRITION_REFERENCE = Step("div", "daily-value-intake-reference")
NUTRITION_SERVING = Step("div", "serving-size")
NUTRITION_UOM = Step("div", "serving-size--uom")
NUTRITION_TABLE = Step("div", "nutrients-table")
NUTRITION_ROW = Step("div", "nutrients-row")
NUTRITION_CELL = Step("div", "nutriInfo-details")
DESCRIPTION_BLOCK = Step("div", "ct-pdp--description-content")
DESCRIPTION_HEADER = Step("p", "mb-0")

# JSON attribute shapes.
TILE_JSON_FIELDS = "name string, id string, price double, brand string, category string"
CATEGORY_JSON_FIELDS = "item_category string, item_category2 string, item_category3 string"

# Request-side defaults of the original crawlers, kept as filter/paging
# parameters: minimum price, attribute filter, page sizes.
MIN_PRICE = 0.01
ATTR_FILTER = ("soldInStores", "000")
PAGE_SIZE_TILE_JSON = 216
PAGE_SIZE_TILE_ATTR = 212
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceSpec:
    """How one retailer's snapshot feeds the harmonised table."""
    key: str            # short id used in paths/partitions
    label: str          # value written to ``source`` by the harmoniser
    layout: str         # tile layout of its landed pages
    name_column: str    # snapshot column holding the product name
    price_column: str   # snapshot column holding the harmonised price
    rank: int           # block order in the harmonised table
    price_basis: str    # what the harmonised price means: per unit, or shelf price


# The harmonised price of the JSON-tile source is its *unit* price text
# (e.g. "3,99€/kg"); the other two use their shelf price.  Labels are
# configuration; pass your own to ``harmonise`` to change them.
SOURCES = (
    SourceSpec("r1", "R1", "tile_json", "Product Name", "Price per unit", 0, "unit"),
    SourceSpec("r2", "R2", "card", "product_name", "product_price", 1, "shelf"),
    SourceSpec("r3", "R3", "tile_attr", "product_name", "product_price", 2, "shelf"),
)
SOURCE_BY_KEY = {s.key: s for s in SOURCES}
