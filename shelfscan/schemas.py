"""Declared schemas.  Nothing is ever read with schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# Snapshot CSVs as the three crawlers wrote them.
R1_CSV = T.StructType([
    T.StructField("Product Name", S), T.StructField("Product ID", S),
    T.StructField("Price", D), T.StructField("Price per unit", S),
    T.StructField("Brand", S), T.StructField("Category", S),
    T.StructField("Image URL", S), T.StructField("Minimum Quantity", S),
    T.StructField("Product Link", S), T.StructField("cgid", S),
    T.StructField("tracking_date", S), T.StructField("source", S),
])

R2_CSV = T.StructType([
    T.StructField("product_id", S), T.StructField("product_name", S),
    T.StructField("product_price", S), T.StructField("product_image", S),
    T.StructField("product_url", S), T.StructField("product_rating", S),
    T.StructField("source", S), T.StructField("timestamp", S),
])

R3_CSV = T.StructType([
    T.StructField("product_id", S), T.StructField("product_name", S),
    T.StructField("product_price", D), T.StructField("product_category", S),
    T.StructField("product_category2", S), T.StructField("product_category3", S),
    T.StructField("product_image", S), T.StructField("product_urls", S),
    T.StructField("product_ratings", S), T.StructField("product_labels", S),
    T.StructField("product_promotions", S), T.StructField("source", S),
    T.StructField("timestamp", S),
])

CSV_SCHEMAS = {"r1": R1_CSV, "r2": R2_CSV, "r3": R3_CSV}
# Without these a file is no snapshot of its source.
MANDATORY_COLUMNS = {"r1": ["Product ID", "Product Name"], "r2": ["product_id", "product_name"],
                     "r3": ["product_id", "product_name"]}

LABEL = T.StructType([T.StructField("alt", S), T.StructField("title", S)])

# Bronze: landed pages.
PAGES_RAW = T.StructType([
    T.StructField("source", S), T.StructField("category", S),
    T.StructField("snapshot_date", T.DateType()), T.StructField("page_no", I),
    T.StructField("page_start", I), T.StructField("html", S),
])

# Silver: one typed product table for every source.
PRODUCT_SNAPSHOT = T.StructType([
    T.StructField("observed_at", T.TimestampNTZType()),
    T.StructField("product_id", S), T.StructField("product_name", S),
    T.StructField("brand", S), T.StructField("category_path", T.ArrayType(S)),
    T.StructField("price_raw", S), T.StructField("price", D),
    T.StructField("price_basis", S),
    T.StructField("unit_price_raw", S), T.StructField("min_quantity", S),
    T.StructField("image_url", S), T.StructField("product_url", S),
    T.StructField("rating", S), T.StructField("labels", T.ArrayType(LABEL)),
    T.StructField("promotion", S), T.StructField("parse_error", S),
    # where the product was found: page number or result offset, tile position
    T.StructField("page_no", I), T.StructField("page_start", I), T.StructField("tile_pos", L),
    # partition columns last, in partition order
    T.StructField("source", S), T.StructField("snapshot_date", T.DateType()),
    T.StructField("category", S),
])
PARTITION_COLUMNS = ["source", "snapshot_date", "category"]

HARMONISED = T.StructType([
    T.StructField("product_name", S), T.StructField("price", D), T.StructField("source", S),
])

UNIT_PRICE = T.StructType([
    T.StructField("Weight_Value", D), T.StructField("Weight_Unit", S),
    T.StructField("Quantity", L), T.StructField("product_name", S),
    T.StructField("product_price", D), T.StructField("price_per_unit", D),
])

NUTRIENT = T.StructType([T.StructField("nutrient", S), T.StructField("quantity", S),
                         T.StructField("unit", S)])
NUTRITION = T.StructType([
    T.StructField("reference_intake", S), T.StructField("serving_size", S),
    T.StructField("uom", S), T.StructField("nutrients", T.ArrayType(NUTRIENT)),
    T.StructField("description", T.MapType(S, S)),
])
