"""The same product at several retailers, and where it is cheapest.

Retailers spell a product differently.  Offers are compared by the words of their names (case,
accents, punctuation and the pack size's text taken off) among offers of one pack size: two are the
same product if the Jaccard similarity of their words is at least ``percent``.

No offer meets all others.  Equal words are one class from the start, combined before the shuffle.
Classes of one pack size meet if they share a word that the prefix filter leaves: with words ordered
from rare to frequent, two similar sets share one of their first n - ceil(similarity * n) + 1.
A word that more than ``hot`` classes of a pack size have does not bring them together by
itself: it needs a second shared word among one more of the first (two similar sets that differ share
two, as ``percent`` is above 50).  So hot blocks are split and no link is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantity import parse_quantity, standardise
from .ordering import materialize

PERCENT = 70
HOT = 200

# Letters with accents and without.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñý"
PLAIN = "aaaaaaeeeeiiiiooooouuuucny"
SIZE_TEXT = (r"\b\d+(?:[.,]\d+)?\s*(?:[x×]\s*\d+(?:[.,]\d+)?\s*)?"
             r"(?:kg|gr|g|ml|cl|l|un|unidades|doses|m)\b")


def name_words(name: Column | str) -> Column:
    """Sorted distinct words of a product name without its pack size; NULL for NULL."""
    text = F.translate(F.lower(F.col(name) if isinstance(name, str) else name), ACCENTED, PLAIN)
    words = F.split(F.regexp_replace(text, SIZE_TEXT, " "), "[^a-z0-9]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def offers(rows: DataFrame, source: str = "source", product_id: str = "product_id",
           name: str = "product_name", price: str = "price") -> DataFrame:
    """``source, product_id, words, size_value, size_unit, quantity, unit_price``: the price per gram,
    millilitre or piece, or of the whole without a pack size."""
    std = standardise(parse_quantity(name))
    out = rows.select(F.col(source).alias("source"), F.col(product_id).alias("product_id"),
                      name_words(name).alias("words"), F.col(price).cast("double").alias("price"),
                      std.alias("s"))
    # kilograms times 1000 can miss the grams by a rounding
    out = out.select("source", "product_id", "words", "price", F.round("s.weight_value", 3).alias("size_value"),
                     F.col("s.weight_unit").alias("size_unit"), F.col("s.quantity").alias("quantity"))
    return out.withColumn("unit_price", F.try_divide("price", F.coalesce(
        "size_value", F.col("quantity").cast("double"), F.lit(1.0)))).drop("price")


SIZE = ["size_value", "size_unit", "quantity"]


def product_classes(priced: DataFrame) -> DataFrame:
    """``c, words, size, block, sources, best`` per set of words and pack size.  ``best`` is the
    cheapest offer (unit price, source, id: ties go to the smaller source, then id)."""
    offer = F.struct("unit_price", "source", "product_id")
    classes = priced.where("size(words) > 0").groupBy("words", *SIZE).agg(
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.min(F.when(F.col("unit_price").isNotNull(), offer)).alias("best"))
    return materialize(classes.withColumn("c", F.monotonically_increasing_id())
                       .withColumn("block", F.xxhash64(*SIZE)))


def similar_classes(classes: DataFrame, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """``a, b``: classes of one pack size whose words are similar enough; a < b."""
    if not 50 < percent <= 100:
        raise ValueError("percent must lie above 50")
    word = classes.select("c", "block", F.explode("words").alias("w"))
    often = word.groupBy("block", "w").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    # a word of one class only comes first and meets nobody
    ranked = (word.join(often, ["block", "w"])
              .groupBy("c").agg(F.array_sort(F.collect_list(F.struct("m", "w"))).alias("common")))
    n = F.size("words")
    alone = n - F.size("common")
    first = F.greatest(n - F.ceil(n * F.lit(percent) / 100).cast("int") + 1 - alone, F.lit(0))
    p = (classes.join(ranked, "c")
         .select("c", "block", "words", *SIZE, F.slice("common", F.lit(1), first).alias("one"),
                 F.slice("common", F.lit(1), first + 1).alias("two")))
    single = (p.select("*", F.explode("one").alias("u")).where(F.col("u.m") <= hot)
              .withColumn("key", F.xxhash64("block", "u.w")))
    double = (p.select("*", F.explode("one").alias("u")).where(F.col("u.m") > hot)
              .select("*", F.explode("two").alias("v")).where("u.w <> v.w")
              .withColumn("key", F.xxhash64("block", F.least("u.w", "v.w"), F.greatest("u.w", "v.w")))
              .drop("v"))
    rows = single.unionByName(double).select("key", "c", "words", *SIZE)
    a, b = rows.alias("a"), rows.alias("b")
    both = F.size(F.array_intersect("a.words", "b.words"))
    either = F.size("a.words") + F.size("b.words") - both
    same_size = F.lit(True)
    for s in SIZE:      # the keys are hashes
        same_size &= F.col(f"a.{s}").eqNullSafe(F.col(f"b.{s}"))
    return (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.c") < F.col("b.c")))
            .where(same_size & (both * 100 >= either * percent))
            .select(F.col("a.c").alias("a"), F.col("b.c").alias("b")).distinct())


def cheapest_sources(rows: DataFrame, source: str = "source", product_id: str = "product_id",
                     name: str = "product_name", price: str = "price", percent: int = PERCENT,
                     hot: int = HOT) -> DataFrame:
    """``product, size_value, size_unit, quantity, n_sources, cheapest_source, cheapest_id,
    unit_price``: one row per different set of words and pack size, with the cheapest of its own
    offers and those of the classes similar to it, and at how many retailers these are.

    Ties in the unit price go to the smaller source, then the smaller id.  Offers without a price
    count as listed but are never the cheapest (NULL if there is none with a price); names
    without a word are left out.
    """
    classes = product_classes(offers(rows, source, product_id, name, price))
    links = similar_classes(classes, percent, hot)
    own = classes.select("c", F.col("c").alias("other"))
    each = own.union(links.select("a", "b")).union(links.select("b", "a"))
    met = each.join(classes.select(F.col("c").alias("other"), "sources", "best"), "other")
    best = met.groupBy("c").agg(F.min("best").alias("best"))
    shops = (met.select("c", F.explode("sources").alias("source")).distinct()
             .groupBy("c").agg(F.count(F.lit(1)).alias("n_sources")))
    return (classes.drop("best").join(best, "c").join(shops, "c", "left")
            .select(F.array_join("words", " ").alias("product"), *SIZE,
                    F.coalesce("n_sources", F.lit(0)).alias("n_sources"),
                    F.col("best.source").alias("cheapest_source"),
                    F.col("best.product_id").alias("cheapest_id"),
                    F.col("best.unit_price").alias("unit_price")))
