"""Harmonise retailer snapshots into one (product_name, price, source) table
and compute the pack-size / unit-price table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import specs
from ..functions.price import parse_price
from ..functions.quantity import parse_quantity, price_per_unit, standardise
from .ordering import with_row_index


def _sources(labels: dict[str, str] | None):
    out = []
    for s in specs.SOURCES:
        lab = (labels or {}).get(s.key, s.label)
        out.append((s, lab))
    return out


def harmonise(frames: dict[str, DataFrame], labels: dict[str, str] | None = None,
              drop_missing: bool = False, with_rank: bool = False,
              with_basis: bool = False) -> DataFrame:
    """UNION ALL of the per-source two-column projections, tagged by source.

    ``frames`` maps a source key (``r1``, ``r2``, ``r3``) to its snapshot
    DataFrame.  Each block is projected to (name, price text) by the source's
    mapping *before* the union, so the scan reads two columns per source.
    The price goes through the locale parser; rows whose price does not parse
    are kept with a NULL price unless ``drop_missing``.  ``with_basis`` adds
    ``price_basis`` (``unit`` or ``shelf``): the first source's harmonised price
    is its per-kg/per-litre text, the others' a shelf price.
    """
    unknown = sorted(set(frames) - {s.key for s in specs.SOURCES})
    if unknown:
        raise ValueError(f"no mapping for the sources {unknown}")
    parts = []
    for s, lab in _sources(labels):
        if s.key not in frames:
            continue
        df = frames[s.key]
        cols = [F.col(f"`{s.name_column}`").cast("string").alias("product_name"),
                parse_price(F.col(f"`{s.price_column}`")).alias("price"),
                F.lit(lab).alias("source")]
        if with_rank:
            cols.append(F.lit(s.rank).alias("source_rank"))
        if with_basis:
            cols.append(F.lit(s.price_basis).alias("price_basis"))
        parts.append(df.select(*cols))
    if not parts:
        raise ValueError("no source frames given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if drop_missing:
        out = out.where(F.col("price").isNotNull())
    return out


def harmonise_products(snapshot: DataFrame, labels: dict[str, str] | None = None,
                       drop_missing: bool = False, with_basis: bool = False) -> DataFrame:
    """The harmonised table straight from the typed ``product_snapshot``.

    Same meaning as :func:`harmonise` over the CSV folders: a source whose
    harmonised price is its unit-price text (``price_basis == "unit"``) takes
    the parsed ``unit_price_raw``, the others their shelf ``price``.  One scan
    of two or three columns; ``source``/``snapshot_date`` filters applied by the
    caller prune partitions.
    """
    key = F.col("source")
    unit_keys = [s.key for s in specs.SOURCES if s.price_basis == "unit"]
    price = F.when(key.isin(unit_keys), parse_price("unit_price_raw")).otherwise(F.col("price"))
    label = F.lit(None).cast("string")
    basis = F.lit(None).cast("string")
    for s, lab in reversed(_sources(labels)):
        label = F.when(key == s.key, F.lit(lab)).otherwise(label)
        basis = F.when(key == s.key, F.lit(s.price_basis)).otherwise(basis)
    cols = [F.col("product_name"), price.alias("price"), label.alias("source")]
    if with_basis:
        cols.append(basis.alias("price_basis"))
    out = snapshot.select(*cols)
    return out.where(F.col("price").isNotNull()) if drop_missing else out


def with_harmonised_index(harmonised: DataFrame, name: str = "row_index") -> DataFrame:
    """0..n-1 over the harmonised table in block order, then name, then price.

    The order is explicit (block rank, name, price) so a re-run numbers the
    same rows the same way; rows tied on all three are identical in every
    output column but the index.
    """
    if "source_rank" not in harmonised.columns:
        raise ValueError("harmonise(..., with_rank=True) is needed for an ordered index")
    order = [F.col("source_rank").asc(), F.col("product_name").asc_nulls_last(),
             F.col("price").asc_nulls_last()]
    return with_row_index(harmonised, order, None, name).drop("source_rank")


def unit_price(df: DataFrame, name_col: str = "product_name",
               price_col: str = "product_price") -> DataFrame:
    """Pack size → grams/ml → price per gram or ml, on the same rows.

    Output columns: Weight_Value, Weight_Unit, Quantity, product_name,
    product_price, price_per_unit.  The derived columns sit on the row they
    come from, so no join (positional or keyed) is needed.
    """
    std = standardise(parse_quantity(name_col))
    price = F.col(price_col)
    if dict(df.dtypes).get(price_col) == "string":
        price = parse_price(price)
    return df.select(std.alias("_s"), F.col(name_col).alias("product_name"),
                     price.cast("double").alias("product_price")).select(
        F.col("_s.weight_value").alias("Weight_Value"),
        F.col("_s.weight_unit").alias("Weight_Unit"),
        F.col("_s.quantity").alias("Quantity"),
        "product_name", "product_price",
        price_per_unit("product_price", "_s.weight_value").alias("price_per_unit"))
