"""Predicates the crawlers sent as request parameters, applied as filters.

Written as plain ``where`` on columns so Catalyst pushes them into the Parquet
scan (``PushedFilters``) and, on partition columns, prunes directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import specs
from ..functions.text import attribute_present


def min_price(df: DataFrame, price_col: str = "price", pmin: float = specs.MIN_PRICE) -> DataFrame:
    """Keep rows priced at least ``pmin`` (a NULL price never passes)."""
    return df.where(F.col(price_col) >= F.lit(pmin))


def attr_equals(df: DataFrame, name: str, value) -> DataFrame:
    """Keep rows whose attribute ``name`` equals ``value``."""
    return df.where(F.col(f"`{name}`") == F.lit(value))


def categories(df: DataFrame, wanted: list[str], col: str = "category") -> DataFrame:
    """Keep the listed categories (partition pruning on ``category``)."""
    return df.where(F.col(col).isin(list(wanted)))


def drop_missing(df: DataFrame, col: str = "price") -> DataFrame:
    return df.where(F.col(col).isNotNull())


def with_attribute(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose attribute is present and non-empty."""
    return df.where(attribute_present(col))
