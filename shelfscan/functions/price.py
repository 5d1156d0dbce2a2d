"""Locale price text → number, as one native Column expression.

Rules (applied in order): render as text, drop every euro sign, keep what
precedes the first ``/``, strip surrounding white space; then if the text has
both ``,`` and ``.`` the dots are thousands separators (removed) and the comma
is the decimal mark; if it has only ``,`` that comma is the decimal mark;
otherwise the text is read as is.  Anything that is not a plain decimal number
afterwards is missing (NULL).  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency sign removed, unit separator, and the number shape a
# price must have after clean-up (sign, digits, optional fraction, exponent).
CURRENCY_SIGN = "€"
UNIT_SEPARATOR = "/"
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# The characters that Python's str.strip() removes (SQL trim() only removes blanks).
EDGE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Strip leading/trailing white space the way Python's ``str.strip`` does."""
    return F.btrim(_col(c), F.lit(EDGE_SPACE))


def clean_price_text(c: Column | str) -> Column:
    """Text part of the rules: euro sign out, unit suffix cut, separators fixed.

    With a comma every dot goes and the comma becomes the decimal mark; without
    dots there is nothing to remove, so both comma rules are one.
    """
    s = _col(c).cast("string")
    s = F.replace(s, F.lit(CURRENCY_SIGN), F.lit(""))
    s = strip_text(F.split_part(s, F.lit(UNIT_SEPARATOR), F.lit(1)))
    return F.when(F.contains(s, F.lit(",")),
                  F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
                  ).otherwise(s)


def to_number(text: Column) -> Column:
    """Guarded number parse: NULL unless the text is a plain decimal number.

    ``try_cast`` alone would accept ``1.5d``, ``2f``, ``nan`` and ``inf``; the
    pattern returns the whole text or, for anything else, an empty one, which
    is no number.  The text is spelled out once.
    """
    return F.regexp_extract(text, NUMBER_SHAPE, 0).try_cast("double")


def parse_price(c: Column | str) -> Column:
    """``0,95€ / UN`` → 0.95, ``1.234,56€`` → 1234.56, bad/empty → NULL."""
    return to_number(clean_price_text(c))
