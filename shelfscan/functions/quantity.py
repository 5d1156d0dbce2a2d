"""Pack size out of a product name, unit standardisation and unit price.

All of it is native Column expressions (regexp_extract / CASE / struct), so a
name is scanned inside whole-stage codegen; nothing goes through Python.

Pack-size semantics: seven matchers are tried in a fixed order and every hit
after the first overwrites the triple (value, unit, quantity).  The matchers
after the plain weight one set all three fields, so the result is simply the
*last* matcher that hits, else the weight one.  The unit-count matcher's
alternatives include ``par`` and ``doses``, so it hits whenever the dose or
pair matcher does, and those two never decide.  Hence::

    coalesce(units, length, volume_pack, multipack, weight)

where each side is a nullable struct (NULL when its pattern does not hit).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Matcher patterns, unit lists and conversion factors that must
# equal the original tool's for the same results.  ``(?U)`` makes \d and \s
# Unicode-aware like Python's ``re``.
WEIGHT_PATTERN = r"(\d+(\.\d+)?)\s*(kg|g|l|ml)"
UNIT_PATTERN = r"(\d+)\s*(un|pieces|dozen|unit|meia\s*dúzia|par|rolos|doses)"
MULTIPACK_PATTERN = r"(\d+)\s*x\s*(\d+(\.\d+)?)\s*(kg|g|l|ml)"
VOLUME_PACK_PATTERN = r"(\d+)\s*x\s*(\d+)\s*(cl|ml)"
LENGTH_PATTERN = r"(\d+)\s*(mt|m)"
DOSE_PATTERN = r"(\d+)\s*(doses)"
PAIR_PATTERN = r"(\d+)\s*(par)"
DOZEN_UNITS = ["dozen", "meia dúzia"]
DOZEN_FACTOR = 12
MASS_UNITS = ["kg", "g"]
VOLUME_UNITS = ["l", "ml"]
THOUSAND_UNITS = ["kg", "l"]
COUNT_UNITS = ["unit", "un", "par", "pieces", "dozen", "meia dúzia", "rolos", "doses"]
# ---------------------------------------------------------------------------

UNICODE = "(?U)"

TRIPLE_TYPE = "struct<weight_value:double,weight_unit:string,quantity:bigint>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _match(name: Column, pattern: str, use) -> Column:
    """``use(group)`` where the pattern hits, else NULL.  The name is searched once;
    groups are then read from the short text that matched."""
    p = UNICODE + pattern

    def found(text: Column) -> Column:
        # Every pattern needs at least one digit, so a hit is never empty.
        return F.when(text != F.lit(""), use(lambda i: F.regexp_extract(text, p, i)))
    return _let(F.regexp_extract(name, p, 0), found)


def _triple(value: Column, unit: Column, qty: Column) -> Column:
    return F.struct(value.cast("double").alias("weight_value"),
                    unit.cast("string").alias("weight_unit"),
                    qty.cast("bigint").alias("quantity"))


def _num(text: Column, kind: str) -> Column:
    return text.try_cast(kind)


def _variant(pattern: str, decimal_comma: bool = False, word_boundary: bool = False) -> str:
    """Optional switches (both off = the original semantics): a decimal comma
    in the value (``0,75l`` → 0.75) and a word boundary after the unit (so
    ``3 garrafas`` is not 3 g)."""
    if decimal_comma:
        pattern = pattern.replace(r"(\.\d+)?", r"([.,]\d+)?")
    if word_boundary:
        pattern = pattern + r"\b"
    return pattern


def _value(text: Column) -> Column:
    return _num(F.replace(text, F.lit(","), F.lit(".")), "double")


def match_weight(name: Column | str, decimal_comma: bool = False,
                 word_boundary: bool = False) -> Column:
    """``0.75l`` → (0.75, 'l', NULL); NULL struct when there is no hit."""
    p = _variant(WEIGHT_PATTERN, decimal_comma, word_boundary)
    return _match(_col(name), p, lambda g: _triple(_value(g(1)), g(3), F.lit(None)))


def match_multipack(name: Column | str, decimal_comma: bool = False,
                    word_boundary: bool = False) -> Column:
    """``4x125 g`` → (125, 'g', 4)."""
    p = _variant(MULTIPACK_PATTERN, decimal_comma, word_boundary)
    return _match(_col(name), p, lambda g: _triple(_value(g(2)), g(4), _num(g(1), "bigint")))


def match_volume_pack(name: Column | str, word_boundary: bool = False) -> Column:
    """``6x25cl`` → (25, 'cl', 6)."""
    p = _variant(VOLUME_PACK_PATTERN, False, word_boundary)
    return _match(_col(name), p,
                  lambda g: _triple(_num(g(2), "double"), g(3), _num(g(1), "bigint")))


def match_length(name: Column | str, word_boundary: bool = False) -> Column:
    """``20m`` → (NULL, 'm', 20), only when the name has ``m`` but no ``ml``."""
    n = _col(name)
    p = _variant(LENGTH_PATTERN, False, word_boundary)
    guard = F.contains(n, F.lit("m")) & ~F.contains(n, F.lit("ml"))
    return F.when(guard, _match(n, p, lambda g: _triple(F.lit(None), g(2), _num(g(1), "bigint"))))


def match_doses(name: Column | str) -> Column:
    return _match(_col(name), DOSE_PATTERN,
                  lambda g: _triple(F.lit(None), F.lit("doses"), _num(g(1), "bigint")))


def match_pairs(name: Column | str) -> Column:
    return _match(_col(name), PAIR_PATTERN,
                  lambda g: _triple(F.lit(None), F.lit("par"), _num(g(1), "bigint")))


def match_units(name: Column | str, word_boundary: bool = False) -> Column:
    """``16 un`` → (NULL, 'un', 16); a dozen unit also sets value = qty × 12."""
    p = _variant(UNIT_PATTERN, False, word_boundary)

    def triple(qty: Column, unit: Column) -> Column:
        return _triple(F.when(unit.isin(DOZEN_UNITS), qty * F.lit(DOZEN_FACTOR)), unit, qty)
    return _match(_col(name), p, lambda g: _let(
        F.struct(_num(g(1), "bigint").alias("q"), g(2).alias("u")), lambda t: triple(t["q"], t["u"])))


def parse_quantity(name: Column | str, decimal_comma: bool = False,
                   word_boundary: bool = False) -> Column:
    """Pack size triple ``struct<weight_value, weight_unit, quantity>``.

    All three fields are NULL when neither a value nor a quantity comes out.
    ``decimal_comma`` and ``word_boundary`` are opt-in fixes of two documented
    quirks; both off reproduce the original results.
    """
    n = _col(name)
    wb = word_boundary
    t = F.coalesce(match_units(n, wb), match_length(n, wb), match_volume_pack(n, wb),
                   match_multipack(n, decimal_comma, wb), match_weight(n, decimal_comma, wb))
    return _let(t, lambda x: F.when(
        x["weight_value"].isNotNull() | x["quantity"].isNotNull(), x)).cast(TRIPLE_TYPE)


def to_base_unit(value: Column | str, unit: Column | str) -> Column:
    """kg and l ×1000, g and ml as is (grams or millilitres); else NULL."""
    v, u = _col(value), _col(unit)
    return (F.when(u.isin(THOUSAND_UNITS), v * F.lit(1000.0))
            .when(u.isin(["g", "ml"]), v.cast("double")))


def to_ml(value: Column | str, unit: Column | str) -> Column:
    """l ×1000, ml as is; else NULL."""
    v, u = _col(value), _col(unit)
    return F.when(u == "l", v * F.lit(1000.0)).when(u == "ml", v.cast("double"))


def standardise(triple: Column) -> Column:
    """(value, unit, qty) → grams / millilitres, or a bare count.

    Mass and volume units convert and keep only the base unit; count units keep
    only the quantity; everything else (cl, m, mt, unknown) becomes all NULL.
    """
    def standard(t: Column) -> Column:
        v, u, q = t["weight_value"], t["weight_unit"], t["quantity"]
        base = u.isin(MASS_UNITS + VOLUME_UNITS)
        std_unit = F.when(u.isin(MASS_UNITS), F.lit("g")).when(u.isin(VOLUME_UNITS), F.lit("ml"))
        return _triple(F.when(base, to_base_unit(v, u)), std_unit, F.when(u.isin(COUNT_UNITS), q))
    return _let(triple, standard)


def price_per_unit(price: Column | str, std_value: Column | str) -> Column:
    """Price per gram or millilitre; NULL when there is no value or it is 0."""
    return F.try_divide(_col(price).cast("double"), _col(std_value))
