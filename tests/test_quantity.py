"""Pack-size parse and standardisation goldens (worked out by hand from the
matcher order; each row names the quirk it pins)."""

import pytest
from pyspark.sql import functions as F

from shelfscan.functions.quantity import parse_quantity, price_per_unit, standardise

N = None
# name, parsed (value, unit, qty), standardised (value, unit, qty)
GOLDENS = [
    ("Agua 0.75l", (0.75, "l", N), (750.0, "ml", N)),
    ("Azeite 0,75l", (75.0, "l", N), (75000.0, "ml", N)),      # decimal comma not understood
    ("Iogurte 4x125 g", (125.0, "g", 4), (125.0, "g", N)),     # pack count lost when standardised
    ("Bifes 2×150 g", (150.0, "g", N), (150.0, "g", N)),       # × is not x
    ("Cerveja 6x25cl", (25.0, "cl", 6), (N, N, N)),            # cl has no conversion
    ("Cafe 16 un", (N, "un", 16), (N, N, 16)),
    ("Cafe 16nun", (N, N, N), (N, N, N)),
    ("12 units", (N, "un", 12), (N, N, 12)),                   # un is tried before unit
    ("2 dozen", (24.0, "dozen", 2), (N, N, 2)),
    ("Ovos 6 meia dúzia", (72.0, "meia dúzia", 6), (N, N, 6)),  # ×12, not ×6
    ("Sumo 1 L", (N, N, N), (N, N, N)),                        # case-sensitive
    ("Corda 20m", (N, "m", 20), (N, N, N)),
    ("Leite 500 ml", (500.0, "ml", N), (500.0, "ml", N)),
    ("Caixa 2 massas 500g", (N, "m", 2), (N, N, N)),           # "2 m" of massas wins
    ("Pack 3 garrafas", (3.0, "g", N), (3.0, "g", N)),         # no word boundary
    ("1 para", (N, "par", 1), (N, N, 1)),
    (None, (N, N, N), (N, N, N)),                              # missing name → NULLs
]


def _rows(df, col):
    return [(r[col]["weight_value"] if r[col] else None,
             r[col]["weight_unit"] if r[col] else None,
             r[col]["quantity"] if r[col] else None) for r in df.collect()]


def test_parse_and_standardise(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDENS)], "i int, name string")
    out = (df.withColumn("t", parse_quantity("name"))
             .withColumn("s", standardise(F.col("t"))).orderBy("i"))
    got_t = _rows(out.select("t"), "t")
    got_s = _rows(out.select("s"), "s")
    for g, t, s in zip(GOLDENS, got_t, got_s):
        assert t == g[1], (g[0], t)
        assert s == g[2], (g[0], s)


def test_price_per_unit_zero_and_missing(spark):
    df = spark.createDataFrame([(4.49, 1000.0), (1.0, 0.0), (2.0, None)], "p double, v double")
    got = [r.u for r in df.select(price_per_unit("p", "v").alias("u")).collect()]
    assert got[0] == pytest.approx(0.00449)
    assert got[1] is None and got[2] is None


def test_property_roundtrip(spark):
    """Format (value, unit) → name → parse gives the value back for names
    free of the documented traps."""

    rows = []
    import random
    rnd = random.Random(7)
    for i in range(300):
        v = rnd.randint(1, 5000)
        u = rnd.choice(["kg", "g", "l", "ml"])
        sep = rnd.choice(["", " "])
        rows.append((i, f"Produto {v}{sep}{u}", float(v), u))
    df = spark.createDataFrame(rows, "i int, name string, v double, u string")
    bad = df.withColumn("t", parse_quantity("name")).where(
        (F.col("t.weight_value") != F.col("v")) | (F.col("t.weight_unit") != F.col("u"))
        | F.col("t").isNull())
    assert bad.count() == 0


def test_optional_switches(spark):
    """Both switches off reproduce the goldens above; each on fixes one quirk."""
    names = ["Azeite 0,75l", "Pack 3 garrafas", "Caixa 2 massas 500g", "Leite 500 ml",
             "Iogurte 4x1,5 kg", "Cafe 16 un"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    out = df.select("i", parse_quantity("name", decimal_comma=True).alias("dc"),
                    parse_quantity("name", word_boundary=True).alias("wb")).orderBy("i").collect()
    dc = [(r.dc.weight_value, r.dc.weight_unit, r.dc.quantity) if r.dc else None for r in out]
    wb = [(r.wb.weight_value, r.wb.weight_unit, r.wb.quantity) if r.wb else None for r in out]
    assert dc[0] == (0.75, "l", None)          # decimal comma understood
    assert dc[4] == (1.5, "kg", 4)
    assert wb[1] is None                        # 'garrafas' is not grams
    assert wb[2] == (500.0, "g", None)          # 'massas' no longer a length
    assert wb[3] == (500.0, "ml", None) and wb[5] == (None, "un", 16)
