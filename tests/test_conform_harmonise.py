"""Schema conformance, harmonisation invariants and the unit-price table."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.operators.conform import SchemaMismatch, assert_schema, conform, empty_frame, union_conformed
from shelfscan.operators.harmonise import harmonise, unit_price, with_harmonised_index
from shelfscan.schemas import HARMONISED, R1_CSV, R2_CSV, R3_CSV

S = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                  T.StructField("c", T.DoubleType())])


def test_conform_fills_drops_and_casts(spark):
    df = spark.createDataFrame([("7", "x", "extra")], "a string, b string, z string")
    out = conform(df, S)
    assert out.columns == ["a", "b", "c"]
    assert out.first().asDict() == {"a": 7, "b": "x", "c": None}
    bad = spark.createDataFrame([("seven",)], "a string")
    assert conform(bad, S).first().a is None          # does not fit → NULL, job goes on
    with pytest.raises(SchemaMismatch):
        assert_schema(df, S)
    e = empty_frame(spark, S)
    assert e.count() == 0 and e.schema == S
    u = union_conformed([e, df, bad], S)
    assert u.count() == 2


def _frames(spark):
    r1 = spark.createDataFrame([("Queijo 200g", "1", 2.49, "12,45€/kg")],
                               "`Product Name` string, `Product ID` string, Price double, "
                               "`Price per unit` string")
    r1 = conform(r1, R1_CSV)
    r2 = conform(spark.createDataFrame(
        [("a", "Arroz Agulha 1kg", "4,49€ / UN"), ("b", "Esgotado", "")],
        "product_id string, product_name string, product_price string"), R2_CSV)
    r3 = conform(spark.createDataFrame([("c", "Leite 1l", 0.89), ("d", "Sal", None)],
                                       "product_id string, product_name string, product_price double"),
                 R3_CSV)
    return {"r1": r1, "r2": r2, "r3": r3}


def test_harmonise_rows_and_types(spark):
    fr = _frames(spark)
    h = harmonise(fr)
    assert [(f.name, f.dataType) for f in h.schema] == [(f.name, f.dataType) for f in HARMONISED]
    rows = h.collect()
    assert len(rows) == sum(f.count() for f in fr.values())   # rows conserved
    got = {(r.product_name, r.source): r.price for r in rows}
    assert got[("Queijo 200g", "R1")] == 12.45      # R1 uses its unit-price text
    assert got[("Arroz Agulha 1kg", "R2")] == 4.49
    assert got[("Esgotado", "R2")] is None          # kept with a missing price
    assert got[("Leite 1l", "R3")] == 0.89
    assert not any(isinstance(r.price, float) and math.isnan(r.price) for r in rows)
    assert harmonise(fr, drop_missing=True).count() == 3
    basis = {(r.source, r.price_basis) for r in harmonise(fr, with_basis=True).collect()}
    assert basis == {("R1", "unit"), ("R2", "shelf"), ("R3", "shelf")}
    labelled = {r.source for r in harmonise(fr, labels={"r2": "Shop Two"}).collect()}
    assert labelled == {"R1", "Shop Two", "R3"}
    idx = with_harmonised_index(harmonise(fr, with_rank=True)).orderBy("row_index").collect()
    assert [r.row_index for r in idx] == list(range(5))
    assert [r.source for r in idx] == ["R1", "R2", "R2", "R3", "R3"]


def test_unit_price_table(spark):
    df = spark.createDataFrame([("Arroz Agulha 1kg", "4,49€ / UN"), ("Ovos 12 un", "2,10€"),
                                ("Agua 0.75l", "0,30€")], "product_name string, product_price string")
    out = {r.product_name: r for r in unit_price(df).collect()}
    assert unit_price(df).columns == ["Weight_Value", "Weight_Unit", "Quantity", "product_name",
                                      "product_price", "price_per_unit"]
    a = out["Arroz Agulha 1kg"]
    assert (a.Weight_Value, a.Weight_Unit, a.product_price) == (1000.0, "g", 4.49)
    assert a.price_per_unit == pytest.approx(0.00449)
    o = out["Ovos 12 un"]
    assert (o.Weight_Value, o.Quantity, o.price_per_unit) == (None, 12, None)
    assert out["Agua 0.75l"].price_per_unit == pytest.approx(0.30 / 750)


def test_filters(spark):
    from shelfscan.operators import filters as FL
    df = spark.createDataFrame([("a", 0.0, "x", "frescos"), ("b", 0.01, "", "bebidas"),
                                ("c", None, None, "frescos")],
                               "id string, price double, attr string, category string")
    assert [r.id for r in FL.min_price(df).collect()] == ["b"]
    assert [r.id for r in FL.with_attribute(df, "attr").collect()] == ["a"]
    assert sorted(r.id for r in FL.categories(df, ["frescos"]).collect()) == ["a", "c"]
    assert [r.id for r in FL.attr_equals(df, "attr", "x").collect()] == ["a"]
    assert sorted(r.id for r in FL.drop_missing(df).collect()) == ["a", "b"]
