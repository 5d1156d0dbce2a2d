"""Schema conformance: select in declared order, fill missing columns with
typed NULLs, drop extras, and check the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    pass


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed empty DataFrame (the seed of a union that forces the schema)."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, strict_types: bool = True) -> DataFrame:
    """Reindex ``df`` to ``schema``.

    Columns are matched by name; missing ones become ``NULL`` of the declared
    type, extra ones are dropped, present ones are cast (``try_cast``: a value
    that does not fit becomes NULL instead of failing the job).
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f"`{f.name}`")
            if strict_types and df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    out = df.select(*cols)
    assert_schema(out, schema)
    return out


def assert_schema(df: DataFrame, schema: T.StructType, check_types: bool = True) -> None:
    """Raise ``SchemaMismatch`` unless column names (and types) equal ``schema``."""
    if df.columns != schema.names:
        raise SchemaMismatch(f"columns {df.columns} != declared {schema.names}")
    if check_types:
        got = [f.dataType for f in df.schema.fields]
        want = [f.dataType for f in schema.fields]
        if got != want:
            raise SchemaMismatch(f"types {got} != declared {want}")


def union_conformed(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL of frames, each reindexed to ``schema`` first."""
    if not frames:
        raise ValueError("nothing to union")
    out = conform(frames[0], schema)
    for f in frames[1:]:
        out = out.unionByName(conform(f, schema))
    return out
