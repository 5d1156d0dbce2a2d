"""Helpers shared by the training-data operators.

Every operator takes a documents-like DataFrame and the names of its id and
text columns, selects only what it needs under reserved names (so extra
columns, whatever they are called, cannot clash) and identifies a row by the
pair ``k1, k2``: 128 bits over (id, text).  Rows that repeat id and text are
the same document to every operator; ids may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.session import ensure_checkpoint_dir, scratch_path, ship_package

# Bytes per Arrow batch handed to a Python worker: documents are heavy rows.
ARROW_BATCH_BYTES = 16 * 1024 * 1024

# The two alphabets of the A-Z lower-casing in the contracts.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder, code shipping and byte-bounded Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Evaluate once and cut the lineage: a reliable checkpoint in the shared
    folder named by ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut``, as a compressed Parquet table in the same shared folder:
    for many rows with repeating columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """``k1, k2``: identity of a row, 128 bits, never null."""
    return [F.xxhash64(doc_id, text).alias("k1"),
            F.xxhash64(F.lit(2), text, doc_id).alias("k2")]


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           *more: Column) -> DataFrame:
    """``doc_id, k1, k2, body`` and the columns in ``more``; ``body`` is the
    text's UTF-8 bytes."""
    did, text = docs[id_col].cast("long"), docs[text_col]
    return docs.select(did.alias("doc_id"), *row_key(did, text),
                       text.cast("binary").alias("body"), *more)


def join_rows(docs: DataFrame, facts: DataFrame, how: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` joined with ``facts`` (``k1, k2`` and reserved names) by row."""
    did = docs[id_col].cast("long")
    a, b = row_key(did, docs[text_col])
    keyed = docs.select("*", a.alias("_row_k1"), b.alias("_row_k2"))
    f = facts.withColumnsRenamed({"k1": "_row_k1", "k2": "_row_k2"})
    return keyed.join(f, ["_row_k1", "_row_k2"], how)


def longs(values: list[int]) -> str:
    """SQL text of an array of longs (one literal instead of a column per value)."""
    return f"array({', '.join(f'{v}L' for v in values)})"


def bucket_of(x: Column, bounds: list, to_sql=longs) -> Column:
    """Number of sorted ``bounds`` that are <= x, by a two-level lookup: about
    2 * sqrt(len(bounds)) comparisons, inside the JVM.

    ``to_sql`` writes a list of bounds as an SQL array of x's type."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.expr(to_sql([c[0] for c in chunks]))
    rest = F.expr(f"array({', '.join(map(to_sql, chunks))})")
    c = F.size(F.filter(heads, lambda b: b <= x))
    inside = F.size(F.filter(F.element_at(rest, F.greatest(c, F.lit(1))), lambda b: b <= x))
    return F.when(c == 0, F.lit(0)).otherwise((c - 1) * step + inside)


def same(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` by name, for selecting them back after a join."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


SKETCH_BITS = 1 << 25   # 4 MB


def likely_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``k1, k2`` may be in ``keys``: all that are, and few others while
    ``keys`` has fewer rows than SKETCH_BITS.  Only a bitmap of that fixed size is broadcast,
    so that a join that follows shuffles little where few rows are wanted."""
    place = F.pmod(F.xxhash64("k1", "k2"), F.lit(SKETCH_BITS))
    bits = (keys.select(place.alias("_h")).groupBy(F.expr("bitmap_bucket_number(_h)").alias("_bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_h))").alias("_bits")))
    byte = "conv(hex(substring(_bits, cast(bitmap_bit_position(_h) div 8 as int) + 1, 1)), 16, 10)"
    return (docs.withColumn("_h", place).withColumn("_bucket", F.expr("bitmap_bucket_number(_h)"))
            .join(F.broadcast(bits), "_bucket")
            .where(F.expr(f"getbit(cast({byte} as bigint), cast(bitmap_bit_position(_h) % 8 as int)) = 1"))
            .select(*docs.columns))


def partitions_for(rows: int, spark: SparkSession, per_task: int = 20_000) -> int:
    """Tasks for documents: as many as the session's shuffles have, more for many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
