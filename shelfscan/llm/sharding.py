"""Sharding by sampled splitters, in DataFrame operations only.

Size-weighted samples of the sort key give quantile boundaries; records fall
into the ranges between them; ranges that turn out overfull are sampled again
and subdivided until none is left that can be split.  Exact sizes per range,
running sums inside ranges and range offsets then give every record its exact
place in the whole order, so shards are cut at equal bytes to within one
record, and slots are gapless.

The sort key is (hash of the group, id, tie): members of a group, such as equal
texts, stay next to each other and share a shard unless a cut falls inside
their group.  A hot group is subdivided by id like any overfull range, and
records of one group and id by the tie: a hash of their carried columns, and, as
equal records may be very many, of where they were read.  The keys are
checkpointed, so the tie of a record does not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.common import bucket_of, cut, longs, prepare

RANGES_PER_SHARD = 32
ROWS_PER_RANGE = 4_000_000
SAMPLES_PER_RANGE = 32
TIE_BITS = 20           # low bits of the tie, which tell equal records apart
OVERFULL = 2.0
SEED = 11
FIRST = -(1 << 63)
UNIT = 1 << 40
BIG = "decimal(38,0)"


def _keys(bounds: list[tuple[int, int, int]]) -> str:
    one = "named_struct('g', {}L, 'd', {}L, 't', {}L)"
    return f"array({', '.join(one.format(*b) for b in bounds)})"


def _range_of(bounds: list[tuple[int, int, int]]) -> Column:
    return bucket_of(F.struct("g", "d", "t"), bounds, _keys).cast("int")


def _draw(rows: DataFrame, rate: Column, turn: int) -> list[tuple[int, int, int]]:
    """Keys drawn with probability min(1, size * rate), decided by a hash of the key,
    so a retried task draws the same ones.  Equal records have ties of their own, so however
    many there are, no more than the sample reaches the driver."""
    u = F.pmod(F.xxhash64(F.lit(SEED + turn), "g", "d", "t"), F.lit(UNIT)) / UNIT
    return sorted((r.g, r.d, r.t) for r in
                  rows.where(u < F.col("size") * rate).select("g", "d", "t").collect())


def _ranges(rows: DataFrame, n: int, total: int) -> tuple[list, list]:
    """Boundaries and, per range in order, (rows, bytes)."""
    drawn = _draw(rows, F.lit(n * SAMPLES_PER_RANGE / max(1, total)), 0)
    bounds = sorted({drawn[i * len(drawn) // n] for i in range(1, n)}) if drawn else []
    turn = 0
    while True:
        got = {r.r: r for r in rows.groupBy(_range_of(bounds).alias("r")).agg(
            F.count("*").alias("n"), F.sum("size").alias("size"),
            F.min(F.struct("g", "d", "t")).alias("lo"),
            F.max(F.struct("g", "d", "t")).alias("hi")).collect()}
        full = [r for r in got.values() if r["size"] > OVERFULL * total / n and r.lo != r.hi]
        turn += 1
        more: set = set()
        if full:
            inside = rows.where(_range_of(bounds).isin([r.r for r in full]))
            again = _draw(inside, F.lit(n * SAMPLES_PER_RANGE / total), turn)
            for r in full:
                own = [x for x in again if r.lo < x <= r.hi]
                parts = min(len(own) + 1, max(2, round(r["size"] * n / total)))
                more.update(own[i * len(own) // parts] for i in range(1, parts))
                if not own:
                    more.add(tuple(r.hi))     # at least the largest key gets a range of its own
        if not more - set(bounds):
            return bounds, [(got[i].n, got[i]["size"]) if i in got else (0, 0)
                            for i in range(len(bounds) + 1)]
        bounds = sorted(set(bounds) | more)


def shard_records(records: DataFrame, group: Column, doc_id: Column, size: Column,
                  n_shards: int, *carry: Column) -> DataFrame:
    """``carry`` columns, ``size``, ``shard`` (0 .. n_shards-1) and ``slot``
    (gapless from 0 in each shard) for every record.

    Shards hold equal bytes to within one record.  ``size`` must be at least 1.
    Null groups and ids sort first; records equal in group and id are ordered
    by a hash of their carried columns.  An empty table gives an empty result.
    """
    prepare(records.sparkSession)
    low = (1 << TIE_BITS) - 1
    tie = F.xxhash64(*carry).bitwiseAND(F.lit(~low)).bitwiseOR(
        F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(low)))
    rows = cut(records.select(
        F.coalesce(group.cast("long"), F.lit(FIRST)).alias("g"),
        F.coalesce(doc_id.cast("long"), F.lit(FIRST)).alias("d"), tie.alias("t"),
        size.cast("long").alias("size"), F.struct(*carry).alias("c")))
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = max(n_shards * RANGES_PER_SHARD, -(-n_rows // ROWS_PER_RANGE))
    bounds, ranges = _ranges(rows, n, total) if n_rows else ([], [(0, 0)])
    row_at, byte_at = [0], [0]
    for k, b in ranges[:-1]:
        row_at.append(row_at[-1] + k)
        byte_at.append(byte_at[-1] + b)
    r = F.col("r") + 1
    w = Window.partitionBy("r").orderBy("g", "d", "t")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut(rows.withColumn("r", _range_of(bounds)).select(
        "c", "size",
        (F.element_at(F.expr(longs(row_at)), r)
         + F.row_number().over(w) - 1).alias("at"),
        (F.element_at(F.expr(longs(byte_at)), r)
         + F.sum("size").over(upto) - F.col("size")).alias("byte")
    ).withColumn("shard", F.expr(      # whole numbers: a decimal quotient is rounded up
        f"(cast(byte as {BIG}) * {n_shards}) div cast({max(1, total)} as {BIG})").cast("int")))
    start = {x.shard: x.at for x in placed.groupBy("shard").agg(F.min("at").alias("at")).collect()}
    first = F.expr(longs([start.get(s, 0) for s in range(n_shards)]))
    return placed.select("c.*", "size", "shard",
                         (F.col("at") - F.element_at(first, F.col("shard") + 1)).alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row,
    by law ``bytes``.  Size is the text's UTF-8 bytes plus 1; a null text has
    size 1 and checksum 0.  Equal texts are neighbours in the order."""
    text, did = docs[text_col], docs[id_col].cast("long")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
    out = shard_records(docs, F.xxhash64(text), did, size, n_shards,
                        did.alias("doc_id"), crc.alias("text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
