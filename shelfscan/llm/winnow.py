"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling polynomial hash; in every window
of w consecutive k-grams the smallest hash is chosen, the rightmost on ties,
and each chosen hash is kept once with its position.  Any passage of at least
w + k - 1 code points that two texts share therefore shares a fingerprint, and
the kept positions say where.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import cut, cut_table, narrow, partitions_for, prepare

GRAM = 16           # code points a hash covers
WINDOW = 32         # hashes a window covers
ROWS_PER_TASK = 10_000  # documents that are sorted together
SAMPLE_PER_RANGE = 40
MAX_RANGES = 100_000    # beyond, more documents are sorted together; they stream through a task
BATCH_BYTES = 4 << 20   # of texts handed to a Python worker at a time
BLOCK = 1 << 18     # windows looked at at a time
# Base of the rolling hash and the multiplier of its finisher
# (the 64-bit golden ratio and a public splitmix constant).
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all k-grams, modulo 2^64, from doubling lengths."""
    part, have, power = values.astype(np.uint64), 1, pow(BASE, 1, 1 << 64)
    total, done = None, 0
    while True:
        if k & have:
            total, done = (part, have) if total is None else (
                total[: len(part) - done] * np.uint64(power) + part[done:], done + have)
        if have * 2 > k:
            return total
        part = part[:-have] * np.uint64(power) + part[have:] if len(part) > have else part[:0]
        have, power = have * 2, pow(BASE, have * 2, 1 << 64)


def window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive keys (all of them if fewer)."""
    w = min(w, len(keys))
    have, part = 1, keys
    while have * 2 <= w:
        part = np.minimum(part[:-have], part[have:])
        have *= 2
    return np.minimum(part[: len(keys) - w + 1], part[w - have: len(keys) - have + 1])


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen 32-bit hashes and their positions, in text order.  A text
    shorter than k is one gram; an empty text has none."""
    if not text:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    k = min(k, len(points))
    picks, last = [], -1
    n_grams = len(points) - k + 1
    for at in range(0, max(1, n_grams - w + 1), BLOCK):
        h = rolling(points[at: at + BLOCK + w + k - 2], k)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
        here = np.arange(len(h), dtype=np.uint64)
        # low half: the position counted down, so equal hashes prefer the right
        keys = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - here)
        low = window_minima(keys, w)
        low = low[np.r_[True, low[1:] != low[:-1]]]
        pos = at + (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
        new = pos > last
        picks.append(((low >> np.uint64(32)).astype(np.uint32)[new], pos[new]))
        last = int(pos[-1])
    return np.concatenate([p[0] for p in picks]), np.concatenate([p[1] for p in picks])


def encode(picks: tuple[np.ndarray, np.ndarray]) -> str:
    """Base64 of the hashes (4 bytes each, little-endian), then the steps
    between positions (1 byte each while w <= 255)."""
    hashes, pos = picks
    steps = np.diff(pos, prepend=0)
    wide = "u1" if len(steps) == 0 or steps.max() < 256 else "<u4"
    return base64.b64encode(hashes.astype("<u4").tobytes() + steps.astype(wide).tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two hash sets; two empty sets are alike."""
    a, b = np.unique(a), np.unique(b)
    if len(a) + len(b) == 0:
        return 1.0
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, k1, k2, hashes array<long>, positions array<long>`` per row;
    null texts are empty and have empty arrays."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            found = [winnow((x or b"").decode("utf-8", "replace"), gram, window)
                     for x in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("k1"), b.column("k2"),
                 pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                 pa.array([p for _, p in found], pa.list_(pa.int64()))],
                ["doc_id", "k1", "k2", "hashes", "positions"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, k1 long, k2 long, hashes array<long>, positions array<long>")


def _order_keys(doc_id: np.ndarray, missing: np.ndarray, k1: np.ndarray) -> np.ndarray:
    """17 bytes a document that sort as descending ids, nulls last, equal ids by ``k1``."""
    out = np.zeros(len(k1), np.dtype([("last", "u1"), ("id", ">u8"), ("k1", ">u8")]))
    sign = np.uint64(1 << 63)
    out["last"] = missing
    out["id"] = np.where(missing, 0, (~doc_id).astype(np.int64).view(np.uint64) ^ sign)
    out["k1"] = k1.view(np.uint64) ^ sign
    return out.view("S17")


def _key_columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("doc_id")
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
    return ids.fill_null(0).to_numpy(zero_copy_only=False), missing, k1, k2


def _cuts(keys: DataFrame, n: int, rows: int) -> np.ndarray:
    """At most n - 1 cut points of the documents' order, from a sample of about SAMPLE_PER_RANGE
    different documents a range, chosen by a hash."""
    share = min(1.0, n * SAMPLE_PER_RANGE / max(1, rows))
    some = keys.where(F.pmod(F.xxhash64("k2"), F.lit(1 << 20)) <= int(share * (1 << 20))).select(
        F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("missing"), "k1").toArrow()
    if some.num_rows == 0:
        return np.zeros(0, "S17")
    order = np.sort(_order_keys(*(some.column(c).to_numpy() for c in ("i", "missing", "k1"))))
    return np.unique(order[[i * len(order) // n for i in range(1, n)]])


def _heads(keys: DataFrame, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every range that has any its first document (order key, k2), and the range above."""
    def run(batches):
        first: dict[int, tuple] = {}
        for b in batches:
            ids, missing, k1, k2 = _key_columns(b)
            order = _order_keys(ids, missing, k1)
            for r, o, k in zip(np.searchsorted(cuts, order, "right").tolist(), order.tolist(), k2.tolist()):
                if r not in first or (o, k) < first[r]:
                    first[r] = (o, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(first), pa.int64()), pa.array([o.ljust(17, b"\0") for o, _ in first.values()], pa.binary()),
             pa.array([k for _, k in first.values()], pa.int64())], ["r", "o", "k2"])

    rows = keys.mapInArrow(run, "r long, o binary, k2 long").groupBy("r").agg(
        F.min(F.struct("o", "k2")).alias("x")).collect()
    full = sorted(r.r for r in rows)
    order, k2, above = np.zeros(len(cuts) + 1, "S17"), np.zeros(len(cuts) + 1, np.int64), \
        np.zeros(len(cuts) + 1, np.int64)
    for r in rows:
        order[r.r], k2[r.r] = bytes(r.x.o), r.x.k2
    above[full] = np.roll(full, 1)
    return order, k2, above


def _dealt(docs: DataFrame, id_col: str, text_col: str, rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Documents dealt to tasks by ranges of descending id (nulls last, equal ids by row key) and
    sorted inside them: ``doc_id, tail, body``; every range also gets, as its tail, the first document
    of the next.  Of a document with more than ``rows_per_task`` equal rows only one is dealt; the
    second table has these, ``doc_id, body, more``: how many others there are."""
    spark = prepare(docs.sparkSession)
    d = narrow(docs, id_col, text_col)
    key = ["doc_id", "k1", "k2"]
    keys = cut(d.select(*key).groupBy(*key).agg(F.count("*").alias("m")))
    rows = keys.agg(F.sum("m")).first()[0] or 0
    # at most rows / rows_per_task documents have so many
    often = keys.where(F.col("m") > rows_per_task).select("k1", "k2", "m")
    one = (d.join(F.broadcast(often), ["k1", "k2"]).groupBy("doc_id", "k1", "k2", "m")
           .agg(F.first("body").alias("body")))
    one = cut_table(one, "often")
    if not one.isEmpty():
        d = d.join(F.broadcast(often), ["k1", "k2"], "left_anti").unionByName(one.drop("m"))
    n = min(MAX_RANGES, partitions_for(rows, spark, rows_per_task))
    cuts = _cuts(keys, n, rows)
    # 37 bytes a range, of which there are MAX_RANGES at most
    shared = spark.sparkContext.broadcast((cuts, *_heads(keys.drop("m"), cuts)))

    @F.pandas_udf("array<int>")
    def places(doc_id: pd.Series, missing: pd.Series, k1: pd.Series, k2: pd.Series) -> pd.Series:
        cuts, head, head_k2, above = shared.value
        order = _order_keys(doc_id.to_numpy(), missing.to_numpy(), k1.to_numpy())
        at = np.searchsorted(cuts, order, "right")
        first = (head[at] == order) & (head_k2[at] == k2.to_numpy())
        return pd.Series([[r, up] if f else [r] for r, up, f in
                          zip(at.tolist(), above[at].tolist(), first.tolist())])

    place = places(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "k1", "k2")
    dealt = (d.select("*", F.posexplode(place).alias("tail", "range"))
             .repartitionById(len(cuts) + 1, F.col("range"))
             .sortWithinPartitions("tail", F.desc_nulls_last("doc_id"), "k1", "k2"))
    return dealt.select("doc_id", "tail", "body"), one.select(
        "doc_id", "body", (F.col("m") - 1).alias("more"))


def _text(body) -> str:
    return (body.as_py() or b"").decode("utf-8", "replace")


def with_next(docs: DataFrame, fn, schema: str, id_col: str = "doc_id", text_col: str = "text",
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows of ``schema`` that ``fn`` gives as tuples for an iterator of
    ((doc_id, text), next (doc_id, text)) over all documents in descending id order (nulls
    last, equal ids by row key); after the last comes the first.  Each text crosses one
    shuffle; documents stream through a task."""
    types = [(x.split()[0], _TYPES[x.split()[1]]) for x in schema.split(", ")]

    def batches_of(rows):
        held = []
        for row in rows:
            held.append(row)
            if len(held) == ROWS_OUT:
                yield out(held)
                held = []
        if held:
            yield out(held)

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)],
                                          [n for n, _ in types])

    def run(batches):
        def pairs():
            held = None
            for b in batches:
                for i, tail, body in zip(*(b.column(c) for c in ("doc_id", "tail", "body"))):
                    doc = (i.as_py(), _text(body))
                    if held is not None:
                        yield held, doc
                    held = None if tail.as_py() else doc

        yield from batches_of(fn(pairs()))

    def alone(batches):
        for b in batches:
            docs_of = [(i.as_py(), _text(body)) for i, body in zip(b.column("doc_id"), b.column("body"))]
            made = out(list(fn((doc, doc) for doc in docs_of)))
            yield made.append_column("more", b.column("more"))

    dealt, often = _dealt(docs, id_col, text_col, rows_per_task)
    # a small batch keeps little text in a worker and in the buffers between it and the JVM
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    made = dealt.mapInArrow(run, schema)
    if often.isEmpty():
        return made
    # equal rows follow each other: worked out once, and given as often as they are there
    names = [n for n, _ in types]
    repeated = often.mapInArrow(alone, f"{schema}, more long").select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("more") - 1, F.lit(rows_per_task).cast("long"))).alias("_from"))
    return made.unionByName(repeated.repartition("doc_id", "_from").select(*names, F.explode(F.sequence(
        "_from", F.least(F.col("_from") + (rows_per_task - 1), F.col("more") - 1)))).select(*names))


_DIGEST = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
ROWS_OUT = 500


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                gram: int = GRAM, window: int = WINDOW,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half
    replaced by the first as many code points of the next document in
    descending id order), with the likeness to the edited text's and to the
    next document's.  Null texts are empty.  A lone document is its own next.
    A task holds two texts and their fingerprints at a time: some 30 bytes a character.
    """
    def run(pairs):
        known: tuple = (None, None)
        for (i, text), (_, after) in pairs:
            own = known[1] if known[0] is text else winnow(text, gram, window)
            following = winnow(after, gram, window)
            known = (after, following)
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            changed = winnow(edited, gram, window)
            yield (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), encode(own),
                   encode(changed), likeness(own[0], changed[0]), likeness(own[0], following[0]))

    return with_next(docs, run, _DIGEST, id_col, text_col, rows_per_task)
