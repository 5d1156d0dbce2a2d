"""Line dedup: lines found in many documents go, as keep bitmaps per document.

Per document, each distinct line key becomes one row: a 128-bit hash, the
document and the key's positions (this pre-aggregation happens before any
shuffle).  Rows are range-partitioned on (hash, document), sorted within
partitions and streamed: a run of equal hashes counts its documents in order
of first occurrence.  Because the document is part of the range key, a line
that a third of all documents hold spreads over many tasks.  A run that
touches a task's border may go on in the next task; its count and its few
undecided rows are settled afterwards from one summary row per border run.

The result per document is a compressed bitmap over its lines, not text.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from shelfscan.llm.common import cut, join_rows, narrow, prepare, same

MIN_DOCS = 10
MIN_CODE_POINTS = 1
ZIP_LEVEL = 1

_ROW = "doc_id long, k1 long, k2 long, h1 long, h2 long, n_lines int, pos binary"
_RUN = ("kind int, k1 long, k2 long, h1 long, h2 long, n_lines int, pos binary, "
        "n long, f1 long, f2 long, l1 long, l2 long")
DROP, UNDECIDED, BORDER = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _split(halves: int) -> tuple[int, int]:
    lo, hi = halves & 0xFFFFFFFFFFFFFFFF, halves >> 64
    return lo - (1 << 64) * (lo >> 63), hi - (1 << 64) * (hi >> 63)


def _code_points(key: bytes) -> int:
    return len(key.decode("utf-8", "replace"))


def _lines(min_code_points: int):
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, k1, k2, body in zip(*(b.column(c).to_pylist()
                                           for c in ("doc_id", "k1", "k2", "body"))):
                lines = (body or b"").split(b"\n")
                at: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    at.setdefault(line_key(line), []).append(i)
                for key, where in at.items():
                    if len(key) < min_code_points or (
                            min_code_points > 1 and _code_points(key) < min_code_points):
                        continue
                    h1, h2 = _split(xxh3_128_intdigest(key))
                    for to, v in zip(out, (doc, k1, k2, h1, h2, len(lines),
                                           np.array(where, "<i4").tobytes())):
                        to.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, [pa.int64()] * 5 + [pa.int32(), pa.binary()])],
                ["doc_id", "k1", "k2", "h1", "h2", "n_lines", "pos"])
    return run


class _Run:
    """The run of one hash that is open at the end of a batch."""

    def __init__(self):
        self.hash, self.n, self.first, self.last, self.held = None, 0, None, None, []


def _stream(min_docs: int):
    """Sorted rows of one task -> dropped rows, undecided rows, border runs."""

    def run(batches):
        cur, at_start = _Run(), True
        out: list[tuple] = []

        def close(at_end: bool):
            border = at_start or at_end
            if cur.hash is None:
                return
            if border:
                out.append((BORDER, None, None, *cur.hash, None, None, cur.n,
                            *cur.first, *cur.last))
                out.extend((UNDECIDED, *doc, *cur.hash, n_lines, pos, None, None, None, None, None)
                           for doc, n_lines, pos in cur.held)

        def flush():
            cols = list(zip(*out)) or [[]] * 12
            types = [pa.int32()] + [pa.int64()] * 4 + [pa.int32(), pa.binary()] + [pa.int64()] * 5
            names = [x.split()[0] for x in _RUN.split(", ")]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            h1, h2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            k1, k2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            if len(h1) and cur.hash == (int(h1[0]), int(h2[0])):
                new[0] = False
            # runs of one row inside the batch decide nothing and are skipped
            single = new.copy()
            single[:-1] &= new[1:]
            if len(single):
                single[-1] = False
                single[0] &= not at_start or cur.hash is not None
            n_lines, pos = b.column("n_lines"), b.column("pos")
            for i in np.flatnonzero(~single).tolist():
                if new[i]:
                    if cur.hash is not None:
                        close(False)
                        at_start = False
                    cur = _Run()
                    cur.hash = (int(h1[i]), int(h2[i]))
                doc = (int(k1[i]), int(k2[i]))
                if doc == cur.last:
                    continue                       # a repeated row of the same document
                cur.n += 1
                cur.first, cur.last = cur.first or doc, doc
                row = (doc, n_lines[i].as_py(), pos[i].as_py())
                if cur.n < min_docs:
                    cur.held.append(row)
                    continue
                out.extend((DROP, *d, *cur.hash, n, p, None, None, None, None, None)
                           for d, n, p in [*cur.held, row])
                cur.held = []
            # a skipped single row after the open run has closed it
            if len(single) and cur.hash is not None and single.any():
                last_skipped = int(np.flatnonzero(single)[-1])
                looked = np.flatnonzero(~single)
                if not len(looked) or last_skipped > int(looked[-1]):
                    close(False)
                    at_start, cur = False, _Run()
            if out:
                yield flush()
        close(True)
        if out:
            yield flush()
    return run


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = MIN_DOCS, min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """``k1, k2, n_lines, n_dropped, keep`` for every document that loses a
    line; documents without a row keep all lines.

    ``keep`` is a zlib-compressed bitmap, one bit per line (little-endian bit
    order).  A line whose key has at least ``min_code_points`` code points
    and is found in at least ``min_docs`` documents loses all its copies.
    Null and empty texts are one empty line; rows repeating id and text are
    one document.
    """
    prepare(docs.sparkSession)
    lines = narrow(docs, id_col, text_col).mapInArrow(_lines(min_code_points), _ROW)
    order = ["h1", "h2", "doc_id", "k1", "k2"]
    runs = cut(lines.repartitionByRange(*order).sortWithinPartitions(*order)
               .select(*(x.split()[0] for x in _ROW.split(", ")))
               .mapInArrow(_stream(min_docs), _RUN)
               .withColumn("task", F.spark_partition_id()))
    # A document at the end of one task and at the start of the next counts once.
    w = Window.partitionBy("h1", "h2").orderBy("task")
    again = (F.lag("l1").over(w) == F.col("f1")) & (F.lag("l2").over(w) == F.col("f2"))
    total = (runs.where(F.col("kind") == BORDER)
             .withColumn("again", F.coalesce(again, F.lit(False)).cast("long"))
             .groupBy("h1", "h2").agg(F.sum(F.col("n") - F.col("again")).alias("docs"))
             .where(F.col("docs") >= min_docs).select("h1", "h2"))
    rest = runs.where(F.col("kind") == UNDECIDED).join(total, ["h1", "h2"], "left_semi")
    cols = ["k1", "k2", "h1", "h2", "n_lines", "pos"]
    dropped = runs.where(F.col("kind") == DROP).select(*cols).union(rest.select(*cols))
    by_doc = dropped.groupBy("k1", "k2").agg(
        F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("pos"))

    def bitmaps(batches):
        for b in batches:
            n_dropped, keep = [], []
            for n, pos in zip(b.column("n_lines").to_pylist(), b.column("pos").to_pylist()):
                bits = np.ones(n, bool)
                bits[np.frombuffer(b"".join(pos), "<i4")] = False
                n_dropped.append(n - int(bits.sum()))
                keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), ZIP_LEVEL))
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("n_lines").cast(pa.int64()),
                 pa.array(n_dropped, pa.int64()), pa.array(keep, pa.binary())],
                ["k1", "k2", "n_lines", "n_dropped", "keep"])

    return by_doc.mapInArrow(bitmaps, "k1 long, k2 long, n_lines long, n_dropped long, keep binary")


def kept_text(text: bytes | None, keep: bytes | None) -> bytes | None:
    """``text`` without the lines whose bit in ``keep`` is 0."""
    if keep is None or text is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return b"\n".join(x for x, bit in zip(lines, bits[:len(lines)].tolist()) if bit)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines gone from the text; a column ``n_chars``
    follows the new text.  Null texts stay null.  The text moves once."""
    joined = join_rows(docs, bitmaps.select("k1", "k2", F.col("keep").alias("_keep")), "left",
                       id_col, text_col)

    @F.pandas_udf("binary")
    def strip(texts: pd.Series, keeps: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t, k) for t, k in zip(texts, keeps)], dtype=object)

    text = F.col(f"`{text_col}`")
    new = F.when(F.col("_keep").isNull(), text).otherwise(
        strip(F.when(F.col("_keep").isNotNull(), text.cast("binary")), F.col("_keep")).cast("string"))
    out = joined.withColumn("_text", new)
    return out.select(*[F.col("_text").alias(c) if c == text_col
                        else F.char_length("_text").cast(docs.schema[c].dataType).alias(c)
                        if c == "n_chars" else x for c, x in zip(docs.columns, same(docs))])


def digests(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document row, from
    the text and its bitmap."""
    d = narrow(docs, id_col, text_col)
    joined = d.join(bitmaps.select("k1", "k2", "keep"), ["k1", "k2"], "left")

    def run(batches):
        for b in batches:
            n_lines, n_dropped, sha = [], [], []
            for body, keep in zip(b.column("body").to_pylist(), b.column("keep").to_pylist()):
                text = body or b""
                kept = kept_text(text, keep)
                lines = text.count(b"\n") + 1
                n_lines.append(lines)
                n_dropped.append(0 if keep is None else lines - int(np.unpackbits(
                    np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[:lines].sum()))
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(sha)], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return joined.select("doc_id", "body", "keep").mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
