"""Substring dedup with prefix-partitioned suffix trees.

A window of ``window`` words is removed from every place if it starts at more
than one.  Shipping every suffix would multiply the corpus, so suffixes travel
in bundles: of the word ``PREFIX``-grams in a window the one with the smallest
hash (rightmost on ties) is its anchor.  Equal windows have equal anchors at
equal offsets, so windows with one anchor position form a bundle of
overlapping suffixes, and the anchor's gram is the prefix by which bundles
are partitioned.

1. Per document the anchors' grams are counted; grams seen once in the corpus
   cannot belong to a repeat and go.  A gram that is in one document only, but
   more than once, can repeat only there and is settled in place.
2. Bundles of the grams of two documents or more are sent by gram, equal bundles
   of a batch of documents as one with all their places, and read in gram order in
   memory-sized groups.  Each group gets its suffix tree (as ranks of word
   prefixes of doubling lengths: the classes of equal rank are the tree's
   nodes at that depth).  Nodes at the window's depth with two places or more
   are repeats; neighbouring ones join to maximal repeats.
3. A gram with more than ``group_rows`` places, or different bundles of more than
   ``group_bytes``, would not fit a group.  Its prefix is made longer by ``PREFIX``
   words at a time: a bundle falls into parts whose windows all hold the same words
   around the anchor, and the longer prefixes are measured alike.  What fits no
   group at the longest goes by the whole window: windows are counted by a 128-bit
   hash, combined before the shuffle, however many copies there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest, xxh64_intdigest

from shelfscan.llm.common import (cut, cut_table, likely_rows, narrow, partitions_for,
                                  prepare)
from shelfscan.llm.winnow import MIX, rolling, window_minima

WINDOW = 35             # words
PREFIX = 8              # words of an anchor gram
GROUP_ROWS = 1_000_000  # places of a gram that one group may hold (24 bytes each)
GROUP_BYTES = 1 << 22   # of a gram's different bundles that one group may hold
TREE_WORDS = 1 << 18    # words of bundles a suffix tree is built over at a time, about
LONG_WORD = 16          # bytes; longer words count as several
BLOCK = 1 << 18         # windows of one document looked at at a time
POSITION_BITS = 24      # low bits of an anchor's sort key (block positions fit)


def _signed64(x: int) -> int:
    return x - (1 << 64) * (x >> 63)


def anchors(words: list[bytes], window: int = WINDOW, prefix: int = PREFIX):
    """(gram hash, anchor position, first and last window start) of every
    bundle of a document, as arrays; positions in words."""
    out: list[tuple] = []
    last_start = len(words) - window
    per = window - prefix + 1       # grams in a window
    for at in range(0, last_start + 1, BLOCK):
        block = words[at: at + BLOCK + window - 1]
        h = rolling(np.array([xxh64_intdigest(w) for w in block], np.uint64), prefix)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
        low = np.uint64((1 << POSITION_BITS) - 1)
        keys = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        best = window_minima(keys, per)
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        last = np.r_[first[1:], len(best)] - 1
        pos = (low - (best[first] & low)).astype(np.int64)
        out.append((h[pos].view(np.int64), at + pos, at + first, at + last))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))


def prefix_lengths(window: int = WINDOW, prefix: int = PREFIX) -> list[int]:
    """Lengths of prefixes, in words, that every window can hold around its anchor."""
    return [prefix, *range(2 * prefix, window - prefix + 2, prefix)]


def parts(words: list[bytes], hot: list[list[int]], window: int = WINDOW, prefix: int = PREFIX):
    """Like ``anchors``, after one lengthening for each list in ``hot``: bundles whose
    key is in the list are cut into parts, the others are left out.

    The prefix of a part is ``length`` words of which a multiple of ``prefix``, the
    smallest that fits the window, stand before the anchor: this follows from the
    anchor's offset, so equal windows stay in parts with equal keys."""
    g, pos, first, last = anchors(words, window, prefix)
    for length, keys in zip(prefix_lengths(window, prefix)[1:], hot):
        hit = np.flatnonzero(np.isin(g, np.array(keys, np.int64)))
        pos, first, last = pos[hit], first[hit], last[hit]
        out: list[tuple] = []
        for before in range(0, length - prefix + 1, prefix):
            start = pos - before
            a = np.maximum(first, start - (window - length))
            z = last if not before else np.minimum(last, start + prefix - (window - length) - 1)
            some = np.flatnonzero(a <= z)
            key = [_signed64(xxh64_intdigest(b" ".join(words[s: s + length]), length * window + before))
                   for s in start[some].tolist()]
            out.append((np.array(key, np.int64), pos[some], a[some], z[some]))
        g, pos, first, last = (np.concatenate([o[i] for o in out]) for i in range(4))
    return g, pos, first, last


def _ends(words: list[bytes]) -> np.ndarray:
    """Bytes up to each word, blanks included."""
    return np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))


def _sizes(ends: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Bytes of the bundles."""
    begin = np.where(first > 0, ends[first - 1], 0) if len(first) else first
    return ends[last + window - 1] - begin if len(first) else first


def repeated_starts(bundles: list[list[bytes]], starts: list[int], places: list[int],
                    window: int = WINDOW) -> list[np.ndarray]:
    """Per bundle, the offsets below ``starts`` whose window of words has two
    places or more; ``places`` says how many a bundle itself has.

    The suffixes' tree is held as ranks: after step j equal ranks mean equal
    first 2^j words, that is, one tree node at that depth."""
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number)) for b in bundles for w in b], np.int64)
    size = np.array([len(b) for b in bundles], np.int64)
    begin = np.cumsum(size) - size
    n_starts = np.array(starts, np.int64)
    owner = np.repeat(np.arange(len(bundles)), n_starts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
    suffix = begin[owner] + offset
    # a suffix that starts here is `window` words long and stays in its bundle
    rank, depth = flat, 1
    while depth * 2 <= window:
        rank = _pair_ranks(rank[:-depth], rank[depth:])
        depth *= 2
    node = _pair_ranks(rank[suffix], rank[suffix + window - depth])
    deep = np.bincount(node, np.array(places, np.int64)[owner], 1)[node] > 1
    ends = np.cumsum(n_starts)
    return [offset[e - n: e][deep[e - n: e]] for e, n in zip(ends.tolist(), n_starts.tolist())]


def _pair_ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the different pairs, equal for equal pairs."""
    if not len(a):
        return a
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def _spans(start: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Sorted window starts -> maximal [from, to) in words."""
    if not len(start):
        return []
    gap = np.flatnonzero(np.diff(start) > window)
    return list(zip(start[np.r_[0, gap + 1]].tolist(),
                    (start[np.r_[gap, len(start) - 1]] + window).tolist()))


def _grams(window: int, prefix: int):
    def run(batches):
        for b in batches:
            cols = [[], [], [], [], []]
            for k1, k2, body in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "body"))):
                words = (body or b"").split()
                every, _, first, last = anchors(words, window, prefix)
                g, which, n = np.unique(every, return_inverse=True, return_counts=True)
                size = np.bincount(which, _sizes(_ends(words), first, last, window), len(g))
                for to, v in zip(cols, (g, n, size, np.full(len(g), k1), np.full(len(g), k2))):
                    to.append(v)
            arrays = [pa.array(np.concatenate(c).astype(np.int64)) if c else pa.array([], pa.int64())
                      for c in cols]
            yield pa.RecordBatch.from_arrays(arrays, ["g", "n", "size", "k1", "k2"])
    return run


def _measures(window: int, prefix: int):
    """Documents with their frequent grams -> different bundles (``bundle``, a hash) of the
    grams, or of the longer prefixes, with places and bytes."""

    def run(batches):
        for b in batches:
            at: dict[tuple, list[int]] = {}
            for k1, k2, body, hot, some in zip(*(b.column(c).to_pylist()
                                                 for c in ("k1", "k2", "body", "hot", "some"))):
                words = body.split()
                g, _, first, last = parts(words, hot, window, prefix)
                if some is not None:
                    hit = np.flatnonzero(np.isin(g, np.array(some, np.int64)))
                    g, first, last = g[hit], first[hit], last[hit]
                for key, a, z in zip(g.tolist(), first.tolist(), last.tolist()):
                    bundle = b" ".join(words[a: z + window])
                    got = at.setdefault((key, _signed64(xxh64_intdigest(bundle, z - a)), k1, k2),
                                        [0, len(bundle)])
                    got[0] += 1
            rows = [(*key, *v) for key, v in at.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 ["g", "bundle", "k1", "k2", "n", "size"])
    return run


def _bundles(window: int, prefix: int):
    """Documents with their repeated grams -> bundles with their words and
    places (k1, k2, first word).  A row without words is a repeat found in
    place: ``n`` words from its place on."""

    def run(batches):
        for b in batches:
            at: dict[tuple, list[int]] = {}
            for k1, k2, body, hot, some, own in zip(*(
                    b.column(c).to_pylist() for c in ("k1", "k2", "body", "hot", "some", "own"))):
                words = body.split()
                g, _, first, last = parts(words, hot, window, prefix)
                for i in np.flatnonzero(np.isin(g, np.array(some, np.int64))).tolist():
                    key = (int(g[i]), int(last[i] - first[i]) + 1,
                           b" ".join(words[first[i]: last[i] + window]))
                    at.setdefault(key, []).extend((k1, k2, int(first[i])))
                here = np.flatnonzero(np.isin(g, np.array(own, np.int64))).tolist()
                if here:
                    found = repeated_starts([words[first[i]: last[i] + window] for i in here],
                                            [int(last[i] - first[i]) + 1 for i in here],
                                            [1] * len(here), window)
                    starts = np.sort(np.concatenate([first[i] + f for i, f in zip(here, found)]))
                    for start, end in _spans(starts, window):
                        at.setdefault((k1, end - start, b""), []).extend((k1, k2, start))
            rows = [(*key, np.array(v, "<i8").tobytes()) for key, v in at.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows), [pa.int64(), pa.int64(), pa.binary(), pa.binary()])],
                    ["g", "n", "words", "places"])
    return run


def _trees(window: int):
    """Bundles in gram order -> repeated spans, one suffix tree a group of whole grams."""

    def spans(rows: list[np.ndarray]):
        all_rows = np.concatenate(rows) if rows else np.zeros((0, 4), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(all_rows[:, i]) for i in range(4)],
                                          ["k1", "k2", "from", "to"])

    def grow(held: dict[tuple, list[bytes]]):
        places = [np.frombuffer(b"".join(v), "<i8").reshape(-1, 3) for v in held.values()]
        found = repeated_starts([words.split() for words, _ in held], [n for _, n in held],
                                [len(x) for x in places], window)
        return spans([np.c_[at[:, :2], at[:, 2] + a, at[:, 2] + z]
                      for at, offsets in zip(places, found) for a, z in _spans(offsets, window)])

    def run(batches):
        held: dict[tuple, list[bytes]] = {}
        size, last = 0, None
        for b in batches:
            whole = []
            for g, n, words, places in zip(*(b.column(c).to_pylist()
                                             for c in ("g", "n", "words", "places"))):
                if not words:
                    at = np.frombuffer(places, "<i8").reshape(-1, 3)
                    whole.append(np.c_[at, at[:, 2] + n])
                    continue
                if g != last and size >= TREE_WORDS:
                    yield grow(held)
                    held, size = {}, 0
                last = g
                key = (words, n)
                if key not in held:
                    size += max(words.count(b" ") + 1, len(words) // LONG_WORD)
                held.setdefault(key, []).append(places)
                size += len(places) // 24
            if whole:
                yield spans(whole)
        if held:
            yield grow(held)
    return run


def _windows(window: int, prefix: int):
    """Documents with their most frequent prefixes -> windows by 128-bit hash."""

    def run(batches):
        for b in batches:
            for k1, k2, body, hot, some in zip(*(b.column(c).to_pylist()
                                                 for c in ("k1", "k2", "body", "hot", "some"))):
                words = body.split()
                g, _, first, last = parts(words, hot, window, prefix)
                hit = np.flatnonzero(np.isin(g, np.array(some, np.int64)))
                start = np.concatenate([np.arange(first[i], last[i] + 1) for i in hit.tolist()])
                h = [xxh3_128_intdigest(b" ".join(words[s: s + window])) for s in start.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signed64(x >> 64) for x in h], pa.int64()),
                     pa.array([_signed64(x & 0xFFFFFFFFFFFFFFFF) for x in h], pa.int64()),
                     pa.array([k1] * len(h), pa.int64()), pa.array([k2] * len(h), pa.int64()),
                     pa.array(start, pa.int64())], ["w1", "w2", "k1", "k2", "from"])
    return run


def _groups(texts: DataFrame, dealt: DataFrame, grams: DataFrame, window: int, prefix: int, group_rows: int,
            group_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Bundles whose keys each fit a group, and the documents (``k1, k2, hot, some``)
    with prefixes that fit none at any length, if there are."""
    fits = (F.col("total") <= group_rows) & (F.col("bytes") <= group_bytes)
    lists = "array<array<bigint>>"

    def bundles_of(met):
        # doc_id is unused here, but with the same columns this is the same exchange
        # as that of the last join, and the text is shuffled once
        return dealt.join(met, ["k1", "k2"]).select(
            "doc_id", "k1", "k2", "body", "hot", "some", "own").mapInArrow(
            _bundles(window, prefix), "g long, n long, words binary, places binary")

    # by all places first: the bytes of the different bundles are at most these
    total = (grams.groupBy("g").agg(F.sum("n").alias("total"), F.sum("size").alias("bytes"),
                                    F.count("*").alias("docs")).where("total > 1"))
    # 0: in this document only, 1: to be met in a tree, 2: perhaps too much for one
    way = F.when(F.col("docs") == 1, 0).when(fits, 1).otherwise(2)
    repeated = grams.join(total, "g").select("k1", "k2", "g", way.alias("way"))
    # per document: at most as many grams as it has words
    by_doc = cut(repeated.groupBy("k1", "k2").agg(*[
        F.collect_set(F.when(F.col("way") == i, F.col("g"))).alias(name)
        for i, name in enumerate(("own", "some", "many"))]))
    none = F.expr(f"cast(array() as {lists})").alias("hot")
    bundles = bundles_of(by_doc.where("size(some) > 0 or size(own) > 0")
                         .select("k1", "k2", none, "some", "own"))
    left = by_doc.where(F.size("many") > 0).select("k1", "k2", none, F.col("many").alias("some"))
    for _ in prefix_lengths(window, prefix):
        if left.isEmpty():
            return bundles, None
        found = cut_table(likely_rows(texts, left).join(left, ["k1", "k2"])
                          .select("k1", "k2", "body", "hot", "some")
                          .mapInArrow(_measures(window, prefix), "g long, bundle long, k1 long, "
                                                                 "k2 long, n long, size long"), "found")
        total = (found.groupBy("g", "bundle").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
                 .groupBy("g").agg(F.sum("n").alias("total"), F.sum("size").alias("bytes"))
                 .where("total > 1"))
        met = found.select("g", "k1", "k2").distinct().join(total, "g").groupBy("k1", "k2").agg(
            F.collect_set(F.when(fits, F.col("g"))).alias("met"),
            F.collect_set(F.when(~fits, F.col("g"))).alias("many"))
        met = cut(met.join(left.select("k1", "k2", "hot"), ["k1", "k2"]))
        bundles = bundles.union(bundles_of(met.where(F.size("met") > 0).select(
            "k1", "k2", "hot", F.col("met").alias("some"),
            F.expr("cast(array() as array<bigint>)").alias("own"))))
        over = met.where(F.size("many") > 0)
        hot = over.select("k1", "k2", "hot", F.col("many").alias("some"))
        left = over.select("k1", "k2", F.concat("hot", F.array("many")).alias("hot"),
                           F.lit(None).cast("array<bigint>").alias("some"))
    return bundles, None if hot.isEmpty() else hot


def _repeats(texts: DataFrame, dealt: DataFrame, grams: DataFrame, window: int, prefix: int,
             group_rows: int, group_bytes: int, parts: int) -> DataFrame:
    """``k1, k2, from, to``: repeated spans, from documents dealt by key."""
    bundles, hot = _groups(texts, dealt, grams, window, prefix, group_rows, group_bytes)
    spans = (bundles.repartition(parts, "g").sortWithinPartitions("g")
             .mapInArrow(_trees(window), "k1 long, k2 long, from long, to long"))
    if hot is None:
        return spans
    windows = cut_table(likely_rows(texts, hot).join(hot, ["k1", "k2"]).select(
        "k1", "k2", "body", "hot", "some").mapInArrow(
        _windows(window, prefix), "w1 long, w2 long, k1 long, k2 long, from long"), "windows")
    often = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    return spans.union(windows.join(often, ["w1", "w2"]).select(
        "k1", "k2", "from", (F.col("from") + window).alias("to")))


def _remove(batches):
    for b in batches:
        n, gone, sha, kept = [], [], [], []
        for body, spans in zip(b.column("body").to_pylist(), b.column("spans").to_pylist()):
            words = (body or b"").split()
            keep = np.ones(len(words), bool)
            for s in spans or []:
                keep[s["from"]: s["to"]] = False
            text = b" ".join([w for w, k in zip(words, keep.tolist()) if k])
            n.append(len(words))
            gone.append(len(words) - int(keep.sum()))
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha),
             pa.array(kept, pa.binary())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, prefix: int = PREFIX,
                    group_rows: int = GROUP_ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` per row; ``kept`` is
    the remaining words joined by one space, as UTF-8 bytes.

    Words are separated by ASCII white space and compared as they are.  All
    places of a repeated window go, the first included; windows are judged on
    the input.  Null and empty texts have no words.  Rows that repeat a
    document are places like any other.  The text is shuffled once: both
    joins use the same deal of the documents.
    """
    if not 0 < prefix < window:
        raise ValueError("the prefix must be shorter than the window")
    spark = prepare(docs.sparkSession)
    d = narrow(docs, id_col, text_col)
    grams = cut_table(d.select("k1", "k2", "body").mapInArrow(
        _grams(window, prefix), "g long, n long, size long, k1 long, k2 long"), "grams")
    parts = partitions_for(docs.count(), spark)
    texts = d.select("doc_id", "k1", "k2", "body")
    dealt = texts.repartition(parts, "k1", "k2")
    spans = _repeats(texts, dealt, grams, window, prefix, group_rows, group_bytes, parts)
    by_doc = spans.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("from", "to")).alias("spans"))
    return (dealt.join(by_doc, ["k1", "k2"], "left").select("doc_id", "body", "spans")
            .mapInArrow(_remove, "doc_id long, n_words long, n_removed long, "
                                 "kept_sha256 string, kept binary"))
