"""MinHash near-dedup with tensored banding.

A document is the set of its distinct word shingles; two are linked if the sets'
Jaccard similarity is at least ``similarity``.  Equal sets are one class from the start.

Two small collections of half keys, ``halves`` each and made of ``rows`` minhashes, are combined
pair by pair into the keys of halves^2 tables: 2 * halves * rows minhashes do the work of
halves^2 * 2 * rows.  Half keys that no other class has are dropped before the tables are formed.

Buckets are not compared all with all.  First every bucket compares its members with one
pivot (in more rounds with others), and links found merge them; buckets whose members are all in one
component are done.  Of the buckets that stay open, members are held against one pivot again, and
two of different components meet only if their differences to it have enough in common that
they can be similar (see ``_rest``).  That loses no pair of a bucket.  Every link is confirmed on
the full sets.

A pair just at 0.85 is missed by all tables with a probability of 2 * (1 - 0.85^rows)^halves,
5e-6 as set here (1e-8 at 0.9), and chains of links make up for part of that.

Defined results: texts without words (null, empty, blank) have an empty set and are linked with
nothing; rows that repeat id and text are one document with equal results; ids may be null (a
component's id is then its smallest other id, null if there is none, and ``kept`` compares
null-safe).  A text's shingles are held by one task: some 200 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import cut, cut_table, narrow, prepare
from shelfscan.llm.components import connected_components

SHINGLE = 5
PERCENT = 85            # least similarity, in hundredths
ROWS = 2                # minhashes of a half key
HALVES = 10             # half keys of either collection
ROUNDS = 1              # rounds of comparing with pivots before the rest is held against one
SALT = 64               # comparisons that share one copy of a pivot's set
LEVELS = (0.25, 0.5, 0.75, 1, 1.25, 1.5, 2, 2.5, 3, 4, 6, 8)    # of cost, in what a link with the pivot may cost
BLOCK = 2048            # shingles hashed at a time
# Odd 64-bit multipliers (the golden ratio, and splitmix64's two).
GOLDEN, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def shingles(body: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (its UTF-8 bytes; A-Z lower-cased,
    words between ASCII white space); of the whole sequence if it is shorter."""
    words = (body or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    out = _mix(h[: len(h) - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = _mix(out * np.uint64(GOLDEN) + h[k: len(h) - size + 1 + k])
    return np.unique(out)


def half_keys(s: np.ndarray, rows: int = ROWS, halves: int = HALVES) -> np.ndarray:
    """The 2 * halves half keys of a set: hashes of ``rows`` minhashes each."""
    n = np.arange(1, 2 * halves * rows + 1, dtype=np.uint64)
    turn, odd = _mix(n * np.uint64(GOLDEN))[:, None], _mix(n * np.uint64(MIX1))[:, None] | np.uint64(1)
    least = np.full(len(n), np.iinfo(np.uint64).max)
    for at in range(0, len(s), BLOCK):
        least = np.minimum(least, ((s[at:at + BLOCK] ^ turn) * odd).min(axis=1))
    out = np.arange(2 * halves, dtype=np.uint64)
    for value in least.reshape(2 * halves, rows).T:
        out = _mix(out * np.uint64(GOLDEN) + value)
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, rows: int = ROWS, halves: int = HALVES) -> DataFrame:
    """``doc_id, k1, k2, n, s1, s2, half`` per row: the set's size, 128 bits over the set, and
    its half keys (an empty set has none)."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            n, s, half = [], [], []
            for body in b.column("body"):
                x = shingles(body.as_py(), shingle)
                n.append(len(x))
                digest = xxhash.xxh3_128_digest(x.tobytes())
                s.append(np.frombuffer(digest, np.int64))
                half.append(half_keys(x, rows, halves).view(np.int64) if len(x) else np.zeros(0, np.int64))
            s = np.array(s, np.int64).reshape(-1, 2)
            ends = pa.array(np.cumsum([0] + [len(x) for x in half]), pa.int32())
            flat = pa.array(np.concatenate(half) if half else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(n, pa.int64()),
                 pa.array(s[:, 0]), pa.array(s[:, 1]), pa.ListArray.from_arrays(ends, flat)],
                ["doc_id", "k1", "k2", "n", "s1", "s2", "half"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, half array<long>")


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return ((F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent))


def buckets(classes: DataFrame, halves: int = HALVES) -> DataFrame:
    """``key, c, n``: members of the buckets with two classes or more, over all halves^2 tables."""
    half = classes.select("c", "n", F.posexplode("half").alias("slot", "h")).select(
        "c", "n", "slot", F.xxhash64("slot", "h").alias("h"))
    shared = half.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    left = (half.join(shared, "h").groupBy("c", "n").agg(
        F.collect_list(F.when(F.col("slot") < halves, F.col("h"))).alias("u"),
        F.collect_list(F.when(F.col("slot") >= halves, F.col("h"))).alias("v")))
    keys = (left.select("c", "n", F.explode("u").alias("a"), "v")
            .select("c", "n", "a", F.explode("v").alias("b"))
            .select(F.xxhash64("a", "b").alias("key"), "c", "n"))
    keys = cut_table(keys, "tables")
    met = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    return cut_table(keys.join(met, "key"), "buckets")


def sets_of(docs: DataFrame, members: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle: int = SHINGLE) -> DataFrame:
    """``c, n, hashes``: the sets of classes, ``members`` having ``c`` and the row key of one of the
    class's documents.  Texts are read again rather than all sets kept; rows that repeat are one."""
    texts = narrow(docs, id_col, text_col).select("k1", "k2", "body")
    of = texts.join(members, ["k1", "k2"]).groupBy("k1", "k2").agg(
        F.first("c").alias("c"), F.first("body").alias("body"))

    def run(batches):
        for b in batches:
            x = [shingles(body.as_py(), shingle) for body in b.column("body")]
            ends = pa.array(np.cumsum([0] + [len(s) for s in x]), pa.int32())
            flat = pa.array((np.concatenate(x) if x else np.zeros(0, np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("c"), pa.array([len(s) for s in x], pa.int64()),
                 pa.ListArray.from_arrays(ends, flat)], ["c", "n", "hashes"])

    return cut_table(of.select("c", "body").mapInArrow(run, "c long, n long, hashes array<long>"),
                     "sets")


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, na, nb, ha, hb``: both sets of every pair.

    The set of an ``a`` with many pairs goes to one place per ``SALT`` of them."""
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / SALT))
    often = pairs.groupBy("a").agg(F.count("*").alias("m"))
    first = (sets.join(often, sets["c"] == often["a"])
             .select("a", F.col("n").alias("na"), F.col("hashes").alias("ha"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("m") / SALT) - 1)).alias("part")))
    second = (pairs.join(often, "a").select("a", "b", part.alias("part"))
              .join(sets.select(F.col("c").alias("b"), F.col("n").alias("nb"),
                                F.col("hashes").alias("hb")), "b"))
    return second.join(first, ["a", "part"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose full sets are similar enough."""
    both = F.size(F.array_intersect("ha", "hb"))
    return (_met(pairs, sets)
            .where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b"))


def _labels(links: DataFrame) -> DataFrame:
    return cut(connected_components(links).select(F.col("node").alias("c"), "root"))


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, c, n, root`` of buckets with members of two components or more."""
    now = members.join(labels, "c", "left").withColumn("root", F.coalesce("root", "c"))
    several = (now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where("lo < hi").select("key"))
    return now.join(several, "key").select("key", "c", "n", "root")


def _with_pivots(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """``a, b``: the pivot of each bucket with its members of other components."""
    order = F.struct(F.xxhash64("c", F.lit(turn)).alias("o"), F.col("c").alias("p"),
                     F.col("n").alias("pn"), F.col("root").alias("pr"))
    pivot = members.groupBy("key").agg(F.min(order).alias("x")).select("key", "x.p", "x.pn", "x.pr")
    return (members.join(pivot, "key").where("root <> pr").where(_similar_sizes("n", "pn", percent))
            .select(F.col("p").alias("a"), F.col("c").alias("b")).distinct())


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of members of open buckets with their pivots, and the pairs ``a, b`` of other members
    of different components that may be links.

    Of every member x only its difference to the pivot p matters: d shingles of p that it lacks, u
    that p lacks.  Two members x, y whose differences have k shingles in common are similar enough
    just if cost(x) + cost(y) <= (100 - percent) |p| + (100 + percent) k with cost = 100 d +
    percent u.  So they need so many common shingles in their differences, the more the farther
    they are from p: with the differences ordered from rare to frequent they share one of the first
    |difference| - k + 1.  Members are set apart by levels of cost, so that k is nearly exact.
    """
    # the member of most open buckets is the pivot, so that a member has few different ones
    well_known = members.groupBy("c").agg(F.count("*").alias("often"))
    pivot = (members.select("key", "c").join(well_known, "c").groupBy("key")
             .agg(F.max_by("c", F.struct("often", "c")).alias("p")))
    group = cut(members.join(pivot, "key").select("p", "c", "root").distinct())
    several = (group.groupBy("p").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                      F.count("*").alias("size")).where("lo < hi").select("p", "size"))
    pairs = (group.where("c <> p").join(several, "p")
             .select(F.col("p").alias("a"), F.col("c").alias("b"), "size"))
    alone = pairs.where("size = 2").select("a", "b")        # nobody else to compare with
    pairs = pairs.where("size > 2")
    lacks, adds = F.array_except("ha", "hb"), F.array_except("hb", "ha")
    far = cut_table(
        _met(pairs.select("a", "b"), sets)
        .select(F.col("a").alias("p"), F.col("b").alias("c"), F.col("na").alias("size"),
                lacks.alias("lacks"), adds.alias("adds"))
        .withColumn("cost", F.size("lacks") * 100 + F.size("adds") * percent)
        .select("p", "c", "size", "cost", F.concat("lacks", "adds").alias("apart")), "apart")
    free = F.col("size") * (100 - percent)
    links = far.where(F.col("cost") <= free).select(F.col("p").alias("a"), F.col("c").alias("b"))

    level = F.lit(0)
    for step in LEVELS:
        level += (F.col("cost") >= free * step).cast("int")
    named = far.join(group, ["p", "c"]).withColumn("level", level)
    levels = named.groupBy("p", "level").agg(
        F.min("cost").alias("cheapest"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    each = named.select("p", "c", F.explode("apart").alias("h"))
    often = each.groupBy("p", "h").agg(F.count("*").alias("m")).where("m > 1")
    # a shingle in one difference only comes first and meets nobody
    common = (each.join(often, ["p", "h"]).groupBy("p", "c")
              .agg(F.sort_array(F.collect_list(F.struct("m", "h"))).alias("common")))
    facts = (named.join(common, ["p", "c"])
             .select("p", "c", "root", "size", "cost", "level", F.size("apart").alias("s"),
                     F.size("common").alias("w"), "common"))
    met = facts.join(levels.withColumnsRenamed({"level": "other"}), "p").where(
        "lo <> root or hi <> root")
    k = F.greatest(F.ceil((F.col("cost") + F.col("cheapest") - free) / (100 + percent)), F.lit(1))
    first = (F.col("s") - k + 1 - (F.col("s") - F.col("w"))).cast("int")
    rows = (met.withColumn("first", first).where("first > 0")
            .select("p", "c", "root", "size", "cost", "level", "other", "w",
                    F.explode(F.slice("common", F.lit(1), F.col("first"))).alias("x"))
            .withColumn("key", F.xxhash64("p", "x.h")))
    x = rows.select("key", "p", "level", "other", F.col("size"), F.col("c").alias("a"),
                    F.col("root").alias("ra"), F.col("cost").alias("ca"), F.col("w").alias("wa"))
    y = rows.select("key", "p", F.col("other").alias("level"), F.col("level").alias("other"),
                    F.col("c").alias("b"), F.col("root").alias("rb"), F.col("cost").alias("cb"),
                    F.col("w").alias("wb"))
    may = (F.col("ca") + F.col("cb") <= free + F.least("wa", "wb") * (100 + percent))
    return links, (x.join(y, ["key", "p", "level", "other"]).where("ra < rb").where(may)
                   .select("a", "b").union(alone).distinct())


def near_dup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS,
                    halves: int = HALVES, rounds: int = ROUNDS) -> DataFrame:
    """One row per document row: ``doc_id, k1, k2, n_shingles, component_id, kept``."""
    rows_of = cut_table(signatures(docs, id_col, text_col, shingle, rows, halves), "signatures")
    first = F.min(F.struct("k1", "k2"))
    classes = cut_table(
        rows_of.where("n > 0").groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("least"), first.alias("at"), F.first("n").alias("n"),
             F.first("half").alias("half"))
        .withColumn("c", F.monotonically_increasing_id()), "classes")
    members = buckets(classes, halves)
    sets = sets_of(docs, classes.join(members.select("c").distinct(), "c")
                   .select("c", "at.k1", "at.k2"), id_col, text_col, shingle)
    nothing = docs.sparkSession.createDataFrame([], "a long, b long")
    links, labels = nothing, docs.sparkSession.createDataFrame([], "c long, root long")
    still = members.withColumn("root", F.col("c"))
    for turn in range(rounds + 1):
        if still.isEmpty():
            break
        if turn < rounds:
            pairs = cut(_with_pivots(still, turn, percent))
        else:
            near, pairs = _rest(still, sets, percent)
            links, pairs = links.union(near), cut(pairs)
        links = cut(links.union(confirm(pairs, sets, percent)))
        labels = _labels(links)
        if turn < rounds:
            still = cut(_open_buckets(members, labels))
    known = classes.join(labels, "c", "left").select(
        "s1", "s2", "least", F.coalesce("root", "c").alias("root"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(least, "root").select("s1", "s2", "component_id")
    full = rows_of.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "s1", "s2")
    alone = full.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return (full.where("n_shingles > 0").join(named, ["s1", "s2"])
            .select(*full.columns, "component_id").union(alone)
            .select("doc_id", "k1", "k2", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
