"""SimHash near-dedup with pigeonring filtering.

Fingerprints are 64-bit SimHashes of word shingles.  Two fingerprints within
``max_bits`` differing bits are linked; linked fingerprints form groups.

Candidates come from the pigeonring principle: cut the 64 bits into ``m``
segments on a ring.  If two fingerprints differ in at most t bits, some
segment starts a chain whose first l segments hold at most floor(l*t/m)
differences, for every l.  While that budget is zero the chain must agree
exactly, so the first ``ceil(m/t)-1`` segments are an equality key; the longer
chains prune the pairs under one key before the full Hamming check.

Large buckets never meet pair by pair.  Fingerprints from a bucket of more
than ``bucket_pairs`` members are linked through midpoints instead: two
fingerprints differ in at most t bits exactly when some 64-bit value lies
within floor(t/2) of the one and ceil(t/2) of the other, so grouping by all
values that near (65 for t = 2) links exactly the right ones in linear
time, with at most that many members a group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from shelfscan.llm.common import cut, join_rows, narrow, prepare, same
from shelfscan.llm.components import connected_components

BITS = 64
SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 16
BUCKET_PAIRS = 64
HASH_SEED = 42
BLOCK = 1 << 15        # shingles turned into bit matrices at a time


def simhash(body: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's UTF-8 bytes.  A-Z is lower-cased,
    words are separated by ASCII white space.  No words (null included): 0."""
    words = (body or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, HASH_SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    first, last = (end - length)[: len(words) - shingle + 1], end[shingle - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), BLOCK):
        spans = zip(first[at:at + BLOCK].tolist(), last[at:at + BLOCK].tolist())
        h = np.array([xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(first), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, k1, k2, fp`` (fp: the SimHash as a signed long) per row."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = [simhash(x, shingle) for x in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("k1"), b.column("k2"),
                 pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "k1", "k2", "fp"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def _chain_masks(segments: int) -> list[list[int]]:
    """masks[l][i]: bits of the l segments from segment i on, round the ring."""
    edge = [round(i * BITS / segments) for i in range(segments + 1)]
    one = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(segments)]
    return [[sum(one[(i + j) % segments] for j in range(n)) for i in range(segments)]
            for n in range(segments + 1)]


def _per_start(masks: list[int]):
    return F.array(*[F.lit(_signed(m)) for m in masks])


def _ball(radius: int) -> list[int]:
    return [sum(1 << i for i in flips) for r in range(radius + 1)
            for flips in combinations(range(BITS), r)]


def links(values: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """``a, b``: edges between distinct fingerprints (one long column) whose
    components equal those of the graph "at most ``max_bits`` differing
    bits".  Every edge is such a pair."""
    if not 0 < max_bits <= 5 or not max_bits < segments <= BITS:
        raise ValueError("0 < max_bits <= 5 and max_bits < segments <= 64 are needed")
    fp = values.columns[0]
    masks = _chain_masks(segments)
    budget = [n * max_bits // segments for n in range(segments + 1)]
    exact = max(n for n in range(segments + 1) if budget[n] == 0)
    # the longest chain of each budget implies the shorter ones
    tests = [(n, budget[n]) for n in range(exact + 1, segments)
             if n + 1 == segments or budget[n + 1] > budget[n]]
    rows = values.select(F.col(fp).alias("fp"), F.posexplode(_per_start(masks[exact]))
                         .alias("start", "mask")).select(
        "start", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    size = rows.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = cut(rows.join(size, ["start", "key"]))

    few = met.where(F.col("n") <= bucket_pairs)
    a = few.select("start", "key", F.col("fp").alias("a"))
    b = few.select("start", "key", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = F.col("a") < F.col("b")
    for n, most in tests:
        chain = F.element_at(_per_start(masks[n]), F.col("start") + 1)
        near &= F.bit_count(differ.bitwiseAND(chain)) <= most
    near &= F.bit_count(differ) <= max_bits
    pairs = a.join(b, ["start", "key"]).where(near).select("a", "b")

    # large buckets: through midpoints
    many = met.where(F.col("n") > bucket_pairs).select("fp").distinct()
    small, large = max_bits // 2, max_bits - max_bits // 2
    hops = [F.struct(F.lit(_signed(x)).alias("flip"),
                     F.lit(x.bit_count() <= small).alias("inner")) for x in _ball(large)]
    near_by = many.select("fp", F.explode(F.array(*hops)).alias("hop")).select(
        F.col("fp").bitwiseXOR(F.col("hop.flip")).alias("mid"), "fp",
        F.col("hop.inner").alias("inner"))
    meet = (near_by.groupBy("mid")
            .agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"),
                 F.collect_list("fp").alias("all"))
            .where("a is not null and size(all) > 1"))
    through = meet.select("a", F.explode("all").alias("b")).where("a <> b")
    return pairs.union(through).distinct()


def near_dup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """One row per document row: ``doc_id, k1, k2, fp, root, component_id``.

    ``component_id`` is the smallest id among documents reachable over links
    (null only if all of them have a null id); ``root`` names the group and
    is never null.  Null, empty and blank texts have fingerprint 0 and link
    like any other; repeated rows give repeated results.  Equal fingerprints
    are collapsed before candidates are searched, so copies cost nothing.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = connected_components(links(classes.select("fp"), max_bits, segments, bucket_pairs))
    labelled = (classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    groups = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(groups, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def fingerprint_hex(fp):
    """16 lower-case hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    id (null ids last, then by row key), once; all columns as they were."""
    groups = near_dup_groups(docs, id_col, text_col, **options)
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")).alias("x"))
    kept = join_rows(docs, first.select("x.k1", "x.k2"), "left_semi", id_col, text_col)
    return kept.dropDuplicates(["_row_k1", "_row_k2"]).select(*same(docs))
