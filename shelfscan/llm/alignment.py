"""Cross-tokenizer alignment by tokenizer spans.

Both tokenizers of a document cover the same bytes (a space and the text).  Their spans
(character offsets of the ``tokenizers`` library, byte spans of a sentencepiece proto) are
coarse cuts; where a span cannot tell, inside a multibyte character or for byte-fallback
tokens, the tokens' decoded bytes refine it.  Byte offsets at which tokens of both end
cut the document into groups; tokens of a group are linked.

Texts are encoded in chunks that start at a single space between two other characters.
Neither tokenizer can join tokens across one: the first starts a new word there, the second
has no piece with a space after another character (checked when it is loaded; without that a
text is one chunk).  Chunks repeat, so a task remembers the recent ones, and new ones are
encoded together.

Every row is a document.  Its links go into a table as distinct id pairs with their
multiplicity; pairs are counted over all rows (combined before the shuffle).  Pairs found
in more than the K-th part of all (document, pair) entries are fewer than K: these are
broadcast, all others are looked up by a join in which no key has more rows than that.

Defined results: null and empty texts, and texts whose tokens do not give back the space and
the text (for example with U+2581), have no tokens: zeros and an empty digest.  Ids may be null
or repeat.  One text, its chunks and pairs are held by a task: some 300 bytes a word.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.bpe import byte_symbols
from shelfscan.llm.common import cut_table, prepare

FREQUENT = 1 << 18      # K: fewer id pairs than this are broadcast
CACHE = 200_000         # chunks a task remembers at least while it can
CACHED_CHARS = 48       # longer ones are not remembered
STEP_CHARS = 1 << 20    # texts looked at together
TOGETHER = 1000         # new chunks encoded together
SMALL = 4096            # links of a group that are listed one by one
CHUNK = re.compile(r"(?<=\S)(?= \S)")
TAILS = ".,;:!?"        # marks cut off a chunk's end
LAST_LATIN = "\u024f"   # letters up to this one have long been letters to every library
SPACE_MARK = "▁"   # fixed value: how sentencepiece writes a space
DIGITS = 10             # of a token id
POWERS = 10 ** np.arange(1, DIGITS)


def pair_type(n_a: int, n_b: int) -> str:
    """Type of an id pair's number."""
    return "int" if n_a * n_b < 1 << 31 else "long"


class Aligner:
    """Aligns the tokens of two vocabularies: ``first`` the content of a ``tokenizers`` JSON
    file, ``second`` that of a sentencepiece model."""

    def __init__(self, first: str, second: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        to_byte = {s: i for i, s in enumerate(byte_symbols())}
        vocab = json.loads(first)["model"]["vocab"]
        n_a, self.n_b = 1 + max(vocab.values()), self.b.vocab_size()
        self.a_bytes = [b""] * n_a
        for t, i in vocab.items():
            self.a_bytes[i] = (bytes([to_byte[c] for c in t]) if all(c in to_byte for c in t)
                               else t.encode())
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.fallback = np.array([self.b.is_byte(i) for i in range(self.n_b)])
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if f else p.replace(SPACE_MARK, " ").encode()
                        for p, f in zip(pieces, self.fallback)]
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (self.a_bytes, self.b_bytes))
        self.code = np.int32 if pair_type(n_a, self.n_b) == "int" else np.int64
        self.splits = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        ends = {p[i] for p in pieces for i in range(1, len(p)) if p[i] in TAILS and p[i - 1].isalpha()}
        self.tails = {c: self.aligned(f" x{c}", [2, 3])[1] for c in TAILS if c not in ends}

    def chunks(self, text: str) -> list[str]:
        """The text's chunks without the space before each."""
        if not self.splits:
            return [text]
        return [c[1:] for c in CHUNK.split(" " + text)]

    def aligned(self, text: str, chunk_ends: list[int]) -> list[tuple] | None:
        """Facts of the chunks of ``text`` (it starts with a space) that end at these byte
        offsets: number of first tokens, digest text, pairs as bytes (repeated), pairs of
        large groups with multiplicity.  None if a tokenizer does not give back the bytes."""
        first = self.a.encode(text, add_special_tokens=False)
        second = self.b.encode(text[1:], return_type="offset_mapping")
        a, b, raw = first.ids, second["ids"], text.encode()
        if not b or (b"".join([self.a_bytes[i] for i in a]) != raw
                     or b"".join([self.b_bytes[i] for i in b]) != raw):
            return None
        # spans are coarse cuts in characters ...
        a, b = np.array(a), np.array(b)
        spans = first.offsets
        a_ends = np.array([e for _, e in spans])
        b_ends = np.array([e for _, e in second["offsets"]]) + 1
        if len(raw) != len(text):
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            byte_of = np.cumsum(np.r_[0, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)])
            # ... which a token shares with the next one inside a multibyte character:
            # there the decoded bytes tell
            starts = np.array([x for x, _ in spans])
            shared = np.r_[starts[1:] < a_ends[:-1], False]
            a_ends = np.where(shared, np.cumsum(self.a_size[a]), byte_of[a_ends])
            b_ends = byte_of[b_ends]
        # ... and which byte-fallback tokens do not have
        b_ends = np.where(self.fallback[b], np.cumsum(self.b_size[b]), b_ends)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        group_a, group_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        many_a, many_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        until_a, until_b = np.r_[0, np.cumsum(many_a)], np.r_[0, np.cumsum(many_b)]
        last = np.searchsorted(common, chunk_ends)              # of each chunk: its last group
        text_of = self._digest(a, b, group_a, group_b, until_a, until_b, last)

        links = many_a * many_b
        listed = np.where(links <= SMALL, many_b, 0)[group_a]   # second tokens met by each first one
        met = np.repeat(until_b[group_a] - (np.cumsum(listed) - listed), listed) + np.arange(listed.sum())
        pairs = (np.repeat(a, listed) * self.n_b + b[met]).astype(self.code).tobytes()
        until = np.r_[0, np.cumsum(np.where(links <= SMALL, links, 0))] * np.dtype(self.code).itemsize
        heavy: dict[int, list] = {}
        for g in np.flatnonzero(links > SMALL):
            (u, cu), (v, cv) = (np.unique(x[r[g]:r[g + 1]], return_counts=True)
                                for x, r in ((a, until_a), (b, until_b)))
            heavy.setdefault(int(np.searchsorted(last, g)), []).append(
                ((u[:, None] * self.n_b + v).ravel(), (cu[:, None] * cv).ravel()))
        upto, tokens = until[last + 1].tolist(), np.diff(until_a[last + 1], prepend=0).tolist()
        return [(n, t, pairs[i:j], heavy.get(k)) for k, (n, t, i, j) in
                enumerate(zip(tokens, text_of, [0, *upto], upto))]

    def _digest(self, a, b, group_a, group_b, until_a, until_b, last) -> list[bytes]:
        """Per chunk ``a1,a2|b1;a3|b2``: decimal ids, put together as rows of digits."""
        n = len(a) + len(b)
        at_a, at_b = np.arange(len(a)) + until_b[group_a], np.arange(len(b)) + until_a[group_b + 1]
        ids = np.empty(n, np.int64)
        ids[at_a], ids[at_b] = a, b
        rows = np.empty((n, DIGITS + 1), np.uint8)
        for d in range(DIGITS):
            rows[:, d] = 48 + ids // 10 ** (DIGITS - 1 - d) % 10
        rows[:, DIGITS] = ord(",")
        rows[at_a[until_a[1:] - 1], DIGITS] = ord("|")
        rows[at_b[until_b[1:] - 1], DIGITS] = ord(";")
        width = 1 + np.searchsorted(POWERS, ids, "right")
        shown = np.arange(DIGITS + 1) >= DIGITS - width[:, None]
        text = rows[shown].tobytes()
        ends = np.cumsum(width + 1)[(until_a + until_b)[last + 1] - 1].tolist()
        return [text[i:j - 1] for i, j in zip([0, *ends], ends)]

    def learn(self, chunks: list[str]) -> dict[str, tuple | None]:
        """Facts of chunks: tokens, digest text, pairs; None where a tokenizer does not give
        back the bytes.  Regular chunks are encoded many at a time."""
        out: dict[str, tuple | None] = {}
        plain, stems = [], {}
        for c in chunks:
            if c[-1:] in self.tails and c[-2:-1].isalpha() and c[-2] <= LAST_LATIN:
                stems[c] = c[:-1]       # a cut before the last mark is certain as well
        wanted = dict.fromkeys([*(c for c in chunks if c not in stems),
                                *(s for s in stems.values() if s not in self.known)])
        for c in wanted:
            if self.splits and len(c) <= CACHED_CHARS and self.regular(c):
                plain.append(c)
            else:
                out[c] = self._one(c)
        for at in range(0, len(plain), TOGETHER):
            part = plain[at:at + TOGETHER]
            text = " " + " ".join(part)
            found = self.aligned(text, list(accumulate(len(c.encode()) + 1 for c in part)))
            out.update(zip(part, found if found else map(self._one, part)))
        for c, stem in stems.items():
            x, y = out[stem] if stem in out else self.known[stem], self.tails[c[-1]]
            out[c] = x and (x[0] + y[0], x[1] + b";" + y[1], x[2] + y[2], x[3])
        return out

    def _one(self, chunk: str) -> tuple | None:
        found = self.aligned(" " + chunk, [len(chunk.encode()) + 1])
        return found and found[0]

    @staticmethod
    def regular(chunk: str) -> bool:
        """Whether single spaces on both sides of ``chunk`` are cuts."""
        return chunk != "" and not (chunk[0].isspace() or chunk[-1].isspace())

    def _unknown(self, split: list[list[str]]) -> set[str]:
        """Chunks that are not remembered."""
        new = set().union(*split).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((c, self.older[c]) for c in again)
        return new - again

    def facts(self, texts: list[str]) -> list[list | None]:
        """Per text the facts of its chunks, in order; None for a text without tokens."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        known = self.known
        split = [t.split(" ") if t and self.splits else [] for t in texts]
        new = self._unknown(split)
        odd = {c for c in new if not self.regular(c)}
        if odd or not self.splits:      # spaces beside other white space are no cuts
            for i, t in enumerate(texts):
                if t and not (self.splits and odd.isdisjoint(split[i])):
                    split[i] = self.chunks(t)
            new = self._unknown(split)
        found = self.learn(sorted(new))
        known.update(found)
        bad = {c for c, v in found.items() if v is None}
        out = [None if not c or not bad.isdisjoint(c) else [known[x] for x in c] for c in split]
        for c in {c for c in found if len(c) > CACHED_CHARS} | bad | odd:
            known.pop(c, None)
        return out

    def document(self, found: list | None) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """``n_a, n_b, n_groups, n_links, digest, pairs, multiplicities`` of a text."""
        if found is None:
            empty = np.zeros(0, self.code)
            return 0, 0, 0, 0, "", empty, empty.astype(np.int64)
        pairs, many = np.unique(np.frombuffer(b"".join([f[2] for f in found]), self.code),
                                return_counts=True)
        many = many.astype(np.int64)
        heavy = [h for f in found if f[3] for h in f[3]]
        if heavy:
            codes = np.concatenate([pairs, *(h[0] for h in heavy)])
            times = np.concatenate([many, *(h[1] for h in heavy)])
            pairs, where = np.unique(codes, return_inverse=True)
            pairs, many = pairs.astype(self.code), np.zeros(len(pairs), np.int64)
            np.add.at(many, where, times)
        text = b";".join([f[1] for f in found])
        groups, n_a = text.count(b"|"), sum([f[0] for f in found])
        return (n_a, text.count(b",") + 2 * groups - n_a, groups, int(many.sum()),
                hashlib.sha256(text).hexdigest(), pairs, many)


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


_LOADED: dict[str, Aligner] = {}


def _aligner(shared) -> Aligner:
    """One aligner per Python worker and pair of vocabularies."""
    digest, first, second = shared.value
    if digest not in _LOADED:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED.clear()
        _LOADED[digest] = Aligner(first, second)
    return _LOADED[digest]


def _share(spark, paths):
    a, b = paths or default_paths()
    with open(a, encoding="utf-8") as f, open(b, "rb") as g:
        first, second = f.read(), g.read()
    digest = hashlib.sha256(first.encode() + second).hexdigest()
    return spark.sparkContext.broadcast((digest, first, second))


_FACTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<{}>, times array<long>")


def document_links(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and its linked id pairs
    ``pairs`` (first id * size of the second vocabulary + second id), distinct, with
    their multiplicities ``times``.  One pass over the texts, no shuffle."""
    shared = _share(prepare(docs.sparkSession), paths)

    def run(batches):
        aligner = _aligner(shared)
        for b in batches:
            ids, bodies = b.column("doc_id"), b.column("body")
            at = 0
            while at < len(b):
                texts, size, start = [], 0, at
                while at < len(b) and (size == 0 or size < STEP_CHARS):
                    texts.append((bodies[at].as_py() or b"").decode("utf-8", "replace"))
                    size += len(texts[-1])
                    at += 1
                found = [aligner.document(f) for f in aligner.facts(texts)]
                ends = pa.array(np.cumsum([0] + [len(f[5]) for f in found]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([f[k] for f in found])))
                         for k in (5, 6)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, at - start),
                     *(pa.array([f[k] for f in found], pa.int64()) for k in range(4)),
                     pa.array([f[4] for f in found], pa.string()), *lists],
                    [x.split()[0] for x in _FACTS.split(", ")])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"),
                         docs[text_col].cast("binary").alias("body"))
    return narrow.mapInArrow(run, _FACTS.format(pair_type(*vocabulary_sizes(paths))))


def vocabulary_sizes(paths: tuple[str, str] | None = None) -> tuple[int, int]:
    import sentencepiece
    a, b = paths or default_paths()
    with open(a, encoding="utf-8") as f:
        first = 1 + max(json.load(f)["model"]["vocab"].values())
    return first, sentencepiece.SentencePieceProcessor(model_file=b).vocab_size()


def pair_counts(links: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best`` of every linked id pair: in how many rows it is, and whether that is the
    most of its first id's pairs.  A first id has at most ``n_b`` pairs, so has its window."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("n"))
    per_first = Window.partitionBy(F.expr(f"pair div {n_b}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(per_first))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id",
          text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per document row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``."""
    links = cut_table(document_links(docs, paths, id_col, text_col)
                      .withColumn("r", F.monotonically_increasing_id()), "links")
    counts = cut_table(pair_counts(links, vocabulary_sizes(paths)[1]), "pairs")
    entries = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > entries // frequent        # fewer than ``frequent`` can be
    each = links.select("r", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "r", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    met = each.join(F.broadcast(counts.where(often)), "pair", "left")
    rare = (met.where("n is null").select("pair", "r", "times")
            .join(counts.where(~often), "pair"))
    sums = (met.where("n is not null").select("r", "times", "n", "best")
            .union(rare.select("r", "times", "n", "best"))
            .groupBy("r").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                              F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return links.drop("pairs", "times").join(sums, "r", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
