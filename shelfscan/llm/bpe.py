"""BPE encoding and decoding by forced-boundary splitting.

Two neighbouring symbols that no vocabulary token holds side by side can never
be merged, so between them every encoding has a cut.  Words are split at these
forced boundaries, the fragments are encoded independently, and their ids are
concatenated.  Words repeat, so a task remembers the recent ones.

The vocabulary file follows the public ``tokenizers`` JSON layout for
byte-level BPE with an end-of-word suffix; that library's BPE model encodes
the fragments.  The path is a parameter; the file is read on the driver and its
content (of fixed size) is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

from shelfscan.llm.common import narrow, prepare

CACHE = 200_000         # words, and chunks of text, that a task remembers at least while it can
CACHED_CHARS = 64       # longer ones are not remembered, so that the memory for them is bounded
# Up to this character all letters and numbers have long been assigned, and
# normalisation but for the case changes nothing (but for U+0130).
STABLE = 0x2FF
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u02ff]")


def vocabulary_path() -> str:
    """Default vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE: printable
    Latin-1 bytes stand for themselves, the others for 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class _Recent(dict):
    """Results of ``make``: the last CACHE new keys and those used since the CACHE before them.
    Keys of more than CACHED_CHARS characters are worked out each time."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        if len(key) > CACHED_CHARS:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _stable_words() -> re.Pattern:
    """The word pattern over characters up to STABLE, with their classes spelled out."""
    kind = {k: re.escape("".join(chr(c) for c in range(STABLE + 1)
                                 if unicodedata.category(chr(c))[0] == k)) for k in "LN"}
    return re.compile(f"[{kind['L']}]+|[{kind['N']}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{kind['L']}{kind['N']}]+")


class Encoder:
    """Encodes and decodes texts as the vocabulary's own library does."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" "))
                  for m in model["merges"]]
        self.library = Tokenizer.from_str(content)
        self.last = self.library.model                         # for a word's last fragment
        self.inner = BPE(vocab=self.vocab, merges=merges)      # for the others: no word end
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")") \
            if self.special else None
        self.words = _stable_words()
        self.table = dict(enumerate(byte_symbols()))
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.joined = self._pairs()
        self.by_word = _Recent(self._word)
        self.by_chunk = _Recent(self._chunk)

    def _pairs(self) -> set[str]:
        """Symbol pairs that stand side by side inside some token."""
        out: set[str] = set()
        for token in self.vocab:
            t = token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            out.update(a + b for a, b in zip(t, t[1:]))
        return out

    def fragments(self, symbols: str) -> list[str]:
        """``symbols`` split at its forced boundaries."""
        cuts = [i for i in range(1, len(symbols)) if symbols[i - 1: i + 1] not in self.joined]
        return [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]

    def _out(self, ids: list[int]) -> tuple[bytes, str, str]:
        """Ids as int32 (little-endian) bytes, as text, and their tokens; texts
        are joined by a space."""
        return (np.array(ids, "<i4").tobytes(), " ".join(map(str, ids)),
                " ".join([self.token_of[i] for i in ids]))

    def _word(self, word: str) -> tuple[bytes, str, str]:
        *inner, last = self.fragments("".join([self.table[b] for b in word.encode()]))
        ids = [t.id for part in inner for t in self.inner.tokenize(part)]
        return self._out(ids + [t.id for t in self.last.tokenize(last)])

    def _chunk(self, chunk: str) -> tuple[bytes, str, str]:
        parts = [self.by_word[w] for w in self.words.findall(chunk)]
        if len(parts) == 1:
            return parts[0]
        return (b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]),
                " ".join([p[2] for p in parts]))

    def pieces(self, text: str) -> list[tuple[bytes, str, str]]:
        """Ids (bytes, text) and tokens of successive parts of ``text``, see ``_out``."""
        out: list[tuple[bytes, str, str]] = []
        known = self.by_chunk
        for part in self.at_special.split(text) if self.at_special and "<" in text else [text]:
            if part in self.special:
                out.append(self._out([self.special[part]]))
            elif UNUSUAL.search(part) is None:
                out += [known[c] for c in part.lower().split()]
            else:   # the library's own normalisation and classes decide
                normal = self.library.normalizer.normalize_str(part)
                spans = self.library.pre_tokenizer.pre_tokenize_str(normal)
                out += [self.by_word[normal[a:b]] for _, (a, b) in spans]
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([p[0] for p in self.pieces(text)]), "<i4")

    def decode(self, ids) -> str:
        """Tokens joined by a space: the vocabulary names no decoder."""
        return " ".join([self.token_of[int(i)] for i in ids])


_LOADED: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    digest, content = shared.value
    if digest not in _LOADED:
        _LOADED.clear()
        _LOADED[digest] = Encoder(content)
    return _LOADED[digest]


def _share(spark, path: str | None):
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        content = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(content.encode()).hexdigest(), content))


def _text(body: bytes | None) -> str:
    return (body or b"").decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, n_tokens long, ids array<int>`` per row.

    Null and empty texts have no ids.  Rows are independent of each other:
    one pass, no shuffle."""
    shared = _share(prepare(docs.sparkSession), path)

    def run(batches):
        e = _encoder(shared)
        for b in batches:
            ids = [b"".join([p[0] for p in e.pieces(_text(x))]) for x in b.column("body").to_pylist()]
            ends = np.cumsum([0] + [len(x) // 4 for x in ids])
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(np.diff(ends), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                ["doc_id", "k1", "k2", "n_tokens", "ids"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, k1 long, k2 long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (with ``ids``) plus ``decoded``; null ids decode to an empty text."""
    spark = prepare(encoded.sparkSession)
    shared = _share(spark, path)
    names = encoded.columns

    def run(batches):
        e = _encoder(shared)
        for b in batches:
            text = [e.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())],
                                             [*names, "decoded"])

    return encoded.mapInArrow(run, ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded string")


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row: encoding,
    decoding and hashing in one pass over the text.  The ids are decoded word
    by word while they are there."""
    shared = _share(prepare(docs.sparkSession), path)

    def run(batches):
        e = _encoder(shared)
        for b in batches:
            n, of_ids, of_text = [], [], []
            for body in b.column("body").to_pylist():
                pieces = e.pieces(_text(body))
                n.append(sum([len(p[0]) for p in pieces]) // 4)
                of_ids.append(hashlib.sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
                of_text.append(hashlib.sha256(" ".join([p[2] for p in pieces]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
