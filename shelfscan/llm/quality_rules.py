"""Quality rules as a short-circuit cascade.

A rule looks at one feature of a document and rejects it or not.  On a sample
each rule's cost and share of rejections are measured; rules then run in the
order of rejections per cost, and a document stops at the first rule that
rejects it.  Features are worked out on demand and kept per document, so a
rule whose feature is already there costs next to nothing.  The order changes
the cost, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import narrow, prepare

# The symbols counted by the contract.
SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 2000      # documents that cost and selectivity are measured on, about
REPEAT_WINDOW = 3
WIDE = 1 << 21          # word numbers below this fit three to a 64-bit key


class Features:
    """Features of one document (UTF-8 bytes), each computed when first asked for."""

    def __init__(self, body: bytes | None):
        self.body = body or b""
        self._known: dict[str, object] = {}

    def __getattr__(self, name):
        known = self.__dict__["_known"]
        if name not in known:
            known[name] = getattr(type(self), "_" + name)(self)
        return known[name]

    def _words(self) -> list[bytes]:
        return self.body.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _text(self) -> str:
        return self.body.decode("utf-8", "replace")

    def _word_chars(self) -> int:
        white = len(self.body) - len(self.body.translate(None, b" \t\n\x0b\x0c\r"))
        return len(self.text) - white

    def _n_symbols(self) -> int:
        return len(self.body) - len(self.body.translate(None, SYMBOLS))

    def _lines(self) -> list[bytes]:
        return [x for x in self.body.split(b"\n") if x.strip()]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _word_ids(self) -> np.ndarray:
        number: dict[bytes, int] = {}
        return np.array([number.setdefault(w, len(number)) for w in self.words], np.uint64)

    def _n_distinct(self) -> int:
        return int(self.word_ids.max()) + 1 if len(self.word_ids) else 0

    def _n_repeat_words(self) -> int:
        ids, w = self.word_ids, REPEAT_WINDOW
        if len(ids) <= w:
            return 0
        key, wide = ids[: len(ids) - w + 1], self.n_distinct
        for j in range(1, w):
            if wide > WIDE:     # renumber so that the pair fits
                key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            key = key * np.uint64(wide) + ids[j: len(ids) - w + 1 + j]
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[group] > 1
        covered = np.zeros(len(ids), bool)
        for j in range(w):
            covered[j: len(ids) - w + 1 + j] |= again
        return int(covered.sum())

    def _n_upper(self) -> int:
        return len(self.body) - len(self.body.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def _n_lower(self) -> int:
        return len(self.body) - len(self.body.translate(None, b"abcdefghijklmnopqrstuvwxyz"))

    def _n_shouts(self) -> int:
        return self.body.count(b"!")

    def _n_same_next(self) -> int:
        return int((self.word_ids[1:] == self.word_ids[:-1]).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], bool]


#: The two base rules of the contract.
BASE_RULES = (
    Rule("few_words", lambda f: f.n_words < 50),
    Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
)
#: The method's own rules: only clear junk.
OWN_RULES = (
    Rule("symbols", lambda f: f.n_symbols > 0.2 * f.n_words),
    Rule("capitals", lambda f: f.n_upper > f.n_lower and 2 * f.n_upper > f.word_chars),
    Rule("shouting", lambda f: f.n_shouts > 0.2 * f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("stuttering", lambda f: 4 * f.n_same_next > f.n_words),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 30 * f.n_words),
)
RULES = BASE_RULES + OWN_RULES
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
            text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``rule, n, rejected, seconds`` over a sample of about ``sample_rows``
    documents drawn by a hash; each rule is timed on fresh features."""
    prepare(docs.sparkSession)
    total = docs.count()
    share = min(1.0, sample_rows / max(1, total))
    d = narrow(docs, id_col, text_col)
    picked = d.where(F.pmod("k2", F.lit(1 << 30)) <= int(share * (1 << 30))).select("body")

    def run(batches):
        n = rejected = seconds = None
        for b in batches:
            n, rejected, seconds = n or [0] * len(rules), rejected or [0] * len(rules), \
                seconds or [0.0] * len(rules)
            for body in b.column("body").to_pylist():
                for i, rule in enumerate(rules):
                    f, t = Features(body), time.perf_counter()
                    rejected[i] += bool(rule.rejects(f))
                    seconds[i] += time.perf_counter() - t
                    n[i] += 1
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.name for r in rules]), pa.array(n, pa.int64()),
                 pa.array(rejected, pa.int64()), pa.array(seconds)],
                ["rule", "n", "rejected", "seconds"])

    got = picked.mapInArrow(run, "rule string, n long, rejected long, seconds double")
    return got.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("n", "rejected", "seconds")])


def cascade_order(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by rejections per second, best first (ties and rules without a
    sample in the given order)."""
    worth = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in measured.collect()}
    return tuple(sorted(rules, key=lambda r: -worth.get(r.name, 0.0)))


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
            text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
            stats: bool = False) -> DataFrame:
    """``doc_id, k1, k2, kept, rejected_by`` per row (``rejected_by``: the
    first rule of the measured order that rejects, null if kept).  With
    ``stats`` also the counts of the contract, for every row.

    Null texts are empty; rows are independent, so repeated rows get equal
    verdicts.  An empty table gives an empty result."""
    ordered = cascade_order(measure(docs, rules, id_col, text_col, sample_rows), rules)

    def run(batches):
        for b in batches:
            by, counts = [], []
            for body in b.column("body").to_pylist():
                f = Features(body)
                by.append(next((r.name for r in ordered if r.rejects(f)), None))
                if stats:
                    counts.append([getattr(f, s) for s in _STATS])
            arrays = [b.column("doc_id"), b.column("k1"), b.column("k2"),
                      pa.array([x is None for x in by], pa.bool_()), pa.array(by, pa.string())]
            names = ["doc_id", "k1", "k2", "kept", "rejected_by"]
            if stats:
                arrays += [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(_STATS))]
                names += _STATS
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, k1 long, k2 long, kept boolean, rejected_by string"
    if stats:
        schema += "".join(f", {s} long" for s in _STATS)
    return narrow(docs, id_col, text_col).mapInArrow(run, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The cascade with the counts of the contract and ``base_failed``."""
    out = cascade(docs, id_col=id_col, text_col=text_col, stats=True)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *_STATS, failed.alias("base_failed"),
                      (F.col("kept") & ~failed).alias("kept"))
