"""Quality classifier with hierarchical empirical Bayes.

A logistic model scores each document from its style.  Sites then add what
their other documents say: a host (source) has the mean score of its
documents, shrunk toward the global mean; a path (source and language) is
shrunk toward its host.  How strongly is estimated from the data: the variance
within sites over the variance between sites is the number of documents that
the prior is worth, so sparse sites stay near it and large ones speak for
themselves.  A document's own score is left out of its site's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import cut, join_rows, narrow, prepare, same
from shelfscan.llm.quality_rules import Features

TRAIN_ROWS = 20_000     # labelled documents the model is fitted on, about
RIDGE = 1.0
STEPS = 30
SITE_WEIGHT = 0.5       # weight of the site's log-odds beside the document's own
THRESHOLD = 0.5         # documents with a smaller posterior are rejected
EDGE = 1e-4             # probabilities are kept this far from 0 and 1
N_FEATURES = 14


def style(body: bytes | None) -> list[float]:
    """Style features of a text, each roughly between 0 and a few units."""
    f = Features(body)
    n, c = max(1, f.n_words), max(1, len(f.body))
    lines = max(1, len(f.lines))
    most = int(np.bincount(f.word_ids.astype(np.int64)).max()) if f.n_words else 0
    per_word = lambda x: min(3.0, x / n)
    # distinct words expected at this length, so that long texts do not look repetitive
    fresh = f.n_distinct / n - 1.0 / (1.0 + 0.1 * np.log1p(n))
    return [np.log1p(f.n_words) / 5.0, min(3.0, f.word_chars / n / 6.0), per_word(f.n_symbols),
            float(f.n_symbols > 0.05 * n), per_word(f.n_shouts), f.n_upper / c,
            float(f.n_upper > f.n_lower), per_word(f.body.count(b"|")), float(fresh),
            f.n_dup_lines / lines, f.n_same_next / n, most / n,
            min(3.0, lines / n * 10), f.n_repeat_words / n]


def features(docs: DataFrame, *more: Column, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, x array<double>`` and the columns in ``more``."""
    prepare(docs.sparkSession)
    d = narrow(docs, id_col, text_col, *more)
    rest = [f for f in d.schema if f.name != "body"]

    def run(batches):
        for b in batches:
            x = [style(t) for t in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in rest), pa.array(x, pa.list_(pa.float64()))],
                [*(f.name for f in rest), "x"])

    return d.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
                        + ", x array<double>")


@dataclass(frozen=True)
class Model:
    """Weights over standardised features; the last is the intercept."""
    mean: list[float]
    scale: list[float]
    weight: list[float]

    def probability(self, x: Column) -> Column:
        """P(good) as a JVM expression over an ``array<double>`` column."""
        z = F.lit(self.weight[-1])
        for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weight)):
            z = z + (x[i] - m) / s * w
        return 1.0 / (1.0 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge-penalised logistic regression by Newton steps.  Without rows of
    both kinds the model is the constant (pseudo-counted) share of good."""
    share = (y.sum() + 1.0) / (len(y) + 1.5)
    if len(y) == 0 or y.min() == y.max():
        return Model([0.0] * N_FEATURES, [1.0] * N_FEATURES,
                     [0.0] * N_FEATURES + [float(np.log(share / max(1e-9, 1 - share)))])
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.r_[np.full(N_FEATURES, RIDGE), 1e-6]
    for _ in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean.tolist(), scale.tolist(), w.tolist())


def train(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Model from about ``rows`` labelled documents (all, if fewer), drawn by a
    hash of the id.  Null labels and ids are left out; of contradicting labels
    the smallest counts."""
    known = (labels.select(labels[id_col].cast("long").alias("doc_id"),
                           labels[label_col].cast("int").alias("y")).dropna()
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    share = min(1.0, rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # in a fixed order, so that the fit does not depend on task order
    drawn = sorted(feats.join(known, "doc_id").select("doc_id", "k2", "x", "y").collect())
    x = np.array([r.x for r in drawn], float).reshape(-1, N_FEATURES)
    return fit(x, np.array([r.y for r in drawn], float))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def _worth(sites: DataFrame, center: Column) -> float:
    """Documents that the prior over ``sites`` (n, s, ss) is worth: variance
    within over variance between, by the method of moments."""
    mean = F.col("s") / F.col("n")
    r = sites.agg(
        F.sum(F.col("ss") - F.col("s") * mean), F.sum("n") - F.count("*"),
        F.sum(F.col("n") * (mean - center) ** 2), F.count("*"), F.sum("n")).first()
    if not r[3]:
        return 1.0
    within = max(r[0], 0.0) / max(1, r[1])
    between = max((r[2] - r[3] * within) / max(1, r[4]), 1e-6)
    return min(max(within / between, 1.0), 1e6)


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """(``host, path, n, s, host_posterior``, worth of the host prior for a
    path, global mean) from ``host, path, p``, by grouped sums."""
    paths = cut(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") ** 2).alias("ss")))
    hosts = cut(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]))
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = s / n if n else 0.5
    m = _worth(hosts, F.lit(mean))
    posterior = hosts.select("host", ((F.col("s") + m * mean) / (F.col("n") + m))
                             .alias("host_posterior"))
    both = paths.join(posterior, "host")
    return both.drop("ss"), _worth(both, F.col("host_posterior")), mean


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang", threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, k1, k2, p_document, host_posterior, path_posterior, posterior,
    keep`` per row.

    Null hosts and paths are the empty name; null texts are empty.  Without
    labels the documents' scores are equal and all are kept.  Repeated rows
    give repeated results.
    """
    feats = cut(features(docs, F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("host"),
                         F.coalesce(docs[path_col].cast("string"), F.lit("")).alias("path"),
                         id_col=id_col, text_col=text_col))
    model = train(feats, labels, id_col, rows=train_rows)
    scored = feats.select("doc_id", "k1", "k2", "host", "path",
                          F.round(model.probability(F.col("x")), 9).alias("p"))
    sites, worth, mean = site_posteriors(scored)
    # the document's own score is taken out of its path
    path_posterior = ((F.col("s") - F.col("p") + worth * F.col("host_posterior"))
                      / (F.col("n") - 1 + worth))
    odds = _logit(F.col("p")) + SITE_WEIGHT * (_logit(path_posterior) - _logit(F.lit(mean)))
    out = scored.join(sites, ["host", "path"]).withColumn("path_posterior", path_posterior)
    out = out.withColumn("posterior", 1.0 / (1.0 + F.exp(-odds)))
    # rounded, because sums of doubles depend on the order of addition
    r = lambda c: F.round(F.col(c), 6).alias(c)
    return out.select("doc_id", "k1", "k2", F.round("p", 6).alias("p_document"),
                      r("host_posterior"), r("path_posterior"), r("posterior"),
                      (F.round("posterior", 6) >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they were."""
    verdict = classify(docs, labels, id_col, text_col, **options)
    good = verdict.where("keep").select("k1", "k2").distinct()
    return join_rows(docs, good, "left_semi", id_col, text_col).select(*same(docs))
