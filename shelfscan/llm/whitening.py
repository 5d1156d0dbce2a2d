"""Embedding whitening by FEAST contour integration.

Vectors become whole numbers, x = floor(64 c) + 1000000, so counts, sums and
cross products are exact whatever the order of the tasks.  The covariance is that
of the distinct vectors.  Its leading eigenpairs come from spectral slices: inertia
counts (signs of the pivots of V - sigma I) cut the spectrum into intervals with few
eigenvalues, a quadrature of complex shifted solves round each interval projects onto
its eigenvectors, Rayleigh-Ritz extracts them, and the inertia counts verify that none
is missed.

Only sums over dimensions reach the driver (dims^2 / 2 numbers, whatever the rows);
the vectors are read, deduplicated and projected by tasks.

Defined results: a row whose vector is null or holds a null, NaN or infinite entry has
no result.  Entries missing at the end of a shorter vector count as 0, and products
64 c beyond 2^40 in size as 2^40.  Ids may be null or repeat: each row has its own
results.  Eigenvalues not above rounding (``dims`` times the double precision, against
the largest) have no component: an empty table, or one distinct vector, gives no rows.
A deviation that no long can hold is null.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import cut_table, prepare

SCALE = 64
SHIFT = 1_000_000
LIMIT = 1 << 40        # of |64 c|
COMPONENTS = 16
MAX_DIMS = 4096        # V and its solves are dense and held by the driver: 128 MB a matrix at most
SLICE = 8              # eigenvalues a contour should hold
NODES = 12             # quadrature nodes on the upper half of a contour
ROUNDS = 40            # subspace iterations of a slice at most
BLOCK = 4096           # rows multiplied at a time: products of 2^40 sum exactly in doubles
LOW = 21               # bits of the low half of a number with more than 20 bits


# rows ------------------------------------------------------------------------

def quantised(vectors: DataFrame, id_col: str = "vec_id",
              vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, x array<long>`` of the rows with a finite vector, and the length of all x:
    that of the longest vector."""
    v = vectors.select(vectors[id_col].alias("vec_id"),
                       vectors[vec_col].cast("array<double>").alias("v"))
    finite = v.where(F.expr("v is not null and forall(v, c -> c is not null and c = c "
                            "and abs(c) < double('Infinity'))"))
    dims = finite.agg(F.max(F.size("v"))).first()[0] or 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries: at most {MAX_DIMS} are supported")
    padded = F.expr(f"concat(v, array_repeat(double(0), {dims} - size(v)))")

    def whole(c: Column) -> Column:
        y = F.greatest(F.least(F.floor(c * SCALE).cast("double"), F.lit(float(LIMIT))),
                       F.lit(float(-LIMIT)))
        return y.cast("long") + SHIFT

    return finite.select("vec_id", F.transform(padded, whole).alias("x")), dims


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The batch's vectors as rows of a matrix of int64."""
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dims)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums per dimension."""
    def run(batches):
        n, total = 0, np.zeros(dims, object)
        for b in batches:
            n += len(b)
            for at in range(0, len(b), BLOCK):
                total += _matrix(b, dims)[at:at + BLOCK].sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), _decimals([n, *total])], ["i", "s"])

    rows = (fit.mapInArrow(run, "i int, s decimal(38,0)")
            .groupBy("i").agg(F.sum("s").alias("s")).collect())
    sums = {r.i: int(r.s) for r in rows}
    return sums.get(-1, 0), [sums.get(i, 0) for i in range(dims)]


def exact_products(y: np.ndarray) -> np.ndarray:
    """y^T y of whole numbers below 2^42 in size, as Python's numbers."""
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), BLOCK):
        part = y[at:at + BLOCK]
        high = (part + (1 << (LOW - 1))) >> LOW
        low = (part - (high << LOW)).astype(np.float64)
        total += (low.T @ low).astype(np.int64).astype(object)
        if high.any():
            high = high.astype(np.float64)
            mixed = (high.T @ low).astype(np.int64).astype(object)
            total += ((mixed + mixed.T) << LOW) + (
                (high.T @ high).astype(np.int64).astype(object) << (2 * LOW))
    return total


def covariance(fit: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance (divisor n), every entry the double nearest to the exact one.

    Vectors are centred on the whole numbers nearest to their means; the rest of the
    centring, exact as well, is a correction of the summed products."""
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    upper = np.triu_indices(dims)

    def run(batches):
        total = np.zeros((dims, dims), object)
        for b in batches:
            total += exact_products(_matrix(b, dims) - centre)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(u, pa.int32()) for u in upper), _decimals(total[upper])], ["i", "j", "p"])

    v = np.zeros((dims, dims))
    for r in (fit.mapInArrow(run, "i int, j int, p decimal(38,0)")
              .groupBy("i", "j").agg(F.sum("p").alias("p")).collect()):
        v[r.i, r.j] = v[r.j, r.i] = (n * int(r.p) - rest[r.i] * rest[r.j]) / (n * n)
    return v


# eigenpairs -------------------------------------------------------------------

def count_above(a: np.ndarray, sigma: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` above ``sigma``: by Sylvester's law the
    positive ones among the pivots of a - sigma I, eliminated with 1x1 or 2x2 pivots
    (the largest entry on the diagonal, or off it if that is much larger)."""
    m = a - sigma * np.eye(len(a))
    positive = 0
    while len(m):
        d = np.abs(np.diag(m))
        p = int(d.argmax())
        off = np.abs(m)
        np.fill_diagonal(off, 0)
        i, j = divmod(int(off.argmax()), len(m))
        if off[i, j] == 0:
            return positive + int((np.diag(m) > 0).sum())
        pivots = [p] if d[p] >= 0.64 * off[i, j] else [i, j]
        others = np.setdiff1d(np.arange(len(m)), pivots)
        head = m[np.ix_(pivots, pivots)]
        side = m[np.ix_(others, pivots)]
        if len(pivots) == 1:
            positive += int(head[0, 0] > 0)
        else:
            positive += 1          # a 2x2 pivot with a small diagonal has one of either sign
        m = m[np.ix_(others, others)] - side @ np.linalg.solve(head, side.T)
        m = (m + m.T) / 2
    return positive


def slices(a: np.ndarray, wanted: int, floor: float, top: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``wanted`` largest eigenvalues
    above ``floor``, cut in gaps of the spectrum where the counts show one."""
    out = []
    todo = [(floor, top, count_above(a, floor), 0)]
    while todo:
        low, high, below, above = todo.pop()
        inside = below - above
        if inside == 0 or above >= wanted:
            continue
        if inside <= SLICE or high - low < 1e-9 * top:
            out.append((low, high, inside))
            continue
        grid = np.linspace(low, high, 11)[1:-1]
        counts = [count_above(a, s) for s in grid]
        # the widest run of equal counts is a gap; of equal ones, that which halves best
        runs, start = [], 0
        for i in range(1, len(grid) + 1):
            if i == len(grid) or counts[i] != counts[start]:
                even = abs(counts[start] - (below + above) / 2)
                if above < counts[start] < below:
                    runs.append((i - start, -even, (grid[start] + grid[i - 1]) / 2, counts[start]))
                start = i
        if runs:
            _, _, cut, c = max(runs)
        else:      # all on one side of one step of the grid: go on inside it
            at = next((i for i, c in enumerate(counts) if c == above), len(grid) - 1)
            cut, c = float(grid[at]), counts[at]
            if c == above and at:
                cut, c = float(grid[at - 1]), counts[at - 1]
        if c in (below, above):        # nothing split off: only the interval gets shorter
            todo.append((cut, high, below, above) if c == below else (low, cut, below, above))
        else:
            todo += [(low, cut, below, c), (cut, high, c, above)]
    return out


def feast(a: np.ndarray, low: float, high: float, inside: int) -> np.ndarray:
    """Orthonormal eigenvectors of the ``inside`` eigenvalues in (low, high).

    The projector onto them is the contour integral of (z I - a)^-1 over the circle
    through low and high, by Gauss-Legendre quadrature on its upper half."""
    size = len(a)
    t, weight = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (t + 1)
    middle, radius = (low + high) / 2, (high - low) / 2
    z = middle + radius * np.exp(1j * angle)
    scale = np.abs(a).sum(axis=1).max()
    y = np.random.default_rng(11).standard_normal((size, min(size, inside + inside // 2 + 6)))
    best = (np.inf, None)
    stale = 0
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for zk, wk, ak in zip(z, weight, angle):
            solved = np.linalg.solve(zk * np.eye(size) - a, y.astype(complex))
            q += wk / 2 * (radius * np.exp(1j * ak) * solved).real
        q, _ = np.linalg.qr(q)
        value, mix = np.linalg.eigh(q.T @ a @ q)               # Rayleigh-Ritz
        y = q @ mix
        # directions that hold rounding only can have a Ritz value inside too: they have the
        # large residuals, and the counts tell how many are none of them
        residual = np.linalg.norm(a @ y - y * value, axis=0) / scale
        inner = np.flatnonzero((value > low) & (value <= high))
        inner = inner[np.argsort(residual[inner])][:inside]
        if len(inner) < inside:
            continue
        worst = residual[inner].max()
        if worst < best[0] / 2:
            best, stale = (worst, y[:, inner]), 0
        else:
            stale += 1
        if stale >= 2:
            break
    if best[0] > 1e-11:
        raise RuntimeError(f"no {inside} eigenpairs found between {low} and {high}")
    return best[1]


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and their eigenvectors."""
    norm = float(np.abs(v).sum(axis=1).max()) if len(v) else 0.0
    if norm == 0:
        return np.zeros(0), np.zeros((len(v), 0))
    a = v / norm
    floor = len(v) * 4 * np.finfo(float).eps
    cuts = slices(a, wanted, floor, 1.0 + 1e-6)
    if not cuts:
        return np.zeros(0), np.zeros((len(v), 0))
    found = np.hstack([feast(a, *c) for c in cuts])
    if found.shape[1] != sum(c[2] for c in cuts):
        raise RuntimeError("eigenpairs are missing against the inertia counts")
    q, _ = np.linalg.qr(found)              # slices made orthogonal to each other
    value, mix = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-value)[:wanted]
    return value[order] * norm, q @ mix[:, order]


# whitening ----------------------------------------------------------------------

class Whitener:
    """What a fit holds: all of it small (dims times components)."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, wanted: int):
        self.n, self.sums = n, sums
        self.values, self.vectors = leading(v, wanted)
        self.explained = self.values / np.trace(v) if len(self.values) else self.values
        self.centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(c) for s, c in zip(sums, self.centre)]
        self.fraction = np.array([r / n for r in self.rest])
        self.turn = self.vectors / np.sqrt(self.values)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.fraction) @ self.turn

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact sums over the dimensions of (n x - S)^2."""
        y = x - self.centre
        largest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 1 << 63:
            d = self.n * y - np.array(self.rest, np.int64)
            return pa.array((d * d).sum(axis=1), pa.int64())
        d = self.n * y.astype(object) - np.array(self.rest, object)
        sums = (d * d).sum(axis=1)
        return pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())


def fit_whitener(x: DataFrame, dims: int, wanted: int = COMPONENTS) -> tuple[Whitener | None, DataFrame]:
    """Fit on every distinct vector once; also the table of those vectors."""
    fit = cut_table(x.select("x").distinct(), "fit")
    n, sums = column_sums(fit, dims)
    if n == 0 or dims == 0:
        return None, fit
    return Whitener(n, sums, covariance(fit, dims, n, sums), wanted), fit


def identity_error(fit: DataFrame, dims: int, w: Whitener) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity,
    measured on the vectors: products of centred values, sums combined by moments."""
    k = len(w.values)

    def run(batches):
        n, total, products, between = 0, np.zeros(k), np.zeros((k, k)), np.zeros((k, k))
        for b in batches:
            x = _matrix(b, dims)
            for at in range(0, len(x), BLOCK):
                y = w.whiten(x[at:at + BLOCK])
                mean = y.mean(axis=0)
                products += (y - mean).T @ (y - mean)
                between += len(y) * np.outer(mean, mean)
                total += len(y) * mean
                n += len(y)
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
             pa.array((products + between).ravel()), pa.array(np.repeat(total, k))],
            ["i", "j", "p", "t"])

    rows = (fit.mapInArrow(run, "i int, j int, p double, t double").groupBy("i", "j")
            .agg(F.sum("p").alias("p"), F.sum("t").alias("t")).collect())
    mean = {r.i: r.t / w.n for r in rows}
    return max((abs(r.p / w.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in rows), default=0.0)


OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``.

    Four passes over the distinct vectors' table (sums, products, check) and the input
    (projection); the only shuffle of vectors is that of the distinct step, which combines
    repeated ones before it."""
    prepare(vectors.sparkSession)
    x, dims = quantised(vectors, id_col, vec_col)
    x = x.withColumn("vec_id", F.col("vec_id").cast("long"))
    w, fit = fit_whitener(x, dims, components)
    if w is None or len(w.values) == 0:
        return vectors.sparkSession.createDataFrame([], OUT)
    error = identity_error(fit, dims, w)
    k = len(w.values)

    def run(batches):
        for b in batches:
            for at in range(0, len(b), BLOCK):
                part = b.slice(at, BLOCK)
                rows = _matrix(part, dims)
                each = pa.array(np.repeat(np.arange(len(part)), k))
                m = len(part) * k
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(each),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                     pa.array(np.full(m, w.n)), w.deviation(rows).take(each),
                     pa.array(w.whiten(rows).ravel()), pa.array(np.tile(w.explained, len(part))),
                     pa.array(np.full(m, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])

    return x.mapInArrow(run, OUT)
