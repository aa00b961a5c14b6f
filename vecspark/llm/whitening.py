"""Embedding whitening by spectrum slicing.

1. Moments.  Whole-number components; one pass for the count and the exact
   sums, one for the second moments about the rounded means (so components are
   centred before they are multiplied), corrected by what the rounding left.
   Every task sends one array.
2. Slicing.  By Sylvester's law the negative pivots of an LDLᵀ factorisation
   of ``V - s I`` count the eigenvalues below ``s``.  Bisection on these counts
   isolates each leading eigenvalue in an interval of its own.
3. Rayleigh quotient iteration, started by inverse iteration from the
   interval, converges cubically to the eigenpair.  Should it leave its
   interval, the interval is halved and it starts again.
4. Certificate.  Counts just below and just above each value found prove its
   number: exactly ``j`` eigenvalues above the first point and ``j - 1`` above
   the second (or, where eigenvalues coincide to rounding, the whole cluster).
5. One pass over the rows projects them and divides by the roots; another
   measures the covariance of the result.

The covariance matrix is the driver's only state; its size is that of one
vector squared, whatever the table's size.

Defined results: rows whose vector is null, empty, or has a null or
non-finite entry take no part, nor do those whose length is not that of most
rows (of equally frequent lengths the smaller) or with entries of 2**36 / scale
or more in absolute value.  Components of rank-deficient data whose eigenvalue
is zero to rounding are not returned, so a table of one row (or of equal rows)
has no components and gives no rows, like an empty one.  Repeated rows and
null ids count like others.  ``deviation`` is null where it does not fit a
BIGINT.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.common import finite_vectors, matrix, summed

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
_HIGH = 1 << 20  # sums of whole numbers are taken in two halves, so that none overflows
_EPS = np.finfo(np.float64).eps
_GROWTH = (1 + 17**0.5) / 8


def count_above(v: np.ndarray, s: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``s``: positive pivots of LDLᵀ with 1 x 1 and 2 x 2 diagonal pivoting."""
    a = v - s * np.eye(len(v))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal().copy()
        p = int(diagonal.argmax())
        np.fill_diagonal(size, 0)
        place = int(size.argmax())
        most = size.flat[place]
        if diagonal[p] == 0 and most == 0:
            return above
        if diagonal[p] >= _GROWTH * most:
            rest = np.delete(np.arange(len(a)), p)
            column, pivot = a[rest, p], a[p, p]
            above += pivot > 0
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:  # a 2 x 2 pivot with one eigenvalue on either side
            pair = [place // len(a), place % len(a)]
            rest = np.delete(np.arange(len(a)), pair)
            columns, pivot = a[np.ix_(rest, pair)], a[np.ix_(pair, pair)]
            above += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(pivot, columns.T)
    return above


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues, falling, and their unit eigenvectors (rows)."""

    values: np.ndarray
    vectors: np.ndarray


def _solve(v: np.ndarray, shift: float, b: np.ndarray, nudge: float) -> np.ndarray:
    for _ in range(4):
        try:
            x = np.linalg.solve(v - shift * np.eye(len(v)), b)
            if np.isfinite(x).all():
                return x
        except np.linalg.LinAlgError:
            pass
        shift += nudge  # the shift is an eigenvalue to the last bit
    raise ArithmeticError("shifted matrix stays singular")


def _quotient_iteration(v: np.ndarray, lo: float, hi: float, nudge: float, rng) -> tuple[float, np.ndarray] | None:
    """The eigenpair of the one eigenvalue in ``(lo, hi]``, or None if the iteration leaves the interval."""
    x = rng.standard_normal(len(v))
    x /= np.linalg.norm(x)
    for _ in range(3):
        x = _solve(v, (lo + hi) / 2, x, nudge)
        x /= np.linalg.norm(x)
    value = float(x @ v @ x)
    least = np.inf
    for _ in range(30):
        residual = float(np.linalg.norm(v @ x - value * x))
        if residual >= least / 2 and least <= 64 * nudge:
            break
        least = min(least, residual)
        if not lo - nudge <= value <= hi + nudge:
            return None
        x = _solve(v, value, x, nudge)
        x /= np.linalg.norm(x)
        value = float(x @ v @ x)
    return (value, x) if lo - nudge <= value <= hi + nudge and least <= 64 * nudge else None


def leading(v: np.ndarray, components: int, seed: int = 5) -> Spectrum:
    """The ``components`` largest positive eigenvalues (as many as the rank has) by slicing, iteration and certificate."""
    rng, d = np.random.default_rng(seed), len(v)
    bound = float(np.abs(v).sum(1).max()) if d else 0.0
    none = Spectrum(np.zeros(0), np.zeros((0, d)))
    if bound == 0:
        return none
    nudge = 4 * d * _EPS * bound
    floor = 4 * nudge
    rank = count_above(v, floor)
    wanted = min(components, rank)
    values, vectors = [], []
    slices = [(floor, rank, bound * (1 + 1e-9), 0)] if wanted else []
    while slices:  # the highest slice is on top
        lo, n_lo, hi, n_hi = slices.pop()
        if n_lo == n_hi or n_hi >= wanted:
            continue
        cluster = hi - lo <= 4 * nudge
        pair = _quotient_iteration(v, lo, hi, nudge, rng) if n_lo - n_hi == 1 and not cluster else None
        if pair is not None and count_above(v, pair[0] - 4 * nudge) == n_lo and count_above(v, pair[0] + 4 * nudge) == n_hi:
            values.append(pair[0]), vectors.append(pair[1])
        elif cluster:  # eigenvalues equal to rounding: any orthogonal basis of their space, certified by the slice's counts
            basis = rng.standard_normal((d, n_lo - n_hi))
            for _ in range(4):
                basis = _solve(v, (lo + hi) / 2, basis, nudge)
                if vectors:
                    known = np.array(vectors)
                    basis -= known.T @ (known @ basis)
                basis = np.linalg.qr(basis)[0]
            for x in basis.T:
                values.append(float(x @ v @ x)), vectors.append(x)
        else:
            mid = (lo + hi) / 2
            n_mid = count_above(v, mid)
            slices.append((lo, n_lo, mid, n_mid)), slices.append((mid, n_mid, hi, n_hi))
    if not values:
        return none
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    found = np.array(vectors)[order]
    for i in range(len(found)):  # what rounding left between near eigenvalues
        found[i] -= found[:i].T @ (found[:i] @ found[i])
        found[i] /= np.linalg.norm(found[i])
    return Spectrum(np.array(values)[order], found)


@dataclass(frozen=True)
class Whitening:
    """Exact count and sums of the whole-number components, and the leading part of their covariance."""

    n: int
    sums: tuple[int, ...]
    trace: float
    spectrum: Spectrum
    scale: int
    shift: int

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.spectrum.values]

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number vectors."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([float(Fraction(s, self.n) - s // self.n) for s in self.sums])
        return ((x - whole) - rest) @ (self.spectrum.vectors / np.sqrt(self.spectrum.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)**2``; None beyond a BIGINT."""
        most = 2**63 - 1
        if self.n * (int(np.abs(x).max(initial=0)) + 1) < 2**62:
            d = self.n * x - np.array(self.sums, dtype=np.int64)
            if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] <= most:
                return (d * d).sum(1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [s if s <= most else None for s in (d * d).sum(1)]


def _whole(batch: pa.RecordBatch, scale: int, shift: int) -> np.ndarray:
    return np.floor(matrix(batch.column("vector")) * float(scale)).astype(np.int64) + shift


def _partial(rows: DataFrame, of, kind: str) -> DataFrame:
    """One array ``v`` a task: the sum of ``of(batch)`` over its batches."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = of(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=["v"])

    return rows.select("vector").mapInArrow(run, f"v array<{kind}>")


def usable(vectors: DataFrame, vector_col: str, keep: list[str], scale: int = SCALE) -> DataFrame:
    """``row`` (the kept columns) and ``vector`` of the rows that take part."""
    most = 2.0**36 / scale
    rows = finite_vectors(vectors, vector_col, keep).where(F.forall("vector", lambda x: F.abs(x) < most))
    common = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return rows.where(F.size("vector") == (common["width"] if common else 0))


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Whitening fitted on all ``vector`` rows; None without rows."""

    def first(batch):
        x = _whole(batch, scale, shift)
        return np.concatenate(([len(x)], (x // _HIGH).sum(0), (x % _HIGH).sum(0)))

    total = summed(_partial(rows, first, "bigint"))
    if total is None:
        return None
    n, d = int(total[0]), len(total) // 2
    sums = [int(h) * _HIGH + int(lo) for h, lo in zip(total[1:d + 1], total[d + 1:], strict=True)]
    middle = np.array([round(Fraction(s, n)) for s in sums], dtype=np.int64)

    def second(batch):
        y = (_whole(batch, scale, shift) - middle).astype(np.float64)
        return (y.T @ y).reshape(-1)

    left = np.array([float(Fraction(s, n) - int(m)) for s, m in zip(sums, middle, strict=True)])
    v = summed(_partial(rows, second, "double")).reshape(d, d) / n - np.outer(left, left)
    v = (v + v.T) / 2
    return Whitening(n, tuple(sums), float(np.trace(v)), leading(v, components), scale, shift)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """The kept columns, ``deviation`` and ``whitened`` (one value a component) of ``row, vector`` rows."""

    def run(batches):
        for batch in batches:
            x = _whole(batch, model.scale, model.shift)
            w = np.ascontiguousarray(model.projected(x)) if len(x) else np.zeros((0, 1))
            ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(model.deviations(x) if len(x) else [], pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))], names=["row", "deviation", "whitened"])

    kind = T.StructType([rows.schema["row"], T.StructField("deviation", T.LongType()),
                         T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, kind).select("row.*", "deviation", "whitened")


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on the rows."""
    k = len(model.spectrum.values)

    def moments(batch):
        w = model.projected(_whole(batch, model.scale, model.shift))
        return np.concatenate((w.sum(0), (w.T @ w).reshape(-1)))

    total = summed(_partial(rows, moments, "double")) / model.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    rows = usable(table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"])
    model = fit(rows)
    found = model is not None and len(model.spectrum.values) > 0
    if not found:
        return rows.where(F.lit(False)).select(
            "row.vec_id", F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"),
            F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    shares = F.array(*[F.lit(e) for e in model.explained])
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("p", "whitened"))
    return out.select("vec_id", (F.col("p") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("p")).alias("explained"), F.lit(identity_error(rows, model)).alias("identity_error"))
