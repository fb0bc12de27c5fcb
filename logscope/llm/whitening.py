"""Embedding whitening (operator 11): principal components by incremental eigendecomposition.

Vectors become integers, ``x = floor(scale * c) + offset``; the *fit list* holds every distinct ``x`` once (``distinct``, which combines
copies before they are shuffled).  Then, on Spark:

1. **Rank-one updates.**  Each task of about ``rows_per_task`` vectors keeps their number, exact sums and the spectral decomposition
   of their scatter, changed by one centred rank-one update per vector (``eigen_update``: deflation, secular equation).
2. **Combination.**  ``FAN`` spectra at a time become one, by successive rank-one updates with the others' eigenpairs and the differences of
   the means, in rounds until one is left.  A spectrum has a fixed size (d x d numbers), whatever it stands for.
3. **Rayleigh-Ritz refinement.**  With the exact mean, a distributed pass sums the outer products of all centred vectors in the basis found
   (nearly diagonal); its small eigenproblem rotates the basis to the components in double precision.
4. A second pass over the fit list measures the whitened covariance against the identity.

Only n, the sums and d x d numbers reach the driver.  Centring is exact: ``n * x - S`` is an integer.

Defined cases: rows whose vector is null or empty, holds a null or non-finite entry, an entry of which ``scale * c`` is 2^52 or more in size,
or has another length than the most common one (ties: the longer) take no part; repeated rows and rows without an id are rows
of their own; components stop at the rank (eigenvalues above rounding of the largest), so that a table of equal vectors, like an
empty one, gives no row; ``deviation`` is null where it exceeds a long; a component's sign makes its largest entry positive;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .eigen_update import Spectrum

ROWS_PER_TASK = 4096
FAN = 8
COMPONENTS = 16
LARGEST = float(1 << 52)
SPECTRUM = "part long, n long, base array<long>, total array<long>, d array<double>, u array<double>"
OUT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """``floor(scale * c) + offset`` of every entry; null for a vector that takes no part."""
    v = vector.cast("array<double>")
    scaled = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))))
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < LARGEST, F.lit(False)) & ~F.isnan(c))
    return F.when(fine & (F.size(v) > 0), F.transform(scaled, lambda c: c + F.lit(offset)))


def usable(rows: DataFrame) -> DataFrame:
    """Rows ``(vec_id, x)`` of the most common length; the counts by length are a small frame."""
    rows = rows.filter(F.col("x").isNotNull())
    most = rows.groupBy(F.size("x").alias("k")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.col("m").desc(), F.col("k").desc()).first()
    return rows.filter(F.size("x") == (most["k"] if most else -1))


def _matrix(col: pa.ListArray) -> np.ndarray:
    flat = col.flatten().to_numpy()
    return flat.reshape(len(col), -1)


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    cols = [pa.array([part]), pa.array([s.n]), *[pa.array([v.tolist()], pa.list_(pa.int64())) for v in (s.base, s.total)],
            *[pa.array([v.ravel().tolist()], pa.list_(pa.float64())) for v in (s.d, s.u)]]
    return pa.RecordBatch.from_arrays(cols, names=["part", "n", "base", "total", "d", "u"])


def spectra(fit: DataFrame) -> DataFrame:
    """One spectrum per task of ``fit (x)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        s = None
        for b in batches:
            for x in _matrix(b.column(0)) if b.num_rows else ():
                s = s or Spectrum(x.copy())
                s.add(x)
        if s:
            yield _row(TaskContext.get().partitionId(), s)

    return fit.mapInArrow(run, SPECTRUM)


def combined(parts: DataFrame, tasks: int, fan: int = FAN) -> DataFrame:
    """At most one spectrum for all of ``parts``, whose numbers are below ``tasks``: ``fan`` become one in each round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, Spectrum] = {}          # numbers that a task was dealt; each has at most ``fan`` rows, in order
        for b in batches:
            for r in b.to_pylist():
                at, base = r["part"] // fan, np.array(r["base"], np.int64)
                s = have.setdefault(at, Spectrum(base))
                s.combine(r["n"], base, np.array(r["total"], np.int64), np.array(r["d"]), np.array(r["u"]).reshape(len(base), -1))
        for at, s in have.items():
            yield _row(at, s)

    while tasks > 1:
        groups = -(-tasks // fan)
        dealt = parts.repartition(groups, F.floor(F.col("part") / F.lit(fan))).sortWithinPartitions("part")
        parts, tasks = dealt.mapInArrow(run, SPECTRUM), groups
    return parts


def _products(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the fit list's centred vectors in ``basis``, divisor ``n``: tasks sum their outer products."""
    k = basis.shape[1]
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                y = centred(_matrix(b.column(0)), n, sums) @ basis
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    out = np.zeros((k, k))
    for r in fit.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():   # k x k
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def _differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact."""
    if max(int(np.abs(x).max(initial=0)), 1) * n < 1 << 61:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; null beyond a long."""
    diff = _differences(x, n, sums)
    if diff.dtype == object or int(np.abs(diff).max(initial=0)) ** 2 * diff.shape[1] >= 1 << 62:
        got = [sum(int(v) ** 2 for v in r) for r in diff]
        return [v if v < 1 << 63 else None for v in got]
    return (diff * diff).sum(1).tolist()


@dataclass
class Whitening:
    """Number and exact sums of the fit list, components as columns, their eigenvalues, trace of the covariance, largest entry of
    (whitened covariance - identity)."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(fit: DataFrame, components: int = COMPONENTS, rows_per_task: int = ROWS_PER_TASK) -> Whitening | None:
    """Whitening of ``fit (x)``, a stored table of distinct integer vectors; null without rows."""
    tasks = max(1, -(-fit.count() // rows_per_task))
    dealt = fit.repartition(tasks, F.xxhash64("x")) if tasks > 1 else fit.coalesce(1)
    got = cut(combined(cut(spectra(dealt)), tasks)).collect()       # one row: d x d numbers
    if not got:
        return None
    r, k = got[0], len(got[0]["base"])
    n = r["n"]
    sums = np.array([n * b + t for b, t in zip(r["base"], r["total"])], object)
    basis = np.linalg.qr(np.array(r["u"]).reshape(k, k))[0]
    small = _products(fit, n, sums, basis)
    values, turn = np.linalg.eigh(small)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], (basis @ turn)[:, order]
    trace = float(np.trace(small))
    rank = int((values > max(values[0], 0) * k * np.finfo(float).eps * 16).sum())
    top = min(components, rank)
    vectors, values = vectors[:, :top], values[:top]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(top)] < 0, -1.0, 1.0) if top else vectors
    error = 0.0
    if top:
        error = float(np.abs(_products(fit, n, sums, vectors / np.sqrt(values)) - np.eye(top)).max())
    return Whitening(n, sums, vectors, values, trace, error)


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(embeddings.select(F.col(vec_id).alias("vec_id"), integers(F.col(vector)).alias("x")))
    schema = OUT.format(rows.schema["vec_id"].dataType.simpleString())
    w = fit_whitening(cut(rows.select("x").distinct()), components, rows_per_task)
    if w is None or not len(w.values):
        return rows.sparkSession.createDataFrame([], schema)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    scaled, top = w.components / np.sqrt(w.values), len(w.values)
    explained = w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            at = np.repeat(np.arange(len(x)), top)
            out = centred(x, w.n, w.sums) @ scaled
            cols = [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), w.n)), pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(at)), pa.array(out.ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(at), w.identity_error))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, schema)
