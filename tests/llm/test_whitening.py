"""Rank-one eigendecompositions and whitening against numpy."""
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logscope.llm import eigen_update as E
from logscope.llm import whitening as W
from logscope.llm.queries import op11_whitening

from .conftest import SF_MID

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def scatter(x):
    c = x - x.mean(0)
    return c.T @ c


def check(s, x):
    m = scatter(x)
    size = max(1.0, np.abs(m).max())
    assert np.abs(s.u * s.d @ s.u.T - m).max() < 1e-11 * size
    assert np.abs(s.u.T @ s.u - np.eye(len(m))).max() < 1e-11
    assert (np.diff(s.d) >= 0).all() and s.n == len(x)


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 7), st.integers(1, 12), st.integers(0, 3), st.integers(0, 10_000))
def test_updates_equal_a_fresh_decomposition(k, n, spread, seed):
    """Few distinct values: equal eigenvalues, zero rows and exact copies all take the deflated ways."""
    x = np.random.default_rng(seed).integers(-spread, spread + 1, (n, k)) + 1_000_000
    s = E.Spectrum(x[0])
    for r in x:
        s.add(r)
    check(s, x)


@pytest.mark.parametrize("seed", range(4))
def test_combined_spectra_and_duplicate_dimensions(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-60, 60, (90, 12)) + 1_000_000
    x[:, 5] = x[:, 4]
    x[:, 7] = 1_000_003
    parts = []
    for a, b in ((0, 1), (1, 30), (30, 90)):
        s = E.Spectrum(x[a])
        for r in x[a:b]:
            s.add(r)
        parts.append(s)
    whole = E.Spectrum(x[40])
    for s in parts:
        whole.combine(s.n, s.base, s.total, s.d, s.u)
    check(whole, x)
    assert (whole.total + whole.n * whole.base == x.sum(0)).all()


def test_secular_roots_next_to_their_poles():
    d, w = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-18, 1.0, 1e-12, 3.0])
    origin, x = E.secular_roots(d, w)
    roots = d[origin] + x
    assert (roots >= d).all() and (roots[:-1] <= d[1:]).all() and roots[-1] <= 5 + w.sum()


def brute(rows, top=16):
    """Expected rows by id, signs left open."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    fit = [list(t) for t in sorted({tuple(v) for v in x})]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    cov = exact.T @ exact / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)
    rank = int((values > values.max() * 1e-12).sum())
    values, vectors = values[order][:min(top, rank)], vectors[:, order][:, :min(top, rank)]
    out = []
    for (i, _), v in zip(kept, x):
        dev = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        y = np.array([(n * a - s) / n for a, s in zip(v, sums)]) @ vectors / np.sqrt(values)
        out.append((i, n, dev, y, values / np.trace(cov)))
    return out


def compare(got, want):
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    flip = None
    assert set(by) == {w[0] for w in want}
    for i, n, dev, y, share in want:
        rows = sorted(by[i], key=lambda r: r["component"])[:len(y)] if len(by[i]) == len(y) else None
        assert rows is not None and [r["component"] for r in rows] == list(range(1, len(y) + 1))
        assert {(r["n"], r["deviation"]) for r in rows} == {(n, dev)}
        mine = np.array([r["whitened"] for r in rows])
        if flip is None and np.abs(y).min() > 1e-6:
            flip = np.sign(mine * y)
        if flip is not None:
            assert np.abs(mine * flip - y).max() < 1e-7
        assert np.allclose([r["explained"] for r in rows], share, rtol=1e-9)
        assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_odd_rows_copies_and_clashing_names(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]                         # copies count once
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [float("inf")] + [0.0] * 4), (205, [1.0, 2.0])]
    rows = [(i, v, 7, "x") for i, v in rows + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, x string")
    got = W.whiten(df, rows_per_task=16)
    assert got.columns == COLUMNS
    compare(got.collect(), brute([r[:2] for r in rows if r[0] < 200]))
    null_id = df.limit(5).union(spark.createDataFrame([(None, rows[9][1], 1, "")], df.schema))
    assert {r["vec_id"] for r in W.whiten(null_id).collect()} >= {None}


def test_rank_and_empty(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert W.whiten(df([])).collect() == [] and W.whiten(df([(1, None)])).collect() == []
    assert W.whiten(df([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []              # one distinct vector: no component
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(6)]                             # rank one
    got = W.whiten(df(rows)).collect()
    assert len(got) == 6 and {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12
    compare(got, brute(rows))
    huge = W.whiten(df([(1, [1e13, 0.0]), (2, [0.0, 1.0]), (3, [-1e13, 5.0]), (4, [1e300, 1.0])])).collect()
    assert {r["vec_id"] for r in huge} == {1, 2, 3} and {r["deviation"] for r in huge if r["vec_id"] == 1} == {None}


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    got = op11_whitening(spark, SF_MID)
    assert dict(got.dtypes) == dict(zip(COLUMNS, ["bigint", "int", "bigint", "bigint", "double", "double", "double"]))
    compare(got.collect(), brute(rows))
