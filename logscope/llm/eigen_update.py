"""Eigendecompositions kept up to date under rank-one changes.

``rank_one(d, u, rho, v)`` turns the decomposition ``u diag(d) u'`` into that of ``u diag(d) u' + rho v v'`` (``rho`` > 0):

* **Deflation**: in the basis ``u`` the change is ``z = u'v``.  Eigenvalues that are equal within rounding share a subspace, in which a
  Householder reflection leaves one entry of ``z``; pairs whose entry is negligible stay as they are.
* **Secular equation**: the other eigenvalues are the roots of ``1 + rho * sum z_j^2 / (d_j - x)``, one right of each ``d_j``.  All
  roots are found at once, each relative to its nearer pole, by rational interpolation inside a bracket that bisection keeps.
* **Eigenvectors** come from entries of ``z`` recomputed from the roots, so that they are orthogonal to working precision.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
ROUNDS = 80


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum w_j / (d_j - x)`` for ascending distinct ``d`` and ``w`` > 0, as (index of the nearer pole, distance from it)."""
    k, total = len(d), w.sum()
    gap = np.append(np.diff(d), total)
    mid = d + gap / 2
    at_mid = 1 + (w / (d - mid[:, None])).sum(1)
    last = np.arange(k) == k - 1
    right = (at_mid < 0) & ~last                        # the root is in the upper half: measured from the upper pole
    origin = np.arange(k) + right
    poles = d - d[origin][:, None]                      # row i: poles as seen from root i's origin
    half = gap / 2
    lo = np.where(right, -half, np.where(last & (at_mid < 0), half, 0.0))
    hi = np.where(right, 0.0, np.where(last & (at_mid < 0), gap, half))
    x = (lo + hi) / 2
    own = np.arange(k)
    left = (own[None, :] <= own[:, None]).astype(float)
    a_pole = poles[own, own]
    b_pole = np.where(last, a_pole + gap, poles[own, np.minimum(own + 1, k - 1)])
    active = np.ones(k, bool)
    # a root closer to its pole than floats tell apart stays at the smallest distance
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(ROUNDS):
            delta = poles - x[:, None]
            t = w / delta
            t2 = t / delta
            psi, both = np.einsum("ij,ij->i", t, left), t.sum(1)
            dpsi, dboth = np.einsum("ij,ij->i", t2, left), t2.sum(1)
            f = 1 + both
            lo, hi = np.where(active & (f < 0), x, lo), np.where(active & (f >= 0), x, hi)
            active &= (np.abs(f) > 4 * EPS * (1 + np.abs(psi) + np.abs(both - psi))) & (hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if not active.any():
                break
            da, db = a_pole - x, b_pole - x
            c = f - da * dpsi - db * (dboth - dpsi)
            a = (da + db) * f - da * db * dboth
            b = da * db * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = x + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            good = (new > lo) & (new < hi)
            x = np.where(active, np.where(good, new, (lo + hi) / 2), x)
    return origin, x


def rank_one(d: np.ndarray, u: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues ascending, eigenvectors as columns) of ``u diag(d) u' + rho v v'``; ``d`` ascends, ``rho`` >= 0."""
    z = u.T @ v
    size = float(np.sqrt(z @ z))
    if not rho * size * size > 0:
        return d, u
    tol = 8 * EPS * max(abs(d[0]), abs(d[-1]), rho * size * size)
    u, d = u.copy(), d.copy()
    # runs of equal eigenvalues: one direction of each takes the whole change
    cuts = np.flatnonzero(np.diff(d) > tol) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(d)]):
        if b - a > 1:
            part = z[a:b].copy()
            length = np.sqrt(part @ part)
            if length > 0:
                h = part.copy()
                h[-1] += np.copysign(length, part[-1])
                scale = 2 / (h @ h)
                u[:, a:b] -= np.outer(u[:, a:b] @ h, scale * h)
                z[a:b] = 0
                z[b - 1] = -np.copysign(length, part[-1])
                d[a:b] = d[a:b].mean()
    keep = rho * size * np.abs(z) > tol
    k = int(keep.sum())
    if not k:
        return d, u
    dk, zk = d[keep], z[keep]
    origin, x = secular_roots(dk, rho * zk * zk)
    apart = (dk - dk[origin][:, None]) - x[:, None]                 # d_j - root_i
    # entries for which the found roots are exact
    log = np.log(np.abs(apart)).sum(0)
    diff = np.abs(dk - dk[:, None])
    np.fill_diagonal(diff, 1.0)
    zhat = np.copysign(np.exp((log - np.log(diff).sum(0)) / 2), zk)
    q = zhat / apart                                                # row i: eigenvector of root i
    q /= np.sqrt((q * q).sum(1))[:, None]
    out_d, out_u = d.copy(), u
    out_d[keep] = dk[origin] + x
    out_u[:, keep] = u[:, keep] @ q.T
    order = np.argsort(out_d, kind="stable")
    return out_d[order], out_u[:, order]


class Spectrum:
    """Number, sums and spectral decomposition of the scatter (sum of centred outer products) of integer vectors.
    Sums are exact; vectors are taken relative to ``base``, an integer vector."""

    def __init__(self, base: np.ndarray):
        k = len(base)
        self.base, self.n, self.total = base, 0, np.zeros(k, np.int64)
        self.d, self.u = np.zeros(k), np.eye(k)

    def mean(self) -> np.ndarray:
        return self.total / self.n

    def add(self, x: np.ndarray) -> None:
        """One more vector: a centred rank-one update."""
        rel = x - self.base
        if self.n:
            self.d, self.u = rank_one(self.d, self.u, self.n / (self.n + 1), rel - self.mean())
        self.n += 1
        self.total += rel

    def combine(self, n: int, base: np.ndarray, total: np.ndarray, d: np.ndarray, u: np.ndarray) -> None:
        """Another spectrum added: its eigenpairs one after another, then the difference of the means."""
        shift = base - self.base
        if self.n:
            apart = total / n + shift - self.mean()
            for value, vector in zip(d, u.T):
                if value > 0:
                    self.d, self.u = rank_one(self.d, self.u, value, vector)
            self.d, self.u = rank_one(self.d, self.u, self.n * n / (self.n + n), apart)
        else:
            self.d, self.u = d, u
        self.n += n
        self.total = self.total + total + n * shift
