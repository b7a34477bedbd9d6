"""Eigendecompositions that grow by rank-one updates.

A spectrum is (values ascending, axes as columns) of a symmetric matrix M. Adding
weight * v v' to M moves every eigenvalue up to a root of the secular equation
1 + rho * sum(z_j^2 / (d_j - x)) = 0 between its old place and the next one;
components of v that vanish and eigenvalues that coincide are deflated first, as
their eigenpairs stay (after a rotation of the coinciding ones).
"""

from __future__ import annotations

import numpy as np

EPS, TINY = np.finfo(np.float64).eps, 1e-290
#: halvings of each root's bracket, down to the last bit of its width
HALVINGS = 53


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(origin, offset) of each root, d ascending and distinct, z2 and rho positive; the origin is the nearest of d.

    Offsets from a pole keep the difference of a root and its pole exact, however close they are.
    """
    gap = np.r_[np.diff(d), rho * z2.sum()]
    half = gap / 2
    terms = np.empty((len(d), len(d)))

    def rises(delta: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the secular function is still negative, so that the root lies above."""
        np.subtract(delta, at[:, None], out=terms)
        np.reciprocal(terms, out=terms)
        return terms @ z2 < -1.0 / rho

    pole = np.arange(len(d))
    # the last root has no pole above it
    nearer_above = rises(d[None, :] - d[:, None], half) & (pole < len(d) - 1)
    pole = pole + nearer_above
    delta = d[None, :] - d[pole][:, None]
    below, above = np.where(nearer_above, -half, 0.0), np.where(nearer_above, 0.0, half)
    above[-1] = gap[-1]
    for _ in range(HALVINGS):
        at = (below + above) / 2
        up = rises(delta, at)
        below[up], above[~up] = at[up], at[~up]
    return pole, (below + above) / 2


def rank_one(values: np.ndarray, axes: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of M + weight * vector vector'."""
    z = axes.T @ vector
    norm2 = float(z @ z)
    rho = weight * norm2
    tiny = 8 * EPS * max(abs(values[0]), abs(values[-1]), rho)
    if not rho > max(tiny * EPS, TINY):
        return values, axes
    z = z / np.sqrt(norm2)
    axes = axes.copy()
    moving = rho * np.abs(z) > tiny
    # of coinciding eigenvalues, one takes the whole of the vector and the others stay
    last = -1
    for i in np.flatnonzero(moving).tolist():
        if last >= 0 and values[i] - values[last] <= tiny:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            axes[:, [last, i]] = axes[:, [last, i]] @ np.array([[c, s], [-s, c]])
            z[last], z[i] = 0.0, r
            moving[last] = False
        last = i
    moved = np.flatnonzero(moving)
    if not len(moved):
        return values, axes
    d, w = values[moved], z[moved]
    pole, offset = secular_roots(d, w * w, rho)
    # root j less d_i
    reach = offset[:, None] - (d[None, :] - d[pole][:, None])
    # the vector whose update has exactly these roots: its eigenvectors are orthogonal to the last bit
    apart = d[:, None] - d[None, :]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(reach / apart, axis=0)) / rho) * np.where(w < 0, -1.0, 1.0)
    turn = exact[None, :] / reach
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values = values.copy()
    values[moved] = d[pole] + offset
    axes[:, moved] = axes[:, moved] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], axes[:, order]


class Spectrum:
    """Count, mean and the eigendecomposition of the scatter of the vectors seen."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.axes = np.zeros(size), np.eye(size)

    def add(self, vector: np.ndarray) -> None:
        self.n += 1
        off = vector - self.mean
        self.mean += off / self.n
        self.values, self.axes = rank_one(self.values, self.axes, off, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        for value, axis in zip(other.values, other.axes.T):
            if value > 0:
                self.values, self.axes = rank_one(self.values, self.axes, axis, float(value))
        n, off = self.n + other.n, other.mean - self.mean
        self.values, self.axes = rank_one(self.values, self.axes, off, self.n * other.n / n)
        self.mean += off * (other.n / n)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.axes.ravel()]).tobytes()

    @staticmethod
    def unpack(data: bytes) -> Spectrum:
        numbers = np.frombuffer(data)
        size = int(np.sqrt(len(numbers))) - 1  # 1 + 2 size + size^2 numbers
        out = Spectrum(size)
        out.n, out.mean = int(numbers[0]), numbers[1 : size + 1].copy()
        out.values, out.axes = numbers[size + 1 : 2 * size + 1].copy(), numbers[2 * size + 1 :].reshape(size, size).copy()
        return out
