"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

An interval of the spectrum is enclosed by a circle. The integral of the resolvent along it, by
quadrature of solves with the complex shifted matrix, projects a few start vectors onto the
eigenvectors inside; Rayleigh-Ritz in their span gives the pairs, and the step is repeated with
these until the residuals vanish. Sylvester's law of inertia counts the eigenvalues between two
real shifts, which sets the intervals and proves that none was missed.
"""

from __future__ import annotations

import numpy as np

NODES, STEPS, PER_INTERVAL, TOLERANCE = 16, 40, 8, 1e-13
#: Eigenvalues this close, relative to the matrix, are never cut apart.
BUNDLE = 1e-10
_PIVOT = (1 + np.sqrt(17)) / 8


def count_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of symmetric ``a`` above ``shift``: positive pivots of LDL' of ``a - shift``.

    Bunch and Parlett's pivots of one or two rows; a pivot of two rows has one sign of each.
    """
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        magnitude = np.abs(m)
        i = int(np.argmax(np.diagonal(magnitude)))
        off = magnitude.copy()
        np.fill_diagonal(off, 0)
        r, s = np.unravel_index(int(np.argmax(off)), off.shape)
        if magnitude[i, i] >= _PIVOT * off[r, s]:
            if not magnitude[i, i]:
                return positive
            picked = [i]
            positive += int(m[i, i] > 0)
        else:
            picked = [r, s]
            positive += 1
        rest = np.setdiff1d(np.arange(len(m)), picked)
        pivot, side = m[np.ix_(picked, picked)], m[np.ix_(rest, picked)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        m = (m + m.T) / 2
    return positive


def _cut(a: np.ndarray, low: float, high: float, at_least: int, at_most: int, ratio: float) -> float:
    """A shift in ``(low, high)`` with that many eigenvalues between it and ``high``.

    Where a bundle of nearly equal ones allows no such number, a shift below the bundle.
    """
    above, finest = count_above(a, high), BUNDLE * _scale(a)
    below = low
    while high - below > finest:
        middle = below + ratio * (high - below)
        n = count_above(a, middle) - above
        if at_least <= n <= at_most:
            return middle
        if n < at_least:
            high = middle
        else:
            below = middle
    return below


def _scale(a: np.ndarray) -> float:
    return max(float(np.abs(a).sum(axis=1).max(initial=0)), 1e-300)


def intervals(
    a: np.ndarray, k: int, floor: float, ratio: float = 0.49, each: int = PER_INTERVAL
) -> list[tuple[float, float, int]]:
    """(low, high, number of eigenvalues) from the top down to ``floor`` until ``k`` or more are covered."""
    high = 1.0001 * _scale(a)
    k = min(k, count_above(a, floor) - count_above(a, high))
    found, done = [], 0
    while done < k:
        low = _cut(a, floor, high, min(k - done, each), max(k - done, each), ratio)
        n = count_above(a, low) - count_above(a, high)
        if not n:
            break
        found.append((low, high, n))
        done, high = done + n, low
    return found


def _edges_in_gaps(a: np.ndarray, low: float, high: float) -> tuple[float, float]:
    """The same eigenvalues between edges that keep away from them, for a fast projection."""
    here, floor = count_above(a, low), low - (high - low)
    if count_above(a, floor) == here:
        return low, high
    good, bad = low, floor
    for _ in range(12):
        middle = (good + bad) / 2
        if count_above(a, middle) == here:
            good = middle
        else:
            bad = middle
    return (low + good) / 2, high


def project(a: np.ndarray, q: np.ndarray, low: float, high: float, nodes: int = NODES) -> np.ndarray:
    """Quadrature of the resolvent on the circle over ``[low, high]``, applied to ``q``.

    The nodes lie on the upper half; the lower half is its conjugate, so the real part is taken.
    """
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(q)
    for x, w in zip(points, weights):
        turn = np.exp(1j * np.pi / 2 * (x + 1))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(a)) - a, q.astype(complex))
        out += w / 2 * (radius * turn * solved).real
    return out


def pairs_inside(a: np.ndarray, low: float, high: float, n: int, rng: np.random.Generator):
    """The ``n`` eigenpairs in the interval, eigenvalues falling; raises if they do not come out."""
    size = min(len(a), 2 * n + 4)
    while True:
        q, converged = rng.normal(size=(len(a), size)), False
        for _ in range(STEPS):
            basis, weight, _ = np.linalg.svd(project(a, q, low, high), full_matrices=False)
            basis = basis[:, weight > 1e-14 * weight[0]]
            small = basis.T @ a @ basis
            ritz, turn = np.linalg.eigh((small + small.T) / 2)
            q = basis @ turn
            inside = np.flatnonzero((ritz > low) & (ritz <= high))
            values, vectors = ritz[inside][::-1], q[:, inside][:, ::-1]
            if converged and len(inside) == n:
                return values, vectors
            if len(inside) == n:
                # One more step takes the vectors to the last digits, which a small gap asks for.
                converged = np.linalg.norm(a @ vectors - vectors * values, axis=0).max() <= TOLERANCE * _scale(a)
        if size == len(a):
            raise ArithmeticError(f"{len(inside)} of {n} eigenvalues between {low} and {high}")
        size = min(len(a), 2 * size)


def largest(a: np.ndarray, k: int, relative: float = 1e-12, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns.

    Only eigenvalues above ``relative`` times the largest row sum count; there may be fewer than ``k``.
    An edge that falls on an eigenvalue shows in the counts; then the cuts are made elsewhere.
    """
    a = (a + a.T) / 2
    if not a.any():
        return np.zeros(0), np.zeros((len(a), 0))
    for ratio in (0.49, 0.43, 0.37):
        try:
            values, vectors = _over_intervals(a, intervals(a, k, relative * _scale(a), ratio), seed)
            return values[:k], vectors[:, :k]
        except ArithmeticError as e:
            error = e
    raise error


def _over_intervals(a: np.ndarray, cuts: list[tuple[float, float, int]], seed: int):
    rng = np.random.default_rng(seed)
    values, vectors = [np.zeros(0)], [np.zeros((len(a), 0))]
    for low, high, n in cuts:
        v, u = pairs_inside(a, *_edges_in_gaps(a, low, high), n, rng)
        values.append(v)
        vectors.append(u)
    e, u = np.concatenate(values), np.concatenate(vectors, axis=1)
    if cuts and len(e) != count_above(a, cuts[-1][0]):
        raise ArithmeticError(f"{len(e)} eigenvalues found, {count_above(a, cuts[-1][0])} counted")
    return e, u
