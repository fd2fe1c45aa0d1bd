"""Eigenpairs of a symmetric matrix by contour integration, interval by interval.

The quadrature of ``(z I - A)^-1 Q`` around a circle filters a random block ``Q`` down to
the eigenvectors whose values lie inside; Rayleigh-Ritz extracts them, and the block is
filtered again until the residuals are at rounding level. How many there have to be is
known beforehand: by Sylvester's law the negative pivots of ``A - s I`` count the
eigenvalues below ``s``. Pivots are taken of the tridiagonal form, so a count costs one pass.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Quadrature points of the half circle.
POINTS = 12
#: Eigenvalues from which an interval is cut, and shifts tried for a cut.
SLICE, SHIFTS = 8, 1023
#: Filter rounds of one block size; the block doubles after them, at last to the whole space.
ROUNDS = 12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal form (Householder reflections)."""
    a = a.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        to = -np.copysign(length, x[0])
        x[0] -= to
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        w = p - (x @ p) * x
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1, k], a[k + 2 :, k] = to, 0
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(form: tuple[np.ndarray, np.ndarray], shifts) -> np.ndarray:
    """For each shift, how many eigenvalues are below it: the negative pivots of ``A - s I``."""
    diagonal, off = form
    shifts = np.atleast_1d(np.asarray(shifts, dtype=float))
    below = np.zeros(len(shifts), dtype=int)
    tiny = EPS * EPS
    pivot = np.ones(len(shifts))
    for i, d in enumerate(diagonal):
        pivot = d - shifts - (off[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def intervals(form, lo: float, hi: float) -> list[tuple[float, float, int]]:
    """(lo, hi, eigenvalues inside), ascending: cut in wide gaps until few are left in each.

    Eigenvalues that only rounding parts stay in one interval, however many they are.
    """
    least = 64 * EPS * len(form[0])
    at_lo, at_hi = count_below(form, [lo, hi]).tolist()
    if at_hi - at_lo <= SLICE or hi - lo < 4 * least:
        return [(lo, hi, at_hi - at_lo)] if at_hi > at_lo else []
    shifts = np.linspace(lo, hi, SHIFTS + 2)
    below = np.array([at_lo, *count_below(form, shifts[1:-1]), at_hi])
    levels, first, n = np.unique(below, return_index=True, return_counts=True)
    gaps = [(f + (m - 1) / 2, m, v) for v, f, m in zip(levels, first, n, strict=True)
            if at_lo < v < at_hi and m * (shifts[1] - shifts[0]) > least]
    if not gaps:  # narrow the ends, which stay a shift away from the eigenvalues
        low = max(0, int(np.searchsorted(below, at_lo, side="right")) - 2)
        high = min(SHIFTS + 1, int(np.searchsorted(below, at_hi)) + 1)
        if high - low > (SHIFTS + 1) // 2:
            return [(lo, hi, at_hi - at_lo)]
        return intervals(form, float(shifts[low]), float(shifts[high]))
    half = (at_lo + at_hi) / 2
    # The widest gap, but a cut that halves the count is worth a gap of half the width.
    place, _, _ = max(gaps, key=lambda g: g[1] * (1 + min(g[2] - at_lo, at_hi - g[2]) / (at_hi - half)))
    cut = float(np.interp(place, np.arange(len(shifts)), shifts))
    return intervals(form, lo, cut) + intervals(form, cut, hi)


def floor_near(form, near: float) -> float:
    """A bound about ``near``, in the widest gap between half and twice of it."""
    shifts = near * np.exp2(np.linspace(-1, 1, SHIFTS))
    _, first, n = np.unique(count_below(form, shifts), return_index=True, return_counts=True)
    widest = int(np.argmax(n))
    return float(shifts[first[widest] + n[widest] // 2])


def inside(a: np.ndarray, lo: float, hi: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``a`` (of norm about 1) with values in [lo, hi).

    Raises if another number of them is found: none is missed silently.
    """
    d = len(a)
    centre, radius = (lo + hi) / 2, max((hi - lo) / 2, 64 * EPS * d)
    angles = np.pi * (np.arange(POINTS) + 0.5) / POINTS
    nodes = centre + radius * np.exp(1j * angles)
    enough = 4 * d * EPS
    size = min(d, 2 * count + 8)
    while True:
        block = np.linalg.qr(np.random.default_rng(size).standard_normal((d, size)))[0]
        for _ in range(ROUNDS):
            if size < d:
                total = np.zeros_like(block)
                for z in nodes:
                    # Both halves of the circle: conjugate nodes add the conjugate.
                    total += ((z - centre) * np.linalg.solve(z * np.eye(d) - a, block)).real / POINTS
                block = np.linalg.qr(total)[0]
            values, turn = np.linalg.eigh(block.T @ a @ block)
            block = block @ turn
            take = (values >= lo) & (values < hi)
            rest = np.linalg.norm(a @ block[:, take] - block[:, take] * values[take], axis=0)
            if take.sum() == count and (rest < enough).all():
                return values[take], block[:, take]
        if size == d:
            raise ArithmeticError(f"{take.sum()} eigenvalues found in [{lo}, {hi}), {count} counted")
        size = min(d, 2 * size)


def joined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz over the eigenvectors of all intervals: (values, orthonormal vectors), falling."""
    basis = np.linalg.qr(vectors)[0]
    values, turn = np.linalg.eigh(basis.T @ a @ basis)
    return values[::-1], (basis @ turn)[:, ::-1]
