"""Singular values and right singular vectors of a small square matrix, accurately.

Householder reflections make the matrix bidiagonal, dqds finds the squares of its singular values
to high relative accuracy, and a twisted factorisation per value gives its vector. The work is that
of one matrix of ``dimensions`` rows, at any number of data rows.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
CLOSE = 1e-3
KEEP_BELOW = 1 - 1 / 64


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v, scale`` such that ``x - scale * v * (v @ x)`` is zero but for its first entry."""
    norm = float(np.linalg.norm(x))
    if norm == 0 or len(x) == 1:
        return np.zeros_like(x), 0.0
    v = x.copy()
    v[0] += math.copysign(norm, x[0])
    return v, 2 / float(v @ v)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``diagonal, above, right``: the matrix is some orthogonal one times the bidiagonal one times ``right.T``."""
    a, size = matrix.copy(), len(matrix)
    right = np.eye(size)
    for k in range(size):
        v, scale = reflector(a[k:, k])
        a[k:, k:] -= np.outer(scale * v, v @ a[k:, k:])
        if k < size - 2:
            v, scale = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, scale * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, scale * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def parted(diagonal: np.ndarray, above: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that nothing connects, with negligible entries made zero in place.

    Where a diagonal entry is zero, rotations of rows move the entry beside it out of its row.
    """
    size = len(diagonal)
    norm = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)))
    diagonal[np.abs(diagonal) <= EPS * norm] = 0
    for k in range(size - 1):
        if diagonal[k] == 0 and above[k] != 0:
            moved, above[k] = above[k], 0
            for i in range(k + 1, size):
                length = math.hypot(diagonal[i], moved)
                cosine, sine = diagonal[i] / length, moved / length
                diagonal[i] = length
                if i == size - 1:
                    break
                moved, above[i] = -sine * above[i], cosine * above[i]
                if moved == 0:
                    break
        if abs(above[k]) <= EPS * (abs(diagonal[k]) + abs(diagonal[k + 1])) or abs(above[k]) <= EPS * EPS * norm:
            above[k] = 0
    edges = [0, *(np.flatnonzero(above == 0) + 1).tolist(), size]
    return [(lo, hi) for lo, hi in zip(edges, edges[1:]) if lo < hi]


def two(q: float, e: float, r: float) -> tuple[float, float]:
    """Both values of the array ``q, e, r``, the larger one first."""
    large = (q + r + e + math.hypot(q - r + e, 2 * math.sqrt(r) * math.sqrt(e))) / 2
    return large, (q * (r / large) if large else 0.0)


def shifted(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential quotient-difference step; None if the shift is above the least value."""
    d, least = q[0] - shift, q[0] - shift
    new_q, new_e = [], []
    for k in range(len(e)):
        sum_ = d + e[k]
        if d < 0 or sum_ <= 0:
            return None
        ratio = q[k + 1] / sum_
        new_q.append(sum_)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if not d >= 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def squares(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """Squares of the singular values of an unreduced bidiagonal matrix, by dqds."""
    found: list[float] = []
    open_parts = [((diagonal**2).tolist(), (above**2).tolist(), 0.0, math.inf)]
    while open_parts:
        q, e, moved, least = open_parts.pop()
        if len(q) == 1:
            found.append(q[0] + moved)
            continue
        if len(q) == 2:
            found += [v + moved for v in two(q[0], e[0], q[1])]
            continue
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        shift = KEEP_BELOW * min(two(q[-2], e[-1], q[-1])[1], least) if math.isfinite(least) else 0.0
        tries = 0
        while (after := shifted(q, e, shift)) is None:
            tries += 1
            shift = 0.0 if tries == 4 else shift / 4
        q, e, least = after
        moved += shift
        cut = next((k for k in reversed(range(len(e))) if e[k] <= EPS * EPS * (moved + q[k + 1])), None)
        if cut is None:
            open_parts.append((q, e, moved, max(least, 0.0)))
        else:
            open_parts.append((q[: cut + 1], e[:cut], moved, max(least, 0.0)))
            open_parts.append((q[cut + 1 :], e[cut + 1 :], moved, max(least, 0.0)))
    return found


def twisted(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors, one column a value, of the square of a bidiagonal matrix.

    From the top and from the bottom, the shifted square is factored into bidiagonal parts; where
    the two meet with the least remainder, the vector is largest enough to start from.
    """
    size = len(diagonal)
    pivots = diagonal**2
    factors = np.divide(above, diagonal[:-1], out=np.zeros(size - 1), where=diagonal[:-1] != 0)
    tiny = np.finfo(float).tiny / EPS + EPS**3 * values.max(initial=0)
    down, up = np.zeros((size, len(values))), np.zeros((size, len(values)))
    from_top, from_bottom = np.zeros((max(size - 1, 0), len(values))), np.zeros((max(size - 1, 0), len(values)))

    def kept_off_zero(x):
        return np.where(np.abs(x) < tiny, np.where(x < 0, -tiny, tiny), x)

    s = -values
    for k in range(size - 1):
        down[k] = s
        from_top[k] = pivots[k] * factors[k] / kept_off_zero(pivots[k] + s)
        s = from_top[k] * factors[k] * s - values
    down[size - 1] = s
    p = pivots[-1] - values
    up[size - 1] = p
    for k in reversed(range(size - 1)):
        ratio = pivots[k] / kept_off_zero(pivots[k] * factors[k] ** 2 + p)
        from_bottom[k] = factors[k] * ratio
        p = p * ratio - values
        up[k] = p
    remainder = np.abs(down + up + values)
    at = np.where(np.isfinite(remainder), remainder, np.inf).argmin(axis=0)
    z = np.zeros((size, len(values)))
    z[at, np.arange(len(values))] = 1
    for k in reversed(range(size - 1)):
        z[k] = np.where(k < at, -from_top[k] * z[k + 1], z[k])
    for k in range(size - 1):
        z[k + 1] = np.where(k >= at, -from_bottom[k] * z[k], z[k + 1])
    return z / np.linalg.norm(z, axis=0)


def settled(square: np.ndarray, values: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The same vectors, made orthogonal where values are close; a lost one is found anew by inverse iteration."""
    draw = np.random.default_rng(1)
    first = 0
    for j in range(len(values)):
        if j and values[j - 1] - values[j] > CLOSE * values[j - 1]:
            first = j
        near = z[:, first:j]
        v = z[:, j]
        for attempt in range(8):
            if not np.isfinite(v).all() or (attempt and (near.shape[1] or not _holds(square, values[j], v))):
                start = draw.normal(size=len(v)) if attempt < 2 or not np.isfinite(v).all() else v
                v = np.linalg.solve(square - values[j] * (1 + 2 * EPS * (attempt + 1)) * np.eye(len(v)), start)
                v = v / np.linalg.norm(v)
            left = v - near @ (near.T @ v)
            left = left - near @ (near.T @ left)
            size = np.linalg.norm(left)
            if size > 0.1:
                v = left / size
                if _holds(square, values[j], v):
                    break
            else:
                v = np.full(len(v), np.nan)
        z[:, j] = v
    return z


def _holds(square: np.ndarray, value: float, v: np.ndarray) -> bool:
    return bool(np.linalg.norm(square @ v - value * v) <= 1e3 * EPS * np.abs(square).max() * math.sqrt(len(v)))


def right_singular(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest squares of singular values, falling, their right vectors as columns, and the sum of all squares."""
    scale = float(np.abs(matrix).max(initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((matrix.shape[1], 0)), 0.0
    diagonal, above, right = bidiagonal(matrix / scale)
    total = float((diagonal**2).sum() + (above**2).sum())
    ranges = parted(diagonal, above)
    owned = [(v, i) for i, (lo, hi) in enumerate(ranges) for v in squares(diagonal[lo:hi], above[lo : hi - 1])]
    owned = sorted(owned, key=lambda x: (-x[0], x[1]))[:most]
    vectors = np.zeros((matrix.shape[1], len(owned)))
    for i, (lo, hi) in enumerate(ranges):
        columns = [c for c, (_, of) in enumerate(owned) if of == i]
        if columns:
            a, b = diagonal[lo:hi], above[lo : hi - 1]
            values = np.array([owned[c][0] for c in columns])
            block = np.diag(a) + np.diag(b, 1)
            with np.errstate(all="ignore"):
                z = twisted(a, b, values)
            vectors[:, columns] = right[:, lo:hi] @ settled(block.T @ block, values, z)
    return np.array([v for v, _ in owned]) * scale**2, vectors, total * scale**2
