"""Leading eigenvectors of a symmetric matrix, for covariances of vectors.

Householder reflections bring the matrix to tridiagonal form, Sturm counts bisect for the
leading eigenvalues, inverse iteration gives their vectors. Vectors of eigenvalues that
lie close together are kept at right angles by orthogonalising each against those before
it in its cluster.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Eigenvalues nearer than this share of the norm belong to one cluster.
CLUSTER = 1e-3
#: Rounds of inverse iteration; two suffice for a shift that is exact but for rounding.
ROUNDS = 5


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal, and the reflections v (each I - 2 v v') that lead there."""
    a, n, mirrors = a.astype(np.float64).copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        v = x
        v[0] += length if x[0] >= 0 else -length
        norm = np.linalg.norm(v)
        if not norm:
            mirrors.append(np.zeros(n - k - 1))
            continue
        v = v / norm
        mirrors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ v)
        w = p - v * (v @ p)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def above(d: np.ndarray, e2: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues exceed each x: the positive pivots of T - x."""
    pivot = d[0] - x
    count = (pivot > 0).astype(np.int64)
    for i in range(1, len(d)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d[i] - x - e2[i - 1] / pivot
        count += pivot > 0
    return count


def largest(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected down to rounding."""
    sides = np.abs(np.concatenate([[0.0], e])) + np.abs(np.concatenate([e, [0.0]]))
    low, high = float((d - sides).min()), float((d + sides).max())
    norm = max(abs(low), abs(high))
    tiny = max(norm * EPS * EPS, np.finfo(np.float64).tiny)
    lows, highs = np.full(k, low - norm * EPS - tiny), np.full(k, high + norm * EPS + tiny)
    wanted = np.arange(1, k + 1)
    for _ in range(200):
        middle = (lows + highs) / 2
        if not ((middle > lows) & (middle < highs)).any() or (highs - lows).max() <= 2 * EPS * norm:
            break
        enough = above(d, e * e, middle, tiny) >= wanted
        lows, highs = np.where(enough, middle, lows), np.where(enough, highs, middle)
    return (lows + highs) / 2


def solved(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges."""
    n = len(d)
    main, over, far, y = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    main, under = main.copy(), e
    for i in range(n - 1):
        if abs(under[i]) > abs(main[i]):
            factor = main[i] / under[i]
            main[i], over[i], far[i], main[i + 1], next_over = under[i], main[i + 1], over[i + 1], over[i] - factor * main[i + 1], -factor * over[i + 1]
            over[i + 1] = next_over
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            factor = under[i] / main[i] if main[i] else 0.0
            main[i + 1] -= factor * over[i]
            y[i + 1] -= factor * y[i]
    main = np.where(np.abs(main) < tiny, tiny, main)
    for i in range(n - 1, -1, -1):
        y[i] -= (over[i] * y[i + 1] if i + 1 < n else 0.0) + (far[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] /= main[i]
    return y


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors as columns.

    Of each vector the entry farthest from zero is positive, so that runs agree.
    """
    n = len(a)
    k = min(k, n)
    scale = float(np.abs(a).max()) if n else 0.0
    if not scale:
        return np.zeros(k), np.eye(n)[:, :k]
    d, e, mirrors = tridiagonal(a / scale)
    values = largest(d, e, k)
    norm = float(max(np.abs(d).max(), np.abs(e).max() if len(e) else 0.0))
    vectors, start, rng = np.zeros((n, k)), 0, np.random.default_rng(7)
    for j in range(k):
        if j and values[j - 1] - values[j] > CLUSTER * norm:
            start = j
        # Equal shifts would give equal vectors; a hair's breadth apart they need not.
        shift = values[j] - EPS * norm * (j - start)
        y = rng.standard_normal(n)
        for _ in range(ROUNDS):
            y = solved(d, e, shift, y / np.linalg.norm(y), EPS * norm)
            for _ in range(2):
                y -= vectors[:, start:j] @ (vectors[:, start:j].T @ y)
            if not np.linalg.norm(y):
                y = rng.standard_normal(n)
        vectors[:, j] = y / np.linalg.norm(y)
    for at in range(len(mirrors) - 1, -1, -1):
        v = mirrors[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return values * scale, vectors
