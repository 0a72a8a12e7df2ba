"""Leading eigenpairs of a small symmetric matrix: the size is that of a vector, not of the data."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a similar tridiagonal matrix."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        x[0] += np.copysign(size, x[0])
        length = np.linalg.norm(x)
        v = x / length if length else x
        reflections.append(v)
        if not length:
            continue
        # Both sides of the trailing block at once: A - 2 v w' - 2 w v'.
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2.0 * (v @ a[k + 1:, k]) * v
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def _below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number: a Sturm count."""
    count = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for d, e2 in zip(diagonal, [0.0, *squares], strict=True):
        q = d - at - e2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` greatest eigenvalues, falling, each bisected between its Sturm counts."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    size = max(abs(low), abs(high), np.finfo(np.float64).tiny)
    tiny = size * EPS * EPS
    lows, highs = np.full(count, low - size * EPS * n), np.full(count, high + size * EPS * n)
    wanted = n - 1 - np.arange(count)  # so many eigenvalues are below the k-th greatest
    squares = off * off
    for _ in range(200):
        middle = (lows + highs) / 2
        if np.all((middle <= lows) | (middle >= highs)):
            break
        under = _below(diagonal, squares, middle, tiny) <= wanted
        lows, highs = np.where(under, middle, lows), np.where(under, highs, middle)
    return (lows + highs) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; pivots are ``floor`` at least."""
    n = len(diagonal)
    d = (diagonal - shift).tolist()
    up, second, low = [*off.tolist(), 0.0], [0.0] * n, off.tolist()
    b = right.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            factor = d[i] / low[i]
            d[i], up[i], second[i], d[i + 1], up[i + 1] = (
                low[i], d[i + 1], up[i + 1], up[i] - factor * d[i + 1], -factor * up[i + 1])
            b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) > floor else floor
            factor = low[i] / d[i]
            d[i + 1] -= factor * up[i]
            b[i + 1] -= factor * b[i]
    x = [0.0] * (n + 2)
    for i in reversed(range(n)):
        pivot = d[i] if abs(d[i]) > floor else floor
        x[i] = (b[i] - up[i] * x[i + 1] - second[i] * x[i + 2]) / pivot
    return np.array(x[:n])


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues, falling, and unit eigenvectors as columns.

    Householder reflections make the matrix tridiagonal, Sturm counts locate the eigenvalues,
    inverse iteration finds the vectors; those of close eigenvalues are made orthogonal to each
    other in every step. A vector's largest entry is positive.
    """
    n = len(matrix)
    if n == 1:
        return np.array([float(matrix[0, 0])])[:count], np.ones((1, 1))[:, :count]
    count = min(count, n)
    if not np.any(matrix):
        return np.zeros(count), np.eye(n)[:, :count]
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, off, count)
    size = max(np.abs(diagonal).max() + 2 * np.abs(off).max(), np.finfo(np.float64).tiny)
    floor = EPS * size
    rng = np.random.default_rng(11)
    found: list[np.ndarray] = []
    first = 0  # where the running cluster of close eigenvalues starts
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            first = k
        # Equal eigenvalues get shifts a little apart, so that their vectors differ.
        shift = min(value, shift - 4 * floor) if k > first else value
        x = rng.standard_normal(n)
        for _ in range(6):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x), floor)
            for _ in range(2):
                for other in found[first:]:
                    x = x - (other @ x) * other
                x = x / np.linalg.norm(x)
        found.append(x)
    vectors = np.array(found).T
    for k in reversed(range(len(reflections))):
        v = reflections[k]
        vectors[k + 1:] -= 2.0 * np.outer(v, v @ vectors[k + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.where(vectors[largest, np.arange(count)] < 0, -1.0, 1.0)
    return np.einsum("ik,ij,jk->k", vectors, matrix, vectors), vectors
