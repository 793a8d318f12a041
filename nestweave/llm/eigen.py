"""Leading eigenvalues and eigenvectors of a symmetric matrix.

Householder reflections make it tridiagonal; Sturm counts (how many eigenvalues lie below a
number) bisect the leading eigenvalues; inverse iteration gives their vectors, and those of close
eigenvalues are made orthogonal to each other in every step.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Eigenvalues closer than this share of the largest are one cluster.
CLUSTER = 1e-3
#: Steps of inverse iteration; from eigenvalues to double precision two are nearly always enough.
STEPS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal and off-diagonal of the similar tridiagonal matrix, and the reflections to it.

    Reflection k acts on the rows after k, by its unit vector, or not at all.
    """
    a = np.array(matrix, float)
    reflections: list[np.ndarray | None] = []
    for k in range(len(a) - 2):
        column = a[k + 1 :, k]
        length = np.linalg.norm(column)
        if not np.any(column[1:]):
            reflections.append(None)
            continue
        unit = column.copy()
        unit[0] += np.copysign(length, unit[0])
        unit /= np.linalg.norm(unit)
        a[k + 1, k] = -np.copysign(length, column[0])
        a[k + 2 :, k] = 0.0
        rest = a[k + 1 :, k + 1 :]
        image = rest @ unit
        image -= (unit @ image) * unit
        rest -= 2 * (np.outer(unit, image) + np.outer(image, unit))
        reflections.append(unit)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def counts_below(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each number of ``at``: the Sturm sequence's negative terms."""
    least = np.finfo(float).tiny
    squares = np.append(0.0, beside**2)
    below, term = np.zeros(len(at), np.int64), np.ones(len(at))
    for d, square in zip(diagonal, squares, strict=True):
        term = d - at - square / term
        term[np.abs(term) < least] = -least
        below += term < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling."""
    n = len(diagonal)
    around = np.append(np.abs(beside), 0.0) + np.append(0.0, np.abs(beside))
    low = np.full(k, (diagonal - around).min())
    high = np.full(k, (diagonal + around).max())
    margin = _EPS * max(np.abs(low).max(), np.abs(high).max()) * n
    low, high = low - margin, high + margin
    wanted = n - 1 - np.arange(k)  # as many lie below the value
    while True:
        middle = (low + high) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = counts_below(diagonal, beside, middle) <= wanted
        low = np.where(open_ & above, middle, low)
        high = np.where(open_ & ~above, middle, high)


def _solve(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """``(T - shift) x = right`` by elimination with row exchanges; pivots of zero become ``least``."""
    n = len(diagonal)
    upper = np.zeros((n, 3))  # of each row: pivot and two entries to its right
    value = right.copy()
    row = [diagonal[0] - shift, beside[0] if n > 1 else 0.0, 0.0]
    for k in range(n - 1):
        below = [beside[k], diagonal[k + 1] - shift, beside[k + 1] if k + 2 < n else 0.0]
        if abs(below[0]) > abs(row[0]):
            row, below = below, row
            value[k], value[k + 1] = value[k + 1], value[k]
        pivot = row[0] if abs(row[0]) > least else least
        upper[k] = pivot, row[1], row[2]
        factor = below[0] / pivot
        value[k + 1] -= factor * value[k]
        row = [below[1] - factor * row[1], below[2] - factor * row[2], 0.0]
    upper[n - 1] = row[0] if abs(row[0]) > least else least, 0.0, 0.0
    for k in range(n - 1, -1, -1):
        for j in (1, 2):
            if k + j < n:
                value[k] -= upper[k, j] * value[k + j]
        value[k] /= upper[k, 0]
    return value


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as rows."""
    n = len(matrix)
    k = min(k, n)
    size = np.abs(matrix).max(initial=0.0)
    if not k or not size:
        return np.zeros(k), np.eye(k, n)
    diagonal, beside, reflections = tridiagonal(matrix / size)
    values = leading_values(diagonal, beside, k)
    scale = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0))
    least = _EPS * scale
    vectors = np.zeros((k, n))
    start = np.random.default_rng(11)
    first = 0  # of the cluster
    for j in range(k):
        if j and values[j - 1] - values[j] > CLUSTER * scale:
            first = j
        # equal eigenvalues get shifts of their own, so that their solutions differ
        shift = values[j] - (j - first) * 2 * least
        vector = start.standard_normal(n)
        for _ in range(STEPS):
            vector = _solve(diagonal, beside, shift, vector / np.linalg.norm(vector), least)
            for _ in range(2):
                vector -= vectors[first:j].T @ (vectors[first:j] @ vector)
        vectors[j] = vector / np.linalg.norm(vector)
    for at, unit in reversed(list(enumerate(reflections))):
        if unit is not None:
            part = vectors[:, at + 1 :]
            part -= 2 * np.outer(part @ unit, unit)
    return values * size, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
