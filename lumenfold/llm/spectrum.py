"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

For a shift s, the signs of the pivots of an LDL' factorisation of ``matrix - s I`` are those of its eigenvalues, so
they count the eigenvalues above s. Bisection on these counts isolates each wanted eigenvalue; Rayleigh quotient
iteration, started in the middle of its interval, then converges cubically; counts on both sides of the result
certify its number. The matrix has a row per dimension of the vectors, so it is small whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17**0.5) / 8
_EPS = float(np.finfo(float).eps)


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive pivots of an LDL' factorisation with pivots of size 1 and 2."""
    a = matrix - shift * np.eye(len(matrix))
    k, positive = 0, 0
    while k < len(a):
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        size = 1
        if largest > 0 and abs(a[k, k]) < _ALPHA * largest:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other >= _ALPHA * largest**2:
                pass
            elif abs(a[r, r]) >= _ALPHA * other:
                _swap(a, k, r)
            else:
                size = 2
                _swap(a, k + 1, r)
        rest = k + size
        if size == 1:
            pivot = a[k, k]
            positive += pivot > 0
            if pivot != 0:
                below = a[rest:, k].copy()
                a[rest:, rest:] -= np.outer(below, below / pivot)
        else:  # such a pair has one positive and one negative eigenvalue
            positive += 1
            below = a[rest:, k:rest].copy()
            a[rest:, rest:] -= below @ np.linalg.solve(a[k:rest, k:rest], below.T)
        k = rest
    return int(positive)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


class Spectrum:
    """Counts of one matrix, remembered by shift."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1).max(initial=0.0)
        self.scale = max(radius, np.finfo(float).tiny)
        #: Below this, differences between eigenvalues are rounding.
        self.blur = 8 * len(matrix) * _EPS * self.scale
        self.counts = {-self.scale - self.blur: len(matrix), self.scale + self.blur: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """Known shifts around eigenvalue ``number`` (from 1, falling): more than its followers lie above the first."""
        low = max(s for s, c in self.counts.items() if c >= number)
        high = min(s for s, c in self.counts.items() if c < number and s > low)
        return low, high

    def pair(self, number: int, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Eigenvalue and unit eigenvector ``number``; ``found`` has the earlier ones as columns."""
        draw = np.random.default_rng(number)
        while True:
            low, high = self.interval(number)
            alone = self.above(low) - self.above(high) == 1
            if not alone and high - low > self.blur:
                self.above((low + high) / 2)
                continue
            value, vector = self._iterated((low + high) / 2, draw.standard_normal(len(self.matrix)), found, alone)
            if not alone or low < value <= high:
                break
            # The start lay nearer to another one: halve until it does not.
            if high - low <= self.blur:
                break
            self.above((low + high) / 2)
        at = np.abs(vector).argmax()
        return value, vector * np.sign(vector[at])

    def _iterated(self, shift: float, vector: np.ndarray, found: np.ndarray, alone: bool) -> tuple[float, np.ndarray]:
        """Inverse iteration at the shift, then, for an isolated eigenvalue, at the Rayleigh quotient."""
        best, left = (np.inf, shift, vector), 60
        for step in range(left):
            vector = vector - found @ (found.T @ vector)
            vector = self._solved(shift, vector / np.linalg.norm(vector))
            vector -= found @ (found.T @ vector)
            vector /= np.linalg.norm(vector)
            value = float(vector @ self.matrix @ vector)
            rest = float(np.linalg.norm(self.matrix @ vector - value * vector))
            if rest < best[0]:
                best = (rest, value, vector)
            elif step > 4 and best[0] <= self.blur:
                break
            if step >= 2 and alone:
                shift = value
        return best[1], best[2]

    def _solved(self, shift: float, vector: np.ndarray) -> np.ndarray:
        for _ in range(8):
            try:
                made = np.linalg.solve(self.matrix - shift * np.eye(len(self.matrix)), vector)
                if np.isfinite(made).all():
                    return made
            except np.linalg.LinAlgError:
                pass
            shift += self.blur / 2  # the shift is an eigenvalue to the last bit
        raise ArithmeticError("no shift near the eigenvalue can be solved for")


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest positive eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that rounding cannot tell from zero are left out. Equal ones get orthogonal vectors of their space.
    An eigenvalue whose number the counts do not confirm is an error.
    """
    spectrum = Spectrum(matrix)
    values, vectors = [], np.zeros((len(matrix), 0))
    for number in range(1, min(count, len(matrix)) + 1 if matrix.any() else 1):
        value, vector = spectrum.pair(number, vectors)
        if value <= spectrum.blur:
            break
        slack = 4 * spectrum.blur
        if not spectrum.above(value + slack) < number <= spectrum.above(value - slack):
            raise ArithmeticError(f"eigenvalue {number} is not where it was found")
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values), vectors
