"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar factor of ``A - shift`` is the sign of that matrix: +1 on the invariant subspace of the eigenvalues above the
shift, -1 on the others. Half of (factor + I) is therefore the projector on the upper subspace. An orthonormal basis of
both subspaces splits the matrix into two smaller ones, until one row is left or all eigenvalues of a part are equal.
The polar factor comes from the dynamically weighted Halley iteration in its QR form, which needs no inverse and few
steps. All of it works on one matrix of the size of a covariance, whatever the number of rows it was summed from.
"""

from __future__ import annotations

import numpy as np

EPSILON = np.finfo(float).eps
MOST_STEPS = 60


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix."""
    n = len(a)
    x = a / np.linalg.norm(a)  # its largest singular value is 1 at most
    low, weights = EPSILON, (0.0, 0.0, 0.0)
    for _ in range(MOST_STEPS):
        root = np.cbrt(4 * (1 - low * low) / low**4)
        base = np.sqrt(1 + root)
        first = base + np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - low * low) / (low * low * base))) / 2
        second = (first - 1) ** 2 / 4
        third = first + second - 1
        weights = (first, second, third)
        q, _ = np.linalg.qr(np.vstack([np.sqrt(third) * x, np.eye(n)]))
        made = second / third * x + (first - second / third) / np.sqrt(third) * q[:n] @ q[n:].T
        made = (made + made.T) / 2
        moved = np.linalg.norm(made - x)
        x = made
        low = min(1.0, low * (first + second * low * low) / (1 + third * low * low))
        if moved <= 10 * EPSILON * np.sqrt(n) and abs(weights[0] - 3) < 1e-6:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces of the larger and the smaller eigenvalues; None if all are equal."""
    n, values = len(a), np.diag(a)
    middle = np.trace(a) / n
    spread = np.linalg.norm(a - middle * np.eye(n))
    if spread <= 4 * EPSILON * n * max(abs(middle), np.abs(a).max()):
        return None
    # The mean parts unequal eigenvalues surely, the median evenly; the others step aside from an eigenvalue.
    aside = [middle + sign * spread / (step * n) for step in (7, 29, 101) for sign in (1, -1)]
    for shift in (np.median(values), middle, *aside):
        factor = polar_factor(a - shift * np.eye(n))
        upper = (factor + np.eye(n)) / 2
        above = int(round(np.trace(upper)))
        if 0 < above < n and np.linalg.norm(upper @ upper - upper) < 1e-6:
            return bases(upper, above)
    raise ArithmeticError("no shift parts the eigenvalues")


def bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement."""
    columns = []
    left = projector.copy()
    for _ in range(rank):  # the columns of largest rest span the range well
        best = int(np.argmax(np.einsum("ij,ij->j", left, left)))
        unit = left[:, best] / np.linalg.norm(left[:, best])
        columns.append(best)
        left -= np.outer(unit, unit @ left)
    q, _ = np.linalg.qr(projector[:, columns], mode="complete")
    q[:, :rank], _ = np.linalg.qr(projector @ q[:, :rank])  # once more, so that the span is that of the projector
    rest = q[:, rank:] - q[:, :rank] @ (q[:, :rank].T @ q[:, rank:])
    return q[:, :rank], np.linalg.qr(rest)[0]


def eigenvectors(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (all by default), falling, and their unit eigenvectors as columns.

    The sign of a vector is that which makes its entry of largest size positive.
    """
    n = len(a)
    wanted = n if wanted is None else min(wanted, n)
    found: list[np.ndarray] = []
    waiting = [np.eye(n)]
    while waiting and len(found) < wanted:
        basis = waiting.pop()  # the part of the largest eigenvalues
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        halves = split(part) if len(part) > 1 else None
        if halves is None:
            found += list(basis.T)
        else:
            upper, lower = halves
            waiting += [basis @ lower, basis @ upper]
    vectors = np.array(found).reshape(-1, n).T
    vectors = polished(a, vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors, values = vectors[:, order], values[order]
    places = np.argmax(np.abs(vectors), axis=0) if n else []
    return values, vectors * np.where(vectors[places, range(len(order))] < 0, -1.0, 1.0)


def polished(a: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The same vectors after one turn inside their own span, which takes off what the splits left of each other."""
    q, r = np.linalg.qr(vectors)
    q = q * np.where(np.diag(r) < 0, -1.0, 1.0)
    inner = q.T @ a @ q
    values = np.diag(inner)
    gaps = values[None, :] - values[:, None]
    scale = np.abs(values).max() if len(values) else 0.0
    near = np.abs(gaps) <= 1e-8 * scale
    turn = np.where(near, 0.0, inner / np.where(near, 1.0, gaps))
    np.fill_diagonal(turn, 0.0)
    turned, r = np.linalg.qr(q @ (np.eye(len(values)) + turn))
    return turned * np.where(np.diag(r) < 0, -1.0, 1.0)
