"""Small symmetric matrices on the driver: principal components and coordinates. Sides are samples, never sites."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import matrix


def ordered_eigen(symmetric: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest, and their vectors; of each vector the entry of the largest size is positive."""
    values, vectors = np.linalg.eigh(symmetric)
    values, vectors = values[::-1], vectors[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values, vectors * np.where(signs == 0, 1, signs)


def components(cells: DataFrame, samples: list[str], n_components: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of samples and the share of variance of each component, of complete cells.

    The dual form: the samples by samples products are summed over sites, and only that matrix is decomposed.
    """
    product = matrix.gram(matrix.vectors(cells, samples), len(samples))
    values, vectors = ordered_eigen(product)
    values = np.maximum(values, 0.0)
    k = min(n_components, len(samples))
    total = values.sum()
    return vectors[:, :k] * np.sqrt(values[:k]), values[:k] / total if total else values[:k]


def gower(distances: np.ndarray) -> np.ndarray:
    """Squared distances, centred by rows, columns and the whole, times -1/2."""
    square = distances**2
    row = square.mean(1, keepdims=True)
    out = -0.5 * (square - row - row.T + square.mean())
    return (out + out.T) / 2


def lingoes(distances: np.ndarray) -> np.ndarray:
    """Distances with the constant added to their squares that leaves no negative eigenvalue."""
    least = np.linalg.eigvalsh(gower(distances))[0]
    if least >= -1e-8:
        return distances
    out = distances**2 - 2 * least
    np.fill_diagonal(out, 0.0)
    return np.sqrt(out)


def principal_coordinates(distances: np.ndarray, correct: bool = True) -> dict:
    """``coordinates, eigenvalues, percent, negative`` (the share of negative eigenvalues before) and ``corrected``."""
    raw = np.linalg.eigvalsh(gower(distances))
    size = np.abs(raw).sum()
    negative = float(-raw[raw < 0].sum() / size) if size else 0.0
    corrected = correct and negative > 1e-6
    values, vectors = ordered_eigen(gower(lingoes(distances) if corrected else distances))
    keep = values > 1e-8
    return {"coordinates": vectors[:, keep] * np.sqrt(values[keep]), "eigenvalues": values[keep], "percent": 100 * values[keep] / values[keep].sum() if keep.any() else values[keep],
            "negative": negative, "corrected": corrected}


def without_nan(distances: np.ndarray) -> np.ndarray:
    """Unknown distances become larger than all known ones."""
    if not np.isnan(distances).any():
        return distances
    known = distances[~np.isnan(distances)]
    out = np.where(np.isnan(distances), (known.max() if len(known) else 0.0) * 10 + 1, distances)
    np.fill_diagonal(out, 0.0)
    return out
