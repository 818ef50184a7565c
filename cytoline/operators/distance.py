"""Dissimilarity of samples over the sites that both have, ranks, silhouettes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distrib import running_counts
from .matrix import sum_blocks


def ranks(cells: DataFrame) -> DataFrame:
    """Each sample's values as ranks among its own, the mean rank for equal ones; missing values stay missing."""
    known = cells.filter("beta IS NOT NULL")
    rank = running_counts(known, "sample", "beta").select("sample", "beta", (F.col("upto") - (F.col("n") - 1) / F.lit(2.0)).cast("double").alias("_rank"))
    return known.join(rank, ["sample", "beta"]).withColumn("beta", F.col("_rank")).select(*cells.columns)


#: What is summed for each pair: common sites, sums of both, of their squares, of the product.
SUMS = ("n", "x", "y", "xx", "yy", "xy")


def pair_sums(table: DataFrame, n: int) -> np.ndarray:
    """SUMS for all pairs of samples, from vectors: one pass over the sites, n by n numbers from each task.

    A join of the sites with themselves would make a row for each site and pair; here blocks of sites are multiplied.
    """

    def work(block: np.ndarray) -> np.ndarray:
        seen = ~np.isnan(block)
        value, seen = np.where(seen, block, 0.0), seen.astype(float)
        x, xx = value.T @ seen, (value**2).T @ seen
        return np.stack([seen.T @ seen, x, x.T, xx, xx.T, value.T @ value])

    return sum_blocks(table, work, (len(SUMS), n, n))


def square_distances(sums: np.ndarray, n_sites: int) -> np.ndarray:
    """Squared euclidean distances over common sites, scaled up to all; NaN without any."""
    n, _, _, xx, yy, xy = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(n > 0, n_sites / n * np.maximum(xx + yy - 2 * xy, 0.0), np.nan)
    np.fill_diagonal(out, 0.0)
    return out


def correlation_distances(sums: np.ndarray) -> np.ndarray:
    """1 - r over common sites; NaN with fewer than two of them, 1 without spread."""
    n, x, y, xx, yy, xy = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = np.sqrt(np.maximum(xx - x * x / n, 0) * np.maximum(yy - y * y / n, 0))
        r = np.where(spread < 1e-12, 0.0, (xy - x * y / n) / spread)
    out = np.where(n < 2, np.nan, 1 - np.clip(r, -1, 1))
    np.fill_diagonal(out, 0.0)
    return out


def pairwise(cells: DataFrame, samples: list[str], metric: str = "pearson") -> tuple[np.ndarray, np.ndarray]:
    """Distances and numbers of common sites; ``metric``: pearson, spearman (on each sample's own ranks) or euclidean."""
    from .matrix import vectors

    table = vectors(ranks(cells) if metric == "spearman" else cells, samples)
    sums = pair_sums(table, len(samples))
    if metric == "euclidean":
        return np.sqrt(square_distances(sums, table.count())), sums[0]
    if metric not in ("pearson", "spearman"):
        raise ValueError(metric)
    return correlation_distances(sums), sums[0]


def frame(spark, samples: list[str], distances: np.ndarray, common: np.ndarray | None = None) -> DataFrame:
    """Pairs i < j as ``sample_i, sample_j, d`` and, if given, ``n_co``; NaN becomes null."""
    rows = []
    for i in range(len(samples)):
        for j in range(i + 1, len(samples)):
            d = None if np.isnan(distances[i, j]) else float(distances[i, j])
            rows.append((samples[i], samples[j], d, *([int(common[i, j])] if common is not None else [])))
    return spark.createDataFrame(rows, "sample_i string, sample_j string, d double" + (", n_co long" if common is not None else ""))


def few_common(common: np.ndarray, least: int) -> int:
    """Pairs with fewer common sites than ``least``."""
    return int((common[np.triu_indices(len(common), 1)] < least).sum())


def silhouettes(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``sample, silhouette`` from pairs (sample_i, sample_j, d) and labels (sample, label); alone in a cluster: 0."""
    both = pairs.select("sample_i", "sample_j", "d").unionByName(pairs.select(F.col("sample_j").alias("sample_i"), F.col("sample_i").alias("sample_j"), "d"))
    own = labels.select(F.col("sample").alias("sample_i"), F.col("label").alias("own"))
    other = labels.select(F.col("sample").alias("sample_j"), "label")
    means = both.join(own, "sample_i").join(other, "sample_j").groupBy("sample_i", "own", "label").agg(F.avg("d").alias("d"))
    ab = means.groupBy("sample_i").agg(F.max(F.when(F.col("own") == F.col("label"), F.col("d"))).alias("a"), F.min(F.when(F.col("own") != F.col("label"), F.col("d"))).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return ab.select(F.col("sample_i").alias("sample"), value.alias("silhouette"))
