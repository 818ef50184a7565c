"""Tests on a few samples: PERMANOVA, Benjamini-Hochberg, risk gradient. Permutations are rows, spread over tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .distrib import VALUE_STRETCHES


def permanova_observed(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row: sums of squares and the pseudo F, from pairs (sample_i, sample_j, d) and groups (sample, label).

    F is null with fewer than two groups or no freedom within them.
    """
    a = groups.select(F.col("sample").alias("sample_i"), F.col("label").alias("g_i"))
    b = groups.select(F.col("sample").alias("sample_j"), F.col("label").alias("g_j"))
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    counts = sizes.agg(F.sum("size").alias("N"), F.count(F.lit(1)).alias("a_groups"))
    squares = pairs.join(a, "sample_i").join(b, "sample_j").join(sizes, F.col("g_i") == F.col("label"))
    sums = squares.agg(F.sum(F.col("d") * F.col("d")).alias("all"), F.sum(F.when(F.col("g_i") == F.col("g_j"), F.col("d") * F.col("d") / F.col("size"))).alias("within"))
    row = sums.join(F.broadcast(counts)).select("N", "a_groups", (F.col("all") / F.col("N")).alias("ss_total"), F.coalesce("within", F.lit(0.0)).alias("ss_within"))
    row = row.withColumn("ss_between", F.col("ss_total") - F.col("ss_within"))
    between, within = F.col("a_groups") - 1, F.col("N") - F.col("a_groups")
    f = F.when((between > 0) & (within > 0), F.try_divide(F.col("ss_between") / F.nullif(between, F.lit(0)), F.col("ss_within") / F.nullif(within, F.lit(0))))
    return row.withColumn("pseudo_f", f)


def _pseudo_f(square: np.ndarray, codes: np.ndarray, k: int) -> np.ndarray:
    """The pseudo F of each row of group codes."""
    n = square.shape[0]
    total = square.sum() / 2 / n
    within = np.zeros(len(codes))
    for g in range(k):
        member = (codes == g).astype(float)
        size = member.sum(1)
        inner = np.einsum("bi,ij,bj->b", member, square, member) / 2
        within += np.divide(inner, size, out=np.zeros_like(inner), where=size > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((total - within) / (k - 1)) / (within / (n - k))


def _permuted(spark: SparkSession, count: int, seed: int, work) -> np.ndarray:
    """``work(rng)`` for each permutation, seeded by its number, so that the result doesn't depend on the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [float(work(np.random.RandomState((seed * 1_000_003 + i) % (1 << 32)))) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["id", "value"])

    rows = spark.range(count).mapInArrow(run, "id long, value double").collect()
    return np.array([r["value"] for r in sorted(rows)], float)


def permanova(spark: SparkSession, distances: np.ndarray, groups: list, permutations: int = 999, seed: int = 42) -> dict:
    names = sorted(set(groups), key=str)
    if len(names) < 2:
        raise ValueError("there must be at least two groups")
    if len(groups) - len(names) <= 0:
        raise ValueError("there are too many groups for these samples")
    square, codes = distances**2, np.array([names.index(g) for g in groups])
    observed = float(_pseudo_f(square, codes[None], len(names))[0])
    null = _permuted(spark, permutations, seed, lambda rng: _pseudo_f(square, rng.permutation(codes)[None], len(names))[0])
    return {"a_groups": len(names), "n": len(groups), "pseudo_f": observed, "n_permutations": permutations, "null_median": float(np.median(null)),
            "null_p95": float(np.percentile(null, 95)), "p_value": float(((null >= observed).sum() + 1) / (permutations + 1))}


def adjusted(tests: DataFrame, p: str = "p_value") -> DataFrame:
    """Add ``p_adj``: Benjamini-Hochberg; a null has none.

    Distinct values are counted and put in order within stretches of values. Only a row for each stretch, of which there
    are VALUE_STRETCHES and one at most, meets in one place, to carry counts upwards and minima downwards.
    """
    counts = tests.filter(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("_n")).withColumn("_s", F.floor(F.col(p) * VALUE_STRETCHES))
    up, down = Window.partitionBy("_s").orderBy(p), Window.partitionBy("_s").orderBy(F.desc(p))
    each = counts.groupBy("_s").agg(F.sum("_n").alias("_sum"))
    below = F.coalesce(F.sum("_sum").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = counts.join(each.select("_s", below.alias("_below"), F.sum("_sum").over(Window.partitionBy()).alias("_all")), "_s")
    upto = F.col("_below") + F.sum("_n").over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_raw", F.col(p) * F.col("_all") / upto)
    after = rows.groupBy("_s").agg(F.min("_raw").alias("_least"))
    after = after.select("_s", F.min("_least").over(Window.orderBy("_s").rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    least = F.least(F.min("_raw").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.col("_after"))
    found = rows.join(after, "_s").select(p, F.least(F.greatest(least, F.lit(0.0)), F.lit(1.0)).alias("p_adj"))
    return tests.join(found, p, "left").select(*tests.columns, "p_adj")


def average_ranks(values: np.ndarray) -> np.ndarray:
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    return (ends - (counts - 1) / 2.0)[inverse]


def _beta_tail(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_tail(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    terms = [1.0]
    for m in range(200):
        terms.append(-(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))
        terms.append((m + 1) * (b - m - 1) * x / ((a + 2 * m + 1) * (a + 2 * m + 2)))
    value = 0.0
    for term in reversed(terms[1:]):
        value = term / (1 + value)
    return front / (1 + value)


def spearman(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Rank correlation and its two-sided p by the t distribution; NaN without spread."""
    a, b = average_ranks(x), average_ranks(y)
    a, b = a - a.mean(), b - b.mean()
    size = math.sqrt((a @ a) * (b @ b))
    if size == 0 or len(x) < 3:
        return float("nan"), float("nan")
    r = max(-1.0, min(1.0, float(a @ b) / size))
    free = len(x) - 2
    if abs(r) == 1:
        return r, 0.0
    t2 = r * r * free / (1 - r * r)
    return r, _beta_tail(free / 2, 0.5, free / (free + t2))


def leave_one_out(x: np.ndarray, y: np.ndarray) -> float:
    """Q2 of a linear fit with each sample left out in turn, from one fit: a residual grows by 1 / (1 - leverage)."""
    design = np.column_stack([np.ones(len(x)), x])
    q, _ = np.linalg.qr(design)
    leverage = np.minimum((q**2).sum(1), 1 - 1e-12)
    residual = (y - q @ (q.T @ y)) / (1 - leverage)
    total = ((y - y.mean()) ** 2).sum()
    return float(1 - (residual**2).sum() / total) if total > 0 else float("nan")


def best_axes(x: np.ndarray, y: np.ndarray, most: int) -> tuple[int, float, list[float]]:
    """The number of leading axes with the largest Q2, the smaller among equals."""
    q2 = [leave_one_out(x[:, :k], y) for k in range(1, most + 1)]
    best = int(np.nanargmax(q2)) if not np.isnan(q2).all() else 0
    return best + 1, q2[best], q2


def axes_to_try(n: int, axes: int, wanted: int | None = None) -> int:
    return min(wanted or max(1, min(10, n // 3)), axes, n - 2)


def gradient_test(spark: SparkSession, x: np.ndarray, y: np.ndarray, most: int, permutations: int = 999, seed: int = 42) -> dict:
    """The best Q2, and how often permuted risks reach it when their number of axes is chosen anew."""
    k, q2, table = best_axes(x, y, most)
    null = _permuted(spark, permutations, seed, lambda rng: best_axes(x, rng.permutation(y), most)[1])
    return {"k": k, "q2": q2, "table": table, "n_permutations": permutations, "null_median": float(np.median(null)), "null_p95": float(np.percentile(null, 95)),
            "p_value": float(((null >= q2).sum() + 1) / (permutations + 1))}


def gradient(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regression weights, their direction, and each sample's projection on it."""
    weights = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0][1:]
    direction = weights / (np.linalg.norm(weights) or 1.0)
    return weights, direction, x @ direction
