"""Sites by samples matrices: filters, scaling, imputation.

A matrix is long (site_id, sample, beta) or, for operators that look at a site's samples together, a table of vectors:
one row for each site with an array in the order of a given list of samples. There are few samples and many sites, so
everything is parallel over sites; only samples by samples matrices come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoline.functions import expr
from cytoline.session import settle

from .intervals import STRETCH


#: Rounds of estimation after which estimates are stored.
KEPT_ROUNDS = 5


def observed(cells: DataFrame, n_samples: int) -> DataFrame:
    """For each site the number of values and their share of the samples."""
    return cells.groupBy("site_id").agg(F.count("beta").alias("n_values")).withColumn("share", F.col("n_values") / n_samples)


def complete_enough(cells: DataFrame, n_samples: int, least: float) -> DataFrame:
    """Cells of sites with at least this share of values."""
    keep = observed(cells, n_samples).filter(F.col("share") >= least).select("site_id")
    return cells.join(keep, "site_id", "left_semi")


def without_missing(cells: DataFrame, n_samples: int) -> DataFrame:
    return cells.join(observed(cells, n_samples).filter(F.col("n_values") == n_samples).select("site_id"), "site_id", "left_semi")


def without_samples(cells: DataFrame, names: list[str]) -> DataFrame:
    """Cells of other samples, at sites where those have any value."""
    rest = cells.filter(~F.col("sample").isin(*names)) if names else cells
    return rest.join(rest.groupBy("site_id").agg(F.count("beta").alias("n")).filter("n > 0").select("site_id"), "site_id", "left_semi")


def binary(cells: DataFrame, threshold: float = 0.5) -> DataFrame:
    return cells.withColumn("beta", (F.col("beta") >= threshold).cast("double"))


def standard_scaled(cells: DataFrame) -> DataFrame:
    """Each site to mean 0 and population deviation 1; sites without spread to 0."""
    by = Window.partitionBy("site_id")
    mean, scale = F.avg("beta").over(by), F.stddev_pop("beta").over(by)
    return cells.withColumn("beta", (F.col("beta") - mean) / F.when(scale == 0, F.lit(1.0)).otherwise(scale))


def robust_scaled(cells: DataFrame, floor: float = 1e-8) -> DataFrame:
    """Each site less its median, by the distance between its 10th and 90th percentiles; no distance counts as 1."""
    q = cells.groupBy("site_id").agg(F.percentile("beta", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"))
    wide = F.col("q")[2] - F.col("q")[0]
    scale = F.greatest(F.when(wide == 0, F.lit(1.0)).otherwise(wide), F.lit(floor))
    return cells.join(q, "site_id").withColumn("beta", (F.col("beta") - F.col("q")[1]) / scale).drop("q")


def impute_median(cells: DataFrame) -> DataFrame:
    middle = cells.groupBy("site_id").agg(F.median("beta").alias("middle"))
    return cells.join(middle, "site_id").withColumn("beta", F.coalesce("beta", "middle")).drop("middle")


def impute_random(cells: DataFrame, seed: int = 42) -> DataFrame:
    """Missing values become uniform on [0, 1), the same ones for the same seed, site and sample."""
    name = F.concat_ws(":", F.col("site_id").cast("string"), "sample", F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return cells.withColumn("beta", F.coalesce("beta", draw))


def vectors(cells: DataFrame, samples: list[str]) -> DataFrame:
    """``site_id, beta``: the values in order of ``samples``; absent ones are null."""
    found = cells.filter(F.col("sample").isin(*samples) & F.col("beta").isNotNull()).groupBy("site_id").agg(F.map_from_entries(F.collect_list(F.struct("sample", "beta"))).alias("m"))
    return found.select("site_id", F.array(*(F.try_element_at("m", F.lit(s)) for s in samples)).alias("beta"))


def cells_of(table: DataFrame, samples: list[str]) -> DataFrame:
    names = F.array(*map(F.lit, samples))
    return table.select("site_id", F.explode(F.arrays_zip(names.alias("sample"), F.col("beta").alias("beta"))).alias("c")).select("site_id", "c.sample", "c.beta")


def _block(batch: pa.RecordBatch, column: str = "beta") -> np.ndarray:
    """Sites by samples, missing values as NaN."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def map_blocks(table: DataFrame, work) -> DataFrame:
    """Replace the vectors of each block of sites by ``work(block)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(_block(batch))
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel(), pa.float64(), from_pandas=True))
                yield pa.RecordBatch.from_arrays([batch.column("site_id"), values], ["site_id", "beta"])

    return table.select("site_id", "beta").mapInArrow(run, f"site_id {table.schema['site_id'].dataType.simpleString()}, beta array<double>")


def sum_blocks(table: DataFrame, work, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``work(block)`` over all sites: each task adds up its own, and sums of equal places are added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(_block(batch))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

    out = np.zeros(shape).ravel()
    for r in table.select("beta").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out.reshape(shape)


def gram(table: DataFrame, n: int, center: bool = True) -> np.ndarray:
    """The samples by samples products of complete vectors, each site less its mean."""

    def work(block: np.ndarray) -> np.ndarray:
        if center:
            block = block - block.mean(1, keepdims=True)
        return block.T @ block

    return sum_blocks(table, work, (n, n))


def impute_neighbours(cells: DataFrame, samples: list[str], k: int = 5, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Missing values from the k nearest samples that have one, weighted by inverse distance.

    Distances are over common sites, scaled up to all of them. Samples at distance 0 stand for all others; without any
    such sample the site's mean is taken.
    """
    from .distance import pair_sums, square_distances

    table, n = vectors(cells, samples), len(samples)
    sums = pair_sums(table, n)
    distance = np.sqrt(square_distances(sums, table.count()))

    def work(block: np.ndarray) -> np.ndarray:
        out, missing = block.copy(), np.isnan(block)
        for i in range(n):
            rows = np.flatnonzero(missing[:, i])
            order = np.argsort(distance[i], kind="stable")
            order = order[~np.isnan(distance[i, order])]
            values, d = block[np.ix_(rows, order)], distance[i, order]
            # the first k samples in this order that have a value
            have = ~np.isnan(values)
            have &= np.cumsum(have, 1) <= k
            same = have & (d == 0)
            weight = np.where(same.any(1, keepdims=True), same, have / np.where(d == 0, 1.0, d))
            total = weight.sum(1)
            near = (weight * np.where(have, values, 0.0)).sum(1) / np.where(total == 0, 1.0, total)
            out[rows, i] = np.where(total == 0, np.nanmean(block[rows], 1), near) if len(rows) else near
        return np.clip(out, low, high)

    return cells_of(map_blocks(table, work), samples)


def impute_components(cells: DataFrame, samples: list[str], components: int = 10, rounds: int = 50, tolerance: float = 1e-4, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Missing values from the leading components, estimated again until they settle; observed values stay.

    The components are eigenvectors of the samples by samples matrix, so a site's estimate needs only its own vector.
    The vectors are stored with their estimates, and again every few rounds (KEPT_ROUNDS): a round is one pass that
    carries the stored estimates on by a few small matrices, however many rounds came before.
    """
    n = len(samples)
    table = settle(map_blocks(vectors(cells, samples), lambda block: np.concatenate([block, np.where(np.isnan(block), np.nanmean(block, 1, keepdims=True), block)], 1)))
    k = max(1, min(components, n - 1, table.count()))

    def carried(block: np.ndarray, bases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The estimates before the last of the bases and after it."""
        missing, x = np.isnan(block[:, :n]), block[:, n:]
        before = x
        for u in bases:
            centre = x.mean(1, keepdims=True)
            before, x = x, np.where(missing, (x - centre) @ u @ u.T + centre, x)
        return before, x

    steps: list[np.ndarray] = []
    for _ in range(rounds):
        if len(steps) > KEPT_ROUNDS:
            # the last basis stays, as the next round compares the estimates before and after it
            done, steps = steps[:-1], steps[-1:]
            table = settle(map_blocks(table, lambda block, done=done: np.concatenate([block[:, :n], carried(block, done)[1]], 1)))

        def measure(block: np.ndarray, bases=tuple(steps)) -> np.ndarray:
            before, x = carried(block, bases)
            c = x - x.mean(1, keepdims=True)
            return np.concatenate([(c.T @ c).ravel(), [((x - before) ** 2).sum(), (before**2).sum()]])

        out = sum_blocks(table, measure, (n * n + 2,))
        if steps and np.sqrt(out[-2]) / (np.sqrt(out[-1]) + 1e-12) < tolerance:
            break
        _, vectors_ = np.linalg.eigh(out[:-2].reshape(n, n))
        steps.append(vectors_[:, ::-1][:, :k])
    last = tuple(steps)
    return cells_of(map_blocks(table, lambda block: np.clip(carried(block, last)[1], low, high)), samples)


def impute_along(cells: DataFrame) -> DataFrame:
    """Missing values from the nearest covered sites on both sides, same sample and chromosome, by inverse distance.

    ``cells`` has chrom and start. A value on one side only is taken as it is; without any it stays missing.
    """
    rows = cells.withColumn("_s", F.expr(f"start div {STRETCH}"))
    value = F.when(F.col("beta").isNotNull(), F.struct("start", "beta"))
    # within a stretch of a chromosome rows are sorted; what lies before and after comes from a row for each stretch
    each = rows.groupBy("sample", "chrom", "_s").agg(F.max(value).alias("_last"), F.min(value).alias("_first"))
    # the next value and the last one are found as the rows go by; a frame that ends with the last row is read anew for every row
    near = lambda which, c, by: F.expr(f"{which}({c}) IGNORE NULLS OVER (PARTITION BY {by})")
    along = "sample, chrom ORDER BY _s"
    each = each.select("sample", "chrom", "_s", near("lag", "_last", along).alias("_before"), near("lead", "_first", along).alias("_after"))
    by = "sample, chrom, _s ORDER BY start"
    rows = rows.join(each, ["sample", "chrom", "_s"]).withColumn("_value", value)
    rows = rows.withColumn("_l", F.coalesce(near("lag", "_value", by), "_before")).withColumn("_r", F.coalesce(near("lead", "_value", by), "_after"))
    a, b = F.col("start") - F.col("_l.start"), F.col("_r.start") - F.col("start")
    both = (F.col("_l.beta") * b + F.col("_r.beta") * a) / (a + b)
    estimate = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), both).otherwise(F.coalesce("_l.beta", "_r.beta"))
    return rows.withColumn("beta", F.coalesce("beta", estimate)).select(*cells.columns)


def prepare(cells: DataFrame, samples: list[str], scale: float = 100.0, exclude: list[str] = (), completeness: float = 1.0, method: str = "no_impute",
            top: int | None = None, threshold: float | None = None, **options) -> DataFrame:
    """The matrix that clustering starts from; beta comes in as 0 to ``scale`` and leaves as 0 to 1."""
    rows = cells.withColumn("beta", F.col("beta") / scale)
    rows = without_samples(rows, list(exclude))
    left = [s for s in samples if s not in exclude]
    rows = complete_enough(rows, len(left), completeness)
    if method == "median":
        rows = impute_median(rows)
    elif method == "knn":
        rows = impute_neighbours(rows, left, **options)
    elif method == "pca":
        rows = impute_components(rows, left, **options)
    elif method == "random":
        rows = impute_random(rows, **options)
    elif method != "no_impute":
        raise ValueError(f"no method {method}")
    if top:
        from .distrib import most_variable, site_variance

        rows = rows.join(most_variable(site_variance(rows, zero=True), top).select("site_id"), "site_id", "left_semi")
    return binary(rows, threshold) if threshold is not None else rows


def codes(df: DataFrame, column: str) -> DataFrame:
    """Add ``code``: the rank of the value among the distinct ones, from 0; null has none."""
    distinct = df.select(column).distinct().filter(F.col(column).isNotNull())
    ranked = distinct.withColumn("code", F.row_number().over(Window.orderBy(column)) - 1)
    return df.join(ranked, column, "left")


def groups(df: DataFrame, column: str) -> tuple[bool, DataFrame]:
    """Whether a column is a scale, and ``sample, group``: numbers of a scale, else names, with one for what is missing."""
    if is_numeric(df, column):
        return True, df.select("sample", expr.number(F.col(column).cast("string")).alias("group"))
    text = F.trim(F.col(column).cast("string"))
    return False, df.select("sample", F.when(text.isNull() | text.isin(*expr.MISSING), F.lit(expr.NO_GROUP)).otherwise(text).alias("group"))


def is_numeric(df: DataFrame, column: str) -> bool:
    """Whether every value that is not missing is a number."""
    text = F.col(column).cast("string")
    row = df.filter(text.isNotNull() & ~F.trim(text).isin(*expr.MISSING)).agg(F.count(F.lit(1)).alias("n"), F.count(expr.number(text)).alias("k")).first()
    return row["n"] > 0 and row["n"] == row["k"]
