"""The data behind each figure, one DataFrame for each. Nothing is drawn."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoline.functions import expr
from cytoline.operators import cluster, cohort, distance, distrib, matrix


def feature_label_distribution(sites: DataFrame) -> DataFrame:
    return cohort.counts_with_percent(sites, "feature_label").orderBy(F.desc("n"), "feature_label")


def variable_sites_heatmap(cells: DataFrame, samples: list[str], top: int = 50) -> DataFrame:
    """``site_id, sample, beta, site_place, sample_place``: the most variable sites, missing values at their median, both in the order of a Ward tree."""
    names = distrib.most_variable(distrib.site_variance(cells, zero=True), top).select("site_id")
    rows = matrix.impute_median(cells.select("site_id", "sample", "beta").join(F.broadcast(names), "site_id", "left_semi"))
    table = sorted((r["site_id"], r["beta"]) for r in matrix.vectors(rows, samples).collect())  # at most ``top`` rows
    import numpy as np

    block = np.array([[np.nan if v is None else v for v in beta] for _, beta in table], float).reshape(-1, len(samples))
    apart = lambda x: np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(2), 0))
    block = np.nan_to_num(block)
    sites_order = cluster.leaves(cluster.linkage(apart(block), "ward"), len(block))
    sample_order = cluster.leaves(cluster.linkage(apart(block.T), "ward"), len(samples))
    spark = cells.sparkSession
    site_place = spark.createDataFrame([(table[i][0], k) for k, i in enumerate(sites_order)], f"site_id {rows.schema['site_id'].dataType.simpleString()}, site_place int")
    sample_place = spark.createDataFrame([(samples[i], k) for k, i in enumerate(sample_order)], "sample string, sample_place int")
    return rows.join(F.broadcast(site_place), "site_id").join(F.broadcast(sample_place), "sample")


def _labelled(cells: DataFrame) -> DataFrame:
    return cells.withColumn("feature_label", F.coalesce("feature_label", F.lit(expr.NO_LABEL)))


def beta_by_feature(cells: DataFrame) -> DataFrame:
    return distrib.feature_quartiles(_labelled(cells))


def sample_pairs(samples: list[str], pivots: int = 2, targets: int = 2) -> list[tuple[str, str]]:
    """The first samples, each with targets of its own among the others, which come round again if they are few."""
    others = samples[pivots:]
    if not others:
        return list(combinations(samples, 2))[: pivots * targets]
    return [(samples[p], others[(p * targets + t) % len(others)]) for p in range(pivots) for t in range(targets)]


def scatter_by_feature(cells: DataFrame, pairs: list[tuple[str, str]]) -> list[DataFrame]:
    return [distrib.pair_correlation(_labelled(cells), a, b, ["feature_label"]) for a, b in pairs]


def scatter_by_origin(cells: DataFrame, pairs: list[tuple[str, str]]) -> list[DataFrame]:
    rows = cells.withColumn("category", expr.origin_category(F.col("origin")))
    return [distrib.pair_correlation(rows, a, b, ["category"]) for a, b in pairs]


def beta_distribution(cells: DataFrame, bins: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The histogram, the counts at its ends, and the median read off it."""
    return distrib.histogram(cells, bins), distrib.extremes(cells), distrib.median_from_histogram(cells, bins)


def variance_distribution(cells: DataFrame, bins: int = 50) -> DataFrame:
    variances = distrib.site_variance(cells)
    ends = variances.filter("variance > 0").agg(F.min("variance").alias("low"), F.max("variance").alias("high")).first()
    if ends["low"] is None or ends["low"] == ends["high"]:
        return variances.groupBy().agg(F.lit(1).cast("bigint").alias("bin"), F.count_if(F.col("variance") > 0).alias("n")).select("bin", "n")
    return distrib.edge_histogram(variances, "variance", distrib.log_edges(ends["low"], ends["high"], min(bins, 100)))


def depth_distribution(cells: DataFrame, least: float, bins: int = 80) -> tuple[DataFrame, DataFrame]:
    top = cells.agg(F.max("cov").alias("high")).first()["high"] or 1
    return distrib.edge_histogram(cells, "cov", distrib.log_edges(1, max(float(top), 2.0), bins)), distrib.depth_quantiles(cells, least)


def colored(points: DataFrame, metadata: DataFrame, column: str) -> tuple[bool, DataFrame]:
    """Points (sample and coordinates) with ``group`` from metadata, and whether it is a scale; no group is N/A, or null on a scale."""
    scale, found = matrix.groups(metadata, column)
    out = points.join(found, "sample", "left")
    return scale, out if scale else out.na.fill(expr.NO_GROUP, ["group"])


def trend(points: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the line through points."""
    return points.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def medoid_silhouettes(spark, distances, ks) -> DataFrame:
    rows = [(k, cluster.silhouette(distances, cluster.medoids(distances, k)[0])) for k in ks]
    return spark.createDataFrame(rows, "k int, silhouette double")


def distances_table(spark, samples: list[str], distances) -> DataFrame:
    return distance.frame(spark, samples, distances)
