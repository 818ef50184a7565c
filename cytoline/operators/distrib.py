"""Distributions of beta, depth and variance, by streaming aggregates over cells."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoline.functions import expr


#: Into so many stretches of values a group is cut to be put in order.
VALUE_STRETCHES = 1024


def running_counts(df: DataFrame, by: str, value: str) -> DataFrame:
    """``by, value, n, upto``: for each distinct value of a group its rows, and all rows up to it; nulls are left out.

    Distinct values are counted, and sums of counts run along stretches of values, so no task sorts a whole group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy(by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    share = F.when(F.col("_high") > F.col("_low"), (F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    counts = counts.join(ends, by).select(by, value, "n", F.floor(share * VALUE_STRETCHES).alias("_s"))
    each = counts.groupBy(by, "_s").agg(F.sum("n").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.join(each.select(by, "_s", F.coalesce(before, F.lit(0)).alias("_below")), [by, "_s"])
    inner = F.sum("n").over(Window.partitionBy(by, "_s").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.select(by, value, "n", (F.col("_below") + inner).alias("upto"))


def medians(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """The exact median of each group, from running counts; groups without a value have none."""
    counts = running_counts(df, by, value)
    total = counts.groupBy(by).agg(F.max("upto").alias("_all"))
    at = lambda place: F.min(F.when(F.col("upto") >= F.expr(place), F.col(value)))
    middle = counts.join(total, by).groupBy(by).agg(((at("(_all + 1) div 2") + at("(_all + 2) div 2")) / 2).alias(out))
    return df.select(by).distinct().join(middle, by, "left")


def extremes(cells: DataFrame) -> DataFrame:
    """Cells at 0, at 100, between and missing, and the mean."""
    b = F.col("beta")
    return cells.agg(F.count_if(b == 0).alias("n_zero"), F.count_if(b == 100).alias("n_hundred"), F.count_if((b > 0) & (b < 100)).alias("n_between"),
                     F.count_if(b.isNull()).alias("n_missing"), F.avg(b).alias("mean"))


def histogram(cells: DataFrame, bins: int = 100, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """``bin`` (from 1) and ``n`` of the values strictly between the edges; empty bins are rows too."""
    inner = cells.filter((F.col("beta") > low) & (F.col("beta") < high))
    counts = inner.groupBy(expr.spread(F.col("beta"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return cells.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin").join(counts, "bin", "left").na.fill(0, ["n"])


def median_from_histogram(cells: DataFrame, bins: int = 100) -> DataFrame:
    """One row: the median (null without values) of beta, interpolated between the middles of bins, with 0 and 100 as bins of their own."""
    step = 100.0 / bins
    inner = histogram(cells, bins).select(F.col("bin").alias("at"), ((F.col("bin") - 0.5) * step).alias("value"), "n")
    ends = extremes(cells).select(F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0.0).alias("value"), F.col("n_zero").alias("n")),
                                                    F.struct(F.lit(bins + 1).cast("bigint").alias("at"), F.lit(100.0).alias("value"), F.col("n_hundred").alias("n")))).alias("e")).select("e.*")
    line = Window.orderBy("at")  # bins + 2 rows
    rows = ends.unionByName(inner).withColumn("upto", F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(Window.partitionBy()))
    rows = rows.withColumn("below", F.coalesce(F.lag("upto").over(line), F.lit(0))).withColumn("previous", F.coalesce(F.lag("value").over(line), F.lit(0.0)))
    first = rows.filter("total > 0 AND upto >= total / 2").agg(F.min_by(F.struct("value", "previous", "below", "upto", "total", "at"), "at").alias("r")).select("r.*")
    part = F.try_divide(F.col("total") / 2 - F.col("below"), F.col("upto") - F.col("below"))
    return first.select(F.when(F.col("at") == 0, F.lit(0.0)).otherwise(F.coalesce(F.col("previous") + part * (F.col("value") - F.col("previous")), F.col("value"))).alias("median"))


def log_edges(low: float, high: float, bins: int) -> list[float]:
    a, b = math.log10(low), math.log10(high)
    return [10 ** (a + (b - a) * i / bins) for i in range(bins + 1)]


def edge_histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """``bin`` (from 1) and ``n`` for ascending edges; the last bin holds its upper edge, values outside are left out."""
    bins, value = len(edges) - 1, F.col(column)
    bin_ = F.least(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value)), F.lit(bins)).cast("bigint")
    counts = df.filter((value >= edges[0]) & (value <= edges[-1])).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin").join(counts, "bin", "left").na.fill(0, ["n"])


def depth_quantiles(cells: DataFrame, threshold: float) -> DataFrame:
    """p10, median, p90 (exact, interpolated), mean, largest and the share below a threshold."""
    v = F.col("cov")
    q = F.percentile(v, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    row = cells.filter(v.isNotNull()).agg(q.alias("q"), F.avg(v).alias("mean"), F.max(v).alias("largest"), F.avg((v < threshold).cast("double")).alias("below"))
    return row.select(F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"), "mean", "largest", "below")


def site_variance(cells: DataFrame, least: int = 2, zero: bool = False) -> DataFrame:
    """Sample variance of beta at each site with ``least`` values; ``zero`` gives the others 0 instead of leaving them out."""
    rows = cells.groupBy("site_id").agg(F.var_samp("beta").alias("variance"), F.count("beta").alias("n_values"))
    if zero:
        return rows.withColumn("variance", F.coalesce("variance", F.lit(0.0)))
    return rows.filter(F.col("n_values") >= least)


def feature_quartiles(cells: DataFrame) -> DataFrame:
    """Quartiles of beta for each feature label, in order of the median."""
    q = F.percentile("beta", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    rows = cells.filter("beta IS NOT NULL").groupBy("feature_label").agg(q.alias("q"), F.count(F.lit(1)).alias("n"))
    return rows.select("feature_label", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "n").orderBy("median", "feature_label")


def pair_correlation(cells: DataFrame, first: str, second: str, by: list[str]) -> DataFrame:
    """Pearson's r of two samples over their common sites, for each group of ``by``; null without spread or with one site."""
    at = cells.filter(F.col("sample").isin(first, second) & F.col("beta").isNotNull()).groupBy("site_id", *by).agg(
        F.max(F.when(F.col("sample") == first, F.col("beta"))).alias("x"), F.max(F.when(F.col("sample") == second, F.col("beta"))).alias("y")
    ).filter("x IS NOT NULL AND y IS NOT NULL")
    sums = at.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("cxy"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    return sums.select(*by, "n", F.when((F.col("n") > 1) & (F.col("vx") * F.col("vy") > 1e-18), F.col("cxy") / F.sqrt(F.col("vx") * F.col("vy"))).alias("r"))


def most_variable(variances: DataFrame, k: int) -> DataFrame:
    """The k sites of the largest variance; the smaller site id first among equals."""
    return variances.orderBy(F.desc("variance"), "site_id").limit(k)
