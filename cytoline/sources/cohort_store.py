"""The cohort stored by site: bucketed tables, so that aligning further samples shuffles those samples alone.

Sites and cells are tables of the session's catalog, bucketed and sorted by ``site_id`` into the same number of buckets.
What joins or groups by site reads a bucket in a task as it lies on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoline.functions import expr

SITE = ["site_id", "chrom", "start", "end"]


def _store(df: DataFrame, table: str, folder: str, buckets: int, mode: str) -> None:
    # one file for each bucket and write: rows go to their bucket's task first
    out = df.repartition(buckets, "site_id").sortWithinPartitions("site_id").write.mode(mode).option("path", folder).option("compression", "zstd")
    out.bucketBy(buckets, "site_id").sortBy("site_id").saveAsTable(table)


def store_sites(reference: DataFrame, table: str, folder: str, buckets: int = 200) -> None:
    """Reference sites as a bucketed table under ``folder``; some ten MB for each bucket are a good size."""
    _store(reference.select(*SITE), table, folder, buckets, "overwrite")


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def align(spark: SparkSession, sites: str, samples: DataFrame, names: list[str], min_cov: int = 1) -> DataFrame:
    """As :func:`cohort.align` against a table of :func:`store_sites`: every site with every named sample.

    The samples' rows are sent to the sites' buckets and gathered by site there, as many as samples are aligned; the
    sites do not move.
    """
    deep = F.col("n_valid") >= min_cov if min_cov > 1 else F.lit(True)
    cells = samples.filter(F.col("sample").isin(names)).select("site_id", F.struct("sample", F.when(deep, expr.percent(F.col("fraction"))).alias("beta"), F.when(deep, F.col("n_valid")).alias("cov")).alias("cell"))
    gathered = cells.repartition(buckets_of(spark, sites), "site_id").groupBy("site_id").agg(F.collect_list("cell").alias("cells"))
    both = spark.table(sites).join(gathered, "site_id", "left").select(*SITE, "cells", F.explode(F.array(*map(F.lit, names))).alias("sample"))
    own = F.filter(F.coalesce("cells", F.array().cast("array<struct<sample:string,beta:double,cov:bigint>>")), lambda c: c["sample"] == F.col("sample"))
    return both.select(*SITE, "sample", F.explode_outer(own).alias("cell")).select(*SITE, "sample", "cell.beta", "cell.cov")


def add(cells: DataFrame, table: str, folder: str, buckets: int) -> None:
    """Add aligned cells to the cohort's table, which comes to be with the first ones; a sample belongs there once."""
    spark = cells.sparkSession
    if spark.catalog.tableExists(table):
        if buckets != (held := buckets_of(spark, table)):
            raise ValueError(f"{table} has {held} buckets, not {buckets}")
        new = {r["sample"] for r in cells.select("sample").distinct().collect()}
        again = sorted(r["sample"] for r in spark.table(table).filter(F.col("sample").isin(sorted(new))).select("sample").distinct().collect())
        if again:
            raise ValueError("samples that the cohort has: " + ", ".join(again))
    _store(cells, table, folder, buckets, "append")
