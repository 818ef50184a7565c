"""Aligned reads sorted by place, with an index of zones: a region is read from the files that can hold it, and no others.

The index has a row for each file, chromosome and window of 16 kb in which reads of the file begin: the smallest start and
the largest end of those reads. A read that begins far before a region and reaches into it is found by its zone's end.
Within a file, the bounds of Parquet's row groups do the rest, as rows are in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoline.operators import intervals, reads

#: Bases of a window of the index; rows of a file at most, so that a region of a deep place opens few bytes.
WINDOW, FILE_ROWS = 1 << 14, 4_000_000
#: Chromosomes whose spans are pushed to the scan; with more of them, files alone are chosen.
MOST_SPANS = 64


def write(rows: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> None:
    """Sort reads by place into ``folder/reads`` and index them in ``folder/index``."""
    spark = rows.sparkSession
    reads.in_order(rows).write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(f"{folder}/reads")
    stored = spark.read.parquet(f"{folder}/reads")
    zones = stored.select(F.col("_metadata.file_path").alias("file"), "chrom", F.expr(f"pos div {WINDOW}").alias("window"), "pos", "end_pos")
    # each file's zones are summed where the file is read, and few rows are left
    zones = zones.groupBy("file", "chrom", "window").agg(F.min("pos").alias("start"), F.max("end_pos").alias("end"), F.count(F.lit(1)).alias("n"))
    zones.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.mode("overwrite").parquet(f"{folder}/index")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """``file, chrom, window, start, end, n``."""
    return spark.read.parquet(f"{folder}/index")


def files_of(spark: SparkSession, folder: str, regions: DataFrame) -> list[str]:
    """The files that can hold reads of the regions (chrom, start, end): as many names as there are files, at most."""
    right = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return [r["file"] for r in intervals.overlap_join(index(spark, folder).select("file", "chrom", "start", "end"), right).select("file").distinct().orderBy("file").collect()]


def within(spark: SparkSession, folder: str, regions: DataFrame) -> DataFrame:
    """The reads that overlap a region, from the files that the index names; each read once.

    No regions, or none with reads, give no rows. The span of the regions on each chromosome reaches the scan as a filter.
    """
    named = files_of(spark, folder, regions)
    stored = spark.read.parquet(*named) if named else spark.read.parquet(f"{folder}/reads").limit(0)
    spans = regions.groupBy("chrom").agg(F.min("start").alias("a"), F.max("end").alias("b")).limit(MOST_SPANS + 1).collect()
    if 0 < len(spans) <= MOST_SPANS:
        any_of = F.lit(False)
        for s in spans:
            any_of = any_of | ((F.col("chrom") == s["chrom"]) & (F.col("pos") < s["b"]) & (F.col("end_pos") > s["a"]))
        stored = stored.filter(any_of)
    return reads.on_regions(stored, regions)
