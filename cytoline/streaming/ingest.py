"""Samples as they arrive, in any number of files and batches: sums by site and sample, kept for each batch and merged.

Collapsing strands needs two sums for each site and sample, of depths and of fractions weighted by depth. Each batch
stores its own sums, under its number, so a batch that is run again replaces what it stored; the sums of all batches give
the sites. What a streaming aggregation would hold as state for good lies in the folder instead, and is read when a batch
touches its sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cytoline.functions import expr
from cytoline.operators import cohort
from cytoline.sources import readers

#: Where the sums lie in the folder of the finished sites, and those of batches that have been merged.
SUMS, MERGED = "_sums", "_merged"


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """Pileup rows of new files; the sample is the file's name up to its first dot."""
    schema = ", ".join(f"c{i} string" for i in range(18))
    rows = spark.readStream.options(sep="\t", comment="#").schema(schema).csv(folder)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return readers.picked(rows.withColumn("sample", F.substring_index(name, ".", 1)), readers.PILEUP, "sample")


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders ``batch=...`` under a path that were written to the end."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    names = [s.getPath().getName() for s in store.listStatus(root)]
    done = [n for n in names if n.startswith("batch=") and store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n[6:]) for n in done)


def sums(spark: SparkSession, out: str) -> DataFrame | None:
    """All sums stored so far: the last merged ones and those of later batches; None before any."""
    merged = _folders(spark, f"{out}/{MERGED}")[-1:]
    later = [b for b in _folders(spark, f"{out}/{SUMS}") if b > (merged or [-1])[0]]
    paths = [f"{out}/{MERGED}/batch={b}" for b in merged] + [f"{out}/{SUMS}/batch={b}" for b in later]
    # each folder is partitioned by sample, which the folder's own number is not
    frames = [spark.read.schema(cohort.SUMS).parquet(p) for p in paths]
    return cohort.together(frames) if frames else None


def merge(spark: SparkSession, out: str) -> None:
    """Add up the sums of all batches but the last, which may be run again; readers use either side of the change."""
    done = _folders(spark, f"{out}/{SUMS}")[:-1]
    merged = (_folders(spark, f"{out}/{MERGED}") or [-1])[-1]
    if not done or done[-1] <= merged:
        return
    paths = [f"{out}/{MERGED}/batch={merged}"] * (merged >= 0) + [f"{out}/{SUMS}/batch={b}" for b in done if b > merged]
    added = cohort.add_sums(cohort.together([spark.read.schema(cohort.SUMS).parquet(p) for p in paths]))
    added.write.mode("overwrite").partitionBy("sample").parquet(f"{out}/{MERGED}/batch={done[-1]}")
    for path in paths:
        old = spark._jvm.org.apache.hadoop.fs.Path(path)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep the sites of all samples under ``out``, partitioned by sample; ``once`` stops after what is there.

    A sample may come in several files, in one batch or many: its sites are those of all its rows together, whatever the
    batches. A batch that is run again, after a restart, replaces what it stored before. A batch works out the sites of
    the samples that it touches, and no others.
    """

    def write(batch: DataFrame, number: int) -> None:
        cohort.partial_sums(batch).write.mode("overwrite").partitionBy("sample").parquet(f"{out}/{SUMS}/batch={number}")
        touched = batch.sparkSession.read.schema(cohort.SUMS).parquet(f"{out}/{SUMS}/batch={number}").select("sample").distinct()
        held = sums(batch.sparkSession, out)
        sites = cohort.finished(cohort.add_sums(held.join(touched, "sample", "left_semi")))
        sites.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("sample").parquet(out)

    query = watch(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if once else query).start()


def depth_by_window(events: DataFrame, time: str, value: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums of a stream of measurements in windows, waiting ``late`` for rows that come late."""
    return events.withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("n"), F.sum(expr.number(F.col(value).cast("string"))).alias("total"))
