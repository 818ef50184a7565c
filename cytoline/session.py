"""Session settings shared by the command line, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: How many bytes go to a Python worker at once. Texts differ in size by orders of magnitude, so a number of rows is no bound.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"

#: What every job relies on: adaptive execution for skew and partition counts, ANSI arithmetic, UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "cytoline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this library's settings; ``extra`` overrides them (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and stages: the session's ``spark.checkpoint.dir``.

    Where none is set, a local run gets a temporary one; on a cluster that is an error, because executors share no
    local folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="cytoline-checkpoint-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the :func:`shared_folder`.

    Spark deletes a checkpoint that is not needed any more if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this library, once for each Spark application; bound what they get at once.

    A cluster that has the library installed, or on its PYTHONPATH, needs nothing. Otherwise the sources are
    zipped and served by the driver; executors share no folder with it.
    """
    if spark.conf.get(BATCH, None) in (None, "67108864b"):  # Spark's own value, for workers of a GB and more
        spark.conf.set(BATCH, BATCH_BYTES)
    context = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_cytoline_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="cytoline-")) / "cytoline.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted((root / "cytoline").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(target))
    context._cytoline_shipped = True
