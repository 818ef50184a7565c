"""Writers. Files of one row for each sample are written as one part; site-sized tables keep their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import single_file


def parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    out = df.write.mode("overwrite").option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(df: DataFrame, path: str, small: bool = False, header: bool = True, missing: str = "NaN") -> None:
    """Tab-separated; ``small`` for tables with a row for each sample or cluster."""
    (df.coalesce(1) if small else df).write.mode("overwrite").options(sep="\t", header=header, nullValue=missing, emptyValue="").csv(path)


def comma(df: DataFrame, path: str, small: bool = False) -> None:
    (df.coalesce(1) if small else df).write.mode("overwrite").options(header=True, emptyValue="").csv(path)


def intervals(df: DataFrame, path: str) -> None:
    """One interval file without a header, in order of chromosome and start; no file where there are no intervals."""
    single_file.write(df.orderBy("chrom", "start"), path)


def pileup(df: DataFrame, path: str) -> None:
    """``sample`` and the columns of a pileup as text of 18 columns, a folder for each sample, in order of place."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    fields = [known(c) for c in ("chrom", "start", "end", "mod_code", "n_valid", "strand", "start", "end")] + [F.lit("255,0,0"), known("n_valid"), known("fraction")]
    ranged = df.repartitionByRange("sample", "chrom", "start").sortWithinPartitions("sample", "chrom", "start")
    ranged.select("sample", F.concat_ws("\t", *fields, *[F.lit("0")] * 7).alias("value")).write.mode("overwrite").partitionBy("sample").text(path)


def wide(long: DataFrame, samples: list[str], keys: list[str]) -> DataFrame:
    """One row for each site; columns beta_ and cov_ of each named sample. The names are given, so nothing is scanned for them."""
    pivot = long.groupBy(*keys).pivot("sample", samples).agg(F.first("beta").alias("beta"), F.first("cov").alias("cov"))
    return pivot.select(*keys, *(F.col(f"`{s}_{v}`").alias(f"{v}_{s}") for s in samples for v in ("beta", "cov")))


def matrix(long: DataFrame, samples: list[str], path: str) -> None:
    """Sites by samples, single precision."""
    pivot = long.groupBy("site_id").pivot("sample", samples).agg(F.first("beta").cast("float"))
    parquet(pivot, path)


def matrix_text(long: DataFrame, samples: list[str], path: str) -> None:
    """Sites by samples as text with four decimals."""
    pivot = long.groupBy("site_id").pivot("sample", samples).agg(F.first("beta"))
    table(pivot.select("site_id", *(F.format_string("%.4f", F.col(f"`{s}`")).alias(s) for s in samples)), path)


def decimals(df: DataFrame, path: str, names: list[str], places: int = 6) -> None:
    """A small table with the named columns at a fixed number of decimals."""
    cols = [F.format_string(f"%.{places}f", F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns]
    table(df.select(*cols), path, small=True)
