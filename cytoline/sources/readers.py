"""Readers: explicit schemas, nothing inferred, missing values as null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoline.functions import expr

#: Positions used of the 18 columns of a pileup before imputation, and of the columns after it.
PILEUP = {"chrom": 0, "start": 1, "end": 2, "mod_code": 3, "strand": 5, "n_valid": 9, "fraction": 10}
IMPUTED = {"chrom": 0, "start": 1, "end": 2, "strand": 3, "fraction": 5, "n_valid": 6}
KINDS = {"start": "bigint", "end": "bigint", "n_valid": "bigint", "fraction": "double"}


def _strings(spark: SparkSession, path: str | list[str], width: int, sep: str = "\t", **options: str) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(width))
    return spark.read.options(sep=sep, comment="#", **options).schema(schema).csv(path)


def picked(df: DataFrame, layout: dict[str, int], *keep: str) -> DataFrame:
    """The columns of a layout by position, typed, after the columns to keep."""
    cols = list(keep)
    for name, i in layout.items():
        kind = KINDS.get(name)
        value = F.trim(f"c{i}")
        cols.append((expr.number(value) if kind == "double" else value.try_cast(kind) if kind else value).alias(name))
    return df.select(*cols)


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated rows of session, flow cell, barcode, pod5 path, interval key; adds the sample's name."""
    df = spark.read.options(sep=" ").schema("session string, flowcell string, barcode string, pod5_path string, bed_key string").csv(path)
    return df.filter("session IS NOT NULL").withColumn("sample", F.concat_ws("_", "session", "barcode"))


def pileup(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A methylation pileup; only the used columns are parsed."""
    return picked(_strings(spark, path, 18), PILEUP)


def imputed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A pileup after imputation; a header is a row whose start is no number."""
    return picked(_strings(spark, path, 7), IMPUTED).filter("start IS NOT NULL").withColumn("mod_code", F.lit("m"))


def intervals(spark: SparkSession, path: str, name_col: int = 3, width: int = 12) -> DataFrame:
    """``chrom, start, end, name``; bad coordinates are 0, negative starts go."""
    df = _strings(spark, path, max(width, name_col + 1))
    return df.select(F.col("c0").alias("chrom"), expr.whole(F.col("c1")).alias("start"), expr.whole(F.col("c2")).alias("end"), F.col(f"c{name_col}").alias("name")).filter("start >= 0")


def origins(spark: SparkSession, path: str) -> DataFrame:
    df = _strings(spark, path, 4, encoding="ISO-8859-1")
    return df.select(F.col("c0").alias("chrom"), expr.whole(F.col("c1")).alias("start"), expr.whole(F.col("c2")).alias("end"), F.col("c3").alias("origin"))


def site_reference(spark: SparkSession, path: str) -> DataFrame:
    """Sites from an interval file or Parquet, by the path's ending; one row for each (chrom, start)."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
        lower = {c.lower(): c for c in df.columns}
        pick = lambda *names: next((F.col(lower[n]) for n in names if n in lower), None)
        found = pick("chr", "chrom"), pick("start", "chromstart"), pick("end", "chromend")
        if any(c is None for c in found):
            raise ValueError(f"no chromosome, start and end among {df.columns}")
    else:
        df = _strings(spark, path, 3)
        found = F.col("c0"), F.col("c1"), F.col("c2")
    chrom, start, end = found
    rows = df.select(F.trim(chrom.cast("string")).alias("chrom"), F.trim(start.cast("string")).try_cast("bigint").alias("start"), F.trim(end.cast("string")).try_cast("bigint").alias("end"))
    rows = rows.filter("chrom IS NOT NULL AND start >= 0 AND end IS NOT NULL").groupBy("chrom", "start").agg(F.min("end").alias("end"))
    return rows.withColumn("site_id", expr.site_key(F.col("chrom"), F.col("start")))


def cohort(spark: SparkSession, path: str) -> DataFrame:
    """The wide cohort table, Parquet or tab-separated with a header; texts of missing numbers become null."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    df = spark.read.options(sep="\t", header=True, encoding="ISO-8859-1").csv(path)
    for name in df.columns:
        if name.startswith(("beta_", "cov_")):
            df = df.withColumn(name, expr.number(F.col(name)))
    return df.withColumn("start", F.col("start").try_cast("bigint"))


def samples_of(df: DataFrame, strict: bool = False) -> list[str]:
    """Names with both a beta and a depth column, in order; ``strict`` makes a lone column an error."""
    beta = {c[5:] for c in df.columns if c.startswith("beta_")}
    depth = {c[4:] for c in df.columns if c.startswith("cov_")}
    if strict and beta != depth:
        raise ValueError(f"columns without their pair: {sorted(beta ^ depth)}")
    if not beta & depth:
        raise ValueError("no pair of beta_ and cov_ columns")
    return sorted(beta & depth)


def to_long(df: DataFrame, samples: list[str], keep: list[str]) -> DataFrame:
    """``keep``, sample, beta, cov: one row for each site and sample, nulls included."""
    pairs = F.array(*(F.struct(F.lit(s).alias("sample"), F.expr(f"nanvl(cast(`beta_{s}` as double), null)").alias("beta"), F.col(f"cov_{s}").cast("double").alias("cov")) for s in samples))
    return df.select(*keep, F.explode(pairs).alias("cell")).select(*keep, "cell.sample", "cell.beta", "cell.cov")


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """A sites by samples matrix as ``site_id, sample, beta``."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.options(sep="\t", header=True).csv(path)
    names = [c for c in df.columns if c != "site_id"]
    value = lambda n: expr.number(F.col(f"`{n}`").cast("string"))
    cells = F.array(*(F.struct(F.lit(n).alias("sample"), value(n).alias("beta")) for n in names))
    return df.select("site_id", F.explode(cells).alias("cell")).select("site_id", "cell.sample", "cell.beta")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated; the key column ``sample``, ``patient`` or the first one is called ``sample``."""
    df = spark.read.options(sep="\t", header=True).csv(path)
    key = next((c for c in ("sample", "patient") if c in df.columns), df.columns[0])
    return df.withColumnRenamed(key, "sample")


def risk(spark: SparkSession, path: str) -> DataFrame:
    """Two fields separated by white space: sample and risk, as text."""
    parts = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(path).filter(F.trim("value") != "").select(parts.alias("p")).filter(F.size("p") >= 2)
    return df.select(F.col("p")[0].alias("sample"), F.col("p")[1].alias("risk")).filter(~F.lower("sample").isin("patient", "sample") & ~F.col("risk").isin(*expr.MISSING))


def distances(spark: SparkSession, path: str) -> DataFrame:
    """A square matrix with a header and an index column, as ``sample_i, sample_j, d``."""
    df = spark.read.options(sep="\t", header=True).csv(path)
    first, *names = df.columns
    cells = F.array(*(F.struct(F.lit(n).alias("sample_j"), expr.number(F.col(f"`{n}`")).alias("d")) for n in names))
    return df.select(F.col(f"`{first}`").alias("sample_i"), F.explode(cells).alias("c")).select("sample_i", "c.sample_j", "c.d")


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.options(sep="\t", header=True).csv(path)
    first, *names = df.columns
    return df.select(F.col(f"`{first}`").alias("sample"), *(expr.number(F.col(f"`{n}`")).alias(n) for n in names))


def gene_model(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts: chromosome, strand, bounds, gene, and the starts and ends of exons as arrays."""
    df = _strings(spark, path, 16)
    longs = lambda c: F.expr(f"transform(filter(split({c}, ','), x -> trim(x) <> ''), x -> cast(trim(x) as bigint))")
    return df.select(F.col("c2").alias("chrom"), F.col("c3").alias("strand"), F.col("c4").cast("bigint").alias("tx_start"), F.col("c5").cast("bigint").alias("tx_end"),
                     longs("c9").alias("exon_starts"), longs("c10").alias("exon_ends"), F.col("c12").alias("gene"))


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Reads as Parquet: qname, flag, chrom, pos, end_pos, mapq, mods."""
    return spark.read.parquet(path)
