"""Operators on aligned reads: qname, flag, chrom, pos, end_pos, mapq, mods (an array of pos, strand, mod_code, prob)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals

#: Fixed value: flags of unmapped, secondary and supplementary alignments.
NOT_PRIMARY = 0x904


def _spans(reads: DataFrame) -> DataFrame:
    return reads.withColumn("start", F.col("pos")).withColumn("end", F.col("end_pos"))


def names_on(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Distinct names of primary reads that overlap a region (chrom, start, end)."""
    primary = _spans(reads).filter((F.col("flag").bitwiseAND(NOT_PRIMARY)) == 0)
    right = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return intervals.overlap_join(primary.select("qname", "chrom", "start", "end"), right, "left_semi").select("qname").distinct()


def named(reads: DataFrame, names: DataFrame) -> DataFrame:
    return reads.join(names.select("qname"), "qname", "left_semi")


def mapped_well(reads: DataFrame, least: int = 1) -> DataFrame:
    return reads.filter(F.col("mapq") >= least)


def on_regions(reads: DataFrame, regions: DataFrame, inside: bool = True) -> DataFrame:
    """Reads that overlap a region, or those that overlap none."""
    right = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return intervals.overlap_join(_spans(reads), right, "left_semi" if inside else "left_anti").drop("start", "end")


def thinned(reads: DataFrame, share: float = 0.125, seed: int = 100) -> DataFrame:
    """About this share of the reads, chosen by a digest of the name and the seed, so that reads of one name stay together."""
    digest = F.md5(F.concat_ws(":", "qname", F.lit(str(seed))).cast("binary"))
    return reads.filter(F.substring(digest, 1, 8) < F.lit(f"{int(share * (1 << 32)):08x}")) if share < 1 else reads


def too_deep(reads: DataFrame, above: int = 100) -> DataFrame:
    return intervals.deep(_spans(reads).select("chrom", "start", "end"), above)


def without_deep(reads: DataFrame, above: int = 100) -> DataFrame:
    return on_regions(reads, too_deep(reads, above), inside=False)


def together(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def in_order(reads: DataFrame) -> DataFrame:
    """Sorted by place, in ranges."""
    return reads.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")


def calls(reads: DataFrame) -> DataFrame:
    """A row for each call of a modification, with ``certainty``: the probability of what is likelier, modified or not."""
    rows = reads.select("chrom", F.explode("mods").alias("m")).select("chrom", F.col("m.pos").alias("start"), F.col("m.strand").alias("strand"), F.col("m.mod_code").alias("mod_code"), F.col("m.prob").alias("prob"))
    return rows.withColumn("certainty", F.greatest("prob", 1 - F.col("prob")))


def estimated_threshold(reads: DataFrame, share: float = 0.1, accuracy: int = 10_000) -> float | None:
    """The certainty that this share of all calls stays below: what a pileup leaves out. None without calls.

    One pass over all calls. Each task keeps a summary of bounded size and summaries are merged; the rank of the result
    is off by at most the number of calls divided by ``accuracy``.
    """
    return calls(reads).agg(F.approx_percentile("certainty", share, accuracy).alias("t")).first()["t"]


def pileup(reads: DataFrame, certain: float | None = 0.5) -> DataFrame:
    """For each place, strand and modification: reads that call it either way, and the percentage that is modified.

    Calls of a certainty below ``certain`` are left out; None estimates it from the calls themselves.
    """
    if certain is None:
        certain = estimated_threshold(reads)
    rows = calls(reads)
    clear = rows.filter(F.col("certainty") >= certain) if certain is not None else rows
    out = clear.groupBy("chrom", "start", "strand", "mod_code").agg(F.count(F.lit(1)).alias("n_valid"), (100 * F.avg((F.col("prob") >= 0.5).cast("double"))).alias("fraction"))
    return out.withColumn("end", F.col("start") + 1)
