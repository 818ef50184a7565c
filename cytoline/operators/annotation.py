"""Annotation tracks from a gene model, and the annotation of sites by priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals


def blocks(genes: DataFrame) -> DataFrame:
    """Transcripts in block form: sizes and starts of exons relative to the transcript."""
    return genes.select(
        "chrom", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"), "gene", F.lit(0).alias("score"), "strand",
        F.col("tx_start").alias("thick_start"), F.col("tx_end").alias("thick_end"), F.size("exon_starts").alias("n_blocks"),
        F.expr("transform(arrays_zip(exon_starts, exon_ends), x -> x.exon_ends - x.exon_starts)").alias("block_sizes"),
        F.expr("transform(exon_starts, x -> x - tx_start)").alias("block_starts"),
    )


def exons(genes: DataFrame) -> DataFrame:
    """One row for each exon of each transcript."""
    rows = genes.select("chrom", "gene", "strand", F.explode(F.arrays_zip("exon_starts", "exon_ends")).alias("x"))
    return rows.select("chrom", F.col("x.exon_starts").alias("start"), F.col("x.exon_ends").alias("end"), "gene", "strand")


def merged_exons(genes: DataFrame) -> DataFrame:
    return intervals.merge(exons(genes), "gene")


def introns(genes: DataFrame) -> DataFrame:
    """What of each transcript is in no exon of any gene; transcripts that overlap give nested and equal rows."""
    rows = genes.select("chrom", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"), "gene", "strand")
    return intervals.subtract(rows, exons(genes).select("chrom", "start", "end"))


def starts(genes: DataFrame) -> DataFrame:
    """Distinct one-base start sites."""
    start, end = intervals.start_site(F.col("tx_start"), F.col("tx_end"), F.col("strand"))
    return genes.select("chrom", start.alias("start"), end.alias("end"), "gene", F.lit(0).alias("score"), "strand").distinct()


#: The labels of sites, in order of priority.
LABELS = ("Promoter/TSS", "Exon", "Intron", "cCRE", "Intergenic")


def annotate(sites: DataFrame, tss: DataFrame, exon: DataFrame, intron: DataFrame, ccre: DataFrame, strict: bool = False, slop: int = 0) -> DataFrame:
    """Add ``feature_label, gene_name, distance_TSS, ccre_accession, ccre_type``: the first of the tracks that hits.

    ``tss`` has name and extra (a sixth column of its file, that is the strand), ``ccre`` name and extra (its type), the
    others name. Columns without a value are empty texts. ``strict`` looks at all overlaps instead of the last start;
    ``slop`` widens start sites on both sides.
    """
    near = tss.withColumn("start", F.greatest(F.col("start") - slop, F.lit(0))).withColumn("end", F.col("end") + slop) if slop else tss
    tracks = {"_t": (near, ["name", "extra"]), "_e": (exon, ["name"]), "_i": (intron, ["name"]), "_c": (ccre, ["name", "extra"])}
    if strict:
        for column, (track, payload) in tracks.items():
            sites = intervals.first_overlap(sites, track, payload).withColumnRenamed("hit", column)
    else:
        sites = intervals.asof_overlaps(sites, tracks)
    has = [F.col(c).isNotNull() for c in ("_t", "_e", "_i", "_c")]

    def first(*values):
        out = F.lit("")
        for hit, value in reversed(list(zip(has, values))):
            out = F.when(hit, F.coalesce(value, F.lit(""))).otherwise(out)
        return out

    none = F.lit("")
    label = F.lit(LABELS[-1])
    for hit, name in reversed(list(zip(has, LABELS))):
        label = F.when(hit, name).otherwise(label)
    return sites.select(
        *(c for c in sites.columns if c not in ("_t", "_e", "_i", "_c")), label.alias("feature_label"),
        first(F.col("_t.name"), F.col("_e.name"), F.col("_i.name"), none).alias("gene_name"),
        first(F.col("_t.extra"), none, none, none).alias("distance_TSS"),
        first(none, none, none, F.col("_c.name")).alias("ccre_accession"),
        first(none, none, none, F.col("_c.extra")).alias("ccre_type"),
    )


def distance_to_start(sites: DataFrame, tss: DataFrame) -> DataFrame:
    """Add ``distance``: bases from each site to the nearest start site on its chromosome; null on one without any."""
    far = F.lit((1 << 63) - 1).cast("long")
    marks = tss.select("chrom", "start", far.alias("end"), F.col("start").alias("at")).distinct()
    back = marks.withColumn("start", -F.col("start"))
    found = intervals.asof_overlap(sites, marks, ["at"]).withColumn("_before", F.col("hit.at")).drop("hit")
    # the nearest one after a site is the last one before it on the mirrored chromosome
    found = intervals.asof_overlap(found.withColumn("start", -F.col("start")), back, ["at"]).withColumn("start", -F.col("start"))
    return found.withColumn("distance", F.least(F.col("start") - F.col("_before"), F.col("hit.at") - F.col("start"))).drop("_before", "hit")
