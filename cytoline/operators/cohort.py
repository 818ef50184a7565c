"""From pileups to the cohort table: strand collapse, alignment to reference sites, origins. The canonical form is long."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cytoline.functions import expr

from . import intervals
from .distrib import medians


#: What the sums of a sample's sites are made of.
SUMS = "sample string, chrom string, start bigint, n_valid bigint, weighted double"


def partial_sums(pileup: DataFrame, mod_code: str = "m", keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """``keys, chrom, start, n_valid, weighted``: depths of both strands, and fractions (0 to 1) times depth, added up by site.

    Sums of parts of a sample can be added; :func:`finished` makes sites of them.
    """
    rows = pileup.filter(F.col("mod_code") == mod_code).select(
        *keys, expr.chromosome(F.col("chrom")).alias("chrom"), expr.plus_start(F.col("start"), expr.checked_strand(F.col("strand"))).alias("start"),
        F.col("n_valid"), (F.col("fraction") / 100 * F.col("n_valid")).alias("weighted"),
    )
    return add_sums(rows, keys)


def add_sums(sums: DataFrame, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    # Sums of both columns are combined on the map side before the one shuffle.
    return sums.groupBy(*keys, "chrom", "start").agg(F.coalesce(F.sum("n_valid"), F.lit(0)).alias("n_valid"), F.coalesce(F.sum("weighted"), F.lit(0.0)).alias("weighted"))


def finished(sums: DataFrame, mod_code: str = "m", keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Sites from their sums. A site of depth 0 keeps its depth and has no fraction."""
    fraction = F.try_divide("weighted", "n_valid").alias("fraction")
    return sums.select(*keys, expr.site_key(F.col("chrom"), F.col("start")).alias("site_id"), "chrom", "start", (F.col("start") + 2).alias("end"), F.lit(mod_code).alias("mod_code"), "n_valid", fraction)


def parse_sample(pileup: DataFrame, mod_code: str = "m", keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """One row for each site of a sample: both strands together, the fraction (0 to 1) weighted by depth.

    ``keys`` are columns of ``pileup`` that separate samples.
    """
    return finished(partial_sums(pileup, mod_code, keys), mod_code, keys)


def together(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames, which have the same columns; joined in pairs, so that no plan is as deep as they are many."""
    while len(frames) > 1:
        frames = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def repeated_sites(sites: DataFrame, keys: tuple[str, ...] = ("sample", "site_id")) -> DataFrame:
    """Keys that occur more than once; none in the result of :func:`parse_sample`."""
    return sites.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def mixed_names(sites: DataFrame) -> DataFrame:
    """Samples whose chromosome names do not all have the prefix."""
    return sites.groupBy("sample").agg(F.count_if(~F.col("chrom").startswith("chr")).alias("n_plain")).filter("n_plain > 0")


def refuse_unfit(reference: DataFrame, samples: DataFrame) -> None:
    """Raise a ValueError if a sample has a site twice, or names chromosomes in another way than the reference does.

    For tables that are stored already; :func:`observed` looks while a cohort is made of them. The join of :func:`align` would repeat the one and silently miss the other.
    """
    twice = [f"{r['sample']} {r['site_id']}" for r in repeated_sites(samples).limit(5).collect()]
    if twice:
        raise ValueError("sites that a sample has more than once: " + ", ".join(twice))
    plain = [r["sample"] for r in mixed_names(reference.withColumn("sample", F.lit("the reference")).unionByName(samples, allowMissingColumns=True)).orderBy("sample").limit(5).collect()]
    if plain:
        raise ValueError("chromosome names without chr: " + ", ".join(plain))


def observed(reference: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
    """Both frames, counted while they are read, and what to call once a table made of both has been written.

    That raises a ValueError where sites and samples name chromosomes in different ways, which a join silently misses.
    """
    seen = {"the reference": Observation(), "a sample": Observation()}
    plain = F.count_if(~F.col("chrom").startswith("chr")).alias("plain")
    names = [df.observe(o, plain, F.min(F.when(~F.col("chrom").startswith("chr"), F.col("chrom"))).alias("example")) for df, o in zip((reference, samples), seen.values())]

    def check() -> None:
        for who, o in seen.items():
            if o.get["plain"]:
                raise ValueError(f"chromosome names without chr: {who} has {o.get['plain']} such rows, as {o.get['example']}")

    return *names, check


def observed_wide(cells: DataFrame, samples: list[str], keys: list[str]) -> tuple[DataFrame, Callable[[], None]]:
    """:func:`writers.wide` of the cells, and what to call once it has been written: a ValueError where a sample has a site
    more than once, of which the table shows one."""
    rows = cells.groupBy(*keys).pivot("sample", samples).agg(F.first("beta").alias("beta"), F.first("cov").alias("cov"), F.count(F.lit(1)).alias("n"))
    most = F.greatest(*(F.coalesce(F.col(f"`{s}_n`"), F.lit(0)) for s in samples), F.lit(0))
    seen = Observation()
    rows = rows.observe(seen, F.count_if(most > 1).alias("twice"), F.min(F.when(most > 1, F.col("site_id"))).alias("example"))

    def check() -> None:
        if seen.get["twice"]:
            raise ValueError(f"sites that a sample has more than once: {seen.get['twice']}, as {seen.get['example']}")

    return rows.select(*keys, *(F.col(f"`{s}_{v}`").alias(f"{v}_{s}") for s in samples for v in ("beta", "cov"))), check


def align(reference: DataFrame, samples: DataFrame, names: list[str], min_cov: int = 1) -> DataFrame:
    """Every reference site with every named sample: ``site_id, chrom, start, end, sample, beta, cov``; absent is null.

    One join on the sites, whatever the number of samples, by shuffling both sides: files tell the optimiser too little of
    how many cells there are to let it broadcast them. Below ``min_cov`` both values are missing. beta is percent.
    """
    grid = reference.select("site_id", "chrom", "start", "end").withColumn("sample", F.explode(F.array(*map(F.lit, names))))
    deep = F.col("n_valid") >= min_cov if min_cov > 1 else F.lit(True)
    cells = samples.select("site_id", "sample", F.when(deep, expr.percent(F.col("fraction"))).alias("beta"), F.when(deep, F.col("n_valid")).alias("cov"))
    return grid.hint("merge").join(cells, ["site_id", "sample"], "left").select("site_id", "chrom", "start", "end", "sample", "beta", "cov")


def split_covered(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of the sites that some sample covers, and the sites that none does."""
    seen = cells.groupBy("site_id", "chrom", "start", "end").agg(F.count("cov").alias("n"))
    return cells.join(seen.filter("n > 0").select("site_id"), "site_id", "left_semi"), seen.filter("n = 0").drop("n")


def missing_by_sample(cells: DataFrame) -> DataFrame:
    return cells.groupBy("sample").agg(F.count_if(F.col("beta").isNull()).alias("n_missing"), F.count(F.lit(1)).alias("n_sites"))


def missing_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """What imputation filled in: by sample, and for ``all`` of them, missing values before and after, and their shares in percent."""
    state = lambda df, n, b, a: df.select("sample", F.lit(n).alias("n"), F.when(F.col("beta").isNull(), b).otherwise(0).alias("b"), F.when(F.col("beta").isNull(), a).otherwise(0).alias("a"))
    sums = state(before, 1, 1, 0).unionByName(state(after, 0, 0, 1)).rollup("sample").agg(F.sum("n").alias("n_sites"), F.sum("b").alias("missing_before"), F.sum("a").alias("missing_after"), F.grouping("sample").alias("whole"))
    share = lambda c: F.round(F.try_divide(100.0 * F.col(c), F.col("n_sites")), 6)
    return sums.select(F.when(F.col("whole") == 1, "all").otherwise(F.col("sample")).alias("sample"), "n_sites", "missing_before", "missing_after", (F.col("missing_before") - F.col("missing_after")).alias("n_imputed"),
                       share("missing_before").alias("percent_before"), share("missing_after").alias("percent_after"))


def unmatched(names: DataFrame, others: DataFrame, kind: str, other_kind: str) -> DataFrame:
    """``sample, lacks``: samples of either frame that the other one does not have. Null names match nothing and lack both."""
    left, right = names.select("sample").distinct(), others.select(F.col("sample").alias("other")).distinct()
    both = left.join(right, F.col("sample") == F.col("other"), "full")
    lone = both.filter("sample IS NULL OR other IS NULL")
    return lone.select(F.coalesce("sample", "other").alias("sample"), F.when(F.col("sample").isNull(), kind).otherwise(F.lit(other_kind)).alias("lacks"))


def depth_medians(samples: DataFrame) -> DataFrame:
    return medians(samples, "sample", "n_valid", "median_depth").join(medians(samples, "sample", "fraction", "median_fraction"), "sample")


def with_origins(sites: DataFrame, regions: DataFrame) -> DataFrame:
    return intervals.tags_of_overlaps(sites, regions, expr.NO_TAG)


def counts_with_percent(df: DataFrame, column: str, none: str = expr.NO_LABEL) -> DataFrame:
    """Rows for each value and their share of all in percent; a null counts as ``none``."""
    counts = df.groupBy(F.coalesce(F.col(column), F.lit(none)).alias(column)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(column, "n", F.round(100 * F.col("n") / F.col("total"), 6).alias("percent"))
