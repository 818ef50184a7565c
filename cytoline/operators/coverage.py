"""How many samples cover each site, and what is lost by asking for more."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cytoline.functions import expr


def per_site(cells: DataFrame, keep: tuple[str, ...] = ("site_id", "chrom", "start")) -> DataFrame:
    return cells.groupBy(*keep).agg(F.count("beta").alias("n_covered"))


def least_covered(sites: DataFrame, k: int = 5000) -> DataFrame:
    """The k sites with the fewest samples; the smaller site id first among equals."""
    return sites.orderBy("n_covered", "site_id").limit(k)


def summary(sites: DataFrame, n_samples: int) -> DataFrame:
    """For x from 1 to ``n_samples``: sites that exactly x samples cover, missing values there, sites with each kind of tag.

    ``sites`` has n_covered and origin; sites without any sample are left out.
    """
    counts = sites.filter("n_covered > 0").groupBy(F.col("n_covered").alias("x")).agg(
        F.count(F.lit(1)).alias("n_sites"), F.count_if(expr.has_probe_tag(F.col("origin"))).alias("n_EPC"), F.count_if(expr.has_island_tag(F.col("origin"))).alias("n_islandcpg")
    )
    every = sites.sparkSession.range(1, n_samples + 1).withColumnRenamed("id", "x")
    full = every.join(counts, "x", "left").na.fill(0)
    return full.select("x", "n_sites", F.when(F.col("x") < n_samples, F.col("n_sites")).otherwise(0).alias("n_sites_with_nan"),
                       (F.col("n_sites") * (n_samples - F.col("x"))).alias("n_nan_values"), "n_EPC", "n_islandcpg")


def refuse_inconsistent(summary_: DataFrame, sites: DataFrame) -> None:
    """Raise a ValueError if a summary does not add up to the sites that it sums: in all, and by either kind of origin."""
    seen = F.col("n_covered") > 0
    want = sites.agg(F.count_if(seen).alias("n_sites"), F.count_if(seen & expr.has_probe_tag(F.col("origin"))).alias("n_EPC"), F.count_if(seen & expr.has_island_tag(F.col("origin"))).alias("n_islandcpg")).first()
    got = summary_.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_sites", "n_EPC", "n_islandcpg"))).first()
    if want != got:
        raise ValueError(f"the summary has {got.asDict()}, the sites {want.asDict()}")


def checked_summary(sites: DataFrame, n_samples: int) -> tuple[DataFrame, Callable[[], None]]:
    """:func:`summary`, and what to call once it has been written: a ValueError if it does not add up to the sites.

    Both sides are counted while the summary is worked out: sites in all, and by either kind of origin.
    """
    seen, want, got = F.col("n_covered") > 0, Observation(), Observation()
    kinds = {"n_sites": seen, "n_EPC": seen & expr.has_probe_tag(F.col("origin")), "n_islandcpg": seen & expr.has_island_tag(F.col("origin"))}
    counted = sites.observe(want, *(F.count_if(of).alias(c) for c, of in kinds.items()))
    out = summary(counted, n_samples).coalesce(1).observe(got, *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kinds))

    def check() -> None:
        if want.get != got.get:
            raise ValueError(f"the summary has {got.get}, the sites {want.get}")

    return out, check


def covered_in(sites: DataFrame, n_samples: int, percent: float) -> DataFrame:
    """Intervals of the sites that at least this percentage of samples covers."""
    if not 0 <= percent <= 100:
        raise ValueError(f"percent must be between 0 and 100, not {percent}")
    if n_samples < 1:
        raise ValueError("there are no samples")
    return sites.filter(F.col("n_covered") / n_samples * 100 >= percent).select("chrom", "start", (F.col("start") + 2).alias("end"), "site_id")
