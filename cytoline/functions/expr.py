"""Column expressions: chromosome names, site keys, rounding, missing values, tags. All run inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value in the file formats read here.
MISSING = ("NaN", "nan", "NA", "N/A", ".", "")
#: Tags of array probes, and the tag of islands.
PROBE_TAGS = ("450k", "850k", "v2")
ISLAND_TAG = "cpgIsland"
NO_TAG = "unknown"
#: What stands for a missing feature label, and for a missing group.
NO_LABEL, NO_GROUP = "Unknown", "N/A"


def chromosome(name: Column) -> Column:
    """``chr`` names stay; ``MT`` and ``M`` become ``chrM``; others get the prefix."""
    return F.when(name.startswith("chr"), name).when(name.isin("MT", "M"), F.lit("chrM")).otherwise(F.concat(F.lit("chr"), name))


def plus_start(start: Column, strand: Column) -> Column:
    """The start on the plus strand: the minus strand's base is one further."""
    return F.when(strand == "-", start - 1).otherwise(start)


def checked_strand(strand: Column) -> Column:
    """The strand; anything but + and - is an error."""
    return F.when(strand.isin("+", "-"), strand).otherwise(F.raise_error(F.concat(F.lit("strand is neither + nor -: "), F.coalesce(strand, F.lit("null")))))


def site_key(chrom: Column, start: Column) -> Column:
    return F.concat_ws(":", chrom, start.cast("string"))


def percent(ratio: Column) -> Column:
    """A ratio as percent with two decimals, halves to even after scaling."""
    return F.rint(ratio * 100 * 100) / 100


def number(text: Column) -> Column:
    """The number that a text holds, else null; the texts of MISSING and NaN are null."""
    value = F.when(~F.trim(text).isin(*MISSING), F.trim(text).try_cast("double"))
    return F.nanvl(value, F.lit(None).cast("double"))


def whole(text: Column) -> Column:
    """The integer that a text holds, else 0."""
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def covered(value: Column, depth: Column, least: int) -> Column:
    """The value where the depth reaches ``least``, else null."""
    return F.when(depth >= least, value)


def covered_or_unknown(value: Column, depth: Column, least: int) -> Column:
    """As :func:`covered`, but a value of unknown depth stays."""
    return F.when(~F.coalesce(depth < least, F.lit(False)), value)


def has_probe_tag(origin: Column) -> Column:
    return F.coalesce(F.arrays_overlap(F.split(origin, ";"), F.array(*map(F.lit, PROBE_TAGS))), F.lit(False))


def has_island_tag(origin: Column) -> Column:
    return F.coalesce(F.array_contains(F.split(origin, ";"), ISLAND_TAG), F.lit(False))


def origin_category(origin: Column) -> Column:
    """Island and array, island, array, or other, by whole words without regard to case."""
    island, array = origin.rlike(r"(?i)\bcpgIsland\b"), origin.rlike(r"(?i)\b(450k|850k|v2)\b")
    return F.when(island & array, "island+array").when(island, "island").when(array, "array").otherwise("other")


def spread(value: Column, low: float, high: float, bins: int) -> Column:
    """The bin of an equal-width histogram, from 1; the last bin holds the upper edge."""
    return F.least(F.expr("1").cast("bigint") * F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))


def karyotype(chrom: Column) -> Column:
    """A sort key that puts chromosomes in the usual order: by number, then X, Y, M, then all others."""
    name = F.upper(F.regexp_replace(chrom, "^chr", ""))
    special = F.when(name == "X", 101).when(name == "Y", 102).when(name.isin("M", "MT"), 103).otherwise(104)
    return F.coalesce(F.try_to_number(F.when(name.rlike("^[0-9]{1,2}$"), name), F.lit("99")).cast("int"), special)
