"""Half-open integer intervals on chromosomes: overlap and as-of joins, merging, subtraction, depth.

No operator compares all pairs. Overlaps are found in a hierarchy of bins: an interval is filed once, in a bin of its own
size, and asks for longer ones in the wider bins, so one as long as a chromosome is no more rows than any other. Whether or
how often something overlaps needs no pairs. Sorted passes (that, as-of matches, merging, depth) sort within stretches of a chromosome and carry what comes before from a table with one row for each stretch, so that no
task sorts a chromosome.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the narrowest bins of the overlap join, for intervals of hundreds to thousands of bases.
BIN = 4096
#: Wider bins are wider by so many powers of two each.
STEP = 6


#: Width of a stretch of the sorted passes, and of those in which overlaps are decided or counted.
STRETCH, SWEPT = 1 << 20, 1 << 16


def _before():
    return Window.partitionBy("chrom").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)


def _stretched(df: DataFrame, place: str = "start") -> DataFrame:
    return df.withColumn("_s", F.expr(f"`{place}` div {STRETCH}"))


def _carried(df: DataFrame, within: Column, before: Column) -> DataFrame:
    """``df`` with ``_c``: ``before`` over earlier stretches, whose own value ``_v`` is ``within``, an aggregate."""
    each = df.groupBy("chrom", "_s").agg(within.alias("_v"))
    return df.join(each.select("chrom", "_s", before.over(_before()).alias("_c")), ["chrom", "_s"])


def _widths(width: int) -> list[int]:
    """Binary logarithms of the widths of bins by level: the narrowest is ``width``, each next one is 64 times as wide."""
    least = width.bit_length() - 1
    if width != 1 << least:
        raise ValueError(f"the width of bins is a power of two, not {width}")
    return list(range(least, 62, STEP))


def _level(start: Column, end: Column, width: int) -> Column:
    """The first level whose bins are at least as wide as the interval is long."""
    bits = _widths(width)
    length, level = F.greatest(end - start, F.lit(1)), F.lit(len(bits) - 1)
    for k in range(len(bits) - 2, -1, -1):
        level = F.when(length <= F.lit(1 << bits[k]), F.lit(k)).otherwise(level)
    return level.cast("int")


def _filed(df: DataFrame, start: str, end: str, width: int, asked: Column, turn: int) -> DataFrame:
    """``df`` with ``_place``: where an interval is filed, once, and the bins in which it asks for wider ones.

    It is filed at its level by its start. At a level of bins as wide as the interval or wider it asks in the bins in
    which an interval that overlaps it can start: three at most. ``asked`` are the levels at which the other side has
    intervals. Each side's filed rows meet only the other side's asking ones: turn 0 is the left side's filed rows with
    what the right asks at the same level or above, turn 1 the right's filed rows with what the left asks above.
    """
    first, last = F.col(start).cast("long"), F.greatest(F.col(end), F.col(start) + 1).cast("long") - 1
    level, least = _level(F.col(start), F.col(end), width), _widths(width)[0]
    place = lambda turn, level, at: F.struct(F.lit(turn).alias("turn"), level.alias("level"), at.alias("bin"))
    moved = lambda at, level: F.call_function("shiftright", at, level * STEP + least)
    wide = lambda level: F.call_function("shiftleft", F.lit(1).cast("long"), level * STEP + least)
    wider = F.filter("_asked", lambda k: (k >= level) if turn else (k > level))
    asks = F.flatten(F.transform(wider, lambda k: F.transform(F.sequence(moved(first + 1 - wide(k), k), moved(last, k)), lambda at: place(1 - turn, k, at))))
    return df.withColumn("_asked", asked).withColumn("_place", F.explode(F.concat(F.array(place(turn, level, moved(first, level))), asks))).drop("_asked")


def _levels(df: DataFrame, start: str, end: str, width: int) -> Column:
    """The levels at which a side has intervals, ten at most, found while the query runs."""
    return df.select(_level(F.col(start), F.col(end), width).alias("_level")).agg(F.collect_set("_level")).scalar()


def overlap_join(left: DataFrame, right: DataFrame, how: str = "inner", width: int = BIN) -> DataFrame:
    """Pairs of ``left`` (chrom, start, end) and ``right`` (chrom, r_start, r_end) that overlap.

    ``how``: inner, or left_semi or left_anti, which are :func:`overlapping`. An empty interval overlaps those that reach beyond it on both sides. Rows
    do not multiply with the length of intervals: each is filed in one bin of its own size and asks in three bins, at
    most, of each wider size that the other side uses. A pair is met once. ``width``, a power of two, is the narrowest bin.
    """
    if how in ("left_semi", "left_anti"):
        return overlapping(left, right, how == "left_semi")
    if how != "inner":
        raise ValueError(how)
    named = right.withColumnRenamed("chrom", "_chrom_r")
    b = _filed(named, "r_start", "r_end", width, _levels(left, "start", "end", width), 1).withColumnRenamed("_place", "_place_r")
    hit = (F.col("chrom") == F.col("_chrom_r")) & (F.col("_place") == F.col("_place_r")) & (F.col("r_start") < F.col("end")) & (F.col("r_end") > F.col("start"))
    held = _levels(right, "r_start", "r_end", width)
    # both sides are shuffled: broadcast on a guess from their files, pairs would all be made where one file is read
    return _filed(left, "start", "end", width, held, 0).hint("merge").join(b, hit).drop("_place", "_place_r", "_chrom_r")


def _swept(rows: DataFrame, of: Callable[[Column], Column], *columns: str) -> DataFrame:
    """``rows`` (chrom, _at, _kind, ...) with each of ``columns`` replaced by its aggregate over all rows up to each, in
    order of place and kind.

    One sort within stretches. What a stretch begins with comes in as a row of its own, the first one and of no kind.
    """
    rows = rows.withColumn("_s", F.expr(f"_at div {SWEPT}"))
    own = rows.groupBy("chrom", "_s").agg(*(of(F.col(c)).alias(c) for c in columns))
    carried = own.select("chrom", "_s", *(of(F.col(c)).over(_before()).alias(c) for c in columns))
    order = Window.partitionBy("chrom", "_s").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(carried, allowMissingColumns=True)
    return both.withColumns({c: of(F.col(c)).over(order) for c in columns}).filter("_kind IS NOT NULL").drop("_s")


def overlapping(left: DataFrame, right: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``left`` (chrom, start, end) that overlap any of ``right`` (chrom, r_start, r_end), or those that overlap none.

    Something overlaps a row if, of all intervals that start before the row's end, the furthest end is behind its start. One
    sorted pass with the furthest end so far decides that, however long intervals are and however many lie on each other.
    A row with a null place overlaps nothing.
    """
    # kind 0 comes before kind 1: an interval that starts at a row's end does not start before it
    asked = left.withColumns({"_at": F.col("end"), "_kind": F.lit(0)})
    marks = right.filter("chrom IS NOT NULL AND r_start IS NOT NULL").select("chrom", F.col("r_start").alias("_at"), F.lit(1).alias("_kind"), F.col("r_end").alias("_reach"))
    found = _swept(asked.unionByName(marks, allowMissingColumns=True), F.max, "_reach").filter("_kind = 0")
    hit = F.coalesce(F.col("_reach") > F.col("start"), F.lit(False))
    return found.filter(hit if inside else ~hit).select(*left.columns)


def overlap_totals(sites: DataFrame, track: DataFrame, value: str) -> DataFrame:
    """``site_id, n, total``: how many intervals of ``track`` (chrom, start, end) overlap each site (site_id, chrom, start,
    end), and the sum of ``value``, whole numbers; sites without any are left out.

    They are those that start before the site's end, less those that end at its start or before: running sums of a
    sorted pass, in which no pair is made. An empty interval overlaps those that reach beyond it on both sides. What
    ends before it starts is no interval.
    """
    known, bare = "chrom IS NOT NULL AND start <= end", F.col("start") == F.col("end")
    event = lambda at, kind, **sums: F.struct(F.col(at).alias("_at"), kind.alias("_kind"), *(F.coalesce(v, F.lit(0)).cast("bigint").alias(c) for c, v in sums.items()))
    none, one = F.lit(0), F.lit(1)
    # at one place: ends, starts of empty sites, ends of empty intervals, starts of sites, then ends of sites, starts
    begins = event("start", F.lit(5), _n=one, _v=F.col("_value"), _gone=none, _gone_v=none)
    stops = event("end", F.when(bare, 2).otherwise(0), _n=none, _v=none, _gone=one, _gone_v=F.col("_value"))
    marks = track.filter(known).withColumn("_value", F.expr(value)).select("chrom", F.explode(F.array(begins, stops)).alias("e")).select("chrom", "e.*")
    asked = sites.filter(known).select("site_id", "chrom", F.explode(F.array(event("start", F.when(bare, 1).otherwise(3)), event("end", F.lit(4)))).alias("e")).select("site_id", "chrom", "e.*")
    found = _swept(asked.unionByName(marks, allowMissingColumns=True), F.sum, "_n", "_v", "_gone", "_gone_v").filter("_kind IN (1, 3, 4)")
    part = lambda begun, gone: F.sum(F.when(F.col("_kind") == 4, F.coalesce(begun, F.lit(0))).otherwise(-F.coalesce(gone, F.lit(0))))
    return found.groupBy("site_id").agg(part("_n", "_gone").alias("n"), part("_v", "_gone_v").alias("total")).filter("n > 0")


def tags_of_overlaps(sites: DataFrame, regions: DataFrame, none: str = "unknown", width: int = BIN) -> DataFrame:
    """``sites`` (site_id, chrom, start, end) with ``origin``: all tags of overlapping regions (chrom, start, end, origin),
    distinct, in order, joined by semicolons; ``none`` without any. Null and empty tags are left out."""
    right = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "origin").filter("origin IS NOT NULL")
    pairs = overlap_join(sites.select("site_id", "chrom", "start", "end"), right, width=width)
    tags = pairs.select("site_id", F.explode(F.split("origin", ";")).alias("tag")).withColumn("tag", F.trim("tag")).filter("tag <> ''")
    found = tags.groupBy("site_id").agg(F.array_join(F.array_sort(F.collect_set("tag")), ";").alias("origin"))
    return sites.join(found, "site_id", "left").withColumn("origin", F.coalesce("origin", F.lit(none)))


def asof_overlap(sites: DataFrame, track: DataFrame, payload: list[str]) -> DataFrame:
    """For each site the last interval that starts at or before it, if it ends after the site's start: a struct ``hit``, or null.

    Among equal starts the larger end is last, then the larger first payload. Earlier intervals that reach further
    are not looked at; :func:`first_overlap` does that.
    """
    return asof_overlaps(sites, {"hit": (track, payload)})


def asof_overlaps(sites: DataFrame, tracks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """As :func:`asof_overlap` for several tracks in one sorted pass: a struct column for each, by its name."""
    names = [f"_h{i}" for i in range(len(tracks))]
    hits = [F.expr(f"named_struct('end', end, {', '.join(f'{chr(39)}{c}{chr(39)}, {c}' for c in payload)})") for _, payload in tracks.values()]
    marks = [track.select("chrom", F.col("start").alias("at"), F.lit(0).alias("kind"), hit.alias(name)) for (track, _), hit, name in zip(tracks.values(), hits, names)]
    both = sites.select("chrom", F.col("start").alias("at"), F.lit(1).alias("kind"), F.struct("*").alias("site"))
    for rows in marks:
        both = both.unionByName(rows, allowMissingColumns=True)
    both = _stretched(both, "at")
    # what a stretch begins with: of each track the last interval of the stretches before
    last = [F.max(F.when(F.col(n).isNotNull(), F.struct("at", n))).alias(n) for n in names]
    each = both.groupBy("chrom", "_s").agg(*last)
    before = each.select("chrom", "_s", *(F.last(n, ignorenulls=True).over(_before())[n].alias(f"_c{n}") for n in names))
    order = Window.partitionBy("chrom", "_s").orderBy("at", "kind", *names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.join(before, ["chrom", "_s"])
    found = found.select("at", "kind", "site", *(F.coalesce(F.last(n, ignorenulls=True).over(order), F.col(f"_c{n}")).alias(n) for n in names)).filter("kind = 1")
    return found.select("site.*", *(F.when(F.col(f"{n}.end") > F.col("at"), F.col(n)).alias(c) for n, c in zip(names, tracks)))


def first_overlap(sites: DataFrame, track: DataFrame, payload: list[str], width: int = BIN) -> DataFrame:
    """As :func:`asof_overlap`, but among all intervals that overlap the site the one with the largest start, end, payload."""
    right = track.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.struct("end", *payload).alias("_hit"))
    pairs = overlap_join(sites.select("site_id", "chrom", "start", (F.col("start") + 1).alias("end")), right, width=width)
    best = pairs.groupBy("site_id").agg(F.max(F.struct("r_start", "_hit")).alias("best")).select("site_id", F.col("best._hit").alias("hit"))
    return sites.join(best, "site_id", "left")


def merge(df: DataFrame, names: str | None = None) -> DataFrame:
    """Overlapping and touching intervals become one; ``names``: a column whose distinct values are joined by commas."""
    by = Window.partitionBy("chrom", "_s").orderBy("start", "end")
    rows = _carried(_stretched(df.filter("end > start")), F.max("end"), F.max("_v"))
    reach = F.greatest(F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.col("_c"))
    first = F.when(F.coalesce(F.col("start") > reach, F.lit(True)), F.col("start"))
    rows = _carried(rows.withColumn("_first", first).drop("_c"), F.max("_first"), F.last("_v", ignorenulls=True))
    # an island is named by its first start
    island = F.coalesce(F.last("_first", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.col("_c"))
    out = [F.min("start").alias("start"), F.max("end").alias("end")]
    if names:
        out.append(F.array_join(F.array_sort(F.collect_set(names)), ",").alias(names))
    return rows.withColumn("_island", island).groupBy("chrom", "_island").agg(*out).drop("_island")


def subtract(left: DataFrame, right: DataFrame, width: int = BIN) -> DataFrame:
    """What is left of each interval of ``left`` outside ``right`` (chrom, start, end).

    A row gives one row for each remaining piece, with its other columns. Rows of one interval are cut alike.
    """
    holes = merge(right).select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    place = ["chrom", "start", "end"]
    cut = overlap_join(left.select(*place).distinct(), holes, width=width)
    found = cut.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("r_start", "r_end"))).alias("_holes"))
    rows = left.join(found, place, "left").select(*left.columns, "_holes")
    starts = F.concat(F.array("start"), F.coalesce(F.expr("transform(_holes, h -> h.r_end)"), F.array().cast("array<bigint>")))
    ends = F.concat(F.coalesce(F.expr("transform(_holes, h -> h.r_start)"), F.array().cast("array<bigint>")), F.array("end"))
    rows = rows.withColumn("_piece", F.explode(F.arrays_zip(starts.alias("s"), ends.alias("e")))).filter("_piece.e > _piece.s")
    return rows.withColumn("start", F.col("_piece.s")).withColumn("end", F.col("_piece.e")).drop("_piece", "_holes")


def depth(df: DataFrame) -> DataFrame:
    """``chrom, start, end, depth``: stretches of equal depth above 0, from a sweep over starts and ends."""
    edges = df.filter("end > start").select("chrom", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step")))).alias("e"))
    # without places at which as many start as end, neighbouring stretches differ in depth
    steps = edges.groupBy("chrom", F.col("e.at").alias("start")).agg(F.sum("e.step").alias("step")).filter("step <> 0")
    rows = _stretched(steps)
    each = rows.groupBy("chrom", "_s").agg(F.sum("step").alias("_v"), F.min("start").alias("_f"))
    after = F.lead("_f").over(Window.partitionBy("chrom").orderBy("_s"))
    rows = rows.join(each.select("chrom", "_s", F.coalesce(F.sum("_v").over(_before()), F.lit(0)).alias("_c"), after.alias("_next")), ["chrom", "_s"])
    by = Window.partitionBy("chrom", "_s").orderBy("start")
    depth_ = F.col("_c") + F.sum("step").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = rows.select("chrom", "start", F.coalesce(F.lead("start").over(by), F.col("_next")).alias("end"), depth_.alias("depth"))
    return swept.filter("depth > 0")


def deep(df: DataFrame, above: int) -> DataFrame:
    """Merged stretches of a depth above a threshold."""
    return merge(depth(df).filter(F.col("depth") > above).select("chrom", "start", "end"))


def start_site(start: Column, end: Column, strand: Column) -> tuple[Column, Column]:
    """The one-base interval at which a transcript starts."""
    at = F.when(strand == "+", start).otherwise(end - 1)
    return at, at + 1
