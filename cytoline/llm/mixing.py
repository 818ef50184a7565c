"""Mixing sources to target weights by capped water-filling.

Every source asks for words in proportion to its weight. A source that would pass its largest number of epochs is
clamped there and its excess is shared again by weight, until no source is above its clamp. Documents are then taken
in a seeded order: whole repetitions of a source first, the fractional one up to the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, column, settle

#: Hex digits of the seeded hash that cut a source into pieces, so that no source meets in one task.
DIGITS = 3
#: A table with a row for each source is broadcast up to this many rows of some 60 bytes.
FEW_SOURCES = 10_000


def words(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, weights: list[float], share: float, epochs: float) -> DataFrame:
    """``source, source_size`` with ``target`` added: one row for each source in, one out.

    Sources in order of code point, null last, take ``weights`` in turn. Targets sum to ``share`` times all sizes, as far
    as the clamps of ``epochs`` times a source's size allow. Sorted by how soon they fill, the sources before the water
    level are clamped and the rest share what is left by weight; that is the fixed point of the repeated sharing.
    """
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", rank.alias("rank"), weight.alias("weight")).withColumn("cap", epochs * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    clamped_before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    level = (share * F.sum("source_size").over(every) - clamped_before) / weight_left
    leveled = ranked.withColumn("level", level).withColumn("clamped", F.col("level") >= F.col("cap") / F.col("weight"))
    water = F.min_by("level", F.when(~F.col("clamped"), F.struct(F.col("cap") / F.col("weight"), F.col("rank")))).over(every)
    target = F.when(F.col("clamped"), F.col("cap")).otherwise(water * F.col("weight"))
    return leveled.select("source", "source_size", F.round(target, 6).alias("target"))


def plan(rows: DataFrame, weights: list[float], share: float, epochs: float, seed: int) -> DataFrame:
    """Add ``source_size, target, taken`` to rows of ``id, source, size`` (and others).

    Documents stand in order of a seeded hash. The hash's first digits cut a source into pieces; from the sums of pieces
    it follows in which one the fractional repetition ends. Rows of the pieces before it are taken, those after it are
    not, and only the rows of that one piece are shuffled and summed one by one.
    """
    rows = rows.withColumn("place", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("-"))).cast("binary")))
    rows = rows.withColumn("piece", F.substring("place", 1, DIGITS))
    pieces = settle(rows.groupBy("source", "piece").agg(F.sum("size").alias("n")))
    targets = water_fill(pieces.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, epochs)
    whole = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size"), 0).cast("long"))
    before = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(F.col("source").alias("s"), "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    reached = starts.join(targets, F.col("s").eqNullSafe(F.col("source"))).filter("start <= rest")
    ends = settle(
        reached.groupBy("s", "source_size", "target", "whole", "rest").agg(F.max(F.struct("piece", "start")).alias("end"))
        .select("s", "source_size", "target", "whole", "rest", F.col("end.piece").alias("end_piece"), F.col("end.start").alias("start"))
    )
    # One row for each source: broadcast if they are few, shuffled otherwise.
    ends = F.broadcast(ends) if ends.count() <= FEW_SOURCES else ends
    rows = rows.join(ends, F.col("source").eqNullSafe(F.col("s")))
    clear = rows.filter("piece <> end_piece").withColumn("part", F.when(F.col("piece") < F.col("end_piece"), F.col("size")).otherwise(F.lit(0).cast("long")))
    within = Window.partitionBy("source").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("start") - F.coalesce(F.sum("size").over(within), F.lit(0))
    cut = rows.filter("piece = end_piece").withColumn("part", F.greatest(F.lit(0).cast("long"), F.least("size", left)))
    both = clear.unionByName(cut).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    return both.drop("place", "piece", "s", "whole", "rest", "end_piece", "start", "part")


def mix(docs: DataFrame, weights: list[float], share: float, epochs: float = 2.0, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """For each row: ``id, source, size, source_size, target, taken``; ``taken`` counts repeated words.

    A null source is a source. A null or empty text has no words and takes none. Rows that repeat an id are rows of
    their own, in order of size. Empty tables give empty results; with no words at all every target is 0.
    """
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, source_col).alias("source"), words(column(docs, text_col)).alias("size"))
    return plan(rows, weights, share, epochs, seed)


def materialise(docs: DataFrame, weights: list[float], share: float, epochs: float = 2.0, seed: int = 0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: the columns of ``docs``, a row for each whole repetition and one for a fractional one.

    A fractional repetition keeps the first words of the text, up to the end of the last word taken; ``n_chars``, where
    the table has it, follows. Documents of which nothing is taken are left out; texts without words stay once.
    """
    rows = docs.select(F.struct("*").alias("doc"), column(docs, id_col).alias("id"), column(docs, source_col).alias("source"),
                       words(column(docs, text_col)).alias("size"))
    mixed = plan(rows, weights, share, epochs, seed)
    whole = F.when(F.col("size") > 0, F.expr("taken div greatest(size, 1)")).otherwise(F.lit(1).cast("long"))
    part = F.when(F.col("size") > 0, F.expr("taken % greatest(size, 1)")).otherwise(F.lit(0).cast("long"))
    takes = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.expr("array()").cast("array<bigint>")))
    out = mixed.select("doc", F.explode(takes).alias("words"))
    # Only the one document of a source at which its target ends is cut: at the end of its last word taken.
    units = F.split(F.col("doc")[text_col], r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(units, F.lit(1), F.greatest(F.col("words"), F.lit(0)).cast("int")), "")
    out = out.withColumn("cut", F.when(F.col("words") < 0, F.col("doc")[text_col]).otherwise(head))
    cols = []
    for name in docs.columns:
        if name == text_col:
            cols.append(F.col("cut").alias(name))
        elif name == "n_chars":
            cols.append(F.when(F.col("words") < 0, F.col("doc")[name]).otherwise(F.char_length("cut")).cast(docs.schema[name].dataType).alias(name))
        else:
            cols.append(F.col("doc")[name].alias(name))
    return out.select(*cols)
