"""Exact deduplication by two-pass Bloom filtering, in DataFrame operations only.

Pass one digests every normalised text and sets bits of a Bloom filter wherever two rows fall on one bit.
Pass two reads the filter: a row with an unset bit has a text of its own and passes straight through; only
the rows that may be repeated are shuffled, grouped by digest and compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_positions, bit_table, column, filter_bits, fresh, probe_bits, settle


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", log_bits: int | None = None) -> DataFrame:
    """For each row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the most code points stays, then the one with the smallest id; null ids come last.
    Rows that repeat an id and a text wholly count as copies; exactly one of them is kept.
    Null and blank texts are equal to each other. An empty table gives an empty result. Other columns are not read.
    ``log_bits`` sets the size of the filter, which otherwise follows the number of rows; see :func:`filter_bits`.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    light = settle(
        docs.select(
            column(docs, id_col).alias("id"),
            F.unhex(F.sha2(normalised(column(docs, text_col)), 256)).alias("sha"),
            F.char_length(text).cast("long").alias("chars"),
        )
        .withColumn("key", F.xxhash64("sha"))
        .withColumn("row", F.monotonically_increasing_id())
    )

    log_bits = log_bits or filter_bits(light.count())
    # Pass one: a bit is set where at least two rows fall on it; counts are summed before they are shuffled.
    shared = (
        light.select(F.explode(bit_positions(F.col("key"), log_bits)).alias("bit"))
        .groupBy("bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    )
    # Pass two: rows with an unset bit go straight through.
    probed = probe_bits(light, "key", bit_table(shared, "bit"), log_bits, "maybe")
    alone = probed.filter(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha", "row"
    )
    maybe = probed.filter("maybe").drop("maybe", "key")
    order = F.struct((-F.col("chars")).alias("short"), F.col("id").isNull().alias("none"), "id", "row")
    # One row for each digest. Settled, so that the join below shuffles both sides and can split a hot digest.
    groups = settle(maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")))
    joined = maybe.join(groups, "sha").select(
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "sha", "row"
    )
    return alone.unionByName(joined).select(
        "id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", log_bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever those are called.

    The same filter decides; rows with a text of their own are not shuffled. Ties and nulls as in :func:`mark`.
    """
    key, maybe, order = fresh(docs, "key", "maybe", "order")
    log_bits = log_bits or filter_bits(docs.count())
    text = F.coalesce(column(docs, text_col), F.lit(""))
    body = F.unhex(F.sha2(normalised(column(docs, text_col)), 256))
    hashed = docs.select(F.struct("*").alias("doc"), body.alias("sha"), F.xxhash64(body).alias("key"),
                         F.char_length(text).cast("long").alias("chars"), column(docs, id_col).alias("id"))
    shared = (
        hashed.select(F.explode(bit_positions(F.col("key"), log_bits)).alias("bit"))
        .groupBy("bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    )
    probed = probe_bits(hashed, "key", settle(bit_table(shared, "bit")), log_bits, "maybe")
    alone = probed.filter(~F.col("maybe")).select("doc")
    rank = F.struct((-F.col("chars")).alias("short"), F.col("id").isNull().alias("none"), "id")
    # min_by keeps one whole document of each digest; partial aggregation thins a hot digest before the shuffle.
    best = probed.filter("maybe").groupBy("sha").agg(F.min_by("doc", rank).alias("doc")).select("doc")
    return alone.unionByName(best).select("doc.*")
