"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A stable key is hashed to 64 bits and jumps between shards of growing tables; no ring is stored, and appending
a shard moves only the share of keys that the new shard must take.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, settle

#: Pieces into which each shard's rows are cut to number them without bringing a shard into one task.
PIECES = 1024


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, among ``shards``."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = keys.astype(np.uint64, copy=True)
    at, nxt = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            at[live] = nxt[live]
            state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
            step = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
            nxt[live] = ((at[live] + 1) * (float(1 << 31) / step)).astype(np.int64)
            live = live[nxt[live] < shards]
    return at.astype(np.int32)


def shard_of(key_hash: Column, shards: int) -> Column:
    """The jump shard of a long column of key hashes."""

    @F.arrow_udf("int")
    def place(hashes: pa.Array) -> pa.Array:
        return pa.array(jump(hashes.to_numpy(zero_copy_only=False).view(np.uint64), shards), pa.int32())

    return place(key_hash)


def assign(docs: DataFrame, shards: int, key_cols: list[str]) -> DataFrame:
    """All columns of ``docs`` as struct ``doc``, with ``shard``: a function of the key columns and ``shards`` only.

    Null keys are keys as well. Rows that repeat a key share its shard. Empty tables give empty results.
    """
    key = F.xxhash64(*(column(docs, c) for c in key_cols))
    return docs.select(F.struct("*").alias("doc"), key.alias("key")).withColumn("shard", shard_of(F.col("key"), shards)).drop("key")


def layout(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each row goes: ``id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus one (null: one). ``slot`` numbers the rows of a shard from 0 without gaps.
    ``grown_shard`` is the shard when one more is appended: the old one or the new one, never another.
    Null ids share the key of a null. Equal ids share a shard and get slots of their own, in order of checksum and size.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(
        column(docs, id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(column(docs, id_col)).alias("key"),
    )
    rows = rows.withColumn("shard", shard_of(F.col("key"), shards)).withColumn("grown_shard", shard_of(F.col("key"), shards + 1))
    rows = settle(rows.withColumn("piece", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(PIECES)).cast("int")))
    # Each piece starts after the pieces before it: a sum over PIECES rows a shard, not over the shard's rows.
    counts = rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("within", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "piece"]).select(
        "id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("within")).cast("long").alias("slot"), "grown_shard"
    )
