"""What the operators of this subpackage share: tables, checkpoints, bounded bit filters."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoline.session import settle, shared_folder, ship  # noqa: F401

#: A word, everywhere in this subpackage: a run of anything but these six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables under ``sf_dir``, read by Spark so that any store works."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ready: dict = {}


def ready(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: one model at a time, so that stages do not add up."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = make()
    pa.default_memory_pool().release_unused()
    return _ready[key]


def give_back() -> None:
    """Return what this Python worker has freed to the system: workers wait, some of them for long, while others run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def sparing(run: Callable) -> Callable:
    """A task's function over batches that gives memory back at its end."""

    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def without_model(run: Callable) -> Callable:
    """As :func:`sparing`, for a function that needs no model: one that an earlier stage left in the worker goes."""

    @wraps(run)
    def whole(batches):
        _ready.clear()
        return (yield from sparing(run)(batches))

    return whole


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, at most so many rows go to a Python worker at once; for steps that run inside, with heavy rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, whatever characters the name has."""
    return df["`" + name.replace("`", "``") + "`"]


def filter_bits(rows: int, most: int = 26) -> int:
    """Bits, as a power of two, of each array of a filter for so many keys: eight a key, which one key in sixty passes by
    chance, up to ``most`` (a broadcast of 2**21 rows of two longs). A fuller filter only passes more rows on."""
    return max(16, min(most, (8 * max(1, rows) - 1).bit_length()))


def bit_positions(key: Column, log_bits: int) -> Column:
    """Two bit positions of a 64-bit key, each in a bit array of its own with 2**log_bits bits."""
    mask = F.lit((1 << log_bits) - 1).cast("long")
    low = key.bitwiseAND(mask)
    high = F.shiftrightunsigned(key, 64 - log_bits).bitwiseAND(mask) + F.lit(1 << log_bits).cast("long")
    return F.array(low, high)


def bit_table(positions: DataFrame, bit: str) -> DataFrame:
    """Pack bit positions into (slot, bits) rows of 64 bits; at most 2**(log_bits + 1) / 64 rows exist."""
    slot = F.shiftright(F.col(bit), 6).alias("slot")
    one = F.expr(f"shiftleft(1L, cast(`{bit}` & 63L as int))")
    return positions.select(slot, one.alias("one")).groupBy("slot").agg(F.bit_or("one").alias("bits"))


def probe_bits(df: DataFrame, key: str, bits: DataFrame, log_bits: int, out: str) -> DataFrame:
    """Add the boolean ``out``: both bits of ``key`` are set.

    ``bits`` is broadcast. Its size has a fixed bound, whatever the input: 2**(log_bits - 5) rows of two longs.
    """
    first, second = (F.element_at(bit_positions(F.col(key), log_bits), i) for i in (1, 2))
    for i, at in enumerate((first, second)):
        df = df.withColumn(f"__at{i}", at)
        side = F.broadcast(bits.select(F.col("slot").alias(f"__slot{i}"), F.col("bits").alias(f"__bits{i}")))
        df = df.join(side, F.shiftright(df[f"__at{i}"], 6) == F.col(f"__slot{i}"), "left")
    hit = lambda i: F.expr(f"coalesce(shiftrightunsigned(__bits{i}, cast(__at{i} & 63L as int)) & 1L, 0L) = 1L")
    return df.withColumn(out, hit(0) & hit(1)).drop(*(f"{n}{i}" for n in ("__at", "__slot", "__bits") for i in (0, 1)))
