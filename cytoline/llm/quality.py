"""A quality classifier by compression: dictionaries of good and of bad text, and which of them a text fits better.

Each block of a text is compressed with either dictionary; the difference of the compressed sizes, divided by the
text's size, is turned into a probability by a logistic fit on labelled examples, each compared with dictionaries that
were made without it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ready, settle
from .labelled import held_out, platt, sample

#: Bounds of what is learned from: labelled examples of each class, and bytes of a dictionary. Of a text with more than
#: 1/SHARE of a dictionary's bytes so many go in, in blocks from all over it. Examples are calibrated in so many folds.
PER_CLASS, DICTIONARY, SHARE, PARTS = 4096, 512 << 10, 8, 4
#: A text is compressed in blocks, so that a long one is judged by the dictionaries and not by its own repetitions.
BLOCK, LEVEL = 1024, 6
#: Added to a text's bytes, so that a few bytes of difference say little about a very short text.
SMOOTH = 64


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    slope: float
    intercept: float


class Scorer:
    def __init__(self, bad: bytes, good: bytes) -> None:
        self.bad, self.good = self._compressor(bad), self._compressor(good)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)

    def difference(self, text: str) -> float:
        """Compressed size with the bad dictionary minus that with the good one, for each byte of the whole text."""
        data, total = text.encode(), 0
        bad, good = self.bad.compress, self.good.compress
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            total += len(bad(block)) - len(good(block))
        return total / (len(data) + SMOOTH)


def difference(text: Column, bad: bytes, good: bytes) -> Column:
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = ready(("quality", hash(bad), hash(good)), lambda: Scorer(bad, good))
        for texts in batches:
            yield pa.array([own.difference(t.as_py() or "") for t in texts], pa.float64())

    return run(text)


def share_of(data: bytes) -> bytes:
    """What a text gives to a dictionary: all of it, or of a longer one the blocks with the smallest checksums, in order."""
    most = DICTIONARY // SHARE
    if len(data) <= most:
        return data
    blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
    picked = sorted(range(len(blocks)), key=lambda i: (zlib.crc32(blocks[i]), i))[: most // BLOCK]
    return b"".join(blocks[i] for i in sorted(picked))


def shares(text: Column) -> Column:
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([share_of(t.as_py().encode()) for t in texts], pa.binary())

    return run(text)


def chosen(rows: list[tuple[int, int, int, int]], without: int = -1) -> tuple[list[int], list[int]]:
    """Which examples, of (place, label, bytes, fold) in order, make the dictionaries of both labels: as many bytes of each."""
    own = [[(at, n) for at, c, n, fold in rows if c == label and fold != without and n] for label in (0, 1)]
    budget = min(DICTIONARY, *(sum(n for _, n in o) for o in own))
    out: tuple[list[int], list[int]] = [], []
    for picked, examples in zip(out, own):
        left = budget
        for at, n in examples:
            if n <= left:
                picked.append(at)
                left -= n
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from rows that are not held out; at most ``PER_CLASS`` examples of each class are read, in whole.

    Texts fill the dictionaries in order of a hash, both up to the same size; equal texts go in once, long ones in blocks
    from all over them, so that none takes more than a share of a dictionary and none is left out for its size. To
    calibrate, each example is compared with dictionaries of other examples only. Rows that repeat an id are
    examples each; null texts are empty. Without text of both classes every score is the smoothed share of 1s.
    """
    examples, counts = sample(docs, labels, label, PER_CLASS, id_col, text_col)
    content = F.xxhash64("text")
    fold = F.pmod(content, F.lit(PARTS)).cast("int")
    examples = settle(examples.select("id", "label", "text", content.alias("content"), fold.alias("fold")))
    # equal texts are in one fold and count once
    light = examples.groupBy("label", "content", "fold").agg(F.min(F.least(F.octet_length("text"), F.lit(DICTIONARY // SHARE))).alias("n")).orderBy("content", "label").collect()
    rows = [(at, r["label"], r["n"], r["fold"]) for at, r in enumerate(light)]
    choices = {f: chosen(rows, f) for f in (-1, *range(PARTS))}
    wanted = {light[at]["content"] for pair in choices.values() for own in pair for at in own}
    n = sum(counts.values())
    if not all(choices[-1]):
        share = (counts.get(1, 0) + 1) / (n + 2)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    spark = docs.sparkSession
    keys = F.broadcast(spark.createDataFrame([(k,) for k in wanted], "content long"))  # at most 2 * PER_CLASS
    found = examples.join(keys, "content").groupBy("content").agg(F.min("text").alias("text"))
    texts = {r["content"]: bytes(r["own"]) for r in found.select("content", shares(F.col("text")).alias("own")).collect()}
    made = {f: [b"".join(texts[light[at]["content"]] for at in own) for own in pair] for f, pair in choices.items()}
    probes = [examples.filter(F.col("fold") == f).select("label", difference(F.col("text"), *made[f]).alias("d")) for f in range(PARTS) if min(map(len, made[f])) >= 8]
    probe = reduce(DataFrame.unionByName, probes).collect() if probes else []
    if len({r["label"] for r in probe}) < 2:  # too few to set any aside
        probe = examples.select("label", difference(F.col("text"), *made[-1]).alias("d")).collect()
    y = np.array([r["label"] for r in probe], float)
    seen = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weights = np.where(y == 1, counts.get(1, 0) / seen[1], counts.get(0, 0) / seen[0])
    slope, intercept = platt(np.array([r["d"] for r in probe]), y, weights)
    return Model(*made[-1], float(slope), float(intercept))


def probability(text: Column, model: Model) -> Column:
    """The calibrated probability of label 1 for each whole text; null texts are empty, and empty texts have difference 0."""
    if not model.bad:
        return F.lit(1.0 / (1.0 + float(np.exp(-model.intercept))))
    value = difference(F.coalesce(text, F.lit("")), model.bad, model.good)
    return 1.0 / (1.0 + F.exp(-(value * model.slope + model.intercept)))


def score(docs: DataFrame, model: Model, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` for each row; equal texts score equally, empty tables give empty results."""
    ident = column(docs, id_col)
    rows = docs.select(ident.alias("id"), held_out(ident).alias("held_out"), probability(column(docs, text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
