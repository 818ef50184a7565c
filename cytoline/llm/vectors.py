"""Vectors as integers: what whitening and top-k search share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column


def integers(df: DataFrame, vec_col: str, scale: int, offset: int = 0) -> tuple[Column, Column]:
    """Whether a row's vector takes part, and the vector as longs: ``floor(scale * entry) + offset``, entries as doubles.

    A null vector, one with a null entry and one with an entry that is not finite take no part. An entry that is finite
    but beyond what a long holds is an error when it is read, as in any arithmetic of the session.
    """
    vec = column(df, vec_col).cast("array<double>")
    finite = F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))), F.lit(False))
    return finite, F.transform(vec, lambda c: F.floor(F.lit(float(scale)) * c) + F.lit(offset).cast("long"))


def most_common_size(rows: DataFrame, x: str = "x") -> tuple[int, int]:
    """How many entries most vectors have (of sizes equally common the larger one), and how many vectors have so many."""
    sizes = rows.groupBy(F.size(x).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d"))
    most = sizes.head()
    return (most["d"], most["n"]) if most else (0, 0)


def matrix(lists: pa.Array, d: int) -> np.ndarray:
    """A column of lists of ``d`` longs each, none null, as rows by entries."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), d)
