"""Labelled examples for the classifiers: a bounded, reproducible sample of the rows that may be learned from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

#: One row in this many is held out: those whose checksum of the id, written as text, is divisible by it.
FOLDS = 5


def held_out(ident: Column) -> Column:
    """Whether a row is held out. A null id has no label and counts as held out."""
    return F.coalesce(F.crc32(ident.cast("string")) % FOLDS == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str, text_col: str) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` examples of each label that are not held out: ``id, text, label``; and how many there are.

    The choice depends on a hash of the id alone. An id labelled more than once counts as 1 if any label is. Null
    labels are left out. Only the chosen ids, at most twice ``per_class``, are broadcast to find their texts. They go to
    Spark as an Arrow table: a list would be read by Python workers of a second kind, which stay in the executors' memory.
    """
    known = (
        labels.select(column(labels, "doc_id").alias("id"), column(labels, label).cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [
        (r["id"], r["label"])
        for c in (0, 1)
        for r in known.filter(F.col("label") == c).orderBy(F.xxhash64("id", F.lit(label)), "id").limit(per_class).collect()
    ]
    own = pa.table({n: pa.array([c[i] for c in chosen], t) for i, (n, t) in enumerate((("id", pa.int64()), ("label", pa.int32())))})
    ids = docs.sparkSession.createDataFrame(own, "id long, label int")
    texts = docs.select(column(docs, id_col).alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "id"), counts


def platt(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slopes and, last, the intercept of a weighted logistic fit of labels on one value a row, or several.

    The fit is slightly shrunk and found by Newton's method.
    """
    values = values.reshape(len(labels), -1)
    weights = weights / weights.sum()
    center = weights @ values
    scale = np.sqrt(weights @ (values - center) ** 2)
    scale[scale == 0] = 1.0
    x = np.concatenate([(values - center) / scale, np.ones((len(values), 1))], 1)
    weights = weights * len(labels)
    beta, ridge = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weights * (labels - p)) - ridge @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / scale
    return np.append(slopes, beta[-1] - slopes @ center)
