"""Exact top-k search by inner product: MaxScore over shards of vectors, merged.

A shard's index has two terms for each dimension, one for the rows that are positive there and one for those that are
negative, with the largest impact of each. Of a query's terms those on its own side add to a score and are bounded by
weight times largest impact; those on the other side only take away and are bounded by 0. In order of their bounds the
first terms that together stay below the k-th best score so far are non-essential: a row that is in no other term
cannot enter. The lists of the other, essential terms are traversed; non-essential terms are then probed for those rows
alone that can still reach the k-th best, the widest bounds first, and the terms that take away last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column
from .vectors import integers, matrix, most_common_size

#: Rows of a shard and queries of a group, on average: what one task holds at once (some 4 MB each at 64 dimensions).
SHARD_ROWS, GROUP_QUERIES = 8_192, 8_192
#: A term that has more than this share of a shard's rows is held as an array over all of them, not as a list.
DENSE = 0.125
#: Rows scored in full to begin with, and again among the most promising ones, so that the k-th best is known early.
FIRST, BEST = 256, 64


class Shard:
    """The index of some vectors: rows by dimensions, in order of preference among equal scores."""

    def __init__(self, x: np.ndarray):
        self.x = np.ascontiguousarray(x.T)
        self.size = x.shape[0]
        self.most = int(np.abs(self.x).max(initial=0))
        self.terms: dict[tuple[int, int], tuple[np.ndarray | None, np.ndarray, int]] = {}
        for j, values in enumerate(self.x):
            for side in (1, -1):
                impacts = np.maximum(values * side, 0)
                rows = np.flatnonzero(impacts)
                if len(rows) > DENSE * self.size:
                    self.terms[j, side] = (None, impacts, int(impacts.max()))
                elif len(rows):
                    self.terms[j, side] = (rows, impacts[rows], int(impacts[rows].max()))

    def best(self, query: np.ndarray, k: int, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the query's ``k`` best, best first; equal scores in order of rows. ``left_out`` marks rows
        that are no candidates."""
        if int(np.abs(query).max(initial=0)) * self.most * max(len(query), 1) >= 2**62:
            raise ArithmeticError("an inner product does not fit a long")
        allowed = np.ones(self.size, bool) if left_out is None else ~left_out
        if allowed.sum() <= k:
            rows = np.flatnonzero(allowed)
            return self._first(rows, query @ self.x[:, rows], k)
        floor = self._kth(query, np.flatnonzero(allowed)[:FIRST], k)
        gains, losses = [], []
        for j in np.flatnonzero(query):
            weight, side = abs(int(query[j])), 1 if query[j] > 0 else -1
            if term := self.terms.get((int(j), side)):
                gains.append((weight * term[2], weight, term))
            if term := self.terms.get((int(j), -side)):
                losses.append((weight * term[2], int(j)))
        gains.sort(key=lambda g: g[0])
        reach = np.cumsum([0] + [g[0] for g in gains])
        # Terms before `split` together stay below the floor; with none essential, every row is probed.
        split = int(np.searchsorted(reach[1:], floor, side="left")) if floor > 0 else 0
        score = np.zeros(self.size, np.int64)
        for _, weight, (rows, impacts, _) in gains[split:]:
            if rows is None:
                score += weight * impacts
            else:
                score[rows] += weight * impacts
        # A row in no essential term reaches less than the floor, so it needs no test of its own.
        rows = np.flatnonzero(allowed & (score + reach[split] >= floor))
        if len(rows) > BEST:
            promising = rows[np.argpartition(-score[rows], BEST - 1)[:BEST]]
            floor = max(floor, self._kth(query, promising, k))
        score = score[rows]
        for at in range(split - 1, -1, -1):
            keep = score + reach[at + 1] >= floor
            rows, score = rows[keep], score[keep]
            _, weight, (listed, impacts, _) = gains[at]
            score = score + weight * (impacts[rows] if listed is None else self._found(listed, impacts, rows))
        for _, j in sorted(losses, reverse=True):
            keep = score >= floor
            rows, score = rows[keep], score[keep]
            score = score + np.minimum(query[j] * self.x[j, rows], 0)
        return self._first(rows, score, k)

    def _kth(self, query: np.ndarray, rows: np.ndarray, k: int) -> int:
        """The k-th best full score of these rows: no better row can be missed by staying at or above it."""
        if len(rows) < k:
            return np.iinfo(np.int64).min // 2
        return int(np.partition(query @ self.x[:, rows], len(rows) - k)[len(rows) - k])

    @staticmethod
    def _found(listed: np.ndarray, impacts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(listed, rows), len(listed) - 1)
        return np.where(listed[at] == rows, impacts[at], 0)

    @staticmethod
    def _first(rows: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((rows, -score))[:k]
        return rows[order], score[order]


def search(queries: DataFrame, rows: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """For each vector of ``queries`` its ``k`` highest inner products with vectors of ``rows`` that have another id:
    ``query_id, rank, id, score``, ranks from 1, equal scores by smaller id, all candidates where there are fewer.

    Entries are taken as ``floor(scale * entry)``. Vectors that are null or hold a null or an entry that is not finite
    take no part, nor do those with another number of entries than most vectors of ``rows``. A null id is a candidate
    (after others of equal score) and a query like any other; it is not its own candidate. Queries that repeat an id and a vector are
    answered once. Candidates that repeat an id and a vector take a rank for each row. Empty tables give empty results.

    Equal candidates are counted before they meet, so copies of one row make no task heavy. Shards and groups of queries
    meet in a grid: each cell holds one of either, so a task's memory does not depend on the number of rows or queries.
    """
    good, x = integers(rows, vec_col, scale)
    found = rows.filter(good).select(column(rows, id_col).alias("id"), x.alias("x"))
    d, n = most_common_size(found)
    found = found.filter(F.size("x") == d).groupBy("id", "x").agg(F.count(F.lit(1)).alias("copies"))
    good, x = integers(queries, vec_col, scale)
    asked = queries.filter(good).select(column(queries, id_col).alias("query_id"), x.alias("q")).filter(F.size("q") == d).distinct()
    shards, groups = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked.count() // GROUP_QUERIES))
    part = lambda count, *names: F.pmod(F.xxhash64(*names), F.lit(count)).cast("int")
    found = found.withColumn("shard", part(shards, "id", "x")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # Cells are numbered and told apart by their hash, not by their number of rows.
    asked = asked.withColumn("group", part(groups, "query_id", "q")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    kind = found.schema["id"].dataType.simpleString()
    asked_kind = asked.schema["query_id"].dataType.simpleString()

    def of_cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("query_id", "at", "id", "score", "copies")}
        if left.num_rows and right.num_rows:
            right = right.sort_by([("id", "ascending")])  # nulls last
            ids, vectors = left.column("query_id").combine_chunks(), matrix(left.column("q"), d)
            shard, theirs = Shard(matrix(right.column("x"), d)), right.column("id").combine_chunks()
            copies = right.column("copies").to_numpy()
            own = {}
            for row, value in enumerate(theirs.to_pylist()):
                own.setdefault(value, []).append(row)
            for at, (ident, query) in enumerate(zip(ids.to_pylist(), vectors)):
                mask = None
                if ident in own:
                    mask = np.zeros(shard.size, bool)
                    mask[own[ident]] = True
                best, score = shard.best(query, k, mask)
                out["query_id"].append(np.full(len(best), at))
                out["id"].append(best)
                out["score"].append(score)
            at = np.concatenate(out["query_id"])
            best = np.concatenate(out["id"])
            return pa.table({"query_id": ids.take(pa.array(at)), "q": left.column("q").combine_chunks().take(pa.array(at)), "id": theirs.take(pa.array(best)),
                             "score": pa.array(np.concatenate(out["score"])), "copies": pa.array(np.minimum(copies[best], k))})
        return pa.table({"query_id": left.column("query_id").slice(0, 0), "q": left.column("q").slice(0, 0), "id": right.column("id").slice(0, 0),
                         "score": pa.array([], pa.int64()), "copies": pa.array([], pa.int64())})

    cells = asked.groupBy("shard", "group").cogroup(found.groupBy("shard", "group"))
    scored = cells.applyInArrow(of_cell, f"query_id {asked_kind}, q array<long>, id {kind}, score long, copies long")
    # Merging the shards: k rows of each, whatever their size. Queries that share an id but not the vector stay apart.
    scored = scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rank = F.row_number().over(Window.partitionBy("query_id", F.xxhash64("q"), "q").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
