"""Toxicity by nearest labelled examples: exact TF-IDF cosine, found through block-max inverted indexes.

Labelled examples are kept in blocks. For every term the index has, block by block, the examples with it and the
largest weight among them. A query bounds each block's cosine by those maxima, visits the blocks from the best bound
down, and stops once no bound can reach the k-th best cosine found: the result is exact. The nearest examples vote,
the nearer the more; the vote is calibrated on the examples themselves, each without itself and its near copies. All
terms of all examples are indexed and have weight: a term's is its TF-IDF times a factor that grows with how far its
document frequencies differ between the classes. One search gives both the vote and the evidence for it. Texts are
searched for in batches: where the bounds of many texts leave many blocks open, those are read by one product of
matrices in single precision, and what can be among the nearest is summed again in full.
"""

from __future__ import annotations

import math
import pickle
import re
import tempfile
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, ready, settle, sparing
from .labelled import held_out, platt, sample

#: Bound of what is learned from: labelled examples of each class.
PER_CLASS = 4096
#: A term's factor is (1 + chi-squared between the classes) / (1 + CHI), chi-squared counting up to CHI.
CHI = 100.0
#: A term in one of so many examples has a row of weights; the cosine from which an example is a near copy of another.
COMMON, COPY = 16, 0.9
#: Examples in a block of the index; blocks that are read first; neighbours that vote; what is added to each side's votes.
BLOCK, FIRST, NEIGHBOURS, PRIOR = 64, 4, 30, 0.2
#: Where the bound of a block in eight is above this share of the best one, blocks are not read one after the other.
FLAT = 0.6
#: Texts that are searched for together; what a sum in single precision can be off at most.
TOGETHER, SLACK = 64, 1e-4
#: Bytes of the header of an index file, and of the pieces in which it travels.
HEADER, PIECE = 4096, 4 << 20
#: Answers that a worker remembers, by the checksum of the text.
REMEMBERED = 20_000
TERM = re.compile(r"[^\W_]+")


def terms(text: str) -> list[str]:
    """The words of a text in lower case."""
    return TERM.findall(text.lower())


class Postings:
    """Examples as unit vectors over numbered terms, in blocks, as an inverted index.

    Terms in many examples have the lowest numbers: each has a row of weights, example by example, and the largest
    weight of each block. Of any other term only the examples with it are stored, and their weights.
    """

    #: Arrays that an index file holds.
    STORED = ("idf", "starts", "examples", "values", "row_of", "rows", "best")

    def __init__(self, idf: np.ndarray, starts: np.ndarray, examples: np.ndarray, values: np.ndarray, row_of: np.ndarray, rows: np.ndarray, best: np.ndarray) -> None:
        self.idf, self.starts, self.examples, self.values = idf, starts, examples, values
        self.row_of, self.rows, self.best, self.common = row_of, rows, best, len(row_of)
        self.blocks = best.shape[1]
        self.block = rows.shape[1] // self.blocks

    @classmethod
    def of(cls, starts: np.ndarray, examples: np.ndarray, counts: np.ndarray, n: int, factor: np.ndarray) -> Postings:
        """``starts``: where each term's ``examples`` and ``counts`` begin; a term's weights are multiplied by its ``factor``.

        Weights of examples are kept, and meant, in single precision; cosines are summed in double.
        """
        frequency, blocks = np.diff(starts), max(1, -(-n // BLOCK))
        idf = (np.log((1 + n) / (1 + frequency)) + 1) * factor
        common = int((frequency >= max(2, n / COMMON)).sum())
        told = np.repeat(idf > 0, frequency)
        if not told.all():
            examples, counts = examples[told], counts[told]
        starts = np.concatenate([[0], np.cumsum(np.where(idf > 0, frequency, 0))]).astype(np.int64)
        values = np.log(counts, dtype=np.float64)
        values += 1
        values *= np.repeat(idf, np.diff(starts))
        norms = np.sqrt(np.bincount(examples, values * values, minlength=n))
        values /= np.where(norms > 0, norms, 1.0)[examples]
        values = values.astype(np.float32)
        # common terms that weigh something have rows and block maxima
        used = np.flatnonzero(idf[:common])
        row_of = np.full(common, -1)
        row_of[used] = np.arange(len(used))
        rows = np.zeros((len(used), blocks * BLOCK), np.float32)
        inner = slice(0, starts[common])
        rows[np.repeat(np.arange(len(used)), np.diff(starts[: common + 1])[used]), examples[inner]] = values[inner]
        return cls(idf, starts, examples, values, row_of, rows, rows.reshape(-1, blocks, BLOCK).max(2).astype(np.float64))

    def weigh(self, at: np.ndarray, counts: np.ndarray, idf: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order and their weights, 1 + log of the count, times idf, to unit length."""
        weights = (1 + np.log(counts)) * (self.idf[at] if idf is None else idf)
        told = np.flatnonzero(weights)
        told = told[np.argsort(at[told])]
        at, weights = at[told], weights[told]
        norm = np.sqrt((weights**2).sum())
        return at, weights / norm if norm else weights

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """For each query the k examples of the largest cosine above 0, the earlier one first among equals.

        What rare terms add is summed up for all examples. The largest such sum of a block and the maxima of common
        terms bound its cosines. The blocks with the best bounds are read first. Of the others only those are read
        whose bound reaches the k-th best cosine found there; no example of the rest can be among the k.
        """
        out: list[list[tuple[int, float]]] = []
        for start in range(0, len(queries), TOGETHER):
            out += self._nearest(queries[start : start + TOGETHER], k, without[start : start + TOGETHER] if without else [-1] * TOGETHER)
        return out

    def _nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> list[list[tuple[int, float]]]:
        state, wide = [], []
        for q, (at, weights) in enumerate(queries):
            cut = int(np.searchsorted(at, self.common))
            starts, lengths = self.starts[at[cut:]], self.starts[at[cut:] + 1] - self.starts[at[cut:]]
            places = np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
            partial = np.bincount(self.examples[places], np.repeat(weights[cut:], lengths) * self.values[places], self.blocks * self.block).astype(float)  # of nothing, numpy counts in integers
            at, weights = self.row_of[at[:cut]], weights[:cut]
            bounds = partial.reshape(self.blocks, self.block).max(1) + weights @ self.best[at]
            order = np.argsort(-bounds, kind="stable")
            # Where many bounds are about as high as the best one, the first blocks would close hardly any.
            flat = self.blocks > 8 and bounds[order[self.blocks // 8]] > FLAT * bounds[order[0]]
            first, more = (order[:0], order) if flat else (order[:FIRST], order[FIRST:])
            found = self._above(at, weights, partial, (first[:, None] * self.block + np.arange(self.block)).ravel(), without[q])
            least = -np.partition(-found[1], k - 1)[k - 1] if len(found[1]) >= k else 0.0
            more = more[(bounds[more] > 0) & (bounds[more] >= least - 1e-9)]
            if 8 * len(more) > self.blocks:
                wide.append(q)
            elif len(more):
                found = tuple(map(np.concatenate, zip(found, self._above(at, weights, partial, (more[:, None] * self.block + np.arange(self.block)).ravel(), without[q]))))
            state.append((at, weights, partial, more, least, found))
        if wide:
            dense = np.zeros((len(wide), len(self.rows)), np.float32)
            for row, q in zip(dense, wide):
                row[state[q][0]] = state[q][1]
            sums = dense @ self.rows
            for row, q in zip(sums, wide):
                at, weights, partial, more, least, found = state[q]
                rough = (row + partial).reshape(self.blocks, self.block)[more].ravel()
                if len(rough) > k + 1:  # one of them may be the query's own example
                    least = max(least, float(-np.partition(-rough, k)[k]))
                near = np.flatnonzero((rough >= least - SLACK) & (rough > -SLACK))
                near = more[near // self.block] * self.block + near % self.block
                state[q] = (*state[q][:5], tuple(map(np.concatenate, zip(found, self._above(at, weights, partial, near, without[q])))))
        return [self._best(*own[5], k) for own in state]

    def _above(self, at: np.ndarray, weights: np.ndarray, partial: np.ndarray, examples: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of some examples with a cosine above 0, and the cosines."""
        scores = np.round(partial[examples] + weights @ self.rows[at[:, None], examples], 12)
        kept = np.flatnonzero((scores > 0) & (examples != without))
        return examples[kept], scores[kept]

    @staticmethod
    def _best(found: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, float]]:
        if len(scores) > 4 * k:
            keep = scores >= -np.partition(-scores, k - 1)[k - 1]
            found, scores = found[keep], scores[keep]
        best = np.lexsort((found, -scores))[:k]
        return list(zip(found[best].tolist(), scores[best].tolist()))


@dataclass
class Index:
    """Labelled examples, found by the cosine over all their terms. A term is known by a 64-bit hash."""

    hashes: np.ndarray  # of all terms, in order
    terms: np.ndarray  # their numbers
    labels: np.ndarray
    ids: np.ndarray
    weights: Postings
    share: float  # of toxic rows
    fitted: tuple[float, float, float] = (1.0, -1.0, 0.0)

    def __post_init__(self) -> None:
        self.memory: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}

    def pieces(self) -> Iterator[bytes]:
        """The index as a file: a header with the places of the arrays, then the arrays."""
        arrays = {n: getattr(self, n) for n in ("hashes", "terms", "labels", "ids")} | {f"weights.{n}": getattr(self.weights, n) for n in Postings.STORED}
        places, at = {}, 0
        for name, array in arrays.items():
            places[name] = array.dtype.str, array.shape, at
            at += -(-array.nbytes // 64) * 64
        header = pickle.dumps((places, self.share, self.fitted))
        yield (len(header).to_bytes(8, "little") + header).ljust(HEADER, b"\0")
        for array in arrays.values():
            raw = np.ascontiguousarray(array).reshape(-1).view(np.uint8)
            for start in range(0, len(raw), PIECE):
                yield raw[start : start + PIECE].tobytes()
            yield bytes(-len(raw) % 64)

    @classmethod
    def opened(cls, path: str) -> Index:
        """The index in a file, mapped into memory: the processes of a machine share one copy."""
        raw = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(raw[:8].tobytes(), "little")
        places, share, fitted = pickle.loads(raw[8 : 8 + size].tobytes())
        arrays = {n: raw[HEADER + at : HEADER + at + np.dtype(kind).itemsize * math.prod(shape)].view(kind).reshape(shape) for n, (kind, shape, at) in places.items()}
        return cls(*(arrays[n] for n in ("hashes", "terms", "labels", "ids")), Postings(*(arrays[f"weights.{n}"] for n in Postings.STORED)), share, fitted)

    def count(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The indexed terms of a text and how often it has them."""
        tally = Counter(terms(text))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tally), np.uint64, len(tally))
        place = np.searchsorted(self.hashes, hashes)
        place[place == len(self.hashes)] = 0
        known = np.flatnonzero(self.hashes[place] == hashes) if len(self.hashes) else np.zeros(0, np.int64)
        return self.terms[place[known]].astype(np.int64), np.fromiter(tally.values(), np.float64, len(tally))[known]

    def nearest(self, texts: list[str], k: int) -> list[list[tuple[int, float]]]:
        """For each text the k examples of the largest cosine over all terms; see :class:`Postings`."""
        return self.weights.nearest([self.weights.weigh(*self.count(t)) for t in texts], k)

    def votes(self, near: list[tuple[int, float]]) -> tuple[float, float]:
        """The votes for and against toxic, each neighbour's its similarity, in logarithms."""
        sides = [PRIOR, PRIOR]
        for i, s in near:
            sides[0 if self.labels[i] else 1] += s
        return math.log(sides[0]), math.log(sides[1])

    def probability(self, near: list[tuple[int, float]]) -> float:
        """The calibrated votes; without neighbours the share of all."""
        if not near:
            return self.share
        *slopes, intercept = self.fitted
        return float(1 / (1 + np.exp(-np.clip(np.dot(slopes, self.votes(near)) + intercept, -30, 30))))

    def score(self, text: str) -> float:
        return self.judge([text])[0][0]

    def judge(self, texts: list[str]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each text the calibrated probability, and the nearest examples, which voted, with their similarities."""
        keys = [xxhash.xxh3_128_intdigest(t.encode()) for t in texts]
        new = {key: t for key, t in zip(keys, texts) if key not in self.memory}
        known = {key: self.memory[key] for key in keys if key in self.memory}
        fresh = list(new.items())
        for start in range(0, len(fresh), TOGETHER):
            own = fresh[start : start + TOGETHER]
            for (key, _), near in zip(own, self.nearest([t for _, t in own], NEIGHBOURS)):
                known[key] = self.probability(near), np.array([i for i, _ in near], np.int32), np.array([s for _, s in near], np.float64)
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory.clear()
        self.memory.update((key, known[key]) for key in list(new)[:REMEMBERED])
        return [known[key] for key in keys]


class Fitted(NamedTuple):
    """An index as a file of bounded size that each machine gets once; see :meth:`Index.opened`."""

    name: str

    @property
    def index(self) -> Index:
        return ready(("toxicity", self.name), lambda: Index.opened(SparkFiles.get(self.name)))


def _factor(toxic: np.ndarray, frequency: np.ndarray, n1: float, n: int) -> np.ndarray:
    """The factors of terms in so many toxic examples of ``n1``, and in so many of all ``n``."""
    n0, clean = n - n1, frequency - toxic
    chi = n * (toxic * (n0 - clean) - clean * (n1 - toxic)) ** 2 / (float(n1 * n0 or 1) * np.maximum(frequency, 1) * np.maximum(n - frequency, 1))
    return (1 + np.minimum(chi, CHI)) / (1 + CHI)


def build(ids: np.ndarray, labels: np.ndarray, of_example: np.ndarray, of_term: np.ndarray, counts: np.ndarray, vocabulary: list[str], totals: dict[int, int]) -> Index:
    """The index of examples and of their (example, term, count) triples; ``totals``: rows of each label that they stand for."""
    n = len(ids)
    # Terms are numbered from the most frequent one down.
    frequency = np.bincount(of_term, minlength=len(vocabulary))
    by_name = np.argsort(np.array(vocabulary, object), kind="stable") if vocabulary else np.zeros(0, np.int64)
    order = by_name[np.argsort(-frequency[by_name], kind="stable")]
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    words, of_term = [vocabulary[t] for t in order.tolist()], number[of_term]
    # How far the terms' document frequencies differ between the classes.
    n1 = labels.sum()
    frequency = frequency[order].astype(float)
    a = np.bincount(of_term, labels[of_example], minlength=len(words))
    factor = _factor(a, frequency, n1, n)
    # Examples with the same rarest telling term stand together, which keeps the maxima of other blocks low.
    rarest = np.full(n, -1)
    full = factor[of_term] == 1
    np.maximum.at(rarest, of_example[full], of_term[full])
    order = np.lexsort((ids, labels, -rarest))
    moved = np.empty(n, np.int32)
    moved[order] = np.arange(n, dtype=np.int32)
    ids, labels, of_example = ids[order], labels[order].astype(float), moved[of_example]
    weight = {c: totals.get(c, 0) / max(1, int((labels == c).sum())) for c in (0, 1)}
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    by = np.lexsort((of_example, of_term))
    starts = np.concatenate([[0], np.cumsum(frequency)]).astype(np.int64)
    postings = Postings.of(starts, of_example[by], counts[by], n, factor)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    order = np.argsort(hashes)
    index = Index(hashes[order], order.astype(np.int32), labels, ids, postings, share)
    del hashes, words
    by = np.argsort(of_example, kind="stable")
    edges = np.searchsorted(of_example[by], np.arange(n + 1))
    known, y = [], []
    for start in range(0, n, TOGETHER):
        own = [by[edges[i] : edges[i + 1]] for i in range(start, min(n, start + TOGETHER))]
        # as if the example were not among those that terms were weighed by
        queries = []
        for o, label in zip(own, labels[start : start + TOGETHER]):
            at, rest = of_term[o].astype(np.int64), frequency[of_term[o]] - 1
            idf = np.where(rest > 0, (np.log(n / (1 + rest)) + 1) * _factor(a[at] - label, rest, n1 - label, n - 1), 0.0)
            queries.append(postings.weigh(at, counts[o].astype(float), idf))
        for i, near in enumerate(postings.nearest(queries, 2 * NEIGHBOURS, [*range(start, start + len(own))]), start):
            others = [(j, s) for j, s in near if s < COPY][:NEIGHBOURS]
            if others:
                known.append(index.votes(others))
                y.append(labels[i])
    if len(set(y)) == 2:
        truth = np.array(y, float)
        index.fitted = tuple(platt(np.array(known), truth, np.where(truth == 1, weight[1], weight[0])).tolist())
    return index  # with nothing to calibrate on, the votes themselves count


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms and their counts of each example, and its words."""
    for batch in batches:
        words, counts, sizes = [], [], []
        for text in batch.column("text"):
            tally = Counter(terms(text.as_py()))
            sizes.append(tally.total())
            words.append(list(tally))
            counts.append(list(tally.values()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32())), pa.array(sizes, pa.int64())],
            ["id", "label", "words", "counts", "size"],
        )


_PARSED = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("size", pa.int64())])


def _build(totals: dict[int, int]):
    """One task over all parsed examples, a bounded number: the index as compressed pieces of a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, _PARSED)
        # of rows that repeat an id the shortest text, and of equally long ones the first in order of its words
        order = sorted(range(table.num_rows), key=lambda i, c=[table.column(x).to_pylist() for x in ("id", "size")]: tuple(x[i] for x in c))
        kept: dict[int, int] = {}
        words_of = lambda i: sorted(zip(table.column("words")[i].as_py(), table.column("counts")[i].as_py()))
        for i in order:
            ident = table.column("id")[i].as_py()
            first = kept.setdefault(ident, i)
            if first != i and table.column("size")[first] == table.column("size")[i] and words_of(i) < words_of(first):
                kept[ident] = i
        table = table.select(["id", "label", "words", "counts"]).take(pa.array([*kept.values()], pa.int64())).combine_chunks()
        words = table.column("words").combine_chunks()
        lengths = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        of_term, vocabulary = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        ids, labels, counts = (x.to_numpy().copy() for x in (*(table.column(c) for c in ("id", "label")), table.column("counts").combine_chunks().flatten()))
        del table, words, coded
        pa.default_memory_pool().release_unused()
        index = build(ids, labels.astype(float), np.repeat(np.arange(len(ids), dtype=np.int32), lengths), of_term, counts, vocabulary, totals)
        for piece in index.pieces():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(piece, 1)], pa.binary())], ["piece"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Fitted:
    """Learn from rows that are not held out; at most ``PER_CLASS`` examples of each class are read, in whole.

    All of them are indexed, copies too, with all their terms. Of rows that repeat an id the shortest text counts. Null
    texts are empty.
    """
    examples, totals = sample(docs, labels, label, PER_CLASS, id_col, text_col)
    parsed = settle(examples.select("id", "label", "text").mapInArrow(_parse, "id long, label int, words array<string>, counts array<int>, size long"))
    rows = parsed.repartition(1).mapInArrow(_build(totals), "piece binary").toLocalIterator()
    return _shipped(docs.sparkSession, (zlib.decompress(r["piece"]) for r in rows))


def _shipped(spark: SparkSession, pieces: Iterator[bytes]) -> Fitted:
    """Write an index file and let every machine of the application fetch it; one of the same content is sent once."""
    folder, digest = Path(tempfile.mkdtemp(prefix="cytoline-")), xxhash.xxh3_128()
    with open(folder / "index", "wb") as out:
        for piece in pieces:
            digest.update(piece)
            out.write(piece)
    if not (folder / "index").stat().st_size:  # there was no row, so no task
        return _shipped(spark, (zlib.decompress(p) for batch in _build({})(iter(())) for p in batch.column("piece").to_pylist()))
    name = f"toxicity-{digest.hexdigest()}.index"
    sent = spark.sparkContext.__dict__.setdefault("_cytoline_indexes", set())
    if name not in sent:
        (folder / "index").rename(folder / name)
        spark.sparkContext.addFile(str(folder / name))
        sent.add(name)
    return Fitted(name)


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """A batch of texts in parts; null ones are empty."""
    for start in range(0, len(texts), 4 * TOGETHER):
        yield [t.as_py() or "" for t in texts[start : start + 4 * TOGETHER]]


def probability(text: Column, fitted: Fitted) -> Column:
    """The calibrated probability that a whole text is toxic; texts without any term of an example, as null and empty ones, get the share of toxic rows."""
    @F.arrow_udf("double")
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([p for part in _parts(texts) for p, _, _ in fitted.index.judge(part)], pa.float64())

    return run(text)


EVIDENCE = "array<struct<id: bigint, similarity: double, label: int>>"


def _shown(index: Index, found: list[np.ndarray], similarities: list[np.ndarray]) -> pa.Array:
    """The examples found for each text as arrays of EVIDENCE."""
    flat = np.concatenate([*found, np.zeros(0, np.int32)])
    values = [pa.array(index.ids[flat], pa.int64()), pa.array(np.concatenate([*similarities, np.zeros(0)])), pa.array(index.labels[flat].astype(np.int32))]
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, ["id", "similarity", "label"]))


def evidence(text: Column, fitted: Fitted, k: int = NEIGHBOURS) -> Column:
    """The nearest labelled examples of each text: their ids, similarities and labels."""

    @F.arrow_udf(EVIDENCE)
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [near for part in _parts(texts) for near in fitted.index.nearest(part, k)]
            yield _shown(fitted.index, [np.array([i for i, _ in near], np.int32) for near in found], [np.array([s for _, s in near], np.float64) for near in found])

    return run(text)


def judged(text: Column, fitted: Fitted) -> Column:
    """``score``, as by :func:`probability`, and ``evidence``, as by :func:`evidence`, from one search."""

    @F.arrow_udf(f"struct<score: double, evidence: {EVIDENCE}>")
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            known = [answer for part in _parts(texts) for answer in fitted.index.judge(part)]
            scores = pa.array([p for p, _, _ in known], pa.float64())
            yield pa.StructArray.from_arrays([scores, _shown(fitted.index, [f for _, f, _ in known], [s for _, _, s in known])], ["score", "evidence"])

    return run(text)


def score(docs: DataFrame, fitted: Fitted, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted, evidence`` for each row; equal texts score equally, empty tables give empty results."""
    ident = column(docs, id_col)
    rows = docs.select(ident.alias("id"), held_out(ident).alias("held_out"), judged(column(docs, text_col), fitted).alias("own"))
    return rows.select("id", "held_out", "own.score", (F.col("own.score") >= threshold).cast("int").alias("predicted"), "own.evidence")
