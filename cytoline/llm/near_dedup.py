"""Near-duplicate detection by MinHash with fast similarity sketching, banding and exact verification.

Sketches follow Dahlgaard, Knudsen and Thorup (2017): in each round every shingle of a set is hashed to one bin with a
value, earlier rounds before later ones, until every bin has a value; after as many rounds as there are bins each
further round fills one given bin, so that all are filled for certain. Two sketches agree in a bin with probability
equal to the sets' similarity, concentrated as if the bins were independent. Bands of bins give buckets of candidates.

Candidates are compared exactly, on their whole sets, and no pair is ever made into a row:
1. a shingle that no other candidate has counts against any link; a set with too many of those has no link at all;
2. sets that buckets connect, directly or through others, are a group; groups are packed into cells of bounded size,
   and a cell counts the overlaps of all its sets with each other by an inverted index and returns which sets belong
   together, at most one row for each set;
3. a group too large for a cell first meets its heaviest members, chunk by chunk. Only what those leave apart from the
   group's largest component is compared with everything else, chunk against chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, bit_positions, bit_table, column, filter_bits, give_back, probe_bits, settle, without_model

#: Words of a shingle; bands and bins of a band. A pair shares no band with probability 1e-7 at a similarity of 0.8,
#: and 3e-10 at 0.85.
SHINGLE, BANDS, ROWS = 5, 30, 4
BINS = BANDS * ROWS
#: Shingles and sets of a chunk of a group; a cell holds two chunks, or small groups of about PACKED shingles together.
CHUNK, CHUNK_SETS, PACKED = 1 << 16, 1024, 1 << 18
#: Heaviest members of a large group, which each chunk of it meets first.
HUBS = 16
#: Links that one task joins into components.
AT_ONCE = 1_000_000
#: Rows that go to Python at a time where each carries a whole text.
BATCH = 500

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _scatter(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64 bits, in place."""
    x ^= x >> np.uint64(33)
    x *= _MIX[0]
    x ^= x >> np.uint64(33)
    x *= _MIX[1]
    x ^= x >> np.uint64(33)
    return x


def shingles(text: str) -> np.ndarray:
    """The distinct shingles of a whole text, hashed to 64 bits and sorted.

    Words are runs of other than ASCII white space with A-Z in lower case. Fewer words than a shingle has are one
    shingle together; no words give an empty set.
    """
    words = text.encode().lower().split()
    n = len(words)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=n)], np.uint64) if n else np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    combined = hashes[: n - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        combined *= _BASE
        combined += hashes[i : n - SHINGLE + 1 + i]
    return np.unique(_scatter(combined))


def sketch(elements: np.ndarray) -> np.ndarray:
    """The BINS values of a set of 64-bit elements that is not empty."""
    out = np.full(BINS, _EMPTY)
    done, some = 0, max(1, 4096 // len(elements))
    while done < BINS:
        rounds = np.arange(done, min(BINS, done + some), dtype=np.uint64)
        hashed = _scatter(elements[None, :] ^ ((rounds + np.uint64(1)) * _STEP)[:, None])
        bins = ((hashed >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        values = (hashed & np.uint64(0xFFFFFFFF)) | (rounds[:, None] << np.uint64(32))
        np.minimum.at(out, bins.ravel().astype(np.intp), values.ravel())
        done += len(rounds)
        if not (out == _EMPTY).any():
            return out
    for i in np.flatnonzero(out == _EMPTY).tolist():
        hashed = _scatter(elements ^ (np.uint64(BINS + i + 1) * _STEP))
        out[i] = (hashed & np.uint64(0xFFFFFFFF)).min() | (np.uint64(BINS + i) << np.uint64(32))
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    grid = values.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for i in range(ROWS):
        key = _scatter(key * _BASE + grid[:, i])
    return key


def node_of(elements: np.ndarray) -> bytes:
    """A name of a set, 128 bits."""
    return xxhash.xxh3_128_digest(elements.tobytes(), seed=1)


def parsed(text: Column) -> Column:
    """Struct of set size, name of the set and band keys of each text."""

    @F.arrow_udf("struct<n: bigint, node: binary, bands: array<bigint>>")
    @without_model
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with np.errstate(over="ignore"):
            for texts in batches:
                sizes, nodes, keys, ends = [], [], [], [0]
                for t in texts:
                    own = shingles(t.as_py() or "")
                    sizes.append(len(own))
                    nodes.append(node_of(own))
                    if len(own):
                        keys.append(bands(sketch(own)).view(np.int64))
                    ends.append(ends[-1] + BANDS * bool(len(own)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
                yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), lists], ["n", "node", "bands"])

    return run(text)


def sets(text: Column) -> Column:
    """Struct of the set's name and the set itself, as sorted 64-bit hashes."""

    @F.arrow_udf("struct<node: binary, elements: array<bigint>>")
    @without_model
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with np.errstate(over="ignore"):
            for texts in batches:
                own = [shingles(t.as_py() or "") for t in texts]
                ends = np.cumsum([0, *map(len, own)])
                flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.StructArray.from_arrays([pa.array(map(node_of, own), pa.binary()), lists], ["node", "elements"])

    return run(text)


def made(texts: DataFrame, text_col: str) -> DataFrame:
    """``node, elements`` of each row's text.

    Neither is ever null, and Spark has to know it: a join by a name that might be null is preceded by a filter for
    which every set is made once more, in Python workers of its own.
    """
    own = texts.select(sets(F.coalesce(column(texts, text_col), F.lit(""))).alias("own"))
    return own.select(F.coalesce("own.node", F.lit(b"")).alias("node"), F.coalesce("own.elements", F.lit([]).cast("array<bigint>")).alias("elements"))


def overlaps(elements: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """How many elements each two of ``n`` sets share, above the diagonal; ``row`` is the set of each element.

    Elements that many sets have are counted by products of 0/1 matrices, the others by walking along the sets of each.
    """
    _, code, count = np.unique(elements, return_inverse=True, return_counts=True)
    out = np.zeros((n, n), np.float32)  # whole numbers below 2**24
    heavy = np.flatnonzero(count > max(2, n / 16))
    place = np.full(len(count), -1)
    place[heavy] = np.arange(len(heavy))
    at = place[code]
    for start in range(0, len(heavy), 2048):
        inside = (at >= start) & (at < start + 2048)
        dense = np.zeros((n, min(2048, len(heavy) - start)), np.float32)
        dense[row[inside], at[inside] - start] = 1
        out += dense @ dense.T
    light = np.flatnonzero((at < 0) & (count[code] > 1))
    light = light[np.lexsort((row[light], code[light]))]
    code, row = code[light], row[light]
    step = 1
    while len(first := np.flatnonzero(code[step:] == code[:-step])) if step < len(code) else False:
        np.add.at(out, (row[first], row[first + step]), 1)
        step += 1
    return out


def linked(elements: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """For each of some sets the first one that links connect it with, itself included; ``elements`` holds all in turn."""
    n = len(sizes)
    both = np.triu(overlaps(elements, np.repeat(np.arange(n), sizes), n), 1).astype(np.int64)
    link = (both > 0) & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
    link |= link.T
    label = np.full(n, -1)
    for i in range(n):
        if label[i] < 0:
            label[i], edge = i, np.array([i])
            while len(edge):
                edge = np.flatnonzero(link[edge].any(0) & (label < 0))
                label[edge] = i
    return label


LINKS = "a binary, b binary"


def links_of(percent: int):
    """By cell: (first, other) for all sets that links connect, group by group; no more rows than sets."""

    def run(table: pa.Table) -> pa.Table:
        groups = table.column("group").to_numpy()
        order = np.argsort(groups, kind="stable")
        lists, names = table.column("elements").combine_chunks(), table.column("node").to_pylist()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        first, other = [], []
        for members in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
            own = {names[i]: i for i in members.tolist()}  # a heavy member comes once more with its chunk
            members = list(own.values())
            if len(members) > 1:
                label = linked(np.concatenate([flat[ends[i] : ends[i + 1]] for i in members]), (ends[1:] - ends[:-1])[members].astype(np.int64), percent)
                for i in np.flatnonzero(label != np.arange(len(label))).tolist():
                    first.append(names[members[label[i]]])
                    other.append(names[members[i]])
        give_back()
        return pa.table({"a": pa.array(first, pa.binary()), "b": pa.array(other, pa.binary())})

    return run


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all edges of one task."""
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([root(x) for x in nodes])], ["node", "comp"])


def components(edges: DataFrame, at_once: int | None = None) -> DataFrame:
    """``node, comp`` for every end of ``edges`` (a, b); ``comp`` is the smallest node of the component.

    Up to AT_ONCE edges, some tens of MB, are joined in a single task. More are contracted: every node takes the smallest
    of its neighbours and itself as its parent, then three times its parent's parent; edges between different parents
    go on to the next round. At least half of the nodes go in each, so few rounds are needed, on fewer and fewer edges.
    The joins are merge joins, because many broadcasts would each take megabytes of the driver.
    """
    edges = settle(edges)
    if edges.count() <= (AT_ONCE if at_once is None else at_once):
        kind = edges.schema["a"].dataType.simpleString()
        return settle(edges.select("a", "b").coalesce(1).mapInArrow(_join_up, f"node {kind}, comp {kind}"))
    names, left = None, edges.select("a", "b")
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("up")))
        known = parents.select(F.col("node").alias("up"), F.col("up").alias("above")).hint("merge")
        jumped = parents
        for _ in range(3):
            jumped = jumped.join(known, "up").select("node", F.col("above").alias("up"))
        jumped = settle(jumped)
        names = jumped.select("node", F.col("up").alias("comp")) if names is None else settle(
            names.join(jumped.select(F.col("node").alias("comp"), "up").hint("merge"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
        )
        for end in ("a", "b"):
            left = left.join(jumped.select(F.col("node").alias(end), F.col("up").alias(f"up_{end}")).hint("merge"), end)
        left = settle(left.filter("up_a <> up_b").select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct())
        if left.isEmpty():
            return names


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`group` keeps, with all their columns, whatever those are called.

    A filter of bounded size over the ids that go lets all other rows pass unshuffled; the rest is compared exactly.
    Rows that repeat an id and a set stay or go together.
    """
    gone = settle(group(docs, percent, id_col, text_col, with_node=True).filter("not kept").select(F.col("id").alias("gone"), F.col("node").alias("set")).distinct())
    log_bits = filter_bits(gone.count())
    bits = bit_table(gone.select(F.explode(bit_positions(F.xxhash64("gone"), log_bits)).alias("bit")).distinct(), "bit")
    ident = column(docs, id_col).cast("long")
    rows = docs.select(F.struct("*").alias("doc"), ident.alias("id"), column(docs, text_col).alias("text"), F.xxhash64(ident).alias("key"))
    rows = probe_bits(rows, "key", settle(bits), log_bits, "maybe")
    unsure = rows.filter("maybe").withColumn("node", sets(F.coalesce("text", F.lit("")))["node"])
    stay = unsure.join(gone, unsure["id"].eqNullSafe(gone["gone"]) & (unsure["node"] == gone["set"]), "left_anti")
    return rows.filter("not maybe").select("doc").unionByName(stay.select("doc")).select("doc.*")


def alone(store: DataFrame, percent: int) -> DataFrame:
    """``short`` of sets in ``store`` (short, n, elements) that have too many elements of their own for any link.

    Of two linked sets, each has all but ``100 - percent`` hundredths of its elements in the other. Names and elements
    that happen to share 64 bits only make this find fewer sets.
    """
    own = store.select("short", F.explode("elements").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("sets"), F.min("short").alias("short"))
    own = own.filter("sets = 1").groupBy("short").agg(F.count(F.lit(1)).alias("own"))
    return own.join(store.select("short", "n"), "short").filter(100 * F.col("own") > (100 - percent) * F.col("n")).select("short")


def _chunks(shingles_: str, sets_: str, chunk: int, chunk_sets: int) -> Column:
    """How many chunks so many shingles and sets make."""
    return F.greatest(F.lit(1), F.ceil(F.col(shingles_) / chunk), F.ceil(F.col(sets_) / chunk_sets)).cast("int")


def _cell(*parts) -> Column:
    return F.xxhash64("group", *parts)


def within_cells(members: DataFrame, percent: int) -> DataFrame:
    """Links among ``members`` (cell, group, node, elements) of a cell and group."""
    return members.select("cell", "group", "node", "elements").groupBy("cell").applyInArrow(links_of(percent), LINKS)


def group_links(members: DataFrame, percent: int, chunk: int = CHUNK, chunk_sets: int = CHUNK_SETS) -> DataFrame:
    """Links (a, b) that connect the sets of each group as all of its links do.

    ``members``: group, node, n, weight, elements. Groups that fit into a chunk are packed together by their hash. A
    larger group is dealt to chunks, and each chunk meets the group's HUBS heaviest members: near copies of one text are
    mostly linked with it. Then every set outside the group's largest component meets all others, chunk by chunk.
    """
    sizes = members.groupBy("group").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    sizes = settle(sizes.filter("sets > 1").select("group", "shingles", "sets", _chunks("shingles", "sets", chunk, chunk_sets).alias("chunks")))
    total = sizes.agg(F.sum("shingles").alias("n"), F.max("chunks").alias("most")).first()
    if total["n"] is None:
        return members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    members = members.join(sizes.select("group", "chunks").hint("merge"), "group")
    bins = max(1, total["n"] // PACKED)
    packed = members.filter("chunks = 1").withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(bins)))
    if total["most"] == 1:
        return within_cells(packed, percent)
    large = settle(members.filter("chunks > 1").withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks"))))
    by_weight = Window.partitionBy("group").orderBy(F.col("weight").desc(), "node")
    hubs = large.select("group", "node", "weight", "chunks").withColumn("place", F.row_number().over(by_weight)).filter(F.col("place") <= HUBS)
    hubs = hubs.select("group", "node", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"))
    hubs = hubs.join(large.select("group", "node", "elements").hint("merge"), ["group", "node"])
    met = large.select("group", "node", "elements", "c").unionByName(hubs).withColumn("cell", _cell("c"))
    links = settle(within_cells(packed, percent).unionByName(within_cells(met, percent)))

    names = components(links)
    placed = large.select("group", "node", "n").join(names.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    comps = placed.groupBy("group", "comp").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    tops = comps.groupBy("group").agg(F.max(F.struct("sets", "comp", "shingles")).alias("top"), F.sum("shingles").alias("shingles"), F.sum("sets").alias("sets"))
    tops = tops.filter("sets > top.sets").select(
        "group", "top.comp", (F.col("shingles") - F.col("top.shingles")).alias("out_n"), (F.col("sets") - F.col("top.sets")).alias("out_sets"), F.col("top.shingles").alias("in_n"), F.col("top.sets").alias("in_sets")
    )
    tops = settle(tops.select("group", F.col("comp").alias("top"), _chunks("out_n", "out_sets", chunk, chunk_sets).alias("outside"), _chunks("in_n", "in_sets", chunk, chunk_sets).alias("inside")))
    rest = placed.join(tops.hint("merge"), "group").withColumn("out", F.col("comp") != F.col("top"))
    rest = rest.withColumn("c", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("out"), F.col("outside")).otherwise(F.col("inside"))))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.col("c")
    others = F.transform(F.filter(upto("outside"), lambda j: (j != own) | (F.col("outside") == 1)), lambda j: _cell(F.least(j, own), F.greatest(j, own)))
    cells = F.when(F.col("out"), F.concat(others, F.transform(upto("inside"), lambda j: _cell(own, F.lit(-1), j)))).otherwise(F.transform(upto("outside"), lambda j: _cell(j, F.lit(-1), own)))
    rest = rest.select("group", "node", F.explode(cells).alias("cell")).join(large.select("group", "node", "elements").hint("merge"), ["group", "node"])
    return links.unionByName(within_cells(rest, percent))


def group(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", with_node: bool = False, chunk: int = CHUNK, chunk_sets: int = CHUNK_SETS) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for each row of ``docs``.

    Rows are linked if 100 times their shared shingles are at least ``percent`` times all of both. ``component_id`` is
    the smallest id that links reach. Rows with equal sets are one node, so copies cost nothing further. Rows without
    words are linked with nothing. Rows that repeat an id are documents of their own. A null id is no name: such a row
    has the component of equal or linked rows that have one, or none. Where a component has no id at all, the rows of
    one of its sets are kept.
    Empty tables give empty results. ``with_node`` adds the hashed name of each row's set as ``node``.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(column(docs, id_col).cast("long").alias("id"), parsed(text).alias("own"))
    with batches_of(docs.sparkSession, 4 * BATCH):
        rows = settle(rows.select("id", "own.n", "own.node", "own.bands", F.xxhash64("own.node").alias("short")))
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("short").alias("short"), F.first("bands").alias("bands"))
    nodes = settle(nodes)

    # Buckets that hold more than one set. Candidates are named by 64 bits here: two with one name are looked at together.
    entries = nodes.select("short", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    found = settle(entries.join(sizes.hint("merge"), "bucket"))
    # A set's weight is the sum of its buckets' sizes: the centre of a group of near copies is more like each of them
    # than they are like each other, and shares the most buckets.
    weights = found.groupBy("short").agg(F.sum("size").alias("weight"))
    wanted = settle(nodes.select("node", "short", "rep", "n").join(weights.hint("merge"), "short"))

    # Only candidates are read a second time; a filter of bounded size spares the other texts, the join makes it exact.
    log_bits = filter_bits(wanted.count())
    bits = bit_table(wanted.select(F.explode(bit_positions(F.xxhash64("rep"), log_bits)).alias("bit")).distinct(), "bit")
    texts = docs.select(F.xxhash64(column(docs, id_col).cast("long")).alias("key"), text.alias("text"))
    texts = probe_bits(texts, "key", settle(bits), log_bits, "maybe").filter("maybe")
    with batches_of(docs.sparkSession, BATCH):
        found_sets = made(texts, "text").join(wanted.select("node", "short", "n", "weight").hint("merge"), "node")
        store = settle(found_sets.groupBy("node").agg(*(F.first(c).alias(c) for c in ("short", "n", "weight", "elements"))))

    live = settle(store.select("short").join(alone(store, percent).hint("merge"), "short", "left_anti").distinct())
    entries = settle(found.select("bucket", "short").join(live.hint("merge"), "short"))
    heads = entries.groupBy("bucket").agg(F.min("short").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    edges = entries.join(heads.hint("merge"), "bucket").filter("short <> head").select(F.col("head").alias("a"), F.col("short").alias("b")).distinct()
    groups = components(edges).select(F.col("node").alias("short"), F.col("comp").alias("group"))
    members = store.join(groups.hint("merge"), "short").select("group", "node", "n", "weight", "elements")
    names = components(group_links(members, percent, chunk, chunk_sets))

    placed = nodes.select("node", "rep").join(names.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.groupBy("comp").agg(F.min("rep").alias("component_id"), F.min("node").alias("first"))
    named = settle(placed.join(least.hint("merge"), "comp").select("node", "component_id", (F.col("node") == F.col("first")).alias("is_first")))
    out = rows.select("id", "n", "node").join(named, "node", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    nameless = (F.col("n") > 0) & F.col("component_id").isNull()
    kept = F.when(nameless, F.col("is_first")).otherwise(F.col("id").eqNullSafe(F.col("component_id")))
    return out.select(*["node"] * with_node, "id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
