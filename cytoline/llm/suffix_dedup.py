"""Removal of long repeated substrings by a hash-compared suffix sort.

Texts are sorted as suffixes without a suffix array of the whole corpus. Prefix polynomial hashes give the hash of any
substring in a few operations; a binary search over them finds how far two suffixes agree, so a mergesort compares
suffixes in logarithmic time; suffixes found equal over the whole length are compared byte by byte. No hash decides
that bytes are equal: wherever equal hashes put stretches of text together, their bytes are compared as well.

Only suffixes that can repeat are sorted. In every substring of ``length`` bytes one gram of ``GRAM`` bytes is the
anchor: the one with the smallest hash (winnowing). Equal substrings have equal anchors at equal places, so grams that
are an anchor in one document only settle their substrings, and the rest meets in one place by its anchor's hash.

The steps, each over groups of bounded size:
1. texts are dealt to buckets of a few MB; a bucket sends the distinct hashes of its anchors, five bytes each;
2. by hash: which anchors occur in more than one document, and which are frequent? Two bits each go back;
3. a bucket sends the distinct surroundings of those anchors with their smallest document id;
   An anchor within a passage that a large share of all texts has would bring as many different surroundings of the
   passage's ends to one place; for such anchors single windows are sent, each to where its own hash belongs;
4. by hash: surroundings are sorted as suffixes, each substring gets its smallest document, one bit goes back;
5. a bucket marks its texts. The texts themselves are shuffled once; steps 1, 3 and 5 share that exchange.
"""

from __future__ import annotations

import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column
from .near_dedup import _STEP, _scatter

#: Bytes of an anchor gram, of a bucket of texts, and the least number of buckets.
GRAM, BUCKET, LEAST = 24, 8 << 20, 24
#: Windows that are hashed at a time; their places take as many low bits of the keys that are compared.
PLACE_BITS = 19
#: Surroundings that are sorted together.
SLICE = 20_000
#: An anchor with more surroundings than this in some bucket is frequent: its windows meet by their own hashes. This
#: decides where windows meet, not how they are compared. Such windows have this for the place of their anchor.
FREQUENT, SPLIT = 32, 255
_LAST = np.iinfo(np.int64).max  # a null id comes after every id

_BASE = 0xD6E8FEB86659FD93
_SIZE = 1 << PLACE_BITS
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)  # a random value for each byte


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
        out[0] = 1
        return np.cumprod(out)


class PrefixHash:
    """Hashes of all prefixes of a buffer, modulo 2**64; ``of`` gives the hash of any substring.

    ``place``, if given, numbers the bytes of each of the buffer's pieces from 0; substrings then stay inside a piece.
    Without it the buffer is one piece.
    """

    up = _powers(_BASE, _SIZE + 256)
    down = _powers(pow(_BASE, -1, 1 << 64), _SIZE + 256)

    def __init__(self, data: np.ndarray, place: np.ndarray | None = None) -> None:
        n = len(data)
        self.place = place
        self.sums = np.zeros(n + 1, np.uint64)
        for at in range(0, n, _SIZE):  # in blocks, so that only the sums take eight bytes for each byte
            block = slice(at, min(n, at + _SIZE))
            power = self.up[: block.stop - at] if place is None else self.up[place[block]]
            np.cumsum(_TABLE[data[block]] * power, out=self.sums[at + 1 : block.stop + 1])
            self.sums[at + 1 : block.stop + 1] += self.sums[at]
        if place is None and n > len(self.up):
            raise ValueError("a buffer of this size needs places")

    def of(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.down[at if self.place is None else self.place[at]]

    def every(self, length: int) -> np.ndarray:
        """The hashes of all substrings of this length of a buffer that is one piece."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]

    def extension(self, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
        """How many bytes, up to ``limit``, two suffixes have in common: a binary search over substring hashes."""
        common, step = np.zeros(len(left), np.int64), 1 << (limit.bit_length() - 1)
        while step:
            longer = common + step
            fits = np.flatnonzero(longer <= limit)
            same = self.of(left[fits] + common[fits], step) == self.of(right[fits] + common[fits], step)
            common[fits[same]] += step
            step >>= 1
        return common


def sort_suffixes(data: np.ndarray, hashes: PrefixHash, starts: np.ndarray, groups: np.ndarray, limit: int) -> np.ndarray:
    """The order of suffixes within each group (``groups`` ascends), by their first ``limit`` bytes; a stable mergesort.

    All runs of a width are merged together: the place of a suffix is its place in its own run plus the number of
    suffixes of the neighbouring run before it, found by binary search.
    """
    n = len(starts)
    order = np.arange(n)
    if not n:
        return order
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(first, n))
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max():
        live = np.flatnonzero(size > width)
        place = live - base[live]
        run = place // width
        partner = run ^ 1
        low = np.minimum(partner * width, size[live])
        high = np.minimum(low + width, size[live])
        low, high = low + base[live], high + base[live]
        begin, right = low.copy(), (run & 1).astype(bool)
        own = starts[order[live]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            mine, other = own[open_], starts[order[middle]]
            common = hashes.extension(mine, other, limit)
            at = np.minimum(common, limit - 1)
            a, b = data[mine + at], data[other + at]
            # an equal suffix of the left run stands before one of the right run
            before = np.where(common >= limit, right[open_], b < a)
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        target = base[live] + (run & ~1) * width + (place - run * width) + (low - begin)
        merged = order.copy()
        merged[target] = order[live]
        order, width = merged, width * 2
    return order


def windows_equal(data: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Byte comparison of substrings whose hashes agree."""
    out, span = np.empty(len(left), bool), np.arange(length)
    for at in range(0, len(left), 50_000):
        a, b = left[at : at + 50_000, None] + span, right[at : at + 50_000, None] + span
        out[at : at + 50_000] = (data[a] == data[b]).all(1)
    return out


def same_bytes(data: np.ndarray, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte comparison of stretches of several sizes."""
    out = np.empty(len(left), bool)
    for at in range(0, len(left), 50_000):
        own = slice(at, at + 50_000)
        size = sizes[own]
        begins = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(begins, size)
        differ = data[np.repeat(left[own], size) + inner] != data[np.repeat(right[own], size) + inner]
        out[own] = np.add.reduceat(differ, begins) == 0 if len(size) else True
    return out


class Cells:
    """The windows of a bucket's texts, cut into cells: runs of windows with the same anchor.

    Columns: ``first`` and ``last`` (windows, in the bucket's bytes), ``anchor`` (place), ``hash`` (of the anchor),
    ``content`` (hash of all bytes of the cell's windows), ``doc`` (row).
    """

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.length = length
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        found = [self._cut(at) for at in range(0, max(0, len(self.data) - length + 1), _SIZE)]
        self.first, self.last, self.anchor, self.hash, self.content = (
            np.concatenate(c) if found else np.zeros(0, t) for c, t in zip(zip(*found) if found else [()] * 5, (np.int64,) * 3 + (np.uint64,) * 2)
        )
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def _cut(self, at: int) -> tuple[np.ndarray, ...]:
        length = self.length
        data = self.data[at : at + _SIZE + length - 1]
        count = len(data) - length + 1
        hashes = PrefixHash(data)
        mixed = _scatter(hashes.every(GRAM))
        low = np.uint64(_SIZE * 2 - 1)
        key = (mixed & ~low) | np.arange(len(mixed), dtype=np.uint64)
        least, width, wide = key, 1, length - GRAM + 1
        while width * 2 <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[: -(wide - width)], least[wide - width :])
        place = (least & low).astype(np.int64)
        # windows that reach into the next text are none
        valid = np.ones(count, bool)
        for i in range(*np.searchsorted(self.ends, [at + 1, at + count + length]).tolist()):
            end = int(self.ends[i]) - at
            valid[max(0, end - length + 1) : max(0, min(end, count))] = False
        window = np.flatnonzero(valid)
        if not len(window):
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
        own = place[window]
        fresh = np.concatenate([[True], (np.diff(window) != 1) | (np.diff(own) != 0)])
        index = np.flatnonzero(fresh)
        first, last = window[index], window[np.append(index[1:], len(window)) - 1] + 1
        anchor = own[index]
        content = hashes.of(first, last - first + length - 1) ^ (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        # the smallest of many hashes are small: mixed again, they spread evenly over the parts
        return first + at, last + at, anchor + at, _scatter(mixed[anchor] ^ _STEP), _scatter(content)

    def anchors(self, parts: int, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes in order; which of them occur in several texts and which have many contents, as rows
        of bits; where each part starts; each cell's number."""
        order = np.lexsort((self.doc, self.content, self.hash))
        ordered = self.hash[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        if len(at):
            docs, contents = self.doc[order], self.content[order]
            fresh = new | np.concatenate([[True], contents[1:] != contents[:-1]])
            flags = np.stack([np.minimum.reduceat(docs, at) != np.maximum.reduceat(docs, at), np.add.reduceat(fresh.astype(np.int64), at) > frequent])
        else:
            flags = np.zeros((2, 0), bool)
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        distinct = ordered[at]
        return distinct, flags, np.searchsorted(part_of(distinct, parts), np.arange(parts + 1)), inverse

    def narrowed(self, chosen: np.ndarray, split: np.ndarray) -> None:
        """Keep the chosen cells only; those to be split become a cell for each window, anchored by the window's own hash."""
        whole, apart = chosen[~split], chosen[split]
        count = self.last[apart] - self.first[apart]
        window = np.repeat(self.first[apart], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        own = np.zeros(len(window), np.uint64)
        for at in range(0, max(0, len(self.data) - self.length + 1), _SIZE):  # in the same blocks as before
            inside = np.flatnonzero((window >= at) & (window < at + _SIZE))
            if len(inside):
                hashes = PrefixHash(self.data[at : at + _SIZE + self.length - 1])
                own[inside] = _scatter(hashes.of(window[inside] - at, self.length))
        self.doc = np.concatenate([self.doc[whole], np.repeat(self.doc[apart], count)])
        self.hash = np.concatenate([self.hash[whole], own])
        self.content = np.concatenate([self.content[whole], own])
        self.anchor = np.concatenate([self.anchor[whole], window + SPLIT])
        self.last = np.concatenate([self.last[whole], window + 1])
        self.first = np.concatenate([self.first[whole], window])


def pack(flags: np.ndarray) -> bytes:
    return np.packbits(flags, axis=1).tobytes()


def unpack(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8).reshape(2, -1), axis=1, count=n).astype(bool)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part, of ``parts`` equal ranges, that a hash belongs to."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def distinct_surroundings(cells: Cells, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells with a new (anchor, content), in order; their smallest ids; each cell's number. Contents are equal in every byte."""
    offset = cells.anchor - cells.first
    order = np.lexsort((ids[cells.doc], offset, cells.content, cells.hash))
    if not len(order):
        return order, np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = cells.last - cells.first
    new = np.concatenate([[True], (np.diff(cells.hash[order]) != 0) | (np.diff(cells.content[order]) != 0) | (np.diff(offset[order]) != 0) | (np.diff(count[order]) != 0)])
    # Equal hashes are not enough: a cell whose bytes differ from those of the first one is sent on its own.
    later = np.flatnonzero(~new)
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[later]]
    new[later] = ~same_bytes(cells.data, cells.first[order[later]], cells.first[head], count[head] + cells.length - 1)
    # such a cell takes a number of its own; the numbers of the cells after it stay with the first one
    alone = np.zeros(len(order), bool)
    alone[later] = new[later]
    rank = np.empty(len(order), np.int64)
    rank[new] = np.arange(int(new.sum()))
    firsts = np.maximum.accumulate(np.where(new & ~alone, np.arange(len(order)), 0))
    number = np.empty(len(order), np.int64)
    number[order] = np.where(alone, rank, rank[firsts])
    return order[new], ids[cells.doc[order[new]]], number


def _load(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a bucket, in an order that does not depend on how its rows arrived.

    Windows are hashed in blocks of the joined texts, and a cell ends where a block does: steps 1, 3 and 5 must agree.
    """
    ids = table.column("id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in table.column("text")]
    order = np.argsort(ids, kind="stable").tolist()
    if len(order) > 1 and (np.diff(ids[order]) == 0).any():
        order.sort(key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order]


def _rows(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary()), ("body", pa.binary())])
SENT = "part int, bucket int, bits binary, body binary"


def _blank() -> dict[str, list]:
    return {name: [] for name in _SENT.names}


def _put(out: dict[str, list], part: int, bucket: int, bits: bytes, body: bytes) -> None:
    for name, value in zip(_SENT.names, (part, bucket, bits, body)):
        out[name].append(value)


def send_anchors(length: int, parts: int, frequent: int):
    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            bucket = table.column("bucket")[0].as_py()
            hashes, flags, at, _ = Cells(_load(table)[1], length).anchors(parts, frequent)
            out = _blank()
            five = hashes.view(np.uint8).reshape(-1, 8)[:, :5]
            for p in range(parts):
                low, high = at[p], at[p + 1]
                if low < high:
                    _put(out, p, bucket, pack(flags[:, low:high]), five[low:high].tobytes())
            return _rows(out, _SENT)

    return run


def match_anchors(table: pa.Table) -> pa.Table:
    """By part: for each anchor that was sent, whether it occurs in more than one document, and whether it is frequent."""
    keys, flags, sizes = [], [], []
    for bits, body in zip(table.column("bits"), table.column("body")):
        five = np.frombuffer(body.as_py(), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(five), 8), np.uint8)
        wide[:, :5] = five
        keys.append(wide.view(np.uint64).ravel())
        flags.append(unpack(bits.as_py(), len(five)))
        sizes.append(len(five))
    key, flag = np.concatenate(keys), np.concatenate(flags, axis=1)
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    at = np.flatnonzero(new)
    together = np.logical_or.reduceat(flag[:, order], at, axis=1)
    together[0] |= np.diff(np.append(at, len(order))) > 1
    answer = np.empty_like(flag)
    answer[:, order] = together[:, np.cumsum(new) - 1]
    out = _blank()
    for i, piece in enumerate(np.split(answer, np.cumsum(sizes)[:-1], axis=1)):
        if piece[0].any():
            _put(out, table.column("part")[i].as_py(), table.column("bucket")[i].as_py(), pack(piece), b"")
    return _rows(out, _SENT)


def _narrow(cells: Cells, answers: pa.Table, parts: int) -> dict[int, bytes]:
    """Keep the cells with an anchor that occurs in several documents, split by window if it is frequent; the bits by part."""
    hashes, _, at, inverse = cells.anchors(parts)
    bits = {p.as_py(): b.as_py() for p, b in zip(answers.column("part"), answers.column("bits")) if len(b.as_py())}
    flags = np.zeros((2, len(hashes)), bool)
    for p, packed in bits.items():
        flags[:, at[p] : at[p + 1]] = unpack(packed, int(at[p + 1] - at[p]))
    chosen = np.flatnonzero(flags[0][inverse]) if len(hashes) else np.zeros(0, np.int64)
    cells.narrowed(chosen, flags[1][inverse[chosen]])
    return bits


def send_surroundings(length: int, parts: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = _blank()
        if not table.num_rows or not answers.num_rows:
            return _rows(out, _SENT)
        with np.errstate(over="ignore"):
            bucket = table.column("bucket")[0].as_py()
            ids, texts = _load(table)
            cells = Cells(texts, length)
            bits = _narrow(cells, answers, parts)
            own, least, _ = distinct_surroundings(cells, ids)
            at = np.searchsorted(part_of(cells.hash[own], parts), np.arange(parts + 1))
            count = (cells.last - cells.first)[own]
            for p in range(parts):
                low, high = at[p], at[p + 1]
                if low == high and p not in bits:
                    continue
                one = own[low:high]
                bytes_ = b"".join(cells.data[a : b + length - 1].tobytes() for a, b in zip(cells.first[one].tolist(), cells.last[one].tolist()))
                head = np.array([high - low], np.int64).tobytes() + cells.hash[one].tobytes() + least[low:high].tobytes()
                body = head + (cells.anchor - cells.first)[one].astype(np.uint8).tobytes() + count[low:high].astype(np.uint8).tobytes() + bytes_
                _put(out, p, bucket, bits.get(p, b""), zlib.compress(body, 1))
            return _rows(out, _SENT)

    return run


def match_surroundings(length: int):
    def run(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            return _rows(_match(table, length), _SENT)

    return run


def _match(table: pa.Table, length: int) -> dict[str, list]:
    """By part: for each cell that was sent, which of its windows occur in a document with a smaller id than the cell's."""
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    sizes = []
    for body in table.column("body"):
        raw = zlib.decompress(body.as_py())
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes.append(n)
        at = 8
        for k, (kind, width) in enumerate(((np.uint64, 8), (np.int64, 8), (np.uint8, 1), (np.uint8, 1))):
            columns[k].append(np.frombuffer(raw, kind, n, at))
            at += width * n
        columns[4].append(np.frombuffer(raw, np.uint8, offset=at))
    anchor, least, offset, count, data = (np.concatenate(c) for c in columns)
    del columns, raw
    offset, count = offset.astype(np.int64), count.astype(np.int64)
    begins = np.cumsum(count + length - 1) - count - length + 1
    masks = np.zeros(len(anchor), np.uint64)
    # Anchors have nothing to do with each other: cells are taken by anchor, about SLICE at a time.
    order = np.argsort(anchor, kind="stable")
    edges = np.flatnonzero(np.diff(anchor[order])) + 1
    stops = np.unique(np.append(edges[np.searchsorted(edges, np.arange(SLICE, len(order), SLICE), side="right").clip(max=max(0, len(edges) - 1))] if len(edges) else [], len(order)).astype(np.int64))
    start = 0
    for stop in stops.tolist() if len(order) else []:
        own = order[start:stop]
        size = count[own] + length - 1
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1])) - np.repeat(ends - size, size)
        masks[own] = _resolve(anchor[own], least[own], offset[own], count[own], ends - size, data[np.repeat(begins[own], size) + place], place.astype(np.uint8), length)
        start = stop
    out = _blank()
    for i, piece in enumerate(np.split(masks, np.cumsum(sizes)[:-1])):
        _put(out, table.column("part")[i].as_py(), table.column("bucket")[i].as_py(), table.column("bits")[i].as_py(), zlib.compress(piece.tobytes(), 1))
    return out


def _resolve(anchor: np.ndarray, least: np.ndarray, offset: np.ndarray, count: np.ndarray, begins: np.ndarray, data: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For cells with all cells of their anchors: the windows that also occur with a smaller id, as bits."""
    hashes = PrefixHash(data, place)
    # Cells of one content are one; where an anchor has a single content, its smallest id answers for all windows. Split
    # windows are left to the sort.
    size = count + length - 1
    content = _scatter(hashes.of(begins, size) ^ count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((least, offset, count, content, anchor))
    new = np.concatenate([[True], (np.diff(anchor[order]) != 0) | (np.diff(content[order]) != 0) | (np.diff(count[order]) != 0) | (np.diff(offset[order]) != 0)])
    new |= offset[order] == SPLIT
    later = np.flatnonzero(~new)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[later]]  # with the smallest id of its content
    same = same_bytes(data, begins[order[later]], begins[first], size[first])
    new[later] = ~same  # a cell that only has the hash of another is a content of its own
    rank = np.cumsum(new) - 1
    group = np.empty(len(order), np.int64)
    group[order] = rank
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    group[order[later[same]]] = rank[at[first[same]]]
    head = order[new]
    # windows of contents, as suffixes; equal ones have their anchor, and it at the same distance
    base = np.cumsum(count[head]) - count[head]
    cell = np.repeat(np.arange(len(head)), count[head])
    within = np.arange(len(cell)) - base[cell]
    smallest = least[head][cell]
    same = np.diff(anchor[head]) == 0  # (heads are in order of their anchors)
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    sought = np.flatnonzero(several[cell])
    if len(sought):
        distance = offset[head][cell[sought]] - within[sought]
        by = np.lexsort((distance, anchor[head][cell[sought]]))
        sought, distance = sought[by], distance[by]
        classes = np.concatenate([[0], np.cumsum((np.diff(anchor[head][cell[sought]]) != 0) | (np.diff(distance) != 0))])
        starts = begins[head][cell[sought]] + within[sought]
        ranked = sort_suffixes(data, hashes, starts, classes, length)
        ordered = starts[ranked]  # classes keep their places
        equal = np.concatenate([[False], classes[1:] == classes[:-1]])
        pairs = np.flatnonzero(equal)
        whole = hashes.extension(ordered[pairs - 1], ordered[pairs], length) >= length
        equal[pairs] = whole
        checked = pairs[whole]
        alike = equal.copy()
        equal[checked] = windows_equal(data, ordered[checked - 1], ordered[checked], length)
        # Hashes that collide can stand between equal windows. A class in which windows of one hash differ, or do not
        # stand together, is sorted again by its bytes.
        by = np.lexsort((hashes.of(ordered, length), classes))
        kinds = np.concatenate([[True], (np.diff(classes[by]) != 0) | (np.diff(hashes.of(ordered[by], length)) != 0)])
        torn = np.bincount(classes[by[kinds]], minlength=classes[-1] + 1) != np.bincount(classes[~alike], minlength=classes[-1] + 1)
        torn[classes[alike & ~equal]] = True
        if torn.any():
            again = np.flatnonzero(torn[classes])
            windows = data[ordered[again][:, None] + np.arange(length)]
            by = np.lexsort((*windows.T[::-1], classes[again]))
            ranked[again], windows = ranked[again[by]], windows[by]
            equal[again] = np.concatenate([[False], (windows[1:] == windows[:-1]).all(1) & (np.diff(classes[again]) == 0)])
        run = np.flatnonzero(~equal)
        lowest = np.minimum.reduceat(smallest[sought[ranked]], run)
        smallest[sought[ranked]] = np.repeat(lowest, np.diff(np.append(run, len(ranked))))
    masks = np.zeros(len(order), np.uint64)
    for w in range(int(count.max())):
        has = np.flatnonzero(count > w)
        hit = smallest[base[group[has]] + w] < least[has]
        masks[has[hit]] |= np.uint64(1 << w)
    return masks


_RESULT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])
RESULT = "id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string"


def mark_texts(length: int, parts: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            return _mark(table, answers, length, parts)

    return run


def _mark(table: pa.Table, answers: pa.Table, length: int, parts: int) -> pa.Table:
    if not table.num_rows:
        return _RESULT.empty_table()
    ids, texts = _load(table)
    removed = None
    if answers.num_rows:
        cells = Cells(texts, length)
        _narrow(cells, answers, parts)
        own, least, number = distinct_surroundings(cells, ids)
        at = np.searchsorted(part_of(cells.hash[own], parts), np.arange(parts + 1))
        masks = np.zeros(len(own), np.uint64)
        for p, body in zip(answers.column("part"), answers.column("body")):
            masks[at[p.as_py()] : at[p.as_py() + 1]] = np.frombuffer(zlib.decompress(body.as_py()), np.uint64)
        count = cells.last - cells.first
        full = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
        # a later document of this bucket has all windows of the cell from the bucket's smallest one
        mask = np.where(ids[cells.doc] > least[number], full, masks[number]) if len(count) else full
        change = np.zeros(len(cells.data) + 1, np.int32)
        whole = mask == full
        np.add.at(change, cells.first[whole], 1)
        np.add.at(change, cells.last[whole] + length - 1, -1)
        some = np.flatnonzero(~whole & (mask != 0))
        for w in range(int(count.max()) if len(some) else 0):
            hit = cells.first[some[(mask[some] >> np.uint64(w)) & np.uint64(1) == 1]] + w
            np.add.at(change, hit, 1)
            np.add.at(change, hit + length, -1)
        removed = np.cumsum(change[:-1]) > 0
        starts = cells.starts
    columns: dict[str, list] = {name: [] for name in _RESULT.names}
    for i, text in enumerate(texts):
        spans = []
        if removed is not None:
            gone = removed[starts[i] : starts[i] + len(text)]
            if gone.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
                text = np.frombuffer(text, np.uint8)[~gone].tobytes()
        columns["spans"].append(spans)
        columns["kept_sha256"].append(sha256(text).hexdigest())
    columns["id"] = [None if i == _LAST else i for i in ids.tolist()]
    columns["n_bytes"] = [len(t) for t in texts]
    return _rows(columns, _RESULT)


def repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """For each row ``id, n_bytes, spans, kept_sha256``: what is removed from its text, and the digest of the rest.

    A byte is removed if a substring of ``length`` bytes covers it that also starts in a row with a smaller id. Texts
    are UTF-8 bytes, null ones empty; null ids come after all others. Rows of one id do not remove from each other,
    nor does a text from itself. Spans are maximal, in bytes. ``length`` is more than GRAM, and less than GRAM + 64.
    Empty tables give empty results.
    """
    if not GRAM < length < GRAM + 64:
        raise ValueError(f"length must be between {GRAM} and {GRAM + 64}")
    text = F.coalesce(column(docs, text_col), F.lit("")).alias("text")
    every = docs.select(column(docs, id_col).cast("long").alias("id"), text)
    # Short texts hold no such substring; however many are alike, they need no place.
    short = every.filter(F.octet_length("text") < length)
    short = short.selectExpr("id", "cast(octet_length(text) as bigint) AS n_bytes", "cast(array() as array<struct<start: bigint, end: bigint>>) AS spans", "sha2(cast(text as binary), 256) AS kept_sha256")
    rows = every.filter(F.octet_length("text") >= length)
    total = rows.select(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    parts = max(LEAST, -(-total // BUCKET))
    dealt = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int").alias("bucket"), "id", F.col("text").cast("binary").alias("text"))
    by_bucket = lambda: dealt.groupBy("bucket")
    anchors = by_bucket().applyInArrow(send_anchors(length, parts, frequent), SENT)
    several = anchors.groupBy("part").applyInArrow(match_anchors, SENT)
    around = by_bucket().cogroup(several.groupBy("bucket")).applyInArrow(send_surroundings(length, parts), SENT)
    matched = around.groupBy("part").applyInArrow(match_surroundings(length), SENT)
    return by_bucket().cogroup(matched.groupBy("bucket")).applyInArrow(mark_texts(length, parts), RESULT).unionByName(short)
