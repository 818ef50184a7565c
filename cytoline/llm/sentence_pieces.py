"""SentencePiece encoding and decoding that keeps the place of every piece in the original text.

Normalisation walks the text by the longest prefix that the model's compiled character map knows, and records for
every normalised byte where its source began. Byte-pair merges then run on the normalised text, and each piece is
projected back to a span of original UTF-8 bytes. Nothing merges across the borders of a unit (mostly a word with the
space before it), so a unit is normalised, merged and projected once, and its ids and the widths of its spans remembered.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ready, sparing
from .token_counts import Memory

SPACE = "▁"  # stands for a space in normalised text
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in the model format


NEVER = float("-inf")
RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
PLAIN_RUNS = re.compile(" *[^ \n]+| +|\n")


class CharacterMap:
    """The compiled character map of a model: a double-array trie of byte strings, and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size :]

    def longest_prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        """The replacement at ``at`` and how many bytes it stands for: the longest known prefix, else one character."""
        units, best = self.units, None
        if units:
            node = self._children(0)
            for i in range(at, len(data)):
                node ^= data[i]
                unit = units[node] if node < len(units) else 0
                if unit & 0x800000FF != data[i]:
                    break
                node ^= (unit >> 10) << ((unit & 0x200) >> 6)
                if unit >> 8 & 1:
                    best = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if best:
            start, taken = best
            return self.texts[start : self.texts.index(b"\0", start)], taken
        taken = _width(data[at])
        return data[at : at + taken], taken

    def _children(self, node: int) -> int:
        unit = self.units[node]
        return node ^ (unit >> 10) << ((unit & 0x200) >> 6)


class Piece(NamedTuple):
    id: int
    piece: str
    start: int  # bytes of the original text
    end: int


#: Units of each kind that a worker remembers in each half of its memory: where other models ran before, and by itself.
UNITS, OWN_UNITS = 45_000, 250_000


class Model:
    """A byte-pair model of the sentencepiece library, encoding and decoding as that library does."""

    def __init__(self, proto: bytes, units: int = UNITS) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        if model.trainer_spec.model_type != 2 or any(p.type == USER for p in model.pieces) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a byte-pair model without user-defined pieces is needed")
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces)}
        self.unknown = self.kinds.index(UNKNOWN)
        self.score = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, UNUSED)}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        long = [p for p in self.score if len(p) > 1]
        #: Borders that are found fast: a space starts a unit, and a line end is a unit's first character.
        self.fast = not self.map.units and not self.squeeze and self.escape and self.dummy and not any(
            "\n" in p or SPACE in p.lstrip(SPACE) for p in long
        )
        #: All neighbouring characters within pieces: merges cross no other border.
        self.inside = {p[i : i + 2] for p in long for i in range(len(p) - 1)}
        self.special = {i for i, k in enumerate(self.kinds) if k == BYTE}
        self.shown = [" ⁇ " if k == UNKNOWN else "" if k == CONTROL else p.replace(SPACE, " ") for p, k in zip(self.pieces, self.kinds)]
        #: Pieces that decode to themselves, and their ids in decimal.
        self.decimal = {p: str(i) for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.units, self.ends, self.runs = Memory(self._unit, units), Memory(self._stretch, units), Memory(self._run, units)

    # -- normalisation --------------------------------------------------------------------------------------------

    def _mapped(self, text: str) -> tuple[list[tuple[bytes, int]], int]:
        """The map's replacements along the text, by longest prefix, and where each began; and the text's bytes."""
        data, out, at = text.encode(), [], 0
        while at < len(data):
            piece, taken = self.map.longest_prefix(data, at)
            out.append((piece, at))
            at += taken
        return out, len(data)

    def _joined(self, chunks: list[tuple[bytes, int]]) -> tuple[bytearray, list[int]]:
        """Normalised bytes with spaces escaped, and for each byte where its source began."""
        out, place = bytearray(), []
        space = SPACE.encode() if self.escape else b" "
        for piece, source in chunks:
            piece = piece.replace(b" ", space)
            out += piece
            place += [source] * len(piece)
        return out, place

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text and, for each of its bytes and its end, the byte of the original where it began."""
        mapped, size = self._mapped(text)
        if self.squeeze:
            while mapped and mapped[0][0] in (b" ", b""):
                mapped.pop(0)
        chunks = [(b" ", mapped[0][1])] if mapped and self.dummy else []
        after_space = self.squeeze
        for piece, source in mapped:
            while after_space and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                chunks.append((piece, source))
                after_space = self.squeeze and piece.endswith(b" ")
        out, place = self._joined(chunks)
        space = SPACE.encode() if self.escape else b" "
        while self.squeeze and out.endswith(space):
            del out[-len(space) :], place[-len(space) :]
        return out.decode(), [*place, size]

    # -- merges ---------------------------------------------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """The pieces of normalised text: the best-scored pair is merged first, the one further left among equals."""
        score, parts = self.score, list(text)
        if len(parts) < 60:
            pairs = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            while pairs and (best := max(pairs)) > NEVER:
                i = pairs.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i:
                    pairs[i - 1] = score.get(parts[i - 1] + parts[i], NEVER)
                if i < len(pairs):
                    pairs[i] = score.get(parts[i] + parts[i + 1], NEVER)
            return parts
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        agenda: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (s := score.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(agenda, (-s, i, parts[i] + parts[after[i]]))

        for i in range(len(parts) - 1):
            offer(i)
        while agenda:
            _, i, both = heapq.heappop(agenda)
            j = after[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def aligned(self, normal: str, place: list[int]) -> tuple[list[int], list[int]]:
        """The ids of normalised text, and how many original bytes each stands for.

        ``place`` has the source of each byte and of the end. A character that no piece has becomes its bytes, of which
        the first stands for all.
        """
        ids, widths, at = [], [], 0
        for piece in self.merge(normal):
            size = len(piece.encode())
            width = place[at + size] - place[at]
            found = self.id_of.get(piece, self.unknown)
            if self.kinds[found] == UNKNOWN and self.byte_ids:
                ids += [self.byte_ids[b] for b in piece.encode()]
                widths += [width] + [0] * (size - 1)
            else:
                ids.append(found)
                widths.append(width)
            at += size
        return ids, widths

    def _run(self, run: str) -> tuple[list[int], list[int]]:
        """Ids and widths of a part of a text that nothing merges out of; not its beginning."""
        mapped, size = self._mapped(run)
        out, place = self._joined(mapped)
        return self.aligned(out.decode(), [*place, size])

    def _stretch(self, part: str) -> tuple[str, ...]:
        """The ids and widths of such a part in decimal, joined by commas; with a third entry if the ids do not decode to it."""
        if part.isascii() and not self.map.units:  # every byte is a character and stands for itself
            merged = self.merge(part.replace(" ", SPACE))
            ids = [self.decimal.get(p) for p in merged]
            if None not in ids:
                return ",".join(ids), ",".join([str(len(p)) for p in merged])
        ids, widths = self._run(part)
        lines = ",".join(map(str, ids)), ",".join(map(str, widths))
        return lines if self._text(ids) == part else (*lines, "")

    def _unit(self, key: str) -> tuple[str, ...]:
        """As :func:`_stretch`, for a unit without the space that it starts with; a unit that starts with a line end has none.

        Last characters that no piece joins with what is before them (as a full stop) are encoded on their own.
        """
        if key[:1] == "\n":
            return self._stretch(key)
        end = len(key)
        while end > 1 and key[end - 2 : end] not in self.inside:
            end -= 1
        if end == len(key):
            return self._stretch(" " + key)
        return tuple(map(",".join, zip(self.units[key[:end]], *map(self.ends.__getitem__, key[end:])))) if end else self._stretch(" ")

    def round_trip(self, text: str) -> tuple[str, str, str]:
        """The ids of a whole text in decimal, joined by commas; the original bytes that each stands for, likewise; and the text that the ids decode to."""
        if not text:
            return "", "", ""
        if self.fast and "  " not in text and text[0] != " " and SPACE not in text:
            # A unit starts at a space or a line end; equal units are encoded, aligned and decoded once.
            units = list(map(self.units.__getitem__, text.replace("\n", " \n").split(" ")))
            if max(map(len, units)) == 2:
                width, _, more = ",".join([u[1] for u in units]).partition(",")
                width = str(int(width) - 1)  # the first space is not in the text
                return ",".join([u[0] for u in units]), f"{width},{more}" if more else width, text
        ids, widths = self.encode(text)
        return ",".join(map(str, ids)), ",".join(map(str, widths)), self.decode(ids)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of a whole text, and how many original bytes each stands for."""
        if not self.fast or SPACE in text or not text:
            normal, place = self.normalise(text)
            if not self.fast:
                return self.aligned(normal, place)
            ids, widths, at = [], [], 0
            for run in RUNS.findall(normal):
                end = at + len(run.encode())
                own = self.aligned(run, place[at : end + 1])
                ids += own[0]
                widths += own[1]
                at = end
            return ids, widths
        # Spaces in a row can be one piece, with or without what follows; nothing else crosses these borders.
        ids, widths = [], []
        for run in PLAIN_RUNS.findall(" " + text):
            own = self.runs[run]
            ids += own[0]
            widths += own[1]
        widths[0] -= 1  # the first space is not in the text
        return ids, widths

    def pieces_of(self, text: str) -> list[Piece]:
        """Every piece of the text with its span of original bytes; of a character's byte pieces the first has it."""
        ids, widths = self.encode(text)
        ends = list(accumulate(widths))
        return [Piece(i, self.pieces[i], end - width, end) for i, width, end in zip(ids, widths, ends)]

    # -- decoding -------------------------------------------------------------------------------------------------

    def _text(self, ids: list[int]) -> str:
        if not self.special.isdisjoint(ids):
            out, raw = [], bytearray()
            for i in ids:
                if self.kinds[i] == BYTE:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(_lenient(raw))
                    raw = bytearray()
                out.append(self.shown[i])
            return "".join(out) + _lenient(raw)
        return "".join(map(self.shown.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front is taken away again."""
        spoken = next((i for i in ids if self.kinds[i] != CONTROL), None)
        lead = spoken is not None and (self.dummy or self.squeeze) and self.kinds[spoken] == NORMAL and self.pieces[spoken][0] == SPACE
        return self._text(ids)[lead:]


def _width(lead: int) -> int:
    """Bytes of the UTF-8 character that starts with this byte."""
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _lenient(raw: bytearray) -> str:
    """UTF-8 with each byte that is not part of a character replaced."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


def model(proto: bytes, units: int = UNITS) -> Model:
    """The worker's model for these bytes; it keeps the units it has met from task to task."""
    return ready(("sentence pieces", hash(proto), units), lambda: Model(proto, units))


DIGEST = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, widths_sha256: string>"


def digest(text: Column, proto: bytes, units: int = UNITS) -> Column:
    """Encode and decode each whole text: the number of ids, digests of the ids, of the decoded text and of the widths.

    Widths are the lengths, in original UTF-8 bytes, of the spans that the ids stand for; spans follow each other.
    """

    @F.arrow_udf(DIGEST)
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from hashlib import sha256

        own = model(proto, units)
        for texts in batches:
            counts, digests = [], ([], [], [])
            for value in texts:
                ids, widths, back = own.round_trip(value.as_py() or "")
                counts.append(ids.count(",") + 1 if ids else 0)
                for out, line in zip(digests, (ids, back, widths)):
                    out.append(sha256(line.encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), *(pa.array(d, pa.string()) for d in digests)], ["n_tokens", "ids_sha256", "decoded_sha256", "widths_sha256"])

    return run(text)


PIECES = "array<struct<id: int, piece: string, start: bigint, end: bigint>>"


def pieces(text: Column, proto: bytes) -> Column:
    """The pieces of each text with their spans of original UTF-8 bytes; none for a null or empty text."""

    @F.arrow_udf(PIECES)
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model(proto)
        kind = pa.list_(pa.struct([("id", pa.int32()), ("piece", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for texts in batches:
            yield pa.array([[p._asdict() for p in own.pieces_of(t.as_py() or "")] for t in texts], kind)

    return run(text)


def ids(text: Column, proto: bytes) -> Column:
    """The ids of each whole text; none for a null or empty text."""

    @F.arrow_udf("array<int>")
    @sparing
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model(proto)
        for texts in batches:
            lines = (own.round_trip(t.as_py() or "")[0] for t in texts)
            parts = [np.array(line.split(","), np.int32) if line else np.zeros(0, np.int32) for line in lines]
            ends = np.cumsum([0, *map(len, parts)])
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return run(text)


def measure(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text", units: int = OWN_UNITS) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256, widths_sha256`` for each row; null texts are empty, repeated rows are rows.

    Empty tables give empty results; null ids stay null; other columns are not read.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(column(docs, id_col).alias("id"), digest(text, proto, units).alias("own"))
    return rows.select("id", "own.*")
