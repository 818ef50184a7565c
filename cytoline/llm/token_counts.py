"""Exact token counts by prefix dynamic programming over byte-pair merges.

A sequence of tokens is the encoding of its text exactly if every token is its own encoding and every two neighbours
stay apart when their text is encoded on its own (Berglund and van der Merwe, 2023). So the last token of every prefix
follows from the last tokens of shorter prefixes, and one pass over a word stores the token count of all its prefixes:
budgets and truncation points are read off without encoding anything again.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ready

#: Entries of each half of a worker's memory, of words with their counts alone, and the longest that are remembered.
REMEMBERED, WORDS, LONGEST = 60_000, 250_000, 64
#: Places of the door through which words come into the memory, and how many are taken before all are free again.
DOOR, TAKEN = 1 << 20, 1 << 18


#: The division into words of the model whose texts are divided here, and what keeps a text from that.
#: Beyond these characters, normalisation or a class of characters could differ; İ becomes two characters in lower case.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
RUN = re.compile(r"[^ \t\n\r\x0b\x0c]+")
UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\xa9\\xab-\\xac\\xae-\\xb1\\xb4\\xb6-\\xb8\\xbb\\xbf-\\u012f\\u0131-\\u0148\\u014a-\\u017e]")

_shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
_hidden = [b for b in range(256) if b not in _shown]
#: Byte-level models write bytes as printable characters: themselves if they are, else from U+0100 on.
BYTE_SYMBOLS = {b: chr(b) for b in _shown} | {b: chr(256 + i) for i, b in enumerate(_hidden)}


#: Normalised characters before a place that decide how what follows is divided into words; only `'re` looks so far.
TAIL = 4


@cache
def second_parts() -> frozenset[str]:
    """Characters that composition can join to the one before though their combining class is 0."""
    pairs = (unicodedata.decomposition(chr(c)) for c in range(sys.maxunicode + 1))
    seconds = {chr(int(d.split()[1], 16)) for d in pairs if d and d[0] != "<" and " " in d}
    jamo = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    return frozenset({c for c in seconds if not unicodedata.combining(c)} | jamo)


def joined(run: str) -> list[str]:
    """The run cut before every character that normalisation never joins to, nor moves over, what comes before it."""
    out, start, seconds = [], 0, second_parts()
    for i in range(1, len(run)):
        if not unicodedata.combining(run[i]) and run[i] not in seconds:
            out.append(run[start:i])
            start = i
    return [*out, run[start:]]


class Memory(dict):
    """Results by key, worked out when missing. Of more than ``most`` keys, those not used lately are forgotten.

    Most distinct words occur once; a key is remembered when it is met for the second time (as far as a hash tells).
    Keys of more than LONGEST characters never are, so that memory is bounded whatever the texts.
    """

    def __init__(self, work, most: int = REMEMBERED) -> None:
        super().__init__()
        self.work, self.most, self.older, self.door, self.taken = work, most, {}, bytearray(DOOR), 0

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
            place = hash(key) & (DOOR - 1)
            if len(key) > LONGEST:
                return found
            if not self.door[place]:
                if self.taken >= TAKEN:
                    self.door, self.taken = bytearray(DOOR), 0
                self.door[place] = 1
                self.taken += 1
                return found
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class PrefixCounter:
    """Counts of a tokenizers BPE model with an end-of-word suffix, for every prefix of a text."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("a plain BPE model is needed")
        self.library = Tokenizer.from_str(definition)
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.vocabulary = set(model["vocab"])
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.hints = tuple(added)
        self.longest = max(map(len, self.vocabulary))
        self.made: dict[str, tuple[int, str, str]] = {}
        self.whole: dict[str, bool] = {}
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and splits[:1] == [SPLIT]
        self.by_word, self.by_run = Memory(self._word, WORDS), Memory(self.chunk)

    # -- merges ---------------------------------------------------------------------------------------------------

    def symbols(self, token: str) -> list[str]:
        """The single symbols of a token; the suffix belongs to the last one."""
        ended = bool(self.suffix) and token.endswith(self.suffix)
        out = list(token[: -len(self.suffix)] if ended else token)
        if ended:
            out[-1] += self.suffix
        return out

    def is_whole(self, token: str) -> bool:
        """Whether a vocabulary entry is its own encoding; notes the merge that completes it."""
        known = self.whole.get(token)
        if known is None:
            parts, none, last = self.symbols(token), len(self.rank), None
            while len(parts) > 1:
                ranks = [self.rank.get(p, none) for p in zip(parts, parts[1:])]
                best = min(ranks)
                if best == none:
                    break
                i = ranks.index(best)
                last = (best, parts[i], parts[i + 1])
                parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]]
            known = self.whole[token] = len(parts) == 1
            self.made[token] = last or (-1, "", "")
        return known

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge joins two neighbouring tokens.

        Their merges are undone, the latest first. At each moment the two pieces at the border would have merged if
        their rule comes before the merges that took them inwards; among equal ranks, the one further left is first.
        """
        rank, made, never = self.rank, self.made, len(self.rank)
        left_until = right_until = never
        while True:
            joined = rank.get((left, right), never)
            if joined < left_until and joined <= right_until:
                return False
            of_left, of_right = made[left], made[right]
            if of_left[0] > of_right[0]:
                left_until, _, left = of_left
            elif of_right[0] >= 0:
                right_until, right, _ = of_right
            else:
                return True
            for piece in (left, right):
                if piece not in made:
                    self.is_whole(piece)

    # -- prefixes -------------------------------------------------------------------------------------------------

    def word_prefixes(self, word: str, ends: bool = True) -> tuple[list[int], list[int]]:
        """For a word of byte symbols: ``open[i]``, tokens of its first i symbols if the word goes on, and ``shut[i]``,
        if it ends there. With ``ends`` false only the last entry of ``shut`` is worked out."""
        return self.states(word, ends)[1:]

    def states(self, word: str, ends: bool = True) -> tuple[list[str], list[int], list[int]]:
        """As :meth:`word_prefixes`, with the last token of every prefix before."""
        n = len(word)
        last, opened, shut = [""] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            low = max(0, i - self.longest)
            for start in range(low, i):
                token = word[start:i]
                if token in self.vocabulary and self.is_whole(token) and (not start or self.stay_apart(last[start], token)):
                    last[i], opened[i] = token, opened[start] + 1
                    break
            if not self.suffix:
                shut[i] = opened[i]
            elif ends or i == n:
                for start in range(low, i):
                    token = word[start:i] + self.suffix
                    if token in self.vocabulary and self.is_whole(token) and (not start or self.stay_apart(last[start], token)):
                        shut[i] = opened[start] + 1
                        break
        return last, opened, shut

    def resumed(self, word: str, last: list[str], opened: list[int], at: int, more: str) -> int:
        """Tokens of a word that has the first ``at`` symbols of ``word``, whose states are given, and ends after ``more``."""
        same = next((i for i, (a, b) in enumerate(zip(word[at : at + len(more)], more)) if a != b), min(len(word) - at, len(more)))
        at, more = at + same, more[same:]
        base = max(0, at - self.longest)
        text, last, opened = word[base:at] + more, last[base : at + 1], opened[base : at + 1]
        for i in range(at - base + 1, len(text) + 1):
            for start in range(max(0, i - self.longest), i):
                token = text[start:i]
                if token in self.vocabulary and self.is_whole(token) and (start + base == 0 or self.stay_apart(last[start], token)):
                    last.append(token)
                    opened.append(opened[start] + 1)
                    break
        if not self.suffix:
            return opened[-1]
        for start in range(max(0, len(text) - self.longest), len(text)):
            token = text[start:] + self.suffix
            if token in self.vocabulary and self.is_whole(token) and (start + base == 0 or self.stay_apart(last[start], token)):
                return opened[start] + 1
        raise ValueError(f"no tokens for {word[:at] + more!r}")

    def words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        """The library's words of a text without special strings: byte symbols and places in the normalised text."""
        return self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text) if self.library.normalizer else text)

    def chunk(self, text: str) -> int:
        """Tokens of any text, through the library's normalisation and its own division into words."""
        total = 0
        for k, part in enumerate(self.special.split(text) if self.special and any(h in text for h in self.hints) else [text]):
            if k % 2:
                total += 1
            elif part:
                total += sum(self.word_prefixes(w, ends=False)[1][-1] for w, _ in self.words(part))
        return total

    def count(self, text: str) -> int:
        """Tokens of the whole text; each distinct word is worked out once.

        Western texts with nothing to normalise but case are divided here. Anything else goes through the library in
        runs between spaces, which no word crosses.
        """
        return self.fitting(text, len(text.encode()))[0]

    def _word(self, word: str) -> int:
        if not word.isascii():
            word = "".join(map(BYTE_SYMBOLS.__getitem__, word.encode()))
        if self.is_whole(word + self.suffix) if word + self.suffix in self.vocabulary else False:
            return 1
        return self.word_prefixes(word, ends=False)[1][-1]

    def prefixes(self, text: str) -> list[int]:
        """``out[i]``: tokens of the first i code points of the text, each prefix taken as a text of its own.

        Words cross no space, so counts of runs between spaces add up, whatever normalisation does to the spaces.
        """
        out, before, last = [0] * (len(text) + 1), 0, ""
        for k, (part, at) in enumerate(self._segments(text)):
            if k % 2:  # a special string counts once it is complete; until then its beginning continues the text before it
                for i in range(1, len(part)):
                    out[at + i] = out[at - len(last)] + self.chunk(last + part[:i])
                before += 1
                out[at + len(part)] = before
                continue
            place, last = 0, ""
            for run in RUN.finditer(part):
                out[at + place + 1 : at + run.start() + 1] = [before] * (run.start() - place)
                inner = self.run_prefixes(run.group())
                out[at + run.start() + 1 : at + run.end() + 1] = [before + n for n in inner]
                before, place = before + inner[-1], run.end()
                last = run.group() if place == len(part) else ""
            out[at + place + 1 : at + len(part) + 1] = [before] * (len(part) - place)
        return out

    def run_prefixes(self, run: str) -> list[int]:
        """Tokens of the first 1, 2, ... code points of a run without spaces or special strings.

        Where characters are joined by normalisation, the run is cut between those that never are (:func:`joined`).
        Counts are stored once over the whole normalised run, word by word. Only a prefix that ends inside such a piece
        can differ from the normalised run's own prefixes: its last few characters are then added to the stored states.
        """
        normal = self.library.normalizer.normalize_str if self.library.normalizer else str
        pieces, whole = list(run), normal(run)
        each = list(map(normal, pieces))
        if "".join(each) != whole:
            pieces = joined(run)
            each = list(map(normal, pieces))
            if "".join(each) != whole or not self.plain:  # of a model whose normalisation is not known here
                return [self.chunk(run[:i]) for i in range(1, len(run) + 1)]
        size = [0, *accumulate(len(c.encode()) for c in whole)]
        closed, before, place, known = [0] * (len(whole) + 1), 0, 0, []
        for word, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(whole):
            closed[place + 1 : start + 1] = [before] * (start - place)
            last, opened, shut = self.states(word)
            for i in range(start, end):
                closed[i + 1] = before + shut[size[i + 1] - size[start]]
            if whole[start] == "'" and whole[start + 1 : end].isalpha():  # of 're, the beginning 'r is two words
                for i in range(start + 1, end):
                    closed[i] = before + self.chunk(whole[start:i])
            known.append((start, end, before, word, last, opened))
            before, place = before + shut[-1], end
        closed[place + 1 :] = [before] * (len(whole) - place)
        out, at = [], 0
        for piece, normalised in zip(pieces, each):
            end = ""  # of the normalised beginning of the piece
            for i in range(1, len(piece)):
                if i > 1 and unicodedata.combining(end[-1]) and unicodedata.combining(end[-1]) == unicodedata.combining(piece[i - 1]):
                    end += normal(piece[i - 1])  # one more mark of a kind: neither joined nor moved
                else:
                    end = normal(piece[:i])
                same = whole.startswith(end, at)
                out.append(closed[at + len(end)] if same else self._ending(whole, at, end, size, known))
            at += len(normalised)
            out.append(closed[at])
        return out

    def _ending(self, whole: str, at: int, end: str, size: list[int], known: list[tuple]) -> int:
        """Tokens of ``whole[:at] + end``, from the states of the words of ``whole``."""
        total, start, first = 0, 0, None
        if at:
            k = bisect_right(known, max(0, at - TAIL), key=lambda w: w[0]) - 1
            start, stop, total, word, last, opened = known[k]
            first = word, last, opened, 0
            if stop - start > TAIL and start < at - TAIL:
                # a long word is of letters alone or of neither letters nor digits: any part of it is divided alike, unless
                # it is an apostrophe before what could be an ending
                cut = at - TAIL
                if cut + 1 < stop or whole[cut] != "'":
                    first, start = (word, last, opened, size[cut] - size[start]), cut
        for j, (more, _) in enumerate(self.library.pre_tokenizer.pre_tokenize_str(whole[start:at] + end)):
            total += self.resumed(*first, more) if first and not j else self.word_prefixes(more, ends=False)[1][-1]
        return total

    def _segments(self, text: str) -> list[tuple[str, int]]:
        at, out = 0, []
        for part in self.special.split(text) if self.special else [text]:
            out.append((part, at))
            at += len(part)
        return out

    def fitting(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and how many code points its longest prefix of at most ``budget`` tokens has.

        Counts of words add up, and those of runs between spaces whatever follows; so only the run in which the budget
        is crossed is asked for the counts of its prefixes.
        """
        plain = self.plain and not UNUSUAL.search(text) and not any(h in text for h in self.hints)
        if plain:
            lower = text.lower()
            sums = list(accumulate(map(self.by_word.__getitem__, PLAIN_WORD.findall(lower)), initial=0))
        else:
            runs = list(RUN.finditer(text))
            sums = list(accumulate((self.by_run[r.group()] for r in runs), initial=0))
        if sums[-1] <= budget:
            return sums[-1], len(text)
        k = bisect_right(sums, budget) - 1
        at = next(islice(PLAIN_WORD.finditer(lower), k, None)).start() if plain else runs[k].start()
        start = at
        while start and RUN.match(text[start - 1]):
            start -= 1
        before = sums[k - len(PLAIN_WORD.findall(lower, start, at))] if plain else sums[k]
        own = self.prefixes(RUN.match(text, start).group())
        return sums[-1], start + max(i for i, n in enumerate(own) if before + n <= budget)

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens, from the stored counts."""
        return text[: self.fitting(text, budget)[1]]


def counter(definition: str) -> PrefixCounter:
    """The worker's counter for this definition; it keeps what it has learned from task to task."""
    return ready(("token counts", hash(definition)), lambda: PrefixCounter(definition))


def token_count(text: Column, definition: str, budget: int) -> Column:
    """The exact number of tokens of each whole text, and the bytes of its longest prefix of at most ``budget`` tokens.

    ``definition``: the tokenizer file's content.
    """

    @F.arrow_udf("struct<n_tokens: bigint, kept_bytes: bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(definition)
        for texts in batches:
            counts, kept = [], []
            for value in texts:
                text = value.as_py() or ""
                n, fits = own.fitting(text, budget)
                counts.append(n)
                kept.append(len(text[:fits].encode()))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(kept, pa.int64())], ["n_tokens", "kept_bytes"])

    return count(text)


def prefix_counts(text: Column, definition: str) -> Column:
    """The exact numbers of tokens of all prefixes of each text, by code points from 0 on; a null text is empty."""

    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        prefixes = counter(definition).prefixes
        for texts in batches:
            yield pa.array([prefixes(t.as_py() or "") for t in texts], pa.list_(pa.int64()))

    return run(text)


def truncated(text: Column, definition: str, budget: int) -> Column:
    """The longest prefix of each text that has at most ``budget`` tokens; a null text is empty."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        truncate = counter(definition).truncate
        for texts in batches:
            yield pa.array([truncate(t.as_py() or "", budget) for t in texts], pa.string())

    return run(text)


def measure(docs: DataFrame, definition: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit, kept_bytes`` for each row; repeated rows are counted each, null ids stay null.

    ``kept_bytes`` is what truncation to ``limit`` tokens leaves. A null text is empty and has no tokens. Empty tables
    give empty results; other columns are not read.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = docs.select(column(docs, id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, definition, limit).alias("own"))
    return rows.select("id", "n_bytes", "own.n_tokens", (F.col("own.n_tokens") > limit).alias("over_limit"), "own.kept_bytes")
