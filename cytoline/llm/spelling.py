"""Spelling variants: words one edit apart, grouped under the form that is used far more often.

A symmetric-delete join: every word emits itself and its distinct single deletions, and words that share such a key
meet. Two words one edit apart share exactly one key: the shorter word itself where a letter was inserted, the word
without the replaced letter otherwise. So no pair is met twice once its distance has been verified, and the pairs of a
word need not be made distinct. How many words meet in a key is bounded by the alphabet and the key's length, not by
the corpus, as words are counted before they emit anything.

A run of letters can be as long as a text, and all its deletions together are as large as its square. Words longer than
:data:`LONG` therefore emit polynomial hashes of their deletions, each worked out from sums over the word's letters, and
their digest in place of themselves; what meets is verified on the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, settle

#: A maximal run of letters.
RUN = r"[A-Za-zÀ-ÿ]+"
#: Words of more code points than these emit hashes. Words of exactly as many do both.
LONG = 64
#: Fixed moduli and bases of the hashes of deletions: two primes below 2**31.
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 69_069_069)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def typed(run: Column, ident: Column, one_in: int = 31) -> Column:
    """The run as it is taken: one in so many, by the checksum of id and run, lacks a letter. A null id counts as ''."""
    h = F.crc32(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % one_in == 0, shorter).otherwise(run)


def words(docs: DataFrame, shortest: int = 7, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the distinct results of at least ``shortest`` code points that occur at least ``least`` times.

    Null and empty texts have none. Rows count each time, also those that repeat an id and a text. Occurrences are
    counted within each task before any are shuffled, so a frequent word is one row of a task.
    """
    lowered = F.translate(column(docs, text_col), UPPER, LOWER)
    runs = docs.select(column(docs, id_col).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    # A run that is too short has no result that is long enough.
    out = runs.filter(F.char_length("run") >= shortest).select(typed(F.col("run"), F.col("id")).alias("word"))
    return out.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def keys(word: Column) -> Column:
    """The word and its distinct single deletions."""
    cut = F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word))))
    return F.concat(F.array(word), F.array_distinct(cut))


def deletion_hashes(word: str) -> np.ndarray:
    """Distinct hashes of the word and of its single deletions, in time and space that grow with its length."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64) + 1
    out = []
    for prime, base in zip(PRIMES, BASES):
        powers = np.ones(1, np.int64)
        while len(powers) < len(codes):
            powers = np.concatenate([powers, powers * pow(base, len(powers), prime) % prime])
        terms = codes * powers[: len(codes)] % prime
        upto = np.concatenate([[0], np.cumsum(terms)])  # of at most 2**31 letters
        # the letters after the deleted one move down by a power
        rest = (upto[-1] - upto[1:]) % prime * pow(base, -1, prime) % prime
        out.append(np.append((upto[:-1] + rest) % prime, upto[-1] % prime))
    return np.unique(out[0] << 31 | out[1])


def _long_near(counted: DataFrame) -> DataFrame:
    """As :func:`near`, for pairs in which a word is longer than LONG."""
    named = counted.filter(F.char_length("word") >= LONG).withColumn("id", F.unhex(F.sha2("word", 256)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, word in zip(batch.column(0), batch.column(1).to_pylist()):
                hashes = deletion_hashes(word)
                yield pa.RecordBatch.from_pydict({"id": pa.repeat(ident, len(hashes)), "key": pa.array(hashes)})

    keyed = named.select("id", "word").mapInArrow(emit, "id binary, key long")
    met = keyed.join(keyed.withColumnRenamed("id", "other_id"), "key").filter("id <> other_id").select("id", "other_id").distinct()
    others = named.select(F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = met.join(named, "id").join(others, "other_id")
    return pairs.filter((F.char_length("word") > LONG) | (F.char_length("other") > LONG)).select("word", "n", "other", "other_n")


def near(counted: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for each word and each word at distance one from it; ``counted`` has ``word, n``."""
    short = counted.filter(F.char_length("word").between(1, LONG))
    keyed = short.select("word", "n", F.explode(keys(F.col("word"))).alias("key"))
    other = keyed.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "key")
    pairs = keyed.join(other, "key").filter("word <> other").select("word", "n", "other", "other_n")
    return pairs.unionByName(_long_near(counted)).filter(F.levenshtein("word", "other", 1) == 1)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words of ``forms`` that have a form: the last that following forms leads to.

    Each round joins where words have come to with where those have come to, which doubles the steps taken. A form is
    used ``factor`` times as often as its word, so chains are short: 63 steps would take six rounds.
    """
    at = settle(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = settle(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def group(docs: DataFrame, factor: int = 10, shortest: int = 7, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of :func:`words`.

    ``n_near`` counts the words at distance one. Of these the one with the largest count (of equal counts the first in
    order of code points) is the word's form if it occurs at least ``factor`` times as often; else ``form`` and
    ``form_n`` are null. ``root`` is where following forms ends, the word itself if it has no form. An empty table, or
    one without long words, gives an empty result.
    """
    counted = settle(words(docs, shortest, least, id_col, text_col))
    met = near(counted).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("most"))
    formed = counted.join(met, "word", "left").withColumn("form_n", F.when(-F.col("most.less") >= factor * F.col("n"), -F.col("most.less")))
    formed = settle(formed.select("word", F.when(F.col("form_n").isNotNull(), F.col("most.other")).alias("form"), "n",
                                  F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
    ends = roots(formed).withColumnRenamed("word", "w")
    return formed.join(ends, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
