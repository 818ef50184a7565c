"""Document fingerprints: a canonical exact digest.

A text is made canonical (Unicode compatibility normalisation, case folding, white space folded to single spaces) and
digested with a 128-bit xxHash. Where two digests are equal, the canonical texts are compared byte by byte.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_positions, bit_table, column, filter_bits, probe_bits, settle

#: Bytes of text that one sorted partition holds, about.
PARTITION = 32 << 20


def canonical(text: str) -> str:
    """The text without differences of compatibility form, case or white space; stable when applied again."""
    folded = text.casefold() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(form: str) -> str:
    """The fingerprint of a canonical text: 128 bits in hexadecimal."""
    return xxhash.xxh3_128_hexdigest(form.encode())


def likeness(first: tuple[str, str], second: tuple[str, str]) -> float:
    """1.0 if two (fingerprint, canonical text) agree, in the digest and then in every byte; else 0.0."""
    return 1.0 if first[0] == second[0] and first[1] == second[1] else 0.0


def canonical_form(text: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([canonical(t.as_py() or "") for t in texts], pa.string())

    return run(text)


def _digests(form: str) -> Column:
    @F.arrow_udf("string")
    def run(forms: pa.Array) -> pa.Array:
        return pa.array([digest(f.as_py()) for f in forms], pa.string())

    return run(form)


def _buckets(texts: DataFrame) -> DataFrame:
    """Groups of ``texts`` (id, text) by fingerprint and canonical bytes: ``fingerprint, proof, group_id, group_size``.

    Equal forms of a task are one row before they are shuffled. ``proof``, a digest of the form, stands for its bytes.
    """
    forms = texts.select("id", canonical_form(F.col("text")).alias("form")).withColumn("fingerprint", _digests("form"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id")))
    found = forms.groupBy("fingerprint", "form").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    return settle(found.select("fingerprint", F.sha2(F.encode("form", "utf-8"), 256).alias("proof"), F.col("first.id").alias("group_id"), "group_size"))


def grouped(marked: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``marked`` (id, fingerprint, proof and more, of all rows of ``docs``) with ``group_id`` and ``group_size`` for proof.

    Fingerprints that may occur twice are found with a Bloom filter; only texts of their ids are read again, and grouped
    by fingerprint and then by the bytes of their canonical forms. ``group_id`` is the smallest id, nulls last.
    """
    log_bits = filter_bits(marked.count())
    keyed = marked.withColumn("key", F.xxhash64("fingerprint"))
    twice = keyed.select(F.explode(bit_positions(F.col("key"), log_bits)).alias("bit")).groupBy("bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    keyed = settle(probe_bits(keyed, "key", settle(bit_table(twice, "bit")), log_bits, "maybe").drop("key"))
    ids = keyed.filter("maybe").select(F.explode(bit_positions(F.xxhash64("id"), log_bits)).alias("bit")).distinct()
    texts = docs.select(column(docs, id_col).cast("long").alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("id"))
    texts = probe_bits(texts, "key", settle(bit_table(ids, "bit")), log_bits, "read").filter("read")
    alone = keyed.filter("not maybe").withColumn("group_id", F.col("id")).withColumn("group_size", F.lit(1).cast("long"))
    several = keyed.filter("maybe").join(_buckets(texts.select("id", "text")).hint("merge"), ["fingerprint", "proof"])
    return alone.unionByName(several.select(*alone.columns)).drop("maybe", "proof")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row ``id, fingerprint, group_id, group_size``; groups hold rows with the same canonical text, and null texts are empty."""
    form = canonical_form(F.coalesce(column(docs, text_col), F.lit("")))
    rows = docs.select(column(docs, id_col).cast("long").alias("id"), form.alias("form"))
    return grouped(settle(rows.select("id", _digests("form").alias("fingerprint"), F.sha2(F.encode("form", "utf-8"), 256).alias("proof"))), docs, id_col, text_col)


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, proof string"
EDGE = "edge string, edge_text string, part int"


def _compare(row: tuple, following: tuple) -> tuple:
    """The result for a row of (id, text, form, fingerprint), given the next row."""
    from hashlib import sha256

    ident, text, form, mark = row
    half = len(text) // 2
    edited = text[: len(text) - half] + following[1][:half]
    edited_form = canonical(edited)
    edited_mark = digest(edited_form)
    own = (mark, form)
    return (
        ident, len(text), sha256(edited.encode()).hexdigest(), mark, edited_mark,
        likeness(own, (edited_mark, edited_form)), likeness(own, (following[3], following[2])), sha256(form.encode()).hexdigest(),
    )


def _marked(ident: int | None, text: str | None) -> tuple:
    form = canonical(text or "")
    return ident, text or "", form, digest(form)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("proof", pa.string())]
_SCHEMA = pa.schema([*_OUT, ("edge", pa.string()), ("edge_text", pa.string()), ("part", pa.int32())])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within one sorted partition: a result for all rows but the last, and the first and last row as edges."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held = None
    none = (None,) * len(_OUT)
    for batch in batches:
        rows = []
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            row = _marked(ident, text.as_py())
            if held is None:
                rows.append((row[0], *none[1:], "first", row[1], part))
            else:
                rows.append((*_compare(held, row), None, None, None))
            held = row
            if len(rows) >= 1000:
                yield _batch(rows, _SCHEMA)
                rows = []
        yield _batch(rows, _SCHEMA)
    if held is not None:
        yield _batch([(held[0], *none[1:], "last", held[1], part)], _SCHEMA)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_compare(_marked(i, t), _marked(None, n)) for i, t, n in zip(*(batch.column(k).to_pylist() for k in range(3)))]
        yield _batch(rows, pa.schema(_OUT))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and their likeness, and the text's group; see OUT for the columns.

    The edited text has its last half of code points replaced by the first ones of the next document, that is the next
    row by id; the last row's next is the first. Null texts are empty, null ids come last, and rows that repeat an
    id follow each other in order of their texts' checksum. One row's next is itself; no rows give none.

    Each text is shuffled once, by range of id. Only the rows at the borders of partitions meet again. Groups (columns
    ``group_id`` and ``group_size``) are those of :func:`grouped`.
    """
    rows = docs.select(column(docs, id_col).cast("long").alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_last(), F.col("tie").asc()]
    total = rows.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PARTITION)
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("id", "text")
    done = settle(ranged.mapInArrow(_along, f"{OUT}, {EDGE}"))
    inner = done.filter("edge IS NULL").drop("edge", "edge_text", "part")
    # Two rows for each partition are numbered; partitions are in order of id.
    edges = done.filter("edge IS NOT NULL").select("doc_id", "edge", "edge_text", "part")
    line = Window.orderBy("part")
    start = F.first("part").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    light = edges.filter("edge = 'first'").select("part", F.coalesce(F.lead("part").over(line), start).alias("next_part"))
    last = edges.filter("edge = 'last'").select("doc_id", F.col("edge_text").alias("text"), "part")
    first = edges.filter("edge = 'first'").select(F.col("edge_text").alias("following"), F.col("part").alias("next_part"))
    border = last.join(light, "part").join(first, "next_part").select("doc_id", "text", "following")
    out = settle(inner.unionByName(border.mapInArrow(_pairs, OUT)).withColumnRenamed("doc_id", "id"))
    return grouped(out, docs, id_col, text_col).withColumnRenamed("id", "doc_id")
