"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. A stage works on all that its predecessor kept; all but
the last return the columns of ``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cytoline.llm import exact_dedup, mixing, near_dedup, sentence_pieces, toxicity
from cytoline.llm.common import column, fresh, shared_folder, table
from cytoline.llm.queries import MIX, TOXIC_FROM, tokenizer_file

#: Near duplicates share at least this many hundredths of their five-word shingles.
NEAR_PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go; null and empty texts get the base rate and stay."""
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    return docs.withColumn(score, toxicity.probability(column(docs, "text"), index)).filter(f"`{score}` < {TOXIC_FROM}").drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays, then the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target words; repetitions are rows of their own."""
    return mixing.materialise(docs, **MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training rows: ``doc_id, source, n_tokens, ids``; a null text has no tokens."""
    ids = sentence_pieces.ids(docs["text"], tokenizer_file("piece_bpe_32k.model"))
    rows = docs.select("doc_id", "source", ids.alias("ids"))
    return rows.selectExpr("doc_id", "source", "cast(size(ids) as bigint) AS n_tokens", "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The first stage learns from labelled examples and the last runs a tokenizer: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last keeps is stored in the shared folder until the next is."""
    docs = table(spark, sf_dir, "documents")
    folder, stored = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}", None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if stored:
            path = spark._jvm.org.apache.hadoop.fs.Path(stored)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        stored = f"{folder}/{k}"
    return STAGES[-1][1](spark, docs, sf_dir)
