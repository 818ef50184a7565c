"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fingerprints, mixing, near_dedup, quality, sentence_pieces, sharding, spelling, suffix_dedup, token_counts, top_k, toxicity, whitening
from .common import table

#: Weights of the sources in turn, the share of all sizes that the mix takes, the most epochs of a source.
MIX = {"weights": [5.0, 2.0, 1.0], "share": 1.5, "epochs": 2.0, "seed": 0}
SHARDS = 8
TOKEN_LIMIT = 2048
NEAR_PERCENT = 85
REPEAT_BYTES = 50
TOXIC_FROM, GOOD_FROM = 0.5, 0.3
COMPONENTS = 32
NEAREST = 10


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file as bytes; they travel with the job, so executors need no copy of their own."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, index, TOXIC_FROM).withColumnRenamed("id", "doc_id")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents"), NEAR_PERCENT).withColumnRenamed("id", "doc_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeats(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), **MIX)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, GOOD_FROM).withColumnRenamed("id", "doc_id")


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentence_pieces.measure(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return out.withColumnRenamed("id", "doc_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.layout(table(spark, sf_dir, "documents"), SHARDS).withColumnRenamed("id", "doc_id")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_successor(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.measure(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json").decode(), TOKEN_LIMIT)
    return out.withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    out = whitening.whiten(vectors, whitening.fit(vectors, COMPONENTS))
    return out.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").cast("long"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k.search(vectors.filter("vec_id % 100 = 0"), vectors, NEAREST).withColumnRenamed("id", "vec_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_toxicity, op2_near_dedup, op3_suffix_dedup, op4_mixing, op5_quality, op6_sentence_pieces, op7_sharding, op8_fingerprints, op9_token_counts, op10_exact_dedup,
           op11_whitening, op12_spelling, op13_top_k, pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": OP4_SQL, "op10_exact_dedup": OP10_SQL, "op12_spelling": OP12_SQL, "op13_top_k": OP13_SQL}


OP12_SQL = r"""
WITH RECURSIVE
polynomial AS (
  SELECT b, b AS c, 0 AS step FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM polynomial WHERE step < 8),
t AS (SELECT list(c ORDER BY b) AS l FROM polynomial WHERE step = 8),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, times, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
           lambda c, b: xor(c >> 8, l[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM bytes, t),
typed AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[: crc % length(run)] || run[crc % length(run) + 2 :] ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (SELECT word, n, unnest(list_distinct(list_transform(range(0, length(word)), lambda i: word[: i] || word[i + 2 :]))) AS key FROM words),
keyed AS (SELECT word, n, word AS key FROM words UNION ALL FROM cut),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM keyed a JOIN keyed b USING (key)
          WHERE a.word <> b.word AND (length(a.word) <> length(b.word)
             OR len(list_filter(range(1, length(a.word) + 1), lambda i: a.word[i] <> b.word[i])) = 1)),
met AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS most, max(other_n) AS most_n FROM pairs GROUP BY word),
formed AS (
  SELECT word, CASE WHEN most_n >= 10 * n THEN most END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN most_n >= 10 * n THEN most_n END AS form_n
  FROM words LEFT JOIN met USING (word)),
chain AS (
  SELECT word, word AS root, form FROM formed
  UNION ALL
  SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.form)
SELECT formed.word, formed.form, chain.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chain ON chain.word = formed.word AND chain.form IS NULL
"""

OP13_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""

OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '-')) AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM r),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT *, level >= cap / weight AS clamped FROM l),
g AS (SELECT *, (SELECT level FROM c WHERE NOT clamped ORDER BY cap / weight, rank LIMIT 1) AS water FROM c),
targets AS (SELECT source, source_size, round(CASE WHEN clamped THEN cap ELSE water * weight END, 6) AS target FROM g),
o AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t),
e AS (SELECT o.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole
      FROM o JOIN targets ON o.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)))::BIGINT AS taken
FROM e
"""
