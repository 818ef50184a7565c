"""The stages one after the other, each held against its own input; the registered queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cytoline.llm import exact_dedup, near_dedup, queries, toxicity
from cytoline.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, small, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_work_on_what_their_predecessor_kept(spark, small, stages):
    columns = table(spark, small, "documents").columns
    assert all(after.columns == columns for _, _, after in stages[:-1])
    _, before, after = stages[0]
    index = toxicity.fit(before, table(spark, small, "labels"))
    assert after.count() == toxicity.score(before, index).filter("predicted = 0").count()
    _, before, after = stages[1]
    assert after.count() == exact_dedup.mark(before).filter("kept").count() == exact_dedup.mark(after).filter("kept").count()
    _, before, after = stages[2]
    groups = near_dedup.group(before, corpus_pipeline.NEAR_PERCENT)
    kept = {r["id"] for r in groups.filter("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept
    assert near_dedup.group(after, corpus_pipeline.NEAR_PERCENT).filter("not kept").count() == 0
    _, before, after = stages[3]
    words = lambda df: df.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.01)
    _, before, after = stages[4]
    assert after.count() == before.count() and after.columns == ["doc_id", "source", "n_tokens", "ids"]


def test_run_equals_the_stages(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    rows = lambda df: sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in df.collect())
    assert rows(got) == rows(stages[-1][2])


def test_stages_take_odd_tables(spark, small, tmp_path):
    odd = [(1, None, None, None, None), (None, "a b c d e f", "en", None, 11), (2, "", "en", "s", 0), (2, "a b c d e f", "en", "s", 11), (3, "A b c d e f", "en", "s", 11)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, columns)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
        docs.collect()


def test_stages_take_long_texts_and_clashing_names(spark, small):
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [(1, long, "en", "s", 1, "a", "b", "c", "d", "e"), (2, long + " more", "en", "s", 1, "a", "b", "c", "d", "e"), (3, "x" * 200_000, "en", "t", 1, "a", "b", "c", "d", "e"), (4, "a few plain words stand here", "en", "t", 1, "a", "b", "c", "d", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, sha string, doc string, size string, id string")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, small)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            docs = after
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} <= {1, 3, 4}
    assert {r["doc_id"]: r["n_tokens"] for r in after.collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{small}/{name_}.parquet'")
    df = queries.queries()[name](spark, small)
    relation = con.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    at = [relation.columns.index(c) for c in columns]
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    want = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    assert got == want


def test_queries_have_a_row_for_each_document(spark, small):
    n = table(spark, small, "documents").count()
    for name, query in queries.queries().items():
        # words, components of vectors and neighbours are no documents
        if name not in ("pipeline", "op11_whitening", "op12_spelling", "op13_top_k"):
            assert query(spark, small).count() == n, name
