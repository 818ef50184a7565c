"""Python workers of an executor: of one kind, and no more than its tasks."""

from pyspark.sql import functions as F

from cytoline.llm import labelled, near_dedup
from cytoline.llm.common import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_examples_are_chosen_without_python_workers(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    rows, counts = labelled.sample(docs, labels, "toxic", 20, "doc_id", "text")
    assert "ExistingRDD" not in plan(rows) and "ArrowEvalPython" not in plan(rows)
    got = [(r["id"], r["label"]) for r in rows.collect()]
    assert len(got) == len(set(got)) == sum(min(20, n) for n in counts.values())
    none, counts = labelled.sample(docs, labels.limit(0), "toxic", 20, "doc_id", "text")
    assert none.collect() == [] and counts == {}


def test_sets_that_a_join_needs_are_made_once(spark, small):
    docs = table(spark, small, "documents")
    nodes = docs.select(F.unhex(F.sha2("text", 256)).alias("node"), "doc_id").hint("merge")
    assert plan(near_dedup.made(docs, "text").join(nodes, "node")).count("ArrowEvalPython") == 1


def test_sets_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, "A b c d e f"), (2, None), (3, ""), (4, "a b")], "doc_id long, `my text` string")
    got = near_dedup.made(docs, "my text").collect()
    want = [near_dedup.shingles(t or "") for _, t in docs.collect()]
    assert [(bytes(r["node"]), r["elements"]) for r in got] == [(near_dedup.node_of(e), e.view("int64").tolist()) for e in want]
