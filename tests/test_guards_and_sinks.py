"""Guards that look while a table is written, single files, thresholds from calls, estimates kept between rounds."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoline.operators import cohort, coverage, matrix, reads
from cytoline.sources import single_file, writers


def test_a_single_file_in_order(spark, tmp_path):
    path = str(tmp_path / "out.bed")
    df = spark.createDataFrame([("c2", 5, None), ("c1", 9, "é"), ("c1", 2, "x")], "chrom string, start long, name string").repartition(3)
    writers.intervals(df, path)
    assert open(path, encoding="utf-8").read() == "c1\t2\tx\nc1\t9\té\nc2\t5\t\n" and os.listdir(tmp_path) == ["out.bed"]
    single_file.write(df.filter("start = 9"), path, header=True)
    assert open(path, encoding="utf-8").read() == "chrom\tstart\tname\nc1\t9\té\n"
    many = spark.range(50_000).repartitionByRange(7, "id").sortWithinPartitions("id")
    single_file.write(many, path)
    assert open(path).read() == "".join(f"{i}\n" for i in range(50_000))


def test_no_rows_no_file(spark, tmp_path):
    path = str(tmp_path / "out.bed")
    none = spark.createDataFrame([], "chrom string, start long")
    writers.intervals(none, path)
    assert os.listdir(tmp_path) == []
    open(path, "w").write("of an earlier run")
    writers.intervals(none, path)
    assert os.listdir(tmp_path) == []


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out.bed")
    df = spark.range(100).repartitionByRange(4, "id").select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        single_file.write(df, path)
    assert os.listdir(tmp_path) == []
    open(path, "w").write("kept")
    with pytest.raises(Exception, match="lost"):
        single_file.write(df, path)
    assert os.listdir(tmp_path) == ["out.bed"] and open(path).read() == "kept"


def jobs(spark, run):
    """SQL executions that ``run`` starts."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return store.executionsCount() - before


def cohort_of(spark, cells):
    reference = spark.createDataFrame([("chr1:1", "chr1", 1, 3), ("chr1:5", "chr1", 5, 7)], "site_id string, chrom string, start long, end long")
    samples = spark.createDataFrame(cells, "sample string, site_id string, chrom string, n_valid long, fraction double")
    return reference, samples


@pytest.mark.parametrize("cells, message", [
    ([("a", "chr1:1", "chr1", 9, 0.5), ("b", "chr1:5", "chr1", 9, 0.5)], None),
    ([("a", "chr1:1", "chr1", 9, 0.5), ("a", "chr1:1", "chr1", 8, 0.5)], "more than once: 1, as chr1:1"),
    ([("a", "chr1:1", "chr1", 9, 0.5), ("b", "1:1", "1", 8, 0.5)], "without chr: a sample has 1 such rows, as 1"),
])
def test_cohorts_are_looked_at_while_they_are_written(spark, tmp_path, cells, message):
    reference, samples, fit = cohort.observed(*cohort_of(spark, cells))
    wide, single = cohort.observed_wide(cohort.align(reference, samples, ["a", "b"]), ["a", "b"], ["site_id", "chrom", "start"])
    assert jobs(spark, lambda: writers.parquet(wide, f"{tmp_path}/out")) == jobs(spark, lambda: writers.parquet(spark.range(3), f"{tmp_path}/three"))
    want = writers.wide(cohort.align(*cohort_of(spark, cells), ["a", "b"]), ["a", "b"], ["site_id", "chrom", "start"])
    if message is None:
        fit(), single()
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(map(tuple, want.collect()))
    else:
        with pytest.raises(ValueError, match=message):
            fit(), single()


def test_a_summary_is_checked_while_it_is_written(spark, tmp_path, monkeypatch):
    sites = spark.createDataFrame([(2, "450k"), (1, "cpgIsland"), (0, "v2"), (1, None)], "n_covered long, origin string")
    summary, check = coverage.checked_summary(sites, 2)
    writers.comma(summary.sortWithinPartitions("x"), f"{tmp_path}/s", small=True)
    check()
    real = coverage.summary
    monkeypatch.setattr(coverage, "summary", lambda df, n: real(df, n).filter("x > 1"))
    summary, check = coverage.checked_summary(sites, 2)
    summary.collect()
    with pytest.raises(ValueError, match="n_sites"):
        check()


@pytest.mark.parametrize("share, accuracy", [(0.1, 20), (0.1, 100), (0.5, 50), (0.9, 1000)])
def test_the_threshold_is_within_its_rank_error(spark, share, accuracy):
    rng = random.Random(9)
    probs = [rng.random() ** 2 for _ in range(20_000)]
    df = spark.createDataFrame([("c", [(i, "+", "m", p) for i, p in enumerate(probs[k::40])]) for k in range(40)], "chrom string, mods array<struct<pos: int, strand: string, mod_code: string, prob: double>>").repartition(7)
    found = reads.estimated_threshold(df, share, accuracy)
    certain = sorted(max(p, 1 - p) for p in probs)
    rank = sum(c < found for c in certain)
    assert abs(rank - share * len(certain)) <= len(certain) / accuracy + 1
    kept = reads.pileup(df, found).agg(F.sum("n_valid")).first()[0]
    assert kept == len(certain) - rank
    none = df.limit(0)
    assert reads.estimated_threshold(none) is None and reads.pileup(none, None).count() == 0


def test_estimates_are_kept_between_rounds(spark, monkeypatch):
    rng = np.random.default_rng(5)
    names = [f"s{i}" for i in range(6)]
    block = rng.standard_normal((80, 2)) @ rng.standard_normal((2, 6)) + 0.05 * rng.standard_normal((80, 6))
    block[rng.random(block.shape) < 0.2] = np.nan
    df = spark.createDataFrame([(i, n, None if np.isnan(v) else float(v)) for i, row in enumerate(block) for n, v in zip(names, row)], "site_id long, sample string, beta double")
    x = np.where(np.isnan(block), np.nanmean(block, 1, keepdims=True), block)
    for _ in range(17):
        c = x - x.mean(1, keepdims=True)
        u = np.linalg.eigh(c.T @ c)[1][:, ::-1][:, :2]
        x = np.where(np.isnan(block), c @ u @ u.T + x.mean(1, keepdims=True), block)
    applied = []
    real = matrix.sum_blocks
    monkeypatch.setattr(matrix, "sum_blocks", lambda table, work, shape: applied.append(len(work.__defaults__[0])) or real(table, work, shape))
    for kept in (2, 5, 50):
        monkeypatch.setattr(matrix, "KEPT_ROUNDS", kept)
        applied.clear()
        out = matrix.impute_components(df, names, 2, 17, 0.0, -1e9, 1e9)
        got = np.array([[r[n] for n in names] for r in out.groupBy("site_id").pivot("sample", names).agg(F.first("beta")).orderBy("site_id").collect()])
        assert np.allclose(got, x, atol=1e-9, rtol=0) and max(applied) <= kept and len(applied) == 17
