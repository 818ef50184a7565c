"""Reads stored with an index, the cohort stored by site, and samples that arrive in parts."""

import random

import pytest
from pyspark.sql import functions as F

from cytoline.operators import cohort
from cytoline.plans import lens
from cytoline.sources import cohort_store, read_store
from cytoline.streaming import ingest

REGIONS = "chrom string, start long, end long"


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_regions_are_read_from_few_files(spark, tmp_path):
    rng = random.Random(4)
    items = [(f"r{i}", rng.choice(["chr1", "chr2"]), p := rng.randint(0, 10**6), p + rng.randint(1, 300)) for i in range(4000)] + [("long", "chr1", 10, 900_000)] * 2
    df = spark.createDataFrame(items, "qname string, chrom string, pos long, end_pos long")
    read_store.write(df, str(tmp_path), 250)
    every = spark.read.parquet(f"{tmp_path}/reads").inputFiles()
    for regions in ([("chr2", 500_000, 500_400)], [("chr1", 899_999, 900_000), ("chr2", 5, 6), ("chr2", 5, 6)], [("chr3", 0, 10**9)], [], [("chr2", 500, 500)]):
        asked = spark.createDataFrame(regions, REGIONS)
        want = sorted(repr(i) for i in items if any(c == i[1] and s < i[3] and e > i[2] for c, s, e in regions))
        got = read_store.within(spark, str(tmp_path), asked)
        assert rows(got) == want
        files = read_store.files_of(spark, str(tmp_path), asked)
        assert len(files) <= 2 * len(regions) + 1 < len(every) and len(set(files)) == len(files)
        if files:
            assert {f.rpartition("/")[2] for f in got.inputFiles()} <= {f.rpartition("/")[2] for f in files}
    assert read_store.index(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == len(items)


def test_a_region_is_pushed_to_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(f"r{i}", "chr1", i * 10, i * 10 + 5) for i in range(100)], "qname string, chrom string, pos long, end_pos long")
    read_store.write(df, str(tmp_path))
    df = read_store.within(spark, str(tmp_path), spark.createDataFrame([("chr1", 20, 40)], REGIONS))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "LessThan(pos,40)" in plan and "GreaterThan(end_pos,20)" in plan


def exchanges_over(node, name):
    """Whether an exchange stands over the scan of a table in a physical plan."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    if node.nodeName() == "AdaptiveSparkPlan":
        return exchanges_over(node.inputPlan(), name)
    below = [exchanges_over(c, name) for c in children]
    found = [b for b in below if b is not None]
    if "Scan" in node.nodeName() and name in node.simpleString(500) + node.nodeName():
        return False
    return None if not found else any(found) or "Exchange" in node.nodeName()


@pytest.fixture
def shuffling(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_further_samples_do_not_move_the_cohort(spark, small, tmp_path, shuffling):
    sites, samples = lens.sites(spark, small), cohort.parse_sample(lens.measure(spark, small))
    cohort_store.store_sites(sites, "stored_sites", f"{tmp_path}/sites", 5)
    first = cohort_store.align(spark, "stored_sites", samples, ["s0", "s1"], 30)
    cohort_store.add(first, "stored_cells", f"{tmp_path}/cells", 5)
    second = cohort_store.align(spark, "stored_sites", samples, ["s2", "s9"], 30)
    plan = second._jdf.queryExecution().executedPlan()
    assert exchanges_over(plan, "stored_sites") is False and plan.toString().count("Exchange hashpartitioning(site_id") == 1
    cohort_store.add(second, "stored_cells", f"{tmp_path}/cells", 5)
    names = ["site_id", "chrom", "start", "end", "sample", "beta", "cov"]
    assert rows(spark.table("stored_cells").select(*names)) == rows(cohort.align(sites, samples, ["s0", "s1", "s2", "s9"], 30).select(*names))
    # nor does counting by site
    per_site = spark.table("stored_cells").groupBy("site_id", "chrom", "start").agg(F.count("beta"))
    assert exchanges_over(per_site._jdf.queryExecution().executedPlan(), "stored_cells") is False
    with pytest.raises(ValueError, match="s2"):
        cohort_store.add(second, "stored_cells", f"{tmp_path}/cells", 5)
    with pytest.raises(ValueError, match="5 buckets"):
        cohort_store.add(second, "stored_cells", f"{tmp_path}/cells", 6)
    for name in ("stored_sites", "stored_cells"):
        spark.sql(f"DROP TABLE {name}")


def pile(rng, n):
    return "".join(f"chr{rng.randint(1, 2)}\t{(s := rng.randint(0, 40))}\t{s + 1}\t{rng.choice('mmh')}\t0\t{rng.choice('+-')}\t0\t0\t0\t{rng.randint(0, 30)}\t{rng.randint(0, 1000) / 10}" + "\t0" * 7 + "\n" for _ in range(n))


@pytest.mark.parametrize("batches", [[["s1.a", "s1.b", "s2.a", "s1.c", "s2.b"]], [["s1.a"], ["s1.b", "s2.a"], ["s1.c"], ["s2.b"]]])
def test_a_sample_may_come_in_parts(spark, tmp_path, batches):
    rng, into, out = random.Random(6), tmp_path / "in", str(tmp_path / "out")
    texts = {name: pile(rng, 60) for name in sorted(n for b in batches for n in b)}
    into.mkdir()
    run = lambda: ingest.start(spark, str(into), out, str(tmp_path / "check"), once=True).awaitTermination()
    for k, batch in enumerate(batches):
        for name in batch:
            (into / f"{name}.bed").write_text(texts[name])
        run()
        if k == 2:
            ingest.merge(spark, out)  # all but the last batch
    run()
    parts = [line.split("\t") for name, text in texts.items() for line in text.splitlines()]
    owners = [name[:2] for name, text in texts.items() for _ in text.splitlines()]
    pileup = spark.createDataFrame([(o, p[0], int(p[1]), p[3], p[5], int(p[9]), float(p[10])) for o, p in zip(owners, parts)], "sample string, chrom string, start long, mod_code string, strand string, n_valid long, fraction double")
    names = ["sample", "site_id", "n_valid", F.round("fraction", 9).alias("fraction")]
    assert rows(spark.read.parquet(out).select(*names)) == rows(cohort.parse_sample(pileup).select(*names))


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = "chr1\t5\t6\tm\t0\t+\t5\t6\t0\t12\t50" + "\t0" * 7 + "\n"
    out, check = str(tmp_path / "out"), tmp_path / "check"
    for name in ("s.a", "s.b"):
        (tmp_path / "in" / f"{name}.bed").write_text(line)
        ingest.start(spark, str(tmp_path / "in"), out, str(check), once=True).awaitTermination()
    last = max((check / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the driver was lost before the batch was noted as done
    for crc in (check / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    ingest.start(spark, str(tmp_path / "in"), out, str(check), once=True).awaitTermination()
    assert [(r["sample"], r["n_valid"], r["fraction"]) for r in spark.read.parquet(out).collect()] == [("s", 24, 0.5)]
