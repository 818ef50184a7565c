import pytest
from pyspark.sql import functions as F

from cytoline.functions import expr
from cytoline.operators import cohort, coverage, distrib, reads
from cytoline.sources import readers, writers

PILE = "sample string, chrom string, start long, end long, mod_code string, strand string, n_valid long, fraction double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_strands_collapse_to_a_weighted_mean(spark):
    df = spark.createDataFrame([("a", "chr1", 100, 101, "m", "+", 10, 50.0), ("a", "chr1", 101, 102, "m", "-", 30, 90.0), ("a", "MT", 5, 6, "m", "+", 4, 25.0), ("a", "2", 7, 8, "m", "+", 0, 0.0), ("a", "2", 9, 10, "h", "+", 3, 10.0)], PILE)
    out = {r["site_id"]: (r["n_valid"], r["fraction"], r["end"]) for r in cohort.parse_sample(df).collect()}
    assert out == {"chr1:100": (40, pytest.approx(0.8), 102), "chrM:5": (4, 0.25, 7), "chr2:7": (0, None, 9)}
    assert cohort.repeated_sites(cohort.parse_sample(df)).count() == 0
    assert rows(cohort.mixed_names(df)) == [("a", 3)]


def test_a_strange_strand_is_an_error(spark):
    df = spark.createDataFrame([("a", "chr1", 1, 2, "m", ".", 1, 1.0)], PILE)
    with pytest.raises(Exception, match="strand"):
        cohort.parse_sample(df).collect()


def test_percent_rounds_halves_to_even_after_scaling(spark):
    values = [0.125, 2.675, 1.005, 33.335, 66.665]
    df = spark.createDataFrame([(v / 100,) for v in values], "v double")
    assert [r[0] for r in df.select(expr.percent(F.col("v"))).collect()] == pytest.approx([0.12, 2.68, 1.0, 33.34, 66.66], abs=0.0101)


def test_alignment_keeps_every_site_and_sample(spark):
    sites = spark.createDataFrame([("chr1:1", "chr1", 1, 3), ("chr1:9", "chr1", 9, 11)], "site_id string, chrom string, start long, end long")
    found = spark.createDataFrame([("chr1:1", "a", 10, 0.5), ("chr1:1", "b", 2, 1.0)], "site_id string, sample string, n_valid long, fraction double")
    cells = cohort.align(sites, found, ["a", "b"], 5)
    assert rows(cells.filter("sample = 'a'").select("site_id", "beta", "cov").na.fill(-1)) == [("chr1:1", 50.0, 10), ("chr1:9", -1.0, -1)]
    covered, excluded = cohort.split_covered(cells)
    assert covered.count() == 2 and rows(excluded.select("site_id")) == [("chr1:9",)]
    assert rows(cohort.missing_by_sample(cells)) == [("a", 1, 2), ("b", 2, 2)]
    wide = writers.wide(covered, ["a", "b"], ["site_id"]).collect()
    assert wide[0].asDict() == {"site_id": "chr1:1", "beta_a": 50.0, "cov_a": 10, "beta_b": None, "cov_b": None}


def test_coverage_summary_counts_each_site_once(spark):
    sites = spark.createDataFrame([("s1", "chr1", 1, 3, "450k;v2"), ("s2", "chr1", 2, 3, "cpgIsland"), ("s3", "chr1", 3, 1, None), ("s4", "chr1", 4, 0, "450k")], "site_id string, chrom string, start long, n_covered long, origin string")
    assert rows(coverage.summary(sites, 3)) == [(1, 1, 1, 2, 0, 0), (2, 0, 0, 0, 0, 0), (3, 2, 0, 0, 1, 1)]
    assert [r["site_id"] for r in coverage.least_covered(sites, 2).collect()] == ["s4", "s3"]
    assert rows(coverage.covered_in(sites, 3, 75).select("site_id")) == [("s1",), ("s2",)]
    with pytest.raises(ValueError):
        coverage.covered_in(sites, 3, 101)


def test_histogram_closes_its_last_bin_and_excludes_its_ends(spark):
    cells = spark.createDataFrame([("a", float(v)) for v in (0, 0, 0.5, 50, 99.99, 100)] + [("a", None)], "site_id string, beta double")
    out = dict(rows(distrib.histogram(cells)))
    assert len(out) == 100 and (out[1], out[51], out[100]) == (1, 1, 1) and sum(out.values()) == 3
    assert rows(distrib.extremes(cells).select("n_zero", "n_hundred", "n_between", "n_missing")) == [(2, 1, 3, 1)]
    edges = spark.createDataFrame([(1.0,), (10.0,), (100.0,), (1000.0,)], "v double")
    assert rows(distrib.edge_histogram(edges, "v", [1.0, 10.0, 100.0])) == [(1, 1), (2, 2)]


def test_median_from_histogram(spark):
    import numpy as np

    values = [0.0, 0.0, 10.5, 20.5, 70.5, 100.0]
    cells = spark.createDataFrame([(v,) for v in values], "beta double")
    got = distrib.median_from_histogram(cells).first()[0]
    middles = np.concatenate([[0], np.arange(100) + 0.5, [100]])
    counts = np.zeros(102)
    for v in values:
        counts[0 if v == 0 else 101 if v == 100 else int(v) + 1] += 1
    upto = np.cumsum(counts)
    i = int(np.searchsorted(upto, 3))
    assert got == pytest.approx(middles[i - 1] + (3 - upto[i - 1]) / (upto[i] - upto[i - 1]) * (middles[i] - middles[i - 1]))
    assert distrib.median_from_histogram(cells.filter("beta < 0")).first()[0] is None


def test_readers_take_missing_texts_and_headers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("site_id\tchrom\tstart\tmod_code\tbeta_a\tcov_a\tbeta_b\tcov_b\nchr1:1\tchr1\t1\tm\t50.0\t4.0\tNaN\tNA\n")
    df = readers.cohort(spark, str(tmp_path / "a.tsv"))
    assert readers.samples_of(df, strict=True) == ["a", "b"]
    assert rows(readers.to_long(df, ["a", "b"], ["site_id"]).na.fill(-1)) == [("chr1:1", "a", 50.0, 4.0), ("chr1:1", "b", -1.0, -1.0)]
    with pytest.raises(ValueError):
        readers.samples_of(df.drop("cov_a"), strict=True)
    (tmp_path / "p.bed").write_text("# x\nchr1\t5\t6\tm\t0\t+\t5\t6\t0\t12\t75.5" + "\t0" * 7 + "\n")
    assert rows(readers.pileup(spark, str(tmp_path / "p.bed"))) == [("chr1", 5, 6, "m", "+", 12, 75.5)]
    (tmp_path / "i.bed").write_text("chrom\tstart\tend\tstrand\tx\tfraction\tn\nchr1\t5\t6\t+\t0\t10.0\t3\n")
    assert rows(readers.imputed(spark, str(tmp_path / "i.bed"))) == [("chr1", 5, 6, "+", 10.0, 3, "m")]
    (tmp_path / "s.txt").write_text("s1 f1 b1 /p k1\n\ns2 f2 b2 /q k2\n")
    assert [r["sample"] for r in readers.sample_sheet(spark, str(tmp_path / "s.txt")).collect()] == ["s1_b1", "s2_b2"]
    (tmp_path / "r.txt").write_text("patient  risk\np1   0.5\np2\tNA\np3 1\n")
    assert rows(readers.risk(spark, str(tmp_path / "r.txt"))) == [("p1", "0.5"), ("p3", "1")]
    (tmp_path / "x.bed").write_text("chr1\t1\t3\nchr1\t1\t3\nchr1\t-4\t3\nchr2\tx\t3\n")
    assert rows(readers.site_reference(spark, str(tmp_path / "x.bed")).select("site_id")) == [("chr1:1",)]


def test_reads(spark):
    schema = "qname string, flag int, chrom string, pos long, end_pos long, mapq int, mods array<struct<pos: bigint, strand: string, mod_code: string, prob: double>>"
    df = spark.createDataFrame([("r1", 0, "chr1", 0, 10, 5, [(3, "+", "m", 0.9)]), ("r2", 256, "chr1", 5, 15, 0, [(3, "+", "m", 0.1)]), ("r3", 0, "chr2", 0, 9, 1, [(4, "-", "m", 0.5)])], schema)
    regions = spark.createDataFrame([("chr1", 8, 9)], "chrom string, start long, end long")
    assert rows(reads.names_on(df, regions)) == [("r1",)]
    assert rows(reads.on_regions(df, regions).select("qname")) == [("r1",), ("r2",)]
    assert rows(reads.on_regions(df, regions, inside=False).select("qname")) == [("r3",)]
    assert rows(reads.mapped_well(df).select("qname")) == [("r1",), ("r3",)]
    assert rows(reads.too_deep(df, 1)) == [("chr1", 5, 10)]
    assert rows(reads.pileup(df).select("chrom", "start", "n_valid", "fraction")) == [("chr1", 3, 2, 50.0), ("chr2", 4, 1, 100.0)]
    assert reads.thinned(df, 1.0).count() == 3 and reads.thinned(df, 0.0).count() == 0


def test_reads_in_order_and_figures_of_points(spark, tmp_path):
    from cytoline.plans import figures

    df = spark.createDataFrame([("c2", 5), ("c1", 9), ("c1", 2), ("c2", 1)], "chrom string, pos long").repartition(3)
    assert [tuple(r) for r in reads.in_order(df).collect()] == [("c1", 2), ("c1", 9), ("c2", 1), ("c2", 5)]
    line = spark.createDataFrame([(x, 2.0 * x + 1) for x in (0.0, 1.0, 5.0)], "x double, y double")
    assert figures.trend(line, "x", "y").first() == (pytest.approx(2.0), pytest.approx(1.0))
    assert [r[0] for r in spark.createDataFrame([(-1.0,), (0.4,), (3.0,)], "v double").select(expr.clip(F.col("v"))).collect()] == [0.0, 0.4, 1.0]
    (tmp_path / "c.tsv").write_text("sample\tPC1\tPC2\na\t0.5\tNA\n")
    assert rows(readers.coordinates(spark, str(tmp_path / "c.tsv")).na.fill(-1)) == [("a", 0.5, -1.0)]
    assert figures.sample_pairs(list("abcdef")) == [("a", "c"), ("a", "d"), ("b", "e"), ("b", "f")]
    assert figures.sample_pairs(list("abc")) == [("a", "c"), ("a", "c"), ("b", "c"), ("b", "c")] and figures.sample_pairs(["a", "b"]) == [("a", "b")]


def test_unfit_cohorts_are_refused(spark):
    reference = spark.createDataFrame([("chr1",)], "chrom string")
    fit = [("a", "chr1:1", "chr1"), ("b", "chr1:1", "chr1")]
    make = lambda data: spark.createDataFrame(data, "sample string, site_id string, chrom string")
    cohort.refuse_unfit(reference, make(fit))
    with pytest.raises(ValueError, match="a chr1:1"):
        cohort.refuse_unfit(reference, make([*fit, fit[0]]))
    with pytest.raises(ValueError, match="without chr: c"):
        cohort.refuse_unfit(reference, make([*fit, ("c", "1:1", "1")]))
    sites = spark.createDataFrame([(2, "450k"), (1, "cpgIsland"), (0, "v2")], "n_covered long, origin string")
    summary = coverage.summary(sites, 2)
    coverage.refuse_inconsistent(summary, sites)
    with pytest.raises(ValueError, match="n_sites"):
        coverage.refuse_inconsistent(summary.filter("x > 1"), sites)


def test_windows_of_a_stream_wait_for_late_rows(spark, tmp_path):
    from cytoline.streaming import ingest

    schema = "t timestamp, v string"
    spark.createDataFrame([("2024-01-01 00:01:00", "2"), ("2024-01-01 00:04:00", "3"), ("2024-01-01 00:06:00", "x")], "t string, v string").select(F.col("t").cast("timestamp"), "v").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    ingest.depth_by_window(stream, "t", "v").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("windows").select("n", "total").na.fill(-1)) == [(1, -1.0), (2, 5.0)]


def test_groups_and_the_order_of_chromosomes(spark):
    from cytoline.operators import matrix

    df = spark.createDataFrame([("a", "1.5", "x"), ("b", "NA", None), ("c", "2", " y ")], "sample string, age string, clinic string")
    scale, ages = matrix.groups(df, "age")
    assert scale and rows(ages.na.fill(-1)) == [("a", 1.5), ("b", -1.0), ("c", 2.0)]
    scale, clinics = matrix.groups(df, "clinic")
    assert not scale and rows(clinics) == [("a", "x"), ("b", "N/A"), ("c", "y")]
    names = spark.createDataFrame([(n,) for n in ("chrX", "chr10", "chrUn", "chr2", "chrM", "Y", "chr1")], "c string")
    assert [r["c"] for r in names.orderBy(expr.karyotype(F.col("c")), "c").collect()] == ["chr1", "chr2", "chr10", "chrX", "Y", "chrM", "chrUn"]
    labels = spark.createDataFrame([("A",), (None,), (None,)], "feature_label string")
    assert rows(cohort.counts_with_percent(labels, "feature_label").select("feature_label", "n")) == [("A", 1), ("Unknown", 2)]
