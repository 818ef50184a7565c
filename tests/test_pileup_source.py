"""The pileup source against Spark's text reader, its ranges, wanted values and zones."""

import gzip
import random

import pytest

from cytoline.sources import pileup_source, readers

ROW = "{chrom}\t{start}\t{end}\t{mod}\t0\t{strand}\t0\t0\t0\t{n}\t{fraction}" + "\t0" * 7


def line(rng, chrom):
    start = rng.randint(0, 10**6)
    return ROW.format(chrom=chrom, start=start, end=start + 1, mod=rng.choice("mh"), strand=rng.choice("+-"), n=rng.choice([rng.randint(0, 90), ".", ""]), fraction=rng.choice([rng.randint(0, 1000) / 10, "NaN", "1e1", "x"]))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, path = random.Random(2), tmp_path_factory.mktemp("pileup")
    for name, chroms in (("s1.a.bed", ("chr1", "chr2")), ("s2.bed", ("chr3", "chr4", "chr5"))):
        lines = ["# a comment"] + [line(rng, c) for c in chroms for _ in range(300)] + ["", "chr9\t5", "chr9\t7\t8\tm\t\t+\té"]
        (path / name).write_text("\n".join(lines) + ("\n" if name == "s2.bed" else ""))
    with gzip.open(path / "s3.bed.gz", "wt") as f:
        f.write("\r\n".join(line(rng, "chr1") for _ in range(50)))
    (path / "empty.bed").write_text("")
    return str(path)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("chrom", "start", "end", "mod_code", "strand", "n_valid", "fraction").collect())))


@pytest.mark.parametrize("size", [7, 1000, 1 << 20])
def test_every_line_is_read_once_whatever_the_ranges(spark, folder, size):
    want = rows(readers.pileup(spark, folder))
    df = pileup_source.scan(spark, folder, range_bytes=max(size, 500))
    assert rows(df) == want and {r["sample"] for r in df.select("sample").distinct().collect()} == {"s1", "s2", "s3"}
    found = [f for f in pileup_source.files([folder]) if f[0].endswith("s1.a.bed")]
    blocks = [b for part in pileup_source.ranges(found, size) for b in pileup_source.lines_of(part, 16)]
    assert b"".join(blocks) == open(found[0][0], "rb").read()


def test_wanted_values_and_columns(spark, folder):
    want = readers.pileup(spark, folder)
    df = pileup_source.scan(spark, folder, chroms=["chr1", "chr4"], mod_codes=["m"])
    assert rows(df) == rows(want.filter("chrom IN ('chr1', 'chr4') AND mod_code = 'm'"))
    assert rows(df.filter("start > 1000")) == rows(want.filter("chrom IN ('chr1', 'chr4') AND mod_code = 'm' AND start > 1000"))
    few = pileup_source.scan(spark, folder, chroms=["chr1"], columns=["n_valid", "start"])
    assert few.columns == ["n_valid", "start"]
    assert sorted(map(repr, few.collect())) == sorted(map(repr, want.filter("chrom = 'chr1'").select("n_valid", "start").collect()))
    with pytest.raises(Exception, match="no columns of a pileup"):
        pileup_source.scan(spark, folder, columns=["depth"]).count()


def test_filters_of_one_use_do_not_reach_another(spark, folder):
    df = pileup_source.scan(spark, folder)
    n = df.count()
    one, two = df.filter("chrom = 'chr1'"), df.filter("chrom = 'chr2'")
    assert {r["chrom"]: r["count"] for r in one.union(two).groupBy("chrom").count().collect()} == {"chr1": one.count(), "chr2": two.count()}
    assert df.count() == n > one.count() > 0


def test_zones_leave_ranges_out(spark, folder):
    size = 4096
    pileup_source.write_zones(spark, folder, range_bytes=size)
    every = len(pileup_source.ranges(pileup_source.files([folder]), size))
    reader = pileup_source.PileupReader({"path": folder, "rangebytes": size, "chrom": "chr5"})
    kept = reader.partitions()
    assert len(kept) == reader.read_ranges and reader.skipped_ranges == every - len(kept) > every / 2
    only = lambda chrom: pileup_source.scan(spark, folder, chroms=[chrom], range_bytes=size)
    assert only("chr5").rdd.getNumPartitions() == len(kept)
    for chrom in ("chr1", "chr5", "none"):
        assert rows(only(chrom)) == rows(readers.pileup(spark, folder).filter(f"chrom = '{chrom}'"))
    # a file that has changed since is read
    with open(f"{folder}/s1.a.bed", "a") as f:
        f.write("\nchr5\t1\t2\tm\t0\t+\t0\t0\t0\t3\t50.0\n")
    assert rows(only("chr5")) == rows(readers.pileup(spark, folder).filter("chrom = 'chr5'"))


def test_the_layout_after_imputation(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("chrom\tstart\tend\tstrand\tx\tfraction\tn_valid\nchr1\t5\t6\t+\t0\t25.5\t9\nchr2\t7\t8\t-\t0\tNA\t\n")
    df = pileup_source.scan(spark, str(tmp_path), "imputed")
    assert rows(df) == rows(readers.imputed(spark, str(tmp_path)))
    assert rows(pileup_source.scan(spark, str(tmp_path), "imputed", ["chr2"], ["m"])) == rows(df)[1:]
    assert not rows(pileup_source.scan(spark, str(tmp_path), "imputed", mod_codes=["h"]))
    pileup_source.write_zones(spark, str(tmp_path), "imputed")
    assert not rows(pileup_source.scan(spark, str(tmp_path), "imputed", mod_codes=["h"])) and rows(pileup_source.scan(spark, str(tmp_path), "imputed", mod_codes=["m"])) == rows(df)


def test_a_path_that_is_not_there(spark, tmp_path):
    with pytest.raises(Exception, match="nothing-here"):
        pileup_source.scan(spark, f"{tmp_path}/nothing-here").count()
