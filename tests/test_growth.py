"""Steps whose work or memory grew faster than their input."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cytoline.operators import intervals, matrix
from cytoline.plans import lens
from cytoline.plans import queries as own


def plan(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


def test_grid_of_cells_is_not_broadcast(spark, small, capsys):
    """F1 to F5: with values only, the join may have its sides changed; the sites times samples are no side to broadcast."""
    shown = plan(own.cells(spark, small).filter("beta > 0"), capsys)
    assert "SortMergeJoin" in shown and "Broadcast" not in shown


@pytest.mark.parametrize("name", ["coverage_log_histogram", "coverage_percentiles"])
def test_depths_of_cells_are_not_broadcast(spark, small, capsys, name):
    """no side of the cells' join goes through the driver, neither as planned nor once sizes are known."""
    df = own.QUERIES[name](spark, small)
    assert "Broadcast" not in plan(df, capsys)
    df.collect()
    final, _, _ = plan(df, capsys).partition("Initial Plan")
    assert "isFinalPlan=true" in final and "SortMergeJoin [site_id" in final


def test_imputation_reads_no_frame_anew(spark, small, capsys):
    """F6, F8: frames up to the last row are read again for each row."""
    assert "unboundedfollowing" not in plan(matrix.impute_along(own.cells(spark, small)), capsys).lower()


@pytest.mark.parametrize("values, want", [([5.0, None, None, 8.0, None], [5.0, 6.0, 7.0, 8.0, 8.0]), ([None, None], [None, None]), ([None, 3.0], [3.0, 3.0])])
def test_imputation_along_one_sample(spark, values, want):
    rows = [(f"a{i}", "chr1", i * 700_000, "s", v) for i, v in enumerate(values)]
    got = matrix.impute_along(spark.createDataFrame(rows, "site_id string, chrom string, start long, sample string, beta double"))
    assert [r["beta"] for r in got.orderBy("start").collect()] == want


def test_coordinates_without_anything_to_correct(spark, tmp_path):
    """dissimilarities that are all equal are those of points."""
    rows = [[2.0 if i == j else 1.0 for j in range(64)] for i in range(64)]
    pq.write_table(pa.table({"vec_id": list(range(64)), "embedding": pa.array(rows, pa.list_(pa.float32()))}), f"{tmp_path}/embeddings.parquet")
    got = own.pcoa_corrected(spark, str(tmp_path)).collect()
    assert len(got) == 63 and {(r["eigenvalue"], r["negative_share"]) for r in got} == {(2.0, 0.0)}


def _odd_intervals(seed: int, n: int) -> list[tuple]:
    """Short and empty ones, some as long as a chromosome, equal ones, some in one place, and nulls."""
    draw = random.Random(seed)
    out = [(i, draw.choice(("a", "b")), s, s + draw.choice((0, 1, 5, 40, 3_000, 200_000))) for i, s in enumerate(draw.choices(range(0, 200_000, 7), k=n))]
    out += [(n + i, "a", 65_536, 65_536 + i % 3) for i in range(12)] + [(n + 12 + i, *out[i][1:]) for i in range(9)]
    return out + [(n + 21, None, 5, 9), (n + 22, "a", None, 9), (n + 23, "a", 5, None), (n + 24, "only here", 5, 9)]


def _hits(one, others):
    _, chrom, a, b = one
    return [t for t in others if None not in (chrom, a, b, *t[1:]) and t[1] == chrom and t[2] < b and t[3] > a]


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_by_a_sorted_pass_equal_all_pairs(spark, capsys, seed):
    """F9, F12, F13, F15 to F17: whether and how often rows are overlapped takes no join of the rows."""
    sites, track = _odd_intervals(seed, 120), _odd_intervals(10 + seed, 90)
    left = spark.createDataFrame(sites, "site_id int, chrom string, start long, end long")
    right = spark.createDataFrame(track, "t int, chrom string, start long, end long")
    named = right.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    for inside in (True, False):
        found = intervals.overlapping(left, named, inside)
        assert sorted(r["site_id"] for r in found.collect()) == [s[0] for s in sites if bool(_hits(s, track)) == inside]
        assert found.columns == left.columns and "Join" not in plan(found, capsys)
    totals = intervals.overlap_totals(left, right, "end - start")
    want = {s[0]: (len(h), sum(t[3] - t[2] for t in h)) for s in sites if (h := _hits(s, track))}
    assert {r["site_id"]: (r["n"], r["total"]) for r in totals.collect()} == want
    assert "Join" not in plan(totals, capsys)


def test_pairs_are_made_where_places_meet(spark, small, capsys):
    """not where the sites are read, of which a small file has very many."""
    left, right = lens.sites(spark, small), lens.track(spark, small, 3).selectExpr("chrom", "start AS r_start", "end AS r_end")
    shown = plan(intervals.overlap_join(left, right), capsys)
    assert "SortMergeJoin" in shown and "Broadcast" not in shown


def test_overlaps_with_empty_tables(spark):
    left = spark.createDataFrame([(1, "a", 5, 9)], "site_id int, chrom string, start long, end long")
    none = left.filter("false")
    named = lambda df: df.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    assert intervals.overlapping(left, named(none)).count() == 0 and intervals.overlapping(left, named(none), False).count() == 1
    assert intervals.overlapping(none, named(left), False).count() == 0
    assert intervals.overlap_totals(left, none, "end - start").count() == 0 and intervals.overlap_totals(none, left, "end - start").count() == 0
