"""Every registered query against its SQL on the smallest tables; the command line and the stream end to end."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from cytoline.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(own.ORACLE))
def test_query_equals_sql(spark, duck, small, name):
    df = own.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    relation = duck.sql(own.ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert len(got) == len(want) and all(a == b or a == pytest.approx(b) for a, b in zip(got, want))


@pytest.mark.parametrize("name", sorted(set(own.QUERIES) - set(own.ORACLE)))
def test_query_gives_the_same_rows_again(spark, small, name):
    first, second = (sorted(map(repr, own.QUERIES[name](spark, small).collect())) for _ in range(2))
    assert first and first == second


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 8
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_command_line(spark, tmp_path, monkeypatch):
    from cytoline import cli

    out = str(tmp_path)
    pile = lambda shift: "".join(f"chr1\t{s}\t{s + 1}\tm\t0\t+\t0\t0\t0\t10\t{(s * 7 + shift) % 101}" + "\t0" * 7 + "\n" for s in range(0, 400, 4))
    names = ["p1", "p2", "p3", "p4", "p5"]
    for i, n in enumerate(names):
        (tmp_path / f"{n}.bed").write_text(pile(i * 13))
        cli.main(["parse_sample", "--input", f"{out}/{n}.bed", "--sample-name", n, "--outdir", out])
    (tmp_path / "sites.bed").write_text("".join(f"chr1\t{s}\t{s + 2}\n" for s in range(0, 440, 4)))
    cli.main(["build_cohort_matrix", "--input", *(f"{out}/{n}.parquet" for n in names), "--sample-names", *names, "--sites-file", f"{out}/sites.bed", "--outdir", out])
    assert spark.read.parquet(f"{out}/cohort_matrix.parquet").count() == 100
    assert len(spark.read.text(f"{out}/excluded_sites.bed").collect()) == 10
    (tmp_path / "origin.bed").write_text("chr1\t0\t100\t450k;v2\nchr1\t50\t60\tcpgIsland\n")
    cli.main(["assign_origins", "--cohort-matrix", f"{out}/cohort_matrix.parquet", "--source-bed", f"{out}/origin.bed", "--outdir", out])
    for n, extra in (("tss", "\t0\t+"), ("exons", ""), ("introns", ""), ("ccre", "\ta\tb\tc\td\te\tpELS")):
        (tmp_path / f"{n}.bed").write_text(f"chr1\t{8 if n == 'tss' else 100}\t{9 if n == 'tss' else 200}\t{n}{extra}\n")
    cli.main(["annotate_genomic", "--cohort-with-origins", f"{out}/cohort_with_origins.parquet", *(a for n in ("tss", "exons", "introns", "ccre") for a in (f"--{n}-bed", f"{out}/{n}.bed")), "--outdir", out])
    cli.main(["export_tsv", "--cohort-genomic", f"{out}/cohort_genomic.parquet", "--outdir", out])
    cli.main(["coverage_loss", "--input", f"{out}/cohort.tsv", "--outdir", out])
    assert spark.read.csv(f"{out}/coverage_summary.csv", header=True).count() == 5
    cli.main(["distribution", "--cohort-tsv", f"{out}/cohort.tsv", "--outdir", out])
    cli.main(["plot_tables", "--input", f"{out}/cohort.tsv", "--outdir", out])
    cli.main(["prepare", "--cohort-tsv", f"{out}/cohort.tsv", "--imputation-method", "no_impute", "--outdir", out])
    matrix = f"{out}/clustering_matrix.parquet"
    (tmp_path / "meta.tsv").write_text("patient\trun\n" + "".join(f"{n}\tr{i % 2}\n" for i, n in enumerate(names)))
    for command in ("run_pca", "run_umap"):
        cli.main([command, "--matrix", matrix, "--metadata", f"{out}/meta.tsv", "--color-by", "run", "--outdir", out])
    for command in ("run_kmeans", "run_gmm"):
        cli.main([command, "--matrix", matrix, "--k-max", "3", "--pca-coords", f"{out}/pca_coords.tsv", "--outdir", out])
    for name in ("pca_by_run_groups", "umap_by_run_groups", "kmeans_labels_on_pca", "gmm_labels_on_pca"):
        assert sum(len(p.read_text().splitlines()) - 1 for p in Path(f"{out}/{name}.tsv").glob("part-*")) == 5, name
    cli.main(["run_pairwise", "--matrix", matrix, "--n-cut", "2", "--outdir", out])
    (tmp_path / "risk.txt").write_text("patient risk\n" + "".join(f"{n} {i}\n" for i, n in enumerate(names)))
    (tmp_path / "meta.tsv").write_text("patient\trun\n" + "".join(f"{n}\tr{i % 2}\n" for i, n in enumerate(names)))
    cli.main(["risk_gradient", "--distance-matrix", f"{out}/distance_matrix.tsv", "--risk-file", f"{out}/risk.txt", "--metadata", f"{out}/meta.tsv", "--permanova-column", "run", "--n-permutations", "19", "--outdir", out])
    for name in ("pca_coords", "umap_coords", "kmeans_labels", "gmm_cluster_members", "hierarchical_labels", "kmedoids_labels", "permanova", "risk_gradient_scores", "permutation_test"):
        assert list(Path(f"{out}/{name}.tsv").glob("part-*")), name


def test_stream_takes_new_files(spark, tmp_path):
    from cytoline.streaming import ingest

    (tmp_path / "in").mkdir()
    line = "chr1\t5\t6\tm\t0\t+\t5\t6\t0\t12\t50" + "\t0" * 7 + "\n"
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.bed").write_text(line)
        ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), once=True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["sample"], r["site_id"], r["fraction"]) for r in got.collect()) == [("a", "chr1:5", 0.5), ("b", "chr1:5", 0.5)]


def test_mixtures_are_swept_up_to_ten(spark, small):
    assert [r["k"] for r in own.gmm(spark, small).orderBy("k").collect()] == list(range(2, 11))


def test_components_are_given_fifty_rounds(spark, small, monkeypatch):
    given = []
    real = own.matrix.impute_components
    monkeypatch.setattr(own.matrix, "impute_components", lambda cells, samples, components, rounds, *more: given.append(rounds) or real(cells, samples, components, 1, *more))
    own.impute_pca_em(spark, small)
    assert given == [50]
