"""Command line: ``python -m cytoline.cli COMMAND ...``. Each command reads files, runs operators and writes files."""

from __future__ import annotations

import argparse
import sys

import numpy as np
from pyspark.sql import functions as F

from cytoline import session
from cytoline.operators import annotation, cluster, cohort, coverage, distance, linalg, matrix, stats
from cytoline.plans import figures
from cytoline.sources import readers, writers

SITE = ["site_id", "chrom", "start"]


def _extra(spark, path, name_col, extra_col):
    """An interval track with two payload columns from one scan; a missing column is empty."""
    width = max(name_col, extra_col) + 1
    rows = readers._strings(spark, path, width)
    from cytoline.functions import expr

    return rows.select(F.col("c0").alias("chrom"), expr.whole(F.col("c1")).alias("start"), expr.whole(F.col("c2")).alias("end"),
                       F.col(f"c{name_col}").alias("name"), F.coalesce(F.col(f"c{extra_col}"), F.lit("")).alias("extra")).filter("start >= 0")


def _refused(check, *frames):
    try:
        check(*frames)
    except ValueError as error:
        raise SystemExit(str(error)) from error


def _report(what, names):
    if names:
        print(f"{what}: {len(names)}: " + ", ".join(sorted(names)[:5]), file=sys.stderr)


def parse_sample(spark, a):
    rows = readers.pileup(spark, a.input) if a.etape == "before_imputation" else readers.imputed(spark, a.input)
    out = cohort.parse_sample(rows.withColumn("sample", F.lit(a.sample_name)))
    writers.parquet(out.drop("sample"), f"{a.outdir}/{a.sample_name}.parquet")


def build_cohort_matrix(spark, a):
    if len(a.input) != len(a.sample_names):
        raise SystemExit("as many inputs as sample names are needed")
    tables = [spark.read.parquet(p).withColumn("sample", F.lit(n)) for p, n in zip(a.input, a.sample_names)]
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    reference, rows = readers.site_reference(spark, a.sites_file), rows.filter("mod_code = 'm'")
    # both tables are looked at while the matrix is made, without a pass of their own
    seen_reference, seen_rows, fit = cohort.observed(reference, rows)
    covered, _ = cohort.split_covered(cohort.align(seen_reference, seen_rows, a.sample_names, a.min_cov))
    matrix_, single = cohort.observed_wide(covered.withColumn("mod_code", F.lit("m")), a.sample_names, [*SITE, "mod_code"])
    target = f"{a.outdir}/cohort_matrix.parquet"
    writers.parquet(matrix_, target)
    try:
        for check in (fit, single):
            check()
    except ValueError as error:
        writers.remove(spark, target)
        raise SystemExit(str(error)) from error
    _, excluded = cohort.split_covered(cohort.align(reference, rows, a.sample_names, a.min_cov))
    writers.intervals(excluded.select("chrom", "start", "end", "site_id"), f"{a.outdir}/excluded_sites.bed")


def assign_origins(spark, a):
    rows = spark.read.parquet(a.cohort_matrix).withColumn("end", F.col("start") + 2)
    writers.parquet(cohort.with_origins(rows, readers.origins(spark, a.source_bed)).drop("end"), f"{a.outdir}/cohort_with_origins.parquet")


def annotate_genomic(spark, a):
    rows = spark.read.parquet(a.cohort_with_origins)
    out = annotation.annotate(rows, _extra(spark, a.tss_bed, 3, 5), readers.intervals(spark, a.exons_bed), readers.intervals(spark, a.introns_bed), _extra(spark, a.ccre_bed, 3, 9), a.strict, a.slop)
    writers.parquet(out, f"{a.outdir}/cohort_genomic.parquet")


def export_tsv(spark, a):
    writers.table(spark.read.parquet(a.cohort_genomic), f"{a.outdir}/cohort.tsv")


def coverage_loss(spark, a):
    df = readers.cohort(spark, a.input)
    names = readers.samples_of(df, strict=True)
    df = df.withColumnRenamed(a.origin_col, "origin")
    sites = coverage.per_site(readers.to_long(df, names, [*SITE, "origin"]), (*SITE, "origin"))
    writers.comma(coverage.least_covered(sites, a.n_least_covered), f"{a.outdir}/per_site_coverage.csv", small=True)
    summary, consistent = coverage.checked_summary(sites, len(names))
    writers.comma(summary.sortWithinPartitions("x"), f"{a.outdir}/coverage_summary.csv", small=True)
    _refused(consistent)
    writers.intervals(coverage.covered_in(sites, len(names), a.min_coverage_pct), f"{a.outdir}/covered_at_least_{a.min_coverage_pct:g}pct.bed")


def _cells(spark, path, keep=SITE):
    df = readers.cohort(spark, path)
    names = readers.samples_of(df)
    return readers.to_long(df, names, [c for c in keep if c in df.columns]), names


def distribution(spark, a):
    cells, _ = _cells(spark, a.cohort_tsv)
    deep = cells.filter(F.col("cov") >= a.min_cov)
    bins, ends, middle = figures.beta_distribution(deep, a.n_beta_bins)
    depth, quantiles = figures.depth_distribution(cells, a.min_cov)
    for name, df in (("beta_histogram", bins), ("beta_extremes", ends), ("beta_median", middle), ("variance_histogram", figures.variance_distribution(deep, a.n_variance_bins)), ("coverage_histogram", depth), ("coverage_quantiles", quantiles)):
        writers.table(df, f"{a.outdir}/{name}{a.tag}.tsv", small=True)


def plot_tables(spark, a):
    from cytoline.functions import expr

    cells, names = _cells(spark, a.input, [*SITE, "origin", "feature_label"])
    cells = cells.withColumn("beta", expr.covered_or_unknown(F.col("beta"), F.col("cov"), a.min_cov))
    pairs = figures.sample_pairs(names)
    tables = {"feature_label_distribution": figures.feature_label_distribution(readers.cohort(spark, a.input)), "heatmap_variable_sites": figures.variable_sites_heatmap(cells, names, a.top_n),
              "beta_by_feature": figures.beta_by_feature(cells)}
    tables |= {f"scatter_feature_{x}_{y}": t for (x, y), t in zip(pairs, figures.scatter_by_feature(cells, pairs))}
    tables |= {f"scatter_origin_{x}_{y}": t for (x, y), t in zip(pairs, figures.scatter_by_origin(cells, pairs))}
    for name, df in tables.items():
        writers.table(df, f"{a.outdir}/{name}.tsv", small=True)


def prepare(spark, a):
    df = readers.cohort(spark, a.cohort_tsv).filter(F.col("mod_code") == a.mod_code)
    names = readers.samples_of(df)
    _report("samples to exclude that are not in the cohort", set(a.exclude_samples) - set(names))
    left = [s for s in names if s not in a.exclude_samples]
    if not left:
        raise SystemExit("all samples are excluded")
    options = {"knn": {"k": a.knn_neighbors}, "pca": {"components": a.pca_n_components, "rounds": a.pca_max_iter, "tolerance": a.pca_tol}}.get(a.imputation_method, {})
    rows = matrix.prepare(readers.to_long(df, names, ["site_id"]), names, 100.0, a.exclude_samples, a.min_completeness, a.imputation_method, a.top_n, a.seuil, **options)
    (writers.matrix if a.output_format == "parquet" else writers.matrix_text)(rows, left, f"{a.outdir}/clustering_matrix{a.tag}.{a.output_format}")


def _matrix(spark, a):
    rows = readers.matrix(spark, a.matrix)
    names = sorted(r["sample"] for r in rows.select("sample").distinct().collect())
    full = matrix.without_missing(rows, len(names))
    return (matrix.robust_scaled(full) if a.use_robust_scaler else matrix.standard_scaled(full)), names


def _points(spark, names, at, prefix):
    return spark.createDataFrame([(s, *map(float, at[i])) for i, s in enumerate(names)], "sample string, " + ", ".join(f"{prefix}{i + 1} double" for i in range(at.shape[1])))


def run_pca(spark, a):
    rows, names = _matrix(spark, a)
    at, share = linalg.components(rows, names, a.n_components)
    points = _points(spark, names, at, "PC")
    writers.decimals(points, f"{a.outdir}/pca_coords{a.tag}.tsv", points.columns[1:])
    _colored(spark, points, names, "pca", a)
    table = spark.createDataFrame([(f"PC{i + 1}", float(v), float(c)) for i, (v, c) in enumerate(zip(share, np.cumsum(share)))], "component string, ratio double, cumulative double")
    writers.decimals(table, f"{a.outdir}/pca_variance{a.tag}.tsv", ["ratio", "cumulative"])


def _distances_of(at):
    return np.sqrt(np.maximum(((at[:, None] - at[None]) ** 2).sum(2), 0))


def run_umap(spark, a):
    rows, names = _matrix(spark, a)
    at = linalg.components(rows, names, min(50, len(names) - 1))[0]
    points = _points(spark, names, cluster.layout(_distances_of(at), a.n_neighbors, a.min_dist, a.random_state), "UMAP")
    writers.decimals(points, f"{a.outdir}/umap_coords{a.tag}.tsv", points.columns[1:])
    _colored(spark, points, names, "umap", a)


def _colored(spark, points, names, what, a):
    """The points with a column of the metadata, the data of a coloured scatter plot."""
    if not (a.metadata and a.color_by):
        return
    metadata = readers.metadata(spark, a.metadata)
    if a.color_by not in metadata.columns:
        raise SystemExit(f"the metadata have no column {a.color_by}")
    _report("samples without metadata", set(names) - {r["sample"] for r in metadata.select("sample").collect()})
    scale, table = figures.colored(points, metadata, a.color_by)
    writers.table(table, f"{a.outdir}/{what}_by_{a.color_by}_{'scale' if scale else 'groups'}{a.tag}.tsv", small=True)


def _labels(spark, names, labels, method, a):
    table = spark.createDataFrame([(s, int(labels[i])) for i, s in enumerate(names)], "sample string, cluster int")
    writers.table(table, f"{a.outdir}/{method}_labels{a.tag}.tsv", small=True)
    writers.table(cluster.members(table).orderBy("cluster"), f"{a.outdir}/{method}_cluster_members{a.tag}.tsv", small=True)
    for what, path in (("pca", a.pca_coords), ("umap", a.umap_coords)):
        if path:
            points = readers.coordinates(spark, path)
            _report(f"samples without {what} coordinates", set(names) - {r["sample"] for r in points.select("sample").collect()})
            writers.table(table.join(points, "sample"), f"{a.outdir}/{method}_labels_on_{what}{a.tag}.tsv", small=True)


def run_kmeans(spark, a):
    rows, names = _matrix(spark, a)
    at = linalg.components(rows, names, len(names))[0]
    ks = cluster.k_range(len(names), a.k_min, a.k_max)
    fits = {k: cluster.k_means(at, k, 10, a.random_state) for k in ks}
    d = _distances_of(at)
    table = spark.createDataFrame([(k, fits[k][1], cluster.silhouette(d, fits[k][0])) for k in ks], "k int, inertia double, silhouette double")
    writers.decimals(table, f"{a.outdir}/kmeans_inertia{a.tag}.tsv", ["inertia", "silhouette"])
    k = a.k_final or cluster.elbow([fits[k][1] for k in ks], ks)
    _labels(spark, names, cluster.k_means(at, k, 20, a.random_state)[0], "kmeans", a)


def run_gmm(spark, a):
    rows, names = _matrix(spark, a)
    at, features = linalg.components(rows, names, len(names))[0], rows.select("site_id").distinct().count()
    ks = cluster.k_range(len(names), a.k_min, a.k_max)
    vectors = session.settle(matrix.vectors(rows, names)) if a.covariance_type == "diag" else None

    def fit(k, starts, rounds):
        if vectors is not None:
            return cluster.diagonal_mixture(vectors, at, k, features, a.reg_covar, starts, a.random_state, rounds)
        return cluster.mixture(at, k, features, a.covariance_type, a.reg_covar, starts, a.random_state, rounds)

    fits = {k: fit(k, 10, 300) for k in ks}
    table = spark.createDataFrame([(k, float(f["bic"]), float(f["aic"]), bool(f["converged"])) for k, f in fits.items()], "k int, bic double, aic double, converged boolean")
    writers.decimals(table, f"{a.outdir}/gmm_bic{a.tag}.tsv", ["bic", "aic"])
    k = a.k_final or min(fits, key=lambda k: (fits[k]["bic"], k))
    _labels(spark, names, fit(k, 20, 500)["labels"], "gmm", a)


def run_pairwise(spark, a):
    rows = readers.matrix(spark, a.matrix)
    names = sorted(r["sample"] for r in rows.select("sample").distinct().collect())
    d, common = distance.pairwise(rows, names, a.distance_metric)
    print(f"pairs with fewer than {a.min_coobs} common sites: {distance.few_common(common, a.min_coobs)}")
    square = spark.createDataFrame([(s, *(None if np.isnan(v) else float(v) for v in d[i])) for i, s in enumerate(names)], "sample string, " + ", ".join(f"`{s}` double" for s in names))
    writers.decimals(square, f"{a.outdir}/distance_matrix{a.tag}.tsv", names)
    merges = cluster.linkage(d, a.linkage)
    writers.table(spark.createDataFrame([tuple(map(float, m)) for m in merges], "left double, right double, height double, size double"), f"{a.outdir}/linkage{a.tag}.tsv", small=True)
    if a.n_cut:
        _labels(spark, names, cluster.cut(merges, len(names), a.n_cut), "hierarchical", a)
    ks, safe = cluster.k_range(len(names), a.k_min, a.k_max), linalg.without_nan(d)
    scores = {k: cluster.silhouette(safe, cluster.medoids(d, k)[0]) for k in ks}
    writers.table(spark.createDataFrame(list(scores.items()), "k int, silhouette double"), f"{a.outdir}/kmedoids_silhouette{a.tag}.tsv", small=True)
    k = a.k_final or max(scores, key=lambda k: (scores[k] if scores[k] == scores[k] else -2, -k))
    _labels(spark, names, cluster.medoids(d, k)[0], "kmedoids", a)


def risk_gradient(spark, a):
    pairs = readers.distances(spark, a.distance_matrix).collect()
    names = list(dict.fromkeys(r["sample_i"] for r in pairs))
    place = {s: i for i, s in enumerate(names)}
    d = np.full((len(names), len(names)), np.nan)
    for r in pairs:
        d[place[r["sample_i"]], place[r["sample_j"]]] = np.nan if r["d"] is None else r["d"]
    d = linalg.without_nan(d)
    out = linalg.principal_coordinates(d, a.lingoes)
    x = out["coordinates"]
    writers.table(_points(spark, names, x, "PCo"), f"{a.outdir}/pcoa_coordinates{a.tag}.tsv", small=True)
    table = [(f"PCo{i + 1}", float(v), float(p), float(c)) for i, (v, p, c) in enumerate(zip(out["eigenvalues"], out["percent"], np.cumsum(out["percent"])))]
    writers.table(spark.createDataFrame(table, "axis string, eigenvalue double, pct_variance double, cumulative_pct_variance double"), f"{a.outdir}/pcoa_eigenvalues{a.tag}.tsv", small=True)
    if a.metadata and a.permanova_column:
        group = {r["sample"]: r[a.permanova_column] for r in readers.metadata(spark, a.metadata).collect()}
        _report("samples without metadata", set(names) - set(group))
        keep = [i for i, s in enumerate(names) if group.get(s) is not None]
        found = stats.permanova(spark, d[np.ix_(keep, keep)], [group[names[i]] for i in keep], a.n_permutations, a.random_state)
        writers.table(spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'double'}" for k, v in found.items())), f"{a.outdir}/permanova{a.tag}.tsv", small=True)
    if not a.risk_file:
        return
    risk = readers.risk(spark, a.risk_file)
    numeric = matrix.is_numeric(risk, "risk")
    if not numeric:
        risk = matrix.codes(risk, "risk").withColumn("risk", F.col("code"))
    value = {r["sample"]: float(r["risk"]) for r in risk.collect()}
    _report("samples without a risk", set(names) - set(value))
    _report("risks of samples that are not in the matrix", set(value) - set(names))
    keep = [i for i, s in enumerate(names) if s in value]
    x, y, names = x[keep], np.array([value[names[i]] for i in keep]), [names[i] for i in keep]
    most = stats.axes_to_try(len(names), x.shape[1], a.max_axes)
    tests = spark.createDataFrame([(f"PCo{i + 1}", *map(float, stats.spearman(x[:, i], y))) for i in range(most)], "axis string, spearman_rho double, p_value double")
    writers.table(stats.adjusted(tests), f"{a.outdir}/axis_risk_correlation{a.tag}.tsv", small=True)
    found = stats.gradient_test(spark, x, y, most, a.n_permutations, a.random_state)
    writers.table(spark.createDataFrame([(k + 1, float(q)) for k, q in enumerate(found.pop("table"))], "k int, Q2_loocv double"), f"{a.outdir}/risk_gradient_loocv{a.tag}.tsv", small=True)
    writers.table(spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'double'}" for k, v in found.items())), f"{a.outdir}/permutation_test{a.tag}.tsv", small=True)
    weights, direction, score = stats.gradient(x[:, : found["k"]], y)
    writers.table(spark.createDataFrame([(f"PCo{i + 1}", float(w), float(v)) for i, (w, v) in enumerate(zip(weights, direction))], "axis string, weight double, direction double"), f"{a.outdir}/risk_gradient_direction{a.tag}.tsv", small=True)
    scores = spark.createDataFrame([(s, float(y[i]), float(score[i])) for i, s in enumerate(names)], "sample string, risk double, projection double")
    writers.table(scores.orderBy("projection"), f"{a.outdir}/risk_gradient_scores{a.tag}.tsv", small=True)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cytoline", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(run, *arguments):
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for names, options in arguments:
            sub.add_argument(*names, **options)
        sub.add_argument("--outdir", default=".")
        return sub

    need = lambda n, **k: ((f"--{n}",), {"required": True} | k)
    may = lambda n, default=None, **k: ((f"--{n}",), {"default": default} | ({"type": type(default)} if default is not None and not isinstance(default, (bool, list)) else {}) | k)
    flag = lambda n: ((f"--{n}",), {"action": "store_true"})
    tag = may("tag", "")
    ks = (may("k-min", 2), may("k-max", 10), may("k-final", type=int), may("random-state", 42), may("pca-coords"), may("umap-coords"), tag)
    by = (may("metadata"), may("color-by"))
    add(parse_sample, need("input"), need("sample-name"), may("etape", "before_imputation", choices=["before_imputation", "after_imputation"]))
    add(build_cohort_matrix, need("input", nargs="+"), need("sample-names", nargs="+"), need("sites-file"), may("min-cov", 1))
    add(assign_origins, need("cohort-matrix"), need("source-bed"))
    add(annotate_genomic, need("cohort-with-origins"), need("tss-bed"), need("exons-bed"), need("introns-bed"), need("ccre-bed"), flag("strict"), may("slop", 0))
    add(export_tsv, need("cohort-genomic"))
    add(coverage_loss, need("input"), may("origin-col", "origin"), may("n-least-covered", 5000), may("min-coverage-pct", 75.0))
    add(distribution, need("cohort-tsv"), may("min-cov", 5), may("n-beta-bins", 100), may("n-variance-bins", 50), tag)
    add(plot_tables, need("input"), may("top-n", 50), may("min-cov", 5))
    add(prepare, need("cohort-tsv"), may("mod-code", "m"), may("top-n", type=int), may("min-completeness", 1.0), may("imputation-method", "pca", choices=["median", "knn", "pca", "random", "no_impute"]),
        may("knn-neighbors", 5), may("pca-n-components", 10), may("pca-max-iter", 50), may("pca-tol", 1e-4), may("output-format", "parquet", choices=["parquet", "tsv"]),
        may("exclude-samples", [], nargs="*"), may("seuil", type=float), tag)
    add(run_pca, need("matrix"), may("n-components", 20), flag("use-robust-scaler"), *by, tag)
    add(run_umap, need("matrix"), may("n-neighbors", 10), may("min-dist", 0.1), may("random-state", 42), flag("use-robust-scaler"), *by, tag)
    add(run_kmeans, need("matrix"), flag("use-robust-scaler"), *ks)
    add(run_gmm, need("matrix"), flag("use-robust-scaler"), may("covariance-type", "diag", choices=sorted(cluster.SHAPES)), may("reg-covar", 1e-6), *ks)
    add(run_pairwise, need("matrix"), may("distance-metric", "pearson", choices=["pearson", "spearman", "euclidean"]), may("linkage", "average", choices=["average", "complete", "ward"]), may("n-cut", type=int), may("min-coobs", 1000), *ks)
    add(risk_gradient, need("distance-matrix"), may("risk-file"), may("metadata"), may("permanova-column"), may("lingoes", True, action=argparse.BooleanOptionalAction), may("max-axes", type=int),
        may("n-permutations", 999), may("random-state", 42), tag)
    return top


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = session.session()
    session.ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
