import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoline.operators import cluster, distance, distrib, linalg, matrix, stats

NAMES = ["a", "b", "c", "d", "e"]


def cells(spark, block):
    """Rows of sites by samples; NaN is missing."""
    data = [(s, NAMES[i], None if np.isnan(v) else float(v)) for s, row in enumerate(block) for i, v in enumerate(row)]
    return spark.createDataFrame(data, "site_id int, sample string, beta double")


def wide(df, n):
    out = {}
    for r in df.collect():
        out.setdefault(r["site_id"], [np.nan] * n)[NAMES.index(r["sample"])] = np.nan if r["beta"] is None else r["beta"]
    return np.array([out[k] for k in sorted(out)])


@pytest.fixture
def block():
    rng = np.random.RandomState(0)
    out = rng.rand(30, 5)
    out[rng.rand(30, 5) < 0.15] = np.nan
    out[0] = rng.rand(5)
    return out


def test_average_ranks(spark):
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate((1.0, 2.0, 2.0, 5.0, None))], "site_id int, sample string, beta double")
    assert [r["beta"] for r in distance.ranks(df).orderBy("site_id").collect()] == [1.0, 2.5, 2.5, 4.0]


def test_pairwise_over_common_sites(spark, block):
    df = cells(spark, block)
    d, n = distance.pairwise(df, NAMES, "pearson")
    e, _ = distance.pairwise(df, NAMES, "euclidean")
    for i in range(5):
        for j in range(i):
            both = ~np.isnan(block[:, i]) & ~np.isnan(block[:, j])
            assert n[i, j] == both.sum()
            assert d[i, j] == pytest.approx(1 - np.corrcoef(block[both, i], block[both, j])[0, 1])
            assert e[i, j] == pytest.approx(np.sqrt(30 / both.sum() * ((block[both, i] - block[both, j]) ** 2).sum()))
    flat = np.array([[1.0, 1, 2], [1, 2, np.nan], [1, 3, np.nan]])
    d, _ = distance.pairwise(cells(spark, flat), NAMES[:3], "pearson")
    assert d[0, 1] == 1 and np.isnan(d[0, 2])
    assert distance.few_common(n, 10**6) == 10


def test_imputers_keep_what_was_observed(spark, block):
    df, seen = cells(spark, block), ~np.isnan(block)
    median = wide(matrix.impute_median(df), 5)
    assert np.allclose(median[~seen], np.broadcast_to(np.nanmedian(block, 1, keepdims=True), block.shape)[~seen])
    near, _ = distance.pairwise(df, NAMES, "euclidean")
    knn = wide(matrix.impute_neighbours(df, NAMES, 2), 5)
    for s, i in zip(*np.nonzero(~seen)):
        donors = [j for j in np.argsort(near[i], kind="stable") if seen[s, j] and j != i][:2]
        w = 1 / near[i, donors]
        assert knn[s, i] == pytest.approx((w * block[s, donors]).sum() / w.sum())
    # components: the same rounds with a singular value decomposition of the whole matrix
    x = np.where(seen, block, np.nanmean(block, 1, keepdims=True))
    for _ in range(50):
        c = x - x.mean(1, keepdims=True)
        u, s, v = np.linalg.svd(c, full_matrices=False)
        new = np.where(seen, block, (u[:, :2] * s[:2]) @ v[:2] + x.mean(1, keepdims=True))
        delta, x = np.linalg.norm(new - x) / np.linalg.norm(x), new
        if delta < 1e-4:
            break
    em = wide(matrix.impute_components(df, NAMES, 2), 5)
    assert np.allclose(em, np.clip(x, 0, 1), atol=1e-3)
    drawn = wide(matrix.impute_random(df, 1), 5)
    for out in (median, knn, em, drawn):
        assert np.allclose(out[seen], block[seen]) and not np.isnan(out).any() and out.min() >= 0 and out.max() <= 1
    assert np.allclose(drawn, wide(matrix.impute_random(df, 1), 5))


def test_filters_and_scales(spark, block):
    df, seen = cells(spark, block), ~np.isnan(block)
    assert matrix.complete_enough(df, 5, 0.8).count() == 5 * (seen.sum(1) >= 4).sum()
    full = matrix.without_missing(df, 5)
    x = block[seen.all(1)]
    assert np.allclose(wide(matrix.standard_scaled(full), 5), (x - x.mean(1, keepdims=True)) / x.std(1, keepdims=True))
    q = np.percentile(x, [10, 50, 90], axis=1)
    assert np.allclose(wide(matrix.robust_scaled(full), 5), ((x.T - q[1]) / (q[2] - q[0])).T)
    assert set(matrix.binary(full).select("beta").distinct().toPandas()["beta"]) <= {0.0, 1.0}
    top = distrib.most_variable(distrib.site_variance(full), 3).collect()
    assert [r["variance"] for r in top] == pytest.approx(sorted(x.var(1, ddof=1))[::-1][:3])
    ready = matrix.prepare(df.withColumn("beta", F.col("beta") * 100), NAMES, exclude=["e"], completeness=0.5, method="median", top=5)
    assert ready.count() == 20 and ready.filter("beta IS NULL OR beta > 1").count() == 0


def test_dual_components_equal_direct_ones(spark):
    x = np.random.RandomState(1).rand(40, 5)
    at, share = linalg.components(cells(spark, x), NAMES, 3)
    c = x.T - x.T.mean(0)
    s = np.linalg.svd(c, compute_uv=False)
    assert np.allclose(share, (s**2 / (s**2).sum())[:3])
    full, _ = linalg.components(cells(spark, x), NAMES, 5)
    assert np.allclose(((full[:, None] - full[None]) ** 2).sum(2), ((c[:, None] - c[None]) ** 2).sum(2))


def test_principal_coordinates_keep_distances():
    x = np.random.RandomState(2).rand(6, 3)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = linalg.principal_coordinates(d)["coordinates"]
    assert np.allclose(np.sqrt(((out[:, None] - out[None]) ** 2).sum(2)), d)
    odd = np.array([[0, 1, 1, 9], [1, 0, 1, 1], [1, 1, 0, 1], [9, 1, 1, 0.0]])
    fixed = linalg.principal_coordinates(odd)
    assert fixed["corrected"] and np.linalg.eigvalsh(linalg.gower(linalg.lingoes(odd)))[0] > -1e-8


def test_permanova_on_a_line(spark):
    x = np.array([0.0, 1, 10, 11])
    d = np.abs(x[:, None] - x[None])
    pairs = distance.frame(spark, list("abcd"), d)
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 2)], "sample string, label int")
    row = stats.permanova_observed(pairs, groups).first()
    assert (row["ss_total"], row["ss_within"], row["pseudo_f"]) == pytest.approx((101, 1, 200))
    out = stats.permanova(spark, d, [1, 1, 2, 2], 99)
    assert out["pseudo_f"] == pytest.approx(200) and 0 < out["p_value"] <= 1
    assert out == stats.permanova(spark, d, [1, 1, 2, 2], 99)
    with pytest.raises(ValueError):
        stats.permanova(spark, d, [1, 1, 1, 1])


def test_benjamini_hochberg(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate((0.01, 0.04, 0.03, 0.20))], "i int, p_value double")
    assert [r["p_adj"] for r in stats.adjusted(df).orderBy("i").collect()] == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.2])


def test_spearman_p_values():
    # r = 0.5 with 10 samples: t = 1.633 with 8 degrees of freedom, two-sided p = 0.1411
    assert stats._beta_tail(4.0, 0.5, 8 / (8 + 0.25 * 8 / 0.75)) == pytest.approx(0.14111, abs=1e-4)
    assert stats._beta_tail(0.5, 0.5, 0.5) == pytest.approx(0.5)
    assert stats.spearman(np.arange(5.0), np.arange(5.0)) == (1.0, 0.0)
    assert np.isnan(stats.spearman(np.ones(5), np.arange(5.0))[0])


def test_leave_one_out_equals_refitting():
    rng = np.random.RandomState(4)
    x, y = rng.rand(12, 2), rng.rand(12)
    guess = []
    for i in range(12):
        k = np.arange(12) != i
        beta = np.linalg.lstsq(np.column_stack([np.ones(11), x[k]]), y[k], rcond=None)[0]
        guess.append(beta[0] + x[i] @ beta[1:])
    want = 1 - ((y - guess) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert stats.leave_one_out(x, y) == pytest.approx(want)


def test_clusters():
    assert cluster.elbow([100, 40, 30, 25], range(2, 6)) == 3
    x = np.concatenate([np.random.RandomState(i).normal(i * 10, 0.5, (8, 2)) for i in range(3)])
    truth = np.repeat([0, 1, 2], 8)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    same = lambda labels: ((labels[:, None] == labels[None]) == (truth[:, None] == truth[None])).all()
    assert same(cluster.k_means(x, 3)[0]) and same(cluster.medoids(d, 3)[0]) and same(cluster.mixture(x, 3)["labels"])
    for method in ("average", "complete", "ward"):
        merges = cluster.linkage(d, method)
        assert same(cluster.cut(merges, 24, 3)) and sorted(cluster.leaves(merges, 24)) == list(range(24))
    assert cluster.mixture(x, 3)["bic"] < cluster.mixture(x, 1)["bic"]
    assert cluster.silhouette(d, truth) > 0.8 and np.isnan(cluster.silhouette(d, np.zeros(24)))
    at = cluster.layout(d, 5)
    e = np.sqrt(((at[:, None] - at[None]) ** 2).sum(2))
    assert e[truth[:, None] == truth[None]].mean() < e[truth[:, None] != truth[None]].mean()


def test_silhouettes_of_tables_equal_arrays(spark):
    x = np.random.RandomState(7).rand(5, 2)
    d, labels = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), np.array([0, 0, 1, 1, 2])
    table = spark.createDataFrame([(NAMES[i], int(labels[i])) for i in range(5)], "sample string, label int")
    got = distance.silhouettes(distance.frame(spark, NAMES, d), table).collect()
    assert np.mean([r["silhouette"] for r in got]) == pytest.approx(cluster.silhouette(d, labels))


def test_members(spark):
    df = spark.createDataFrame([("s2", 0), ("s1", 0), ("s3", 1)], "sample string, cluster int")
    assert sorted(map(tuple, cluster.members(df).collect())) == [(0, 2, "s1, s2"), (1, 1, "s3")]
    assert cluster.singletons(df).first()[0] == 1


def test_imputing_along_a_chromosome(spark):
    df = spark.createDataFrame([("x", "a", "c", s, v) for s, v in ((0, None), (10, 1.0), (15, None), (30, 5.0), (40, None))], "site_id string, sample string, chrom string, start long, beta double")
    assert [r["beta"] for r in matrix.impute_along(df).orderBy("start").collect()] == [1.0, 1.0, 2.0, 5.0, 5.0]


def test_mixtures_of_every_shape_equal_a_direct_fit(spark):
    """Log likelihoods after a rotation, or from sums over sites, are those of densities on the sites themselves."""
    rng = np.random.RandomState(3)
    sites = rng.normal(0, 1, (30, 12)) * rng.uniform(0.2, 3, (30, 1))
    sites[:, 6:] += rng.normal(0, 2, (30, 1))
    centred = sites - sites.mean(1, keepdims=True)
    values, vectors = np.linalg.eigh(centred.T @ centred)
    x, ridge = vectors[:, ::-1] * np.sqrt(np.maximum(values[::-1], 0)), 1e-2
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(sites)], "site_id int, beta array<double>")

    def direct(labels, shape):
        joint = np.full((12, 2), -np.inf)
        means = [sites[:, labels == c].mean(1) for c in (0, 1)]
        covs = [(sites[:, labels == c] - means[c][:, None]) @ (sites[:, labels == c] - means[c][:, None]).T / (labels == c).sum() for c in (0, 1)]
        if shape == "tied":
            covs = [sum(covs[c] * (labels == c).mean() for c in (0, 1))] * 2
        for c in (0, 1):
            cov = covs[c]
            if shape == "spherical":
                cov = np.eye(30) * np.trace(cov) / 30
            elif shape == "diag":
                cov = np.diag(np.diag(cov))
            cov = cov + ridge * np.eye(30)
            apart = sites - means[c][:, None]
            joint[:, c] = -0.5 * (30 * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + (apart * np.linalg.solve(cov, apart)).sum(0)) + np.log((labels == c).mean())
        return np.log(np.exp(joint - joint.max(1, keepdims=True)).sum(1)).sum() + joint.max(1).sum()

    free = {"spherical": 2, "diag": 60, "tied": 465, "full": 930}
    for shape in cluster.SHAPES:
        fit = cluster.diagonal_mixture(table, x, 2, 30, ridge, 4) if shape == "diag" else cluster.mixture(x, 2, 30, shape, ridge, 4)
        assert fit["log_likelihood"] == pytest.approx(direct(fit["labels"], shape), rel=1e-3)
        assert fit["bic"] == pytest.approx(-2 * fit["log_likelihood"] + (61 + free[shape]) * np.log(12))


def test_long_trees_have_an_order():
    n = 3000
    merges = np.array([(k + n - 1 if k else 0, k + 1, k, k + 2) for k in range(n - 1)], float)
    assert sorted(cluster.leaves(merges, n)) == list(range(n))


def test_layout_keeps_groups_together():
    rng = np.random.RandomState(2)
    x = np.concatenate([rng.normal(c, 0.3, (20, 5)) for c in (0, 4, 8)])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    a, b = cluster.curve(0.1)
    assert (a, b) == (pytest.approx(1.577, abs=0.02), pytest.approx(0.895, abs=0.02))
    at = cluster.layout(d, 8)
    apart = np.sqrt(((at[:, None] - at[None]) ** 2).sum(2))
    np.fill_diagonal(apart, np.inf)
    assert (apart.argmin(1) // 20 == np.arange(60) // 20).all()
