"""Whitening, spelling variants and top-k search against brute force, on odd rows and small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoline.llm import spelling, top_k, vectors, whitening
from cytoline.llm.queries import op11_whitening, op12_spelling, op13_top_k

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, copies string, shard string, q string"


def vector_rows(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "i", "x", "c", "s", "q") for i, v in rows], VECTORS).repartition(parts)


def kept(rows):
    return [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]


def odd_vectors(n=60, d=5, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(d)]) for i in range(n)]
    return rows + [(100, [0.1] * d), (100, [0.1] * d), (200, [0.1] * d), (None, [0.2] * d), (300, None), (400, [NAN] + [0.0] * (d - 1)),
                   (500, [0.0] * (d - 1) + [INF]), (600, [0.0] * (d - 1) + [None]), (700, [0.0] * d), (800, []), (900, [0.5] * (d + 1))]


# -- whitening ---------------------------------------------------------------------------------------------------------


def brute_whitening(rows, d, scale=64, offset=1_000_000, k=32):
    x = np.array([np.floor(scale * np.array(v, np.float32).astype(float)) + offset for _, v in rows if len(v) == d]).astype(np.int64)
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    y = x - sums / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    return x, n, deviation, y, values[::-1][:k], basis[:, ::-1][:, :k], values.sum()


def check_whitening(out, rows, d, k):
    x, n, deviation, y, values, basis, trace = brute_whitening(rows, d, k=k)
    assert len(out) == n * min(k, d) and {r["n"] for r in out} == {n}
    ids = Counter((i, c) for i, _ in rows for c in range(1, min(k, d) + 1))
    assert Counter((r["id"], r["component"]) for r in out) == ids
    assert sorted(r["deviation"] for r in out if r["component"] == 1) == sorted(deviation)
    want = y @ basis / np.sqrt(values)
    for c in range(min(k, d)):
        got = sorted(r["whitened"] for r in out if r["component"] == c + 1)
        assert np.allclose(got, sorted(want[:, c]), atol=1e-7) or np.allclose(got, sorted(-want[:, c]), atol=1e-7)
        assert all(r["explained"] == pytest.approx(values[c] / trace, rel=1e-9) for r in out if r["component"] == c + 1)
    (error,) = {r["identity_error"] for r in out}
    assert error < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = odd_vectors()
    df = vector_rows(spark, rows)
    model = whitening.fit(df)
    out = whitening.whiten(df, model).collect()
    # the longer vector is not of the size that most have, the empty one neither
    check_whitening(out, [(i, v) for i, v in kept(rows) if len(v) == 5], 5, 32)
    assert model.d == 5 and model.basis.shape == (5, 5)


def test_whitening_of_nothing_and_of_rows_that_do_not_differ(spark):
    none = vector_rows(spark, [(1, None), (2, [NAN, 1.0])], 1)
    for df in (none, none.limit(0), vector_rows(spark, [(1, [])], 1)):
        assert whitening.whiten(df, whitening.fit(df)).collect() == []
    same = vector_rows(spark, [(i, [0.5, 0.25, 0.1]) for i in range(4)])
    out = whitening.whiten(same, whitening.fit(same)).collect()
    assert len(out) == 12 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] == 0 for r in out)
    line = vector_rows(spark, [(i, [i / 8, i / 4, -i / 8]) for i in range(6)])
    out = whitening.whiten(line, whitening.fit(line)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in out)
    assert all(r["explained"] == pytest.approx(1.0) for r in out if r["component"] == 1) and all(r["identity_error"] < 1e-9 for r in out)


def test_the_range_finder_stops_at_few_components_and_expands_when_it_must(spark):
    rng = np.random.default_rng(4)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    steep = rng.standard_normal((500, 30)) * np.repeat([40.0, 1e-4], [4, 26]) @ basis
    flat = rng.standard_normal((500, 30))
    for values, expands in ((steep, False), (flat, True)):
        rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
        df = vector_rows(spark, rows)
        model = whitening.fit(df, components=4, scale=1 << 20, oversampling=3)
        assert model.expanded is expands and (model.passes < 5 or expands)
        _, n, _, y, values, exact, trace = brute_whitening(rows, 30, scale=1 << 20, k=4)
        assert np.allclose(model.values, values, rtol=1e-12) and model.trace == pytest.approx(trace, rel=1e-12)
        assert np.allclose(np.abs((model.basis * exact).sum(0)), 1, atol=1e-9)
        residual = y.T @ (y @ model.basis) / n - model.basis * model.values
        assert np.linalg.norm(residual, axis=0).max() < 1e-11 * values[0]


def test_deviations_stay_exact_where_64_bits_do_not_hold_them():
    n, sums = 10**12, np.array([10**12 * 10**6 + 7, 5])
    model = whitening.Whitening(2, n, sums, np.eye(2), np.ones(2), 2.0, 1, True, 64, 0)
    x = np.array([[10**6 + 40, -3], [10**6, 0]])
    assert [int(v) for v in model.deviations(x)] == [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]


def test_whitening_of_a_whole_table(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    out = op11_whitening(spark, small)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [out.schema[c].dataType.simpleString() for c in ("component", "n", "deviation")] == ["int", "bigint", "bigint"]
    check_whitening(out.withColumnRenamed("vec_id", "id").collect(), rows, 64, 32)


# -- spelling variants -------------------------------------------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(items, shortest=7, least=2):
    counts = Counter()
    for ident, text in items:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_group(counts, factor=10):
    near, lengths = defaultdict(list), defaultdict(list)
    for w in counts:
        lengths[len(w)].append(w)
    for w in counts:
        near[w] = [o for k in (-1, 0, 1) for o in lengths[len(w) + k] if one_apart(w, o)]
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= factor * counts[w]:
                form[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(rows)


def grouped(df, **more):
    return sorted(tuple(r) for r in spelling.group(df, **more).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_of_odd_documents(spark):
    long = "Wonderful wonderfull wonderfal Éléphant éléphant Éléphants naïveté ××××××× "
    items = [(1, long * 30), (2, "wonderful " * 300), (2, "wonderful " * 300), (None, "wonderful beautiful beautifull " * 40), (3, None), (4, ""), (5, "short words only"),
             (6, "x" * 60_000 + " " + "x" * 60_000 + ("y" + "x" * 60_000 + " ") * 2), (7, "abababab babababa aaaaaaaa aaaaaaaaa abababa " * 3), (8, "日本語 wonderful日beautiful "), (9, "WONDERFULİwonderful"), *((20 + k, f"{'ab' * 31}{c} " * (3 if k else 40)) for k, c in enumerate(("c", "cd", "cde", "bcde", "cdf", "cdeé")))]
    df = spark.createDataFrame([(i, t, "w", "k", "r") for i, t in items], "doc_id long, text string, word string, n string, key string").repartition(3)
    assert {r["word"]: r["n"] for r in spelling.words(df).collect()} == brute_words(items)
    assert grouped(df) == brute_group(brute_words(items))
    assert grouped(df.limit(0)) == [] and grouped(df.filter("doc_id IN (3, 4, 5)")) == []


def test_words_one_apart_share_exactly_one_key(spark):
    words = [f"{a}{b}{c}{d}" for a in "ab" for b in ("", "a", "b") for c in "ab" for d in ("", "a", "b", "ab")]
    words = sorted({w for w in words if w})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r["word"], r["other"]) for r in spelling.near(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_hashes_of_deletions_are_those_of_the_words():
    whole = lambda w: {int(h) for h in spelling.deletion_hashes(w)}
    word = "éaabbbca"
    deletions = {word[:i] + word[i + 1 :] for i in range(len(word))}
    assert len(whole(word)) == len(deletions) + 1
    assert all(len(whole(word) & whole(d)) == 1 for d in deletions) and not whole(word) & whole("something else")
    assert len(spelling.deletion_hashes("x" * 1_000_000)) == 2


def test_forms_are_followed_to_the_last(spark):
    chain = "abcdefgh"
    forms = [(chain[:i + 1], chain[: i + 2] if i < 7 else None) for i in range(8)] + [("z", None)]
    out = spelling.roots(spark.createDataFrame(forms, "word string, form string"))
    assert {r["word"]: r["root"] for r in out.collect()} == {chain[:i + 1]: chain for i in range(7)}


def test_spelling_of_a_whole_table(spark, small):
    items = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out = op12_spelling(spark, small)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == brute_group(brute_words(items))
    assert any(r[1] for r in got) and any(r[4] for r in got)


# -- top-k search ------------------------------------------------------------------------------------------------------


def brute_top(rows, k, d, scale=1024):
    rows = [(i, np.floor(scale * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows if len(v) == d]
    asked = {(i, tuple(v)) for i, v in rows if i is not None and i % 100 == 0}
    out = Counter()
    for i, q in asked:
        scores = sorted(((-int(np.dot(q, v)), o is None, o or 0, o) for o, v in rows if o != i))[:k]
        out.update((i, rank, o, -s) for rank, (s, _, _, o) in enumerate(scores, 1))
    return out


def searched(df, k):
    return Counter(tuple(r) for r in top_k.search(df.filter("vec_id % 100 = 0"), df, k).select("query_id", "rank", "id", "score").collect())


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_search_of_odd_rows(spark, k):
    rows = odd_vectors(80, 5, 2) + [(1000 + i % 3, [0.1] * 5) for i in range(40)]
    df = vector_rows(spark, rows)
    assert searched(df, k) == brute_top(kept(rows), k, 5)


def test_search_of_nothing(spark):
    none = vector_rows(spark, [(100, None), (200, [NAN, 1.0])], 1)
    assert not searched(none, 10) and not searched(none.limit(0), 10)
    assert not searched(vector_rows(spark, [(100, [1.0, 2.0])], 1), 10)
    assert not searched(vector_rows(spark, [(1, [1.0, 2.0])], 1), 10)


@pytest.mark.parametrize("dense", [0.125, 2.0])
def test_a_shard_gives_what_scoring_all_gives(monkeypatch, dense):
    monkeypatch.setattr(top_k, "DENSE", dense)
    rng = np.random.default_rng(3)
    for case in range(40):
        d, n = int(rng.integers(1, 40)), int(rng.integers(1, 3000))
        x = (rng.standard_normal((n, d)) * 100 * (rng.random((n, d)) < rng.choice([0.05, 0.5, 1.0]))).astype(np.int64)
        if case % 3 == 0:
            x[: n // 2] = x[0]
        shard = top_k.Shard(x)
        for query in (x[0], -x[-1], np.zeros(d, np.int64), (rng.standard_normal(d) * 50).astype(np.int64)):
            out = rng.random(n) < 0.1
            rows, scores = shard.best(query, 10, out)
            all_scores = x @ query
            want = [r for r in np.lexsort((np.arange(n), -all_scores)) if not out[r]][:10]
            assert rows.tolist() == want and scores.tolist() == all_scores[want].tolist()


def test_products_beyond_a_long_are_an_error():
    with pytest.raises(ArithmeticError):
        top_k.Shard(np.full((3, 2), 2**31)).best(np.full(2, 2**31), 1)


def test_shards_and_groups_of_queries_meet_once(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 13)
    monkeypatch.setattr(top_k, "GROUP_QUERIES", 3)
    rng = random.Random(8)
    rows = [(i * 25, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(70)]
    assert searched(vector_rows(spark, rows), 10) == brute_top(rows, 10, 8)


def test_search_of_a_whole_table(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    out = op13_top_k(spark, small)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in out.collect()) == brute_top(rows, 10, 64)


def test_vectors_of_other_kinds(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3, None])], "vec_id long, embedding array<int>")
    good, x = vectors.integers(df, "embedding", 64, 5)
    assert [tuple(r) for r in df.select(good, F.when(good, x)).collect()] == [(True, [69, 133]), (False, None)]
