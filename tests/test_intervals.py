import random

from pyspark.sql import functions as F

from cytoline.operators import annotation, intervals


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, items, names="chrom string, start long, end long"):
    return spark.createDataFrame(items, names)


def test_asof_looks_at_the_last_start_only(spark):
    track = table(spark, [("c", 0, 100, "A"), ("c", 10, 20, "B")], "chrom string, start long, end long, name string")
    sites = table(spark, [("s1", "c", 50, 52), ("s2", "c", 15, 17), ("s3", "d", 1, 3)], "site_id string, chrom string, start long, end long")
    found = {r["site_id"]: r["hit"] and r["hit"]["name"] for r in intervals.asof_overlap(sites, track, ["name"]).collect()}
    assert found == {"s1": None, "s2": "B", "s3": None}
    found = {r["site_id"]: r["hit"] and r["hit"]["name"] for r in intervals.first_overlap(sites, track, ["name"]).collect()}
    assert found == {"s1": "A", "s2": "B", "s3": None}


def test_all_tags_of_overlaps(spark):
    regions = table(spark, [("c", 0, 10, "850k; v2"), ("c", 5, 15, "450k;v2"), ("c", 0, 99, None)], "chrom string, start long, end long, origin string")
    sites = table(spark, [("a", "c", 8, 10), ("b", "c", 15, 17), ("d", "c", 14, 16)], "site_id string, chrom string, start long, end long")
    out = {r["site_id"]: r["origin"] for r in intervals.tags_of_overlaps(sites, regions).collect()}
    assert out == {"a": "450k;850k;v2", "b": "unknown", "d": "450k;v2"}


def test_overlap_join_equals_all_pairs(spark):
    rng = random.Random(3)
    make = lambda n: [(rng.choice("xy"), s := rng.randint(0, 300), s + rng.randint(0, 90)) for _ in range(n)]
    a, b = make(60), make(60)
    left, right = table(spark, a), table(spark, b, "chrom string, r_start long, r_end long")
    want = sorted((*p, q[1], q[2]) for p in a for q in b if p[0] == q[0] and q[1] < p[2] and q[2] > p[1])
    assert rows(intervals.overlap_join(left, right, width=16).select("chrom", "start", "end", "r_start", "r_end")) == want
    hit = [p for p in a if any(p[0] == q[0] and q[1] < p[2] and q[2] > p[1] for q in b)]
    assert rows(intervals.overlap_join(left, right, "left_semi", 16)) == sorted(hit)
    assert intervals.overlap_join(left, right, "left_anti", 16).count() == len(a) - len(hit)


def test_merge_joins_touching_intervals(spark):
    df = table(spark, [("c", 0, 10, "b"), ("c", 5, 15, "a"), ("c", 20, 30, "z"), ("c", 30, 31, "z"), ("c", 40, 40, "e")], "chrom string, start long, end long, name string")
    assert rows(intervals.merge(df, "name")) == [("c", 0, 15, "a,b"), ("c", 20, 31, "z")]


def test_subtract_and_depth_equal_counting_bases(spark):
    rng = random.Random(5)
    a = [(i, "c", s := rng.randint(0, 100), s + rng.randint(1, 60)) for i in range(25)]
    b = [("c", s := rng.randint(0, 150), s + rng.randint(1, 12)) for _ in range(12)]
    out = intervals.subtract(table(spark, a, "k int, chrom string, start long, end long"), table(spark, b), width=8)
    covered = {x for _, s, e in b for x in range(s, e)}
    got = {}
    for r in out.collect():
        got.setdefault(r["k"], set()).update(range(r["start"], r["end"]))
    assert all(got.get(k, set()) == set(range(s, e)) - covered for k, _, s, e in a)
    depth = {}
    for _, _, s, e in a:
        for x in range(s, e):
            depth[x] = depth.get(x, 0) + 1
    swept = intervals.depth(table(spark, [x[1:] for x in a])).collect()
    assert {x: r["depth"] for r in swept for x in range(r["start"], r["end"])} == depth
    places = sorted((r["start"], r["end"], r["depth"]) for r in swept)
    assert all(p[1] < q[0] or p[2] != q[2] for p, q in zip(places, places[1:]))


def test_gene_model_tracks(spark):
    genes = spark.createDataFrame([("c", "+", 0, 100, "g", [0, 50], [10, 100]), ("c", "-", 40, 90, "h", [40], [90])], "chrom string, strand string, tx_start long, tx_end long, gene string, exon_starts array<bigint>, exon_ends array<bigint>")
    assert rows(annotation.starts(genes).select("start", "end", "gene")) == [(0, 1, "g"), (89, 90, "h")]
    assert rows(annotation.merged_exons(genes)) == [("c", 0, 10, "g"), ("c", 40, 100, "g,h")]
    assert rows(annotation.introns(genes).select("start", "end", "gene")) == [(10, 40, "g")]
    assert annotation.blocks(genes).filter("gene = 'g'").select(F.array_join(F.col("block_sizes").cast("array<string>"), ",")).first()[0] == "10,50"


def test_first_track_that_hits_wins(spark):
    named = "chrom string, start long, end long, name string, extra string"
    tss, exon = table(spark, [("c", 5, 6, "T", "+")], named), table(spark, [("c", 0, 20, "E", "")], named)
    intron, ccre = table(spark, [("c", 0, 40, "I", "")], named), table(spark, [("c", 0, 60, "C", "pELS")], named)
    sites = table(spark, [(str(s), "c", s, s + 2) for s in (5, 6, 30, 50, 70)], "site_id string, chrom string, start long, end long")
    out = {r["site_id"]: (r["feature_label"], r["gene_name"], r["distance_TSS"], r["ccre_type"]) for r in annotation.annotate(sites, tss, exon, intron, ccre).collect()}
    assert out == {"5": ("Promoter/TSS", "T", "+", ""), "6": ("Exon", "E", "", ""), "30": ("Intron", "I", "", ""), "50": ("cCRE", "", "", "pELS"), "70": ("Intergenic", "", "", "")}
    near = {r["site_id"]: r["distance"] for r in annotation.distance_to_start(sites, tss).collect()}
    assert near == {"5": 0, "6": 1, "30": 25, "50": 45, "70": 65}


def test_sorted_passes_carry_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(intervals, "STRETCH", 16)
    test_asof_looks_at_the_last_start_only(spark)
    test_merge_joins_touching_intervals(spark)
    test_subtract_and_depth_equal_counting_bases(spark)
    rng = random.Random(9)
    track = [("c", s := rng.randint(0, 500), s + rng.randint(1, 60), f"n{i}") for i in range(40)]
    sites = [(str(i), "c", s := rng.randint(0, 600), s + 2) for i in range(120)]
    named = table(spark, track, "chrom string, start long, end long, name string")
    got = {r["site_id"]: r["hit"] and r["hit"]["name"] for r in intervals.asof_overlap(table(spark, sites, "site_id string, chrom string, start long, end long"), named, ["name"]).collect()}
    for i, _, s, _ in sites:
        last = max(((a, b, n) for _, a, b, n in track if a <= s), default=None)
        assert got[i] == (last[2] if last and last[1] > s else None)
    merged, want = rows(intervals.merge(named)), []
    for _, a, b, _ in sorted(track, key=lambda t: t[1:3]):
        if want and a <= want[-1][1]:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    assert merged == [("c", *w) for w in want]


def test_semi_and_anti_joins_do_not_depend_on_the_order_of_rows(spark):
    """Repeated rows and rows dealt at random each time they are read: kept and dropped rows still add up."""
    rng = random.Random(7)
    a = [(i % 40, "c", s := rng.randint(0, 300), s + rng.randint(0, 40)) for i in range(200)] * 2
    left = table(spark, a, "k int, chrom string, start long, end long").repartition(5, F.rand())
    right = table(spark, [("c", s, s + 9) for s in range(0, 300, 50)], "chrom string, r_start long, r_end long")
    inside, outside = (sorted(map(tuple, intervals.overlap_join(left, right, how, 16).collect())) for how in ("left_semi", "left_anti"))
    hit = [r for r in a if any(s < r[3] and s + 9 > r[2] for s in range(0, 300, 50)) and r[3] > r[2]]
    assert sorted(inside + outside) == sorted(a) and inside == sorted(r for r in a if r in hit)


def test_several_tracks_are_matched_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(intervals, "STRETCH", 64)
    rng = random.Random(9)
    sites = table(spark, [(f"s{i}", "cd"[i % 2], p := rng.randint(0, 900), p + 2) for i in range(150)], "site_id string, chrom string, start long, end long")
    tracks = [table(spark, [("cd"[i % 2], s := rng.randint(0, 900), s + rng.randint(1, 90), f"n{i % 7}") for i in range(60)], "chrom string, start long, end long, name string") for _ in range(3)]
    both = intervals.asof_overlaps(sites, {f"t{k}": (t, ["name"]) for k, t in enumerate(tracks)})
    got = {r["site_id"]: tuple(r[f"t{k}"] and (r[f"t{k}"]["end"], r[f"t{k}"]["name"]) for k in range(3)) for r in both.collect()}
    for k, track in enumerate(tracks):
        rows_ = [tuple(r) for r in track.collect()]
        for site in sites.collect():
            last = max(((s, e, n) for c, s, e, n in rows_ if c == site["chrom"] and s <= site["start"]), default=None)
            assert got[site["site_id"]][k] == (last[1:] if last and last[1] > site["start"] else None)


def test_long_intervals_are_few_rows(spark):
    long = [("c", 0, 250_000_000), ("c", 4_095, 4_097), ("c", 4_095, 1 << 40), ("c", 5, 5)]
    df = table(spark, long)
    for levels in ([], [0], [0, 3], list(range(9))):
        asked = F.array(*map(F.lit, levels)).cast("array<int>")
        for turn in (0, 1):
            filed = intervals._filed(df, "start", "end", intervals.BIN, asked, turn)
            assert filed.filter(F.col("_place.turn") == turn).count() == len(long)
            assert filed.count() <= len(long) * (1 + 3 * len(levels))


def test_intervals_of_all_lengths_meet_once(spark):
    rng = random.Random(17)
    make = lambda n: [(rng.choice("xy"), s := rng.randint(-2_000, 200_000), s + int(2 ** rng.uniform(0, 18)) - rng.randint(0, 1)) for _ in range(n)]
    a, b = make(120) + [("x", 0, 1 << 45), ("x", 7, 7)], make(120) + [("x", -5, 1 << 50), ("y", 64, 64)]
    left, right = table(spark, a), table(spark, b, "chrom string, r_start long, r_end long")
    meets = lambda p, q: p[0] == q[0] and q[1] < p[2] and q[2] > p[1]
    want = sorted((*p, q[1], q[2]) for p in a for q in b if meets(p, q))
    for width in (1, 16, 4096):
        assert rows(intervals.overlap_join(left, right, width=width).select("chrom", "start", "end", "r_start", "r_end")) == want
    hit = [p for p in a if any(meets(p, q) for q in b)]
    assert rows(intervals.overlap_join(left, right, "left_semi")) == sorted(hit)
    assert intervals.overlap_join(left, right, "left_anti").count() == len(a) - len(hit)
    none = right.limit(0)
    assert not rows(intervals.overlap_join(left, none)) and len(rows(intervals.overlap_join(left, none, "left_anti"))) == len(a)
    assert not rows(intervals.overlap_join(left.limit(0), right))


def test_bins_are_powers_of_two(spark):
    import pytest

    df = table(spark, [("c", 0, 1)])
    with pytest.raises(ValueError, match="power of two"):
        intervals.overlap_join(df, df, width=100)
