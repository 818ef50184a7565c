"""Each operator against a brute-force version, an exact round trip or the library, on odd documents and a small table."""

import hashlib
import random
import time
import unicodedata
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from cytoline.llm import exact_dedup, fingerprints, labelled, mixing, near_dedup, quality, sentence_pieces, sharding, suffix_dedup, token_counts, toxicity
from cytoline.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, kept string, key string, doc string, node string"
ODD = [
    (3, "The cat sat on the mat and then it sat on the hat again today.", "a"),
    (1, "the  cat sat\ton the mat and then it sat on the hat again today.", "a"),
    (9, "The cat sat on the mat and then it sat on the hat again today.", "a"),
    (9, "The cat sat on the mat and then it sat on the hat again today.", "a"),
    (4, None, "b"), (5, "", None), (6, " \n\t ", "b"), (7, "one", "b"), (8, "one two", None),
    (None, "one two", "c"), (None, None, None), (10, "été 日本語テキスト \U0001f389 \x00 ▁ <s> naïve ﬁ", "c"),
    (11, "word " * 5000, "a"), (12, "x" * 30000, "a"), (13, "ONE TWO", "c"), (14, " lead", "b"), (15, "\n\nline  two  spaces \n", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", s, None, "x", "y", "z", "k", "d", "n") for i, t, s in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# -- exact dedup -------------------------------------------------------------------------------------------------------


def brute_exact(items):
    groups = defaultdict(list)
    for i, t, *_ in items:
        groups["".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i is None, i or 0))
    return {sha(k): (min(v), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("bits", [3, None])
def test_exact_dedup(odd, bits):
    got = exact_dedup.mark(odd, log_bits=bits).collect()
    want = brute_exact(ODD)
    assert len(got) == len(ODD)
    for r in got:
        (_, none, keep), size = want[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (None if none else keep, size)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == {k: 1 for k in want}
    kept = exact_dedup.keep_first(odd, log_bits=bits)
    assert kept.columns == odd.columns and kept.count() == len(want)


def test_exact_dedup_of_nothing(empty):
    assert exact_dedup.mark(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


# -- near dedup --------------------------------------------------------------------------------------------------------


def shingle_sets(items):
    out = []
    for i, t, *_ in items:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def brute_near(items, percent):
    sets = [(i, s) for i, s in shingle_sets(items)]
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return [(i, len(s), least.get(root(a)) if s else i) for a, (i, s) in enumerate(sets)]


def rows_of(df, *names):
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))


def test_near_dedup_of_odd_documents(odd, empty):
    got = near_dedup.group(odd, 85)
    assert rows_of(got, "id", "n_shingles", "component_id") == sorted(map(repr, brute_near(ODD, 85)))
    kept = near_dedup.keep_one(odd, 85)
    assert kept.columns == odd.columns
    assert near_dedup.group(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0


@pytest.mark.parametrize("chunk", [near_dedup.CHUNK, 700, 100])
def test_near_dedup_finds_every_link(spark, chunk):
    """Chains of edits, so that components hold pairs that are not linked, and groups hold several components."""
    rng, items = random.Random(11), []
    for g in range(6):
        words = [f"w{rng.randint(0, 60)}" for _ in range(90)]
        for _ in range(14):
            items.append((len(items) * 7 % 101 + 1000 * g, " ".join(words)))
            for _ in range(rng.choice((0, 1, 2))):
                words[rng.randrange(90)] = f"v{rng.randint(0, 10**6)}"
    for _ in range(30):  # a star: edits of one text, less like each other than like the text
        own = [f"s{k}" for k in range(80)]
        for _ in range(rng.choice((1, 1, 2, 4))):
            own[rng.randrange(80)] = f"t{rng.randint(0, 10**6)}"
        items.append((len(items) + 9000, " ".join(own)))
    items.append((9999, " ".join(f"s{k}" for k in range(80))))
    df = spark.createDataFrame(items, "doc_id long, text string")
    for percent in (80, 85):
        assert rows_of(near_dedup.group(df, percent, chunk=chunk), "id", "n_shingles", "component_id") == sorted(map(repr, brute_near(items, percent)))
    n = len({c for *_, c in brute_near(items, 80)})
    assert near_dedup.keep_one(df, 80).count() == n


def test_near_copies_without_an_id_count(spark):
    base = [f"w{k}" for k in range(100)]
    near = lambda *at: " ".join("x%d" % k if k in at else w for k, w in enumerate(base))
    # 1 and 2 are linked through the row without an id only
    items = [(1, near(3, 4, 5)), (None, near()), (2, near(90, 91, 92)), (None, near(50)), (None, "other words than these are here"), (None, "other words than these are here")]
    items += [(None, f"a b c d e f g h i j k l m n o p q r s t u v w {x}") for x in "xy"]  # alike, with no id in their component
    df = spark.createDataFrame(items, "doc_id long, text string")
    assert rows_of(near_dedup.group(df, 85), "id", "n_shingles", "component_id") == sorted(map(repr, brute_near(items, 85)))
    kept = [r["text"] for r in near_dedup.keep_one(df, 85).collect()]
    assert len(kept) == 4 and kept.count(items[4][1]) == 2 and kept.count(items[0][1]) == 1 and sum(t.startswith("a b c") for t in kept) == 1


def exact_components(items, percent):
    """All links by walking along the documents of each shingle."""
    sets = [(i, s) for i, s in shingle_sets(items)]
    having = defaultdict(list)
    for a, (_, s) in enumerate(sets):
        for e in s:
            having[e].append(a)
    common = Counter()
    for own in having.values():
        for k, a in enumerate(own):
            for b in own[:k]:
                common[b, a] += 1
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[root(a)] = min(i, least.get(root(a), i))
    return [(i, len(s), least[root(a)] if s else i) for a, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup_of_a_whole_table(spark, percent):
    """Recall over all documents of sf0.01: components are those of every link."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(near_dedup.group(docs, percent), "id", "n_shingles", "component_id") == sorted(map(repr, exact_components(items, percent)))


def test_overlaps_are_those_of_the_sets():
    rng = np.random.RandomState(5)
    sets = [np.unique(rng.randint(0, hi, rng.randint(1, 90))) for hi in (40, 40, 300, 300, 5000) * 12]
    out = near_dedup.overlaps(np.concatenate(sets), np.repeat(np.arange(60), [len(s) for s in sets]), 60)
    assert all(out[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(i + 1, 60))


def test_components_are_the_same_in_one_task_and_spread(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(35)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    df = df.select(*(F.sha2(F.col(c).cast("string"), 256).cast("binary").alias(c) for c in ("a", "b")))  # names of sets are binary
    assert rows_of(near_dedup.components(df), "node", "comp") == rows_of(near_dedup.components(df, 0), "node", "comp")
    assert near_dedup.components(df.limit(0)).count() == near_dedup.components(df.limit(0), -1).count() == 0


def test_sketches_fill_and_agree_like_the_sets():
    rng = np.random.RandomState(0)
    with np.errstate(over="ignore"):
        for n in (1, 2, 7, 50, 3000):
            assert (near_dedup.sketch(rng.randint(0, 1 << 62, n).astype(np.uint64)) != near_dedup._EMPTY).all()
        same = []
        for _ in range(60):
            x = rng.randint(0, 1 << 62, 300).astype(np.uint64)
            a, b = x[:200], x[100:]  # a third of the union is shared
            same.append((near_dedup.sketch(a) == near_dedup.sketch(b)).mean())
    assert abs(np.mean(same) - 1 / 3) < 0.02


# -- suffix dedup ------------------------------------------------------------------------------------------------------


def brute_repeats(items, length=50):
    out, seen = [], set()
    order = sorted(items, key=lambda r: (r[0] is None, r[0] or 0))
    at = 0
    while at < len(order):
        end = at
        while end < len(order) and order[end][0] == order[at][0]:
            end += 1
        new = set()
        for i, t, *_ in order[at:end]:
            b = (t or "").encode()
            gone = np.zeros(len(b) + 1, int)
            grams = [b[k : k + length] for k in range(len(b) - length + 1)]
            for k, g in enumerate(grams):
                if g in seen:
                    gone[k] += 1
                    gone[k + length] -= 1
            new.update(grams)
            mark = np.cumsum(gone[:-1]) > 0
            out.append((i, len(b), int(mark.sum()), int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum()), sha(bytes(np.frombuffer(b, np.uint8)[~mark]))))
        seen |= new
        at = end
    return out


@pytest.mark.parametrize("frequent", [32, 1, 0])
def test_suffix_dedup(spark, odd, empty, docs, texts, frequent):
    def got(df):
        return rows_of(suffix_dedup.repeats(df, frequent=frequent).selectExpr("id", "n_bytes", "aggregate(spans, 0L, (n, s) -> n + s.end - s.start) AS removed", "cast(size(spans) AS int) AS n", "kept_sha256"), "id", "n_bytes", "removed", "n", "kept_sha256")

    assert got(odd) == sorted(map(repr, brute_repeats(ODD)))
    assert got(docs) == sorted(map(repr, brute_repeats(texts)))
    assert suffix_dedup.repeats(empty).count() == 0
    rng, base = random.Random(2), "".join(random.Random(1).choice("ab ") for _ in range(400))
    items = []
    for i in range(60):  # few characters, long overlaps, many partial matches
        a = rng.randrange(300)
        items.append((i * 37 % 61, base[a : a + rng.randrange(120)] + rng.choice(("", "z", "zz")) + base[rng.randrange(300) :][:60]))
    assert got(spark.createDataFrame(items, "doc_id long, text string")) == sorted(map(repr, brute_repeats(items)))


def repeats_here(items, parts=3, length=50, frequent=32):
    """The steps of suffix dedup in this process."""
    own = suffix_dedup
    items = [(i, t or "") for i, t in items if len((t or "").encode()) >= length]
    tables = [pa.table({"bucket": [b] * len(rows), "id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t.encode() for _, t in rows], pa.binary())}) for b in range(parts) if (rows := items[b::parts])]
    gather = lambda rows, name, n: [pa.concat_tables([t.filter(pc.equal(t[name], k)) for t in rows]) for k in range(n)]
    sent = [own.send_anchors(length, parts, frequent)(t) for t in tables]
    answers = gather([own.match_anchors(t) for t in gather(sent, "part", parts) if t.num_rows], "bucket", len(tables))
    around = [own.send_surroundings(length, parts)(t, a) for t, a in zip(tables, answers)]
    matched = gather([own.match_surroundings(length)(t) for t in gather(around, "part", parts) if t.num_rows], "bucket", len(tables))
    out = [own.mark_texts(length, parts)(t, a) for t, a in zip(tables, matched)]
    return {(r["id"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept_sha256"]) for t in out for r in t.to_pylist()}


def passages(n=40):
    """Texts that share passages, some of them in nearly all texts, between words of their own."""
    rng = random.Random(6)
    common = [" ".join(f"p{k}q{rng.randint(0, 99)}" for k in range(25)) for _ in range(4)]
    out = []
    for i in range(n):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(30)]
        for c in rng.sample(common, rng.randint(0, 3)):
            words.insert(rng.randrange(len(words)), c)
        out.append((i, " ".join(words)))
    return [*out, *((100 + i, out[i][1]) for i in range(0, n, 3))]


@pytest.mark.parametrize("frequent", [32, 0])
def test_equal_hashes_meet_a_byte_comparison(monkeypatch, frequent):
    compared, ordered = [], []
    for name in ("windows_equal", "same_bytes"):
        f = getattr(suffix_dedup, name)
        monkeypatch.setattr(suffix_dedup, name, lambda data, left, *more, f=f: compared.append(len(left)) or f(data, left, *more))
    sort = suffix_dedup.sort_suffixes
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", lambda data, hashes, starts, *more: ordered.append(len(starts)) or sort(data, hashes, starts, *more))
    items = passages()
    assert repeats_here(items, frequent=frequent) == {(i, removed, digest) for i, _, removed, _, digest in brute_repeats(items)}
    assert sum(compared) > 0 and sum(ordered) > 0


def test_texts_whose_hashes_collide_lose_nothing(monkeypatch):
    """With a hash that knows four bytes apart from each other only, nothing goes that does not repeat; windows that are
    sorted by themselves lose no repetition, those in cells next to none."""
    monkeypatch.setattr(suffix_dedup, "_TABLE", suffix_dedup._TABLE[np.arange(256) % 4])
    want = {i: removed for i, _, removed, _, _ in brute_repeats(passages())}
    for frequent in (32, 0):
        got = {i: removed for i, removed, _ in repeats_here(passages(), frequent=frequent)}
        assert all(got[i] <= want[i] for i in want) and sum(got.values()) > 0.998 * sum(want.values())
        if not frequent:  # windows that are sorted one by one
            assert got == want
    monkeypatch.setattr(suffix_dedup, "_TABLE", suffix_dedup._TABLE[np.zeros(256, int)])
    got = {i: removed for i, removed, _ in repeats_here(passages())}
    assert all(got[i] <= want[i] for i in want)


def test_suffix_sort_orders_suffixes(monkeypatch):
    data = np.frombuffer(bytes(random.Random(4).choice(b"abc") for _ in range(600)), np.uint8)
    starts, groups = np.arange(0, 500), np.sort(np.random.RandomState(1).randint(0, 7, 500))
    with np.errstate(over="ignore"):
        order = suffix_dedup.sort_suffixes(data, suffix_dedup.PrefixHash(data), starts, groups, 50)
    raw = data.tobytes()
    want = sorted(range(500), key=lambda i: (groups[i], raw[starts[i] : starts[i] + 50], i))
    assert order.tolist() == want


# -- mixing ------------------------------------------------------------------------------------------------------------

MIX = {"weights": [5.0, 2.0, 1.0], "share": 1.5, "epochs": 2.0}


def test_mixing_meets_targets(odd, empty, docs):
    for df in (odd, docs):
        rows = mixing.mix(df, **MIX).collect()
        assert len(rows) == df.count()
        sizes, taken, target = Counter(), Counter(), {}
        for r in rows:
            sizes[r["source"]] += r["size"]
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert 0 <= r["taken"] <= 2 * r["size"]
        # targets by repeated sharing
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: MIX["weights"][k % 3] for k, s in enumerate(order)}
        free, left, want = set(order), 1.5 * sum(sizes.values()), {}
        while free:
            level = left / sum(weight[s] for s in free)
            full = {s for s in free if level * weight[s] >= 2 * sizes[s]}
            for s in full or free:
                want[s] = 2 * sizes[s] if full else level * weight[s]
            left -= sum(want[s] for s in (full or free))
            free -= full or free
        assert target == pytest.approx(want)
        assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
        assert rows_of(mixing.mix(df, **MIX), "id", "taken") == rows_of(mixing.mix(df.repartition(5), **MIX), "id", "taken")
        out = mixing.materialise(df, **MIX)
        assert out.columns == df.columns
        assert out.select(F.sum(mixing.words(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(empty, **MIX).count() == 0 and mixing.materialise(empty, **MIX).count() == 0


# -- sharding ----------------------------------------------------------------------------------------------------------


def brute_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(odd, empty, docs):
    keys = np.random.RandomState(0).randint(0, 1 << 62, 500).astype(np.uint64)
    assert sharding.jump(keys, 13).tolist() == [brute_jump(int(k), 13) for k in keys]
    for df in (odd, docs):
        rows = sharding.layout(df, 8).collect()
        assert len(rows) == df.count()
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len({(r["id"], r["shard"]) for r in rows}) == len({r["id"] for r in rows})
    got = {(r["id"], r["size"], r["text_crc32"]) for r in sharding.layout(odd, 8).collect()}
    assert got == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ODD}
    assert sharding.layout(empty, 8).count() == 0
    assert sharding.assign(odd, 8, ["doc_id", "source"]).count() == len(ODD)
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_sharding_of_a_whole_table(spark):
    """Every column of the query against the hash, the jumps and the numbering done row by row."""
    import struct

    import xxhash

    from cytoline.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.select("doc_id", "text").collect()}
    key = lambda i: xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
    rows = queries.op7_sharding(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"] for r in rows} == set(text) and len(rows) == len(text)
    slots = defaultdict(set)
    for r in rows:
        i = r["doc_id"]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text[i]) + 1, zlib.crc32(text[i]), "key")
        assert (r["shard"], r["grown_shard"]) == (brute_jump(key(i), 8), brute_jump(key(i), 9))
        slots[r["shard"]].add(r["slot"])
    assert all(s == set(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(rows)


# -- fingerprints ------------------------------------------------------------------------------------------------------


def test_fingerprints(odd, empty, docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.with_successor(docs).collect()}
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        r, own = got[i], fingerprints.canonical(t)
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == (len(t), sha(edited), fingerprints.digest(own))
        assert (r["near_edited"], r["near_next"]) == (float(own == fingerprints.canonical(edited)), float(own == fingerprints.canonical(following)))
    assert fingerprints.with_successor(odd).count() == len(ODD) and fingerprints.with_successor(empty).count() == 0
    same = defaultdict(list)
    for i, t in texts:
        same[fingerprints.canonical(t)].append(i)
    assert {(r["group_id"], r["group_size"]) for r in got.values()} == {(min(v), len(v)) for v in same.values()} and all(r["doc_id"] in same[fingerprints.canonical(dict(texts)[r["doc_id"]])] for r in got.values())
    assert {i: (r["group_id"], r["group_size"]) for i, r in got.items()} == {i: (min(v), len(v)) for v in same.values() for i in v}
    one = fingerprints.with_successor(odd.filter("doc_id = 7")).first()
    assert one["near_next"] == 1.0
    forms = defaultdict(list)
    for i, t, _ in ODD:
        forms[fingerprints.canonical(t or "")].append(i)
    rows = fingerprints.groups(odd).collect()
    assert Counter((r["fingerprint"], r["group_size"]) for r in rows) == Counter({(fingerprints.digest(f), len(v)): len(v) for f, v in forms.items()})
    assert fingerprints.groups(empty).count() == 0
    for t in ("ﬁne Straße", "İx", "a  b", "Å"):
        assert fingerprints.canonical(fingerprints.canonical(t)) == fingerprints.canonical(t)


# -- tokenizers --------------------------------------------------------------------------------------------------------


def test_token_counts_equal_the_library(odd, empty, texts):
    from tokenizers import Tokenizer

    definition = tokenizer_file("word_bpe_49k.json").decode()
    library, own = Tokenizer.from_str(definition), token_counts.PrefixCounter(definition)
    exact = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = {(r["id"], r["n_tokens"], r["n_bytes"], r["over_limit"]) for r in token_counts.measure(odd, definition, 100).collect()}
    assert got == {(i, n := exact(t or ""), len((t or "").encode()), n > 100) for i, t, _ in ODD}
    assert token_counts.measure(empty, definition, 1).count() == 0
    rng = random.Random(0)
    alphabet = "abcdeéßΣ日🎉'st 1\n\t!?<|>ıİ́\u0085\x1c"
    for t in [t for _, t in texts[:60]] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["a<|endoftext|>b"]:
        assert own.count(t) == exact(t)
    t = "Hello<|endoftext|>World's shhahaerble été 12!! x"
    assert own.prefixes(t) == [exact(t[:i]) for i in range(len(t) + 1)]
    for r in token_counts.measure(odd.filter("length(text) < 30000"), definition, 9).collect():
        (text,) = {t for i, t, _ in ODD if i == r["id"] and t and len(t.encode()) == r["n_bytes"]} or {""}
        fits = max((i for i in range(min(len(text), 200) + 1) if exact(text[:i]) <= 9), default=0)
        assert r["kept_bytes"] == len(text[:fits].encode())
    cut = own.truncate(t, 5)
    assert exact(cut) <= 5 and t.startswith(cut)


def test_token_counts_of_prefixes_on_every_text(odd):
    from tokenizers import Tokenizer

    definition = tokenizer_file("word_bpe_49k.json").decode()
    library, own = Tokenizer.from_str(definition), token_counts.PrefixCounter(definition)
    exact = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(1)
    alphabet = "abcdeéßΣ日🎉'st 1\n\t!?<|>ıİ\u0301\u0085\x1crevl"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    for t in ["First paragraph.\n\nSecond one.", "two  spaces", "e\u0301te\u0301 we're they'll've", "wow!<|endoftext|><|endoftext|>'s", *made]:
        assert own.prefixes(t) == [exact(t[:i]) for i in range(len(t) + 1)], t
    short = odd.filter("length(text) < 200")
    for r in short.select("text", token_counts.prefix_counts(F.col("text"), definition).alias("n"), token_counts.truncated(F.col("text"), definition, 3).alias("cut")).collect():
        assert r["n"] == [exact(r["text"][:i]) for i in range(len(r["text"]) + 1)]
        assert r["cut"] == r["text"][: max(i for i, n in enumerate(r["n"]) if n <= 3)]


JOINED = ["a", "é", "ガ", "ぱ", "한", "글", "'", "s", "r", "!", "1", "Σ", "İ", "\u0301", "\u0327", "\u0323", "\u0344", "ộ", "日", "'re", "ll", "\u1161", "\u11a8", "\u09c7", "\u09be"]


def test_token_counts_of_prefixes_where_characters_are_joined():
    from tokenizers import Tokenizer

    definition = tokenizer_file("word_bpe_49k.json").decode()
    library, own = Tokenizer.from_str(definition), token_counts.PrefixCounter(definition)
    exact = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(3)
    for k in range(400):
        t = "".join(rng.choice(JOINED) for _ in range(rng.randint(0, 60)))
        t = unicodedata.normalize("NFD", t) if k % 2 else t
        assert own.prefixes(t) == [exact(t[:i]) for i in range(len(t) + 1)], t


@pytest.mark.parametrize("base", ["ガギグパピプが", "éèộüñç", "한글문자", "ạ́b̧́!́", "e" + "\u0301" * 30_000])
def test_long_runs_of_joined_characters_are_counted_once(base):
    from tokenizers import Tokenizer

    definition = tokenizer_file("word_bpe_49k.json").decode()
    library, own = Tokenizer.from_str(definition), token_counts.PrefixCounter(definition)
    base = unicodedata.normalize("NFD", base)
    text = (base * (30_000 // len(base) + 1))[:30_000]
    started = time.process_time()
    n, fits = own.fitting(text, 2048)
    assert time.process_time() - started < 30  # re-encoding every prefix would take an hour
    counts = own.prefixes(text)
    assert n == counts[-1] == len(library.encode(text, add_special_tokens=False).ids)
    assert fits == max(i for i, c in enumerate(counts) if c <= 2048)
    for i in [1, 2, 3, 500, fits, fits + 1, 9_999]:
        assert counts[i] == len(library.encode(text[:i], add_special_tokens=False).ids)


def test_token_counts_are_the_last_stored_ones(texts):
    own = token_counts.PrefixCounter(tokenizer_file("word_bpe_49k.json").decode())
    for _, t in texts[:40]:
        assert own.count(t or "") == own.prefixes(t or "")[-1]


@pytest.mark.parametrize("text", ["1234567890" * 50, "日本語" * 1000, "🎉😀" * 1000, "。！" * 4000, "ก็ดีนะ" * 2000, "ඳෞ" * 9000, "中文没有空格的长文本" * 10000, "?!" * 20000, "\n" * 3000, " " * 3000, "ab" * 40000])
def test_sentence_pieces_of_long_unbroken_texts(text):
    import sentencepiece

    proto = tokenizer_file("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_proto=proto), sentence_pieces.Model(proto)
    for t in (text, "a " + text + " b", text + "."):
        ids = library.encode(t)
        line, _, back = own.round_trip(t)
        assert line == ",".join(map(str, ids)) and back == library.decode(ids)
        assert b"".join(t.encode()[p.start : p.end] for p in own.pieces_of(t)) == t.encode()
    assert not any(len(k) > token_counts.LONGEST for memory in (own.units, own.ends, own.runs) for k in memory)


def test_sentence_pieces_equal_the_library(spark, odd, empty, texts):
    import sentencepiece

    proto = tokenizer_file("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_proto=proto), sentence_pieces.Model(proto)
    want = {(i, len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t, _ in ODD}
    rows = sentence_pieces.measure(odd, proto).collect()
    assert {(r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == want
    widths = lambda t: sha(",".join(str(p.end - p.start) for p in own.pieces_of(t)))
    assert {(r["id"], r["widths_sha256"]) for r in rows} == {(i, widths(t or "")) for i, t, _ in ODD}
    assert sentence_pieces.measure(empty, proto).count() == 0
    rng = random.Random(0)
    alphabet = "abcdeéßΣ日🎉'st 1\n\t  ▁!<s>unk0x0A>  \x00\r "
    for t in [t for _, t in texts[:60]] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]:
        ids = library.encode(t)
        line, spans, back = own.round_trip(t)
        assert line == ",".join(map(str, ids)) and back == library.decode(ids)
        pieces = own.pieces_of(t)
        assert spans == ",".join(str(p.end - p.start) for p in pieces)
        assert not t or own.aligned(*own.normalise(t)) == own.encode(t)  # the whole text at once
        assert [p.id for p in pieces] == ids and b"".join(t.encode()[p.start : p.end] for p in pieces) == t.encode()
    got = {r["doc_id"]: r["p"] for r in odd.filter("doc_id IN (4, 8)").select("doc_id", sentence_pieces.pieces(F.coalesce("text", F.lit("")), proto).alias("p")).collect()}
    assert not got[4] and [p["piece"] for p in got[8]] == ["▁one", "▁two"]


def test_character_map_takes_the_longest_prefix():
    """A double array made here: 'a' -> 'x', 'ab' -> 'y'; offsets follow the source."""
    units = [0] * 512
    root = 256
    units[0] = root << 10
    a = root ^ ord("a")
    below = 128  # children of 'a'
    units[a] = ord("a") | 1 << 8 | (a ^ below) << 10
    units[below] = 1 << 31 | 0
    ab = below ^ ord("b")
    end = 300
    units[ab] = ord("b") | 1 << 8 | (ab ^ end) << 10
    units[end] = 1 << 31 | 2
    import struct

    blob = struct.pack("<I", len(units) * 4) + struct.pack(f"<{len(units)}I", *units) + b"x\0y\0"
    table = sentence_pieces.CharacterMap(blob)
    assert [table.longest_prefix(b"abac\xc3\xa9", i) for i in (0, 2, 3, 4)] == [(b"y", 2), (b"x", 1), (b"c", 1), (b"\xc3\xa9", 2)]


# -- classifiers -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def taught(spark):
    """Documents of which one in three has a word of a list, and labels that say so; others are shouted."""
    rng, vocabulary, bad = random.Random(5), [f"word{i}" for i in range(400)], ["vile", "foul", "nasty"]
    items, labels = [], []
    for i in range(900):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = i % 3 == 0
        if toxic:
            for w in rng.choices(bad, k=4):
                words.insert(rng.randrange(len(words)), w)
        shouted = i % 4 == 0
        items.append((i, "!!% ".join(words).upper() if shouted else " ".join(words)))
        labels.append((i, int(not shouted), int(toxic)))
    return SimpleNamespace(docs=spark.createDataFrame(items, "doc_id long, text string"), labels=spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int"), truth={i: (q, t) for i, q, t in labels})


def test_toxicity(taught, odd, empty, spark):
    index = toxicity.fit(taught.docs, taught.labels)
    rows = toxicity.score(taught.docs, index).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["id"] for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == taught.truth[r["id"]][1] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(odd, index).count() == len(ODD) and toxicity.score(empty, index).count() == 0
    near = taught.docs.filter("doc_id < 6").select(toxicity.evidence(F.col("text"), index).alias("e")).collect()
    assert any(r["e"] for r in near)
    none = toxicity.fit(empty, taught.labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd, none).collect()} <= {0, 1}


def test_toxicity_searches_by_every_term(spark):
    """A toxic word of a single labelled example is enough to find a near copy of it, and cosines are over all terms."""
    rng, vocabulary = random.Random(8), [f"word{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=80) + (["vile", "foul"] if i % 3 == 0 else []))) for i in range(300)]
    labels = [(i, int(i % 3 == 0)) for i in range(300)]
    rare = next(i for i in range(300, 330) if zlib.crc32(str(i).encode()) % 5)
    insult = [f"rare{i}" for i in range(60)]
    items.append((rare, " ".join(insult)))
    labels.append((rare, 1))
    index = toxicity.fit(spark.createDataFrame(items, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).index
    near = " ".join([*insult[:57], "another", "two"])
    (found, similarity), *others = index.nearest([near], 5)[0]
    assert index.ids[found] == rare and similarity == pytest.approx(1.0, abs=0.05) and not others
    assert index.score(near) >= 0.5 > index.score(" ".join(rng.choices(vocabulary, k=80)))


def test_toxicity_returns_its_evidence(taught):
    index = toxicity.fit(taught.docs, taught.labels)
    few = taught.docs.filter("doc_id < 20")
    want = {r["doc_id"]: r["e"] for r in few.select("doc_id", toxicity.evidence(F.col("text"), index).alias("e")).collect()}
    got = {r["id"]: r["evidence"] for r in toxicity.score(few, index).collect()}
    assert got == want and all(e["label"] == taught.truth[e["id"]][1] for near in got.values() for e in near) and all(got.values())


@pytest.mark.parametrize("block", [8, 64])
def test_nearest_examples_equal_reading_them_all(taught, monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    examples = [(r["text"], taught.truth[r["doc_id"]][1]) for r in taught.docs.limit(500).collect()]
    vocabulary = sorted({w for t, _ in examples for w in toxicity.terms(t)})
    triples = [(i, vocabulary.index(w), n) for i, (t, _) in enumerate(examples) for w, n in Counter(toxicity.terms(t)).items()]
    n = len(examples)
    index = toxicity.build(np.arange(n), np.array([c for _, c in examples], float), *np.array(triples).T, vocabulary, {0: 300, 1: 200})
    assert (index.weights.idf > 0).all()
    for postings in (index.weights,):
        dense = np.zeros((len(vocabulary), n))
        for t in range(len(vocabulary)):
            own = slice(postings.starts[t], postings.starts[t + 1])
            dense[t, postings.examples[own]] = postings.values[own]
        queries = [postings.weigh(*index.count(t)) for t, _ in examples[:90]]
        for (at, weights), got, without in zip(queries, postings.nearest(queries, 7, [*range(-1, 89)]), range(-1, 89)):
            scores = np.round(weights @ dense[at], 12)
            want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if s > 0 and i != without))[:7]
            assert [pytest.approx(-s) for s, _ in want] == [s for _, s in got]
            assert all(scores[i] == pytest.approx(s) for i, s in got)


def test_toxicity_of_a_whole_table(spark):
    """As registered, over sf0.01: all labelled rows are indexed, the neighbours that vote equal cosines worked out from the
    texts, scores follow from them; what held-out rows show."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    fitted = toxicity.fit(docs, labels)
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    known = fitted.index.ids.tolist()
    tallies = [Counter(toxicity.terms(text[i])) for i in known]
    frequency = Counter(w for t in tallies for w in t)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert sorted(known) == sorted(i for i, t in truth.items() if i in text and t is not None and zlib.crc32(str(i).encode()) % 5)
    toxic, n1 = Counter(w for i, t in zip(known, tallies) if truth[i] for w in t), sum(truth[i] for i in known)
    n0, idf = len(known) - n1, {}
    for w, n in frequency.items():
        a, b = toxic[w], n - toxic[w]
        chi = len(known) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (n1 * n0 * n * max(1, len(known) - n))
        idf[w] = (np.log((1 + len(known)) / (1 + n)) + 1) * (1 + min(chi, toxicity.CHI)) / (1 + toxicity.CHI)

    def unit(tally):
        own = {w: (1 + np.log(n)) * idf[w] for w, n in tally.items() if w in idf}
        size = sum(x * x for x in own.values()) ** 0.5
        return {w: x / size for w, x in own.items()}

    vectors = [unit(t) for t in tallies]
    rows = toxicity.score(docs, fitted).collect()
    for r in rows[::9]:
        own = unit(Counter(toxicity.terms(text[r["id"]])))
        cosines = {i: sum(x * v.get(w, 0.0) for w, x in own.items()) for i, v in zip(known, vectors)}
        assert [e["similarity"] for e in r["evidence"]] == pytest.approx(sorted((c for c in cosines.values() if c > 1e-12), reverse=True)[: toxicity.NEIGHBOURS])
        assert all(cosines[e["id"]] == pytest.approx(e["similarity"]) and e["label"] == truth[e["id"]] for e in r["evidence"])
        if r["evidence"]:
            sides = [toxicity.PRIOR + sum(e["similarity"] for e in r["evidence"] if e["label"] == c) for c in (1, 0)]
            *slopes, intercept = fitted.index.fitted
            assert r["score"] == pytest.approx(1 / (1 + np.exp(-(np.dot(slopes, np.log(sides)) + intercept))))
    held = [(truth[r["id"]], r["predicted"]) for r in rows if r["held_out"] and truth.get(r["id"]) is not None]
    assert sum(p for t, p in held if t == 1) >= 0.9 * sum(t for t, _ in held) and sum(p for t, p in held if t == 0) <= 0.06 * sum(t == 0 for t, _ in held)


def test_toxicity_learns_the_same_from_repeated_rows(spark, taught):
    doubled = taught.docs.unionByName(taught.docs.select("doc_id", F.concat("text", F.lit(" more"))).toDF("doc_id", "text")).unionByName(taught.docs.filter("doc_id < 9").withColumn("text", F.lit(None).cast("string")))
    assert toxicity.fit(doubled, taught.labels).name == toxicity.fit(doubled.repartition(7), taught.labels).name


def test_quality(taught, odd, empty):
    model = quality.fit(taught.docs, taught.labels)
    held = [r for r in quality.score(taught.docs, model, 0.3).collect() if r["held_out"]]
    assert np.mean([r["predicted"] == taught.truth[r["id"]][0] for r in held]) > 0.97
    rows = quality.score(odd, model, 0.3).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows) and quality.score(empty, model, 0.3).count() == 0
    none = quality.fit(empty, taught.labels.limit(0))
    assert {r["score"] for r in quality.score(odd, none, 0.3).collect()} == {0.5}


def test_long_texts_are_learned_from_too(spark):
    """All good examples are longer than a text's share of a dictionary."""
    rng, words = random.Random(4), [f"word{i}" for i in range(3000)]
    good = [" ".join(rng.choices(words[:1500], k=15_000)) for _ in range(30)]
    bad = [" ".join(rng.choices(words[1500:], k=15_000)) for _ in range(30)]
    items = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(items, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(i, int(i < 30)) for i, _ in items], "doc_id long, quality int"))
    assert len(model.bad) > quality.DICTIONARY // 2 and len(model.good) > quality.DICTIONARY // 2
    held = [r for r in quality.score(docs, model, 0.3).collect() if r["held_out"]]
    assert held and all(r["predicted"] == (r["id"] < 30) for r in held)
    data = good[0].encode()
    share = quality.share_of(data)
    assert len(data) > quality.DICTIONARY // quality.SHARE >= len(share) > quality.DICTIONARY // quality.SHARE - quality.BLOCK
    assert all(share[at : at + 500] in data for at in range(0, len(share), quality.BLOCK)) and not data.startswith(share[: 4 * quality.BLOCK])
    assert quality.share_of(b"short") == b"short"


def test_quality_difference_is_that_of_single_blocks(texts):
    import zstandard

    bad, good = (" ".join(t for _, t in texts[k:60:2])[: 1 << 16].encode() for k in (0, 1))
    own = quality.Scorer(bad, good)
    sizes = []
    for content in (bad, good):
        with_it = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
        sizes.append(lambda data, c=with_it: sum(len(c.compress(data[k : k + quality.BLOCK])) for k in range(0, len(data), quality.BLOCK)))
    for t in ["", "a", "x" * 300000, *(t for _, t in texts[60:120])]:
        data = t.encode()
        assert own.difference(t) == pytest.approx((sizes[0](data) - sizes[1](data)) / (len(data) + quality.SMOOTH), abs=0.002)


def test_quality_of_a_whole_table(spark):
    """As registered, over sf0.01: dictionaries of one size, made of whole texts; what held-out rows show."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert abs(len(model.good) - len(model.bad)) < 0.1 * len(model.good)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    learned = [t for i, t in text.items() if t and zlib.crc32(str(i).encode()) % 5 and truth.get(i) is not None]
    assert max(t in model.bad + model.good for t in learned) and not any(t in model.bad + model.good for i, t in text.items() if zlib.crc32(str(i).encode()) % 5 == 0 and len(t) > 40 and t not in learned)
    held = [(truth[r["id"]], r["score"]) for r in quality.score(docs, model, 0.3).collect() if r["held_out"] and truth.get(r["id"]) is not None]
    good, bad = ([s for t, s in held if t == c] for c in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97 and np.mean([g >= 0.3 for g in good]) > 0.95


def test_quality_of_examples_without_text(spark):
    docs = spark.createDataFrame([(i, None if i % 2 else "good words here and there") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    assert {r["predicted"] for r in quality.score(docs, quality.fit(docs, labels), 0.3).collect()} == {1}


def test_held_out_rows_are_never_learned_from(taught):
    rows, counts = labelled.sample(taught.docs, taught.labels, "toxic", 100, "doc_id", "text")
    got = rows.collect()
    assert all(zlib.crc32(str(r["id"]).encode()) % 5 for r in got) and max(Counter(r["label"] for r in got).values()) <= 100
    assert sum(counts.values()) > len(got)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_sentence_pieces_by_itself_remembers_more_units(spark, monkeypatch):
    """The pipeline's workers have held other models before; the query's have not."""
    given = []
    real = sentence_pieces.digest
    monkeypatch.setattr(sentence_pieces, "digest", lambda text, proto, units: given.append(units) or real(text, proto, units))
    proto = tokenizer_file("piece_bpe_32k.model")
    sentence_pieces.measure(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), proto)
    assert given == [sentence_pieces.OWN_UNITS] and sentence_pieces.OWN_UNITS > sentence_pieces.UNITS
    assert sentence_pieces.Model(proto, 7).units.most == 7 and sentence_pieces.Model(proto).units.most == sentence_pieces.UNITS
