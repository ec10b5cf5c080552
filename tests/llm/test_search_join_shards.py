import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nassaj.llm import components, jaccard, sharding, vafile


# --- exact search -----------------------------------------------------------------
def brute_search(rows, k, scale=1024):
    best = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v):
            ints = [int(np.floor(scale * float(np.float32(x)))) for x in v]
            best[i] = min(best.get(i, ints), ints)
    out = []
    for q, a in best.items():
        if q % 5 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in best.items() if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "copies", "few"])
def test_search_is_exact(spark, case, monkeypatch):
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 20)
    monkeypatch.setattr(vafile, "SCAN_ROWS", 64)
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).astype("float32").tolist()) for i in range({"random": 400, "copies": 300, "few": 4}[case])]
    if case == "copies":
        rows = [(i, [0.5] * 6 if i % 3 == 0 else [0.1] * 6 if i % 3 == 1 else v) for i, v in rows]
    rows += [(1000, None), (1005, [1.0] * 5 + [float("nan")]), (1010, [float("inf")] * 6), (1015, []), (1020, [1.0, 2.0])]
    rows += [(0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS score", "3 AS q")
    got = vafile.top_k(df, "vec_id", "embedding", F.col("vec_id") % 5 == 0, k=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_search(rows, 3)


def test_search_without_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vafile.top_k(df, "vec_id", "embedding", F.lit(True)).collect() == []


def test_search_with_huge_components(spark):
    rows = [(i, [3e8 * (i + 1), -1e8, 5.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vafile.top_k(df, "vec_id", "embedding", F.col("vec_id") % 5 == 0, k=3).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [11, 10, 9]


# --- n-gram Jaccard join ----------------------------------------------------------
def words(text):
    return text.encode().lower().split() if text else []


def brute_components(rows, n, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: 10**9)
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], k)
    return sorted((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize(("n", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 50, 3)])
def test_join_finds_every_component(spark, n, percent, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(3, 60))] for _ in range(25)]
    rows = []
    for i in range(260):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w if r.random() < 0.7 else w + bases[0][:20])))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one"), (906, "Éa b"), (907, "éa b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS key", "1 AS n", "2 AS node", "3 AS chunk")
    got = jaccard.jaccard_components(df.repartition(3), "doc_id", "text", n, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute_components(rows, n, percent)


def test_join_of_a_large_group(spark):
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 4, 85)
    assert sorted(map(tuple, got.collect())) == brute_components(rows, 4, 85)


@pytest.mark.parametrize(("hot", "block"), [(1024, 256), (4, 3)])
def test_links_go_through_null_and_repeated_ids(spark, monkeypatch, hot, block):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "HOT_MEANS", 0)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    chain = [f"w{i}" for i in range(60)]
    texts = [" ".join(chain[i : i + 50]) for i in (0, 2, 4)]  # one and two link, two and three do, one and three do not
    r = random.Random(3)
    rows = [(1, texts[0]), (None, texts[1]), (3, texts[2]), (7, "x y z"), (None, "x y z"), (None, "only nulls here"), (None, "ONLY nulls here")]
    for i in range(60):
        w = [f"b{k}" for k in range(80)]
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((r.choice([None, 20, 30, 40 + i]), " ".join(w)))
    rows += [(30, "under a number of others"), (None, None), (None, ""), (50, None)]
    want = []
    least = dict()
    groups = brute_components([(i, t) for i, (_, t) in enumerate(rows)], 4, 85)
    for i, _, c in groups:
        if rows[i][0] is not None:
            least[c] = min(least.get(c, 10**9), rows[i][0])
    want = [(str(rows[i][0]), n, str(least.get(c))) for i, n, c in groups]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(str(r[0]), r[1], str(r[2])) for r in jaccard.jaccard_components(df, "doc_id", "text", 4, 85).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(got)[0][2] == "1" and ("3", 47, "1") in got


def test_profiles_of_different_lengths_bound_the_overlap(spark):
    r = np.random.default_rng(1)
    rows, want = [], []
    for n, m, common in [(250, 260, 200), (1000, 1100, 1000), (4000, 4090, 10), (9000, 9500, 8000), (3, 4, 2)]:
        h = np.unique(r.integers(0, 1 << 64, n + m, dtype=np.uint64))
        a, b = np.sort(h[:n]), np.sort(np.concatenate([h[:common], h[n : n + m - common]]))
        rows.append((jaccard._profile(a), jaccard._profile(b)))
        want.append((len(np.intersect1d(a, b)), min(len(a), len(b))))
    df = spark.createDataFrame(rows, "a array<smallint>, b array<smallint>").coalesce(1)
    for (least, most), bound in zip(want, df.select(jaccard._overlap_bound("a", "b")).collect(), strict=True):
        assert least <= bound[0] <= most
    assert df.select(jaccard._overlap_bound("a", "b")).collect()[2][0] < 0.85 * 4000


def test_join_of_nothing_and_repeats(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(df).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "q"), (2, None), (2**62 + 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.jaccard_components(df).collect()) == [
        ("1", 2, "1"), ("1", 2, "1"), ("2", 0, "2"), (str(2**62 + 1), 1, str(2**62 + 1)), ("None", 1, "None"),
    ]


@pytest.mark.parametrize("block", [7, 256])
def test_every_link_is_counted(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    r = random.Random(2)
    rows = []
    for i in range(60):
        w = [f"b{k}" for k in range(160)]
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = f"x{r.randrange(40)}"
        rows.append((i if i % 5 else None, " ".join(w)))
    rows += [(3, rows[3][1]), (None, rows[4][1]), (90, None), (91, " "), (None, "c d e f"), (None, "c d e f")]
    sets = [set(jaccard.shingles(t, 4).tolist()) for _, t in rows]
    like = [[bool(a and b) and 100 * len(a & b) >= 85 * len(a | b) for b in sets] for a in sets]
    want = [(str(k), len(s), sum(like[i]) - bool(s)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))]
    found, pairs = jaccard.jaccard_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text", 4, 85)
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["n_links"]) for r in found.collect()) == sorted(want)
    distinct = [set(s) for s in {frozenset(s) for s in sets if s}]
    n_pairs = sum(100 * len(a & b) >= 85 * len(a | b) for i, a in enumerate(distinct) for b in distinct[:i])
    assert pairs.count() == pairs.distinct().count() == n_pairs > 300


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (200, 200)]
    df = spark.createDataFrame(random.Random(1).sample(links, len(links)), "x long, y long")
    found = {r["node"]: r["label"] for r in components.components(df, "x", "y").collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 200}


# --- shards -----------------------------------------------------------------------
def test_slots_are_even_and_few_move():
    names = [f"n{i}" for i in range(10)]
    before, after = sharding.fill(names, 1009), sharding.fill(names[:-1], 1009)
    sizes = Counter(before).values()
    assert max(sizes) - min(sizes) <= 1
    assert sum(a != b for a, b in zip(before, after, strict=True) if b != 9 and a != 9) < 1009 * 0.1
    heavy = Counter(sharding.fill(["a", "b"], 1009, {"a": 3}))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)
    with pytest.raises(ValueError):
        sharding.fill([], 1009)


def test_placement(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, None)], "doc_id long, slot string").selectExpr("*", "'x' AS id")
    names = ["p", "q", "r"]
    rows = sharding.place(df, "doc_id", names, 101).collect()
    table = sharding.fill(names, 101)
    assert len(rows) == 4 and all(r["shard"] == names[table[r["slot"]]] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert sharding.place(df.limit(0), "doc_id", names, 101).count() == 0
    hot = spark.range(2000).selectExpr("1 AS k", "id AS salt")
    assert sharding.place(hot, "k", names, 101, salt="salt").select("shard").distinct().count() == 3
    sharding.write(sharding.place(df, "doc_id", names, 101), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_large_shards_are_written_in_several_files(spark, tmp_path):
    placed = sharding.place(spark.range(0, 4000, 1, 4).selectExpr("1 AS k", "id", "repeat('x', 100) AS t"), "k", ["p", "q"], 101)
    sharding.write(placed, f"{tmp_path}/out", file_bytes=60_000)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r["id"] for r in out.collect()) == list(range(4000))
    assert out.select(F.input_file_name()).distinct().count() > 1
