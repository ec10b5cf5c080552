import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from nassaj.llm import nra, refine, whitening
from nassaj.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


# --- ranked search ----------------------------------------------------------------
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_ranking(docs, items, k):
    counted = [(key, Counter(words(t))) for key, t in docs]
    held = [c for _, c in counted if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for c in held)
    df = Counter(t for c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in counted:
            score = 0
            for t in set(words(text)) & c.keys():
                m = 10 + 90 * sum(c.values()) * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, r, None if missing else key, -s) for r, (s, missing, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, k):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS row", "2 AS rank").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'x' AS term")
    found = nra.search(d, i, k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "ÉTÉ", "naïve", "日本", "x-y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.randint(1, 30)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (None, docs[5][1]), (3, docs[3][1])]
    docs += [(2000, None), (2001, ""), (2002, " ... "), (2003, "W1 " * 50_000)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 12)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unheard of"), (None, "w1 w2"), (0, "W1, w1; w1"), (54, docs[3][1])]
    return docs, items


@pytest.mark.parametrize(("seed", "k", "postings", "chars"), [(1, 10, 1 << 20, 1 << 24), (2, 3, 200, 100), (3, 1, 1, 1 << 24)])
def test_ranking_is_that_of_all_scores(spark, monkeypatch, seed, k, postings, chars):
    monkeypatch.setattr(nra, "POSTINGS", postings)
    monkeypatch.setattr(nra, "QUERY_CHARS", chars)
    monkeypatch.setattr(nra, "FIRST_READ", 2)
    docs, items = corpus(seed)
    assert ranked(spark, docs, items, k) == brute_ranking(docs, items, k)


def test_search_of_nothing(spark):
    assert ranked(spark, [], [(1, "a")], 3) == []
    assert ranked(spark, [(1, "a")], [], 3) == []
    assert ranked(spark, [(1, None), (2, "")], [(1, "a")], 3) == []


def test_reading_stops_early():
    """Lists whose ends cannot matter are not read to the end."""

    class Watched(np.ndarray):
        most = 0

        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop is not None:
                Watched.most = max(Watched.most, min(at.stop, len(self)))
            return super().__getitem__(at)

    docs = np.arange(100_000).view(Watched)
    gains = np.sort(np.random.default_rng(1).integers(1, 50, 100_000))[::-1].astype(np.int64)
    gains[:5] = 1000
    found, scores = nra.nra([(docs, gains)], 100_000, 5, 0)
    assert sorted(found.tolist()) == [0, 1, 2, 3, 4] and set(scores.tolist()) == {1000}
    assert Watched.most < 100


# --- exact duplicates -------------------------------------------------------------
def brute_duplicates(rows):
    def low(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    groups = defaultdict(list)
    for key, t in rows:
        groups[low(t)].append(key)
    out = []
    for t, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        left = Counter(keys)
        for n, key in enumerate(keys):
            first = key == keep and keys.index(key) == n
            out.append((key, keep, len(keys), first, hashlib.sha256(t.encode()).hexdigest()))
        assert sum(left.values()) == len(keys)
    return sorted(out, key=str)


def odd_texts():
    r = random.Random(5)
    long = "word " * 60_000
    rows = [(i, r.choice(["a", "A", "b", "ab", "É", "é", "same beginning " * 20 + r.choice("xyXY")])) for i in range(300)]
    rows += [(400, None), (401, ""), (402, None), (403, long), (404, long.upper()), (405, long + "."), (406, long[:-1] + "!")]
    return rows + [(None, "b"), (None, "only nulls"), (None, "Only Nulls"), (7, rows[7][1]), (299, rows[299][1]), (299, rows[299][1])]


@pytest.mark.parametrize(("bits", "digest_all"), [(1 << 24, True), (64, True), (128, False)])
def test_duplicates_are_those_of_all_texts(spark, bits, digest_all):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "'h' AS hash", "2 AS row", "3 AS n").repartition(3)
    found = refine.exact_duplicates(df, digest_all=digest_all, bits=bits)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = [tuple(r) for r in found.collect()]
    want = brute_duplicates(rows)
    if digest_all:
        assert sorted(got, key=str) == want
    else:
        assert sorted((r[:4] for r in got), key=str) == sorted((r[:4] for r in want), key=str)
        assert all(r[4] is not None for r in got if r[2] > 1)
        assert {r[4] for r in got} <= {r[4] for r in want} | {None}


def test_lone_texts_are_not_hashed_in_full(spark):
    df = spark.createDataFrame([(i, f"text {i} " * (i + 1)) for i in range(50)], "doc_id long, text string")
    found = refine.exact_duplicates(df).collect()
    assert len(found) == 50 and all(r["text_sha256"] is None and r["kept"] and r["keep_id"] == r["doc_id"] for r in found)


def test_duplicates_of_a_hot_group(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    found = refine.exact_duplicates(rows).where("group_size > 1")
    assert found.count() == 1667 and [r["doc_id"] for r in found.where("kept").collect()] == [4998]
    assert refine.exact_duplicates(rows.limit(0)).collect() == []


# --- whitening --------------------------------------------------------------------
def random_symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    v = q @ np.diag(values) @ q.T
    return (v + v.T) / 2


SPECTRA = {
    "spread": np.linspace(100, 1, 20),
    "wide": 10.0 ** -np.arange(0, 10, 0.5),
    "equal": np.array([5.0] * 4 + [3.0] * 3 + [1.0] * 6),
    "near": np.array([7.0, 7.0 - 1e-11, 7.0 - 2e-11, 4.0, 4.0 - 1e-13, 2.0, 1.0]),
    "all equal": np.ones(8),
    "poor": np.array([3.0, 2.0, 0.0, 0.0, 0.0, 0.0]),
    "one": np.array([2.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_counts_follow_the_spectrum(name):
    v = random_symmetric(SPECTRA[name])
    for s in (-0.5, 0.01, 0.7, 1.5, 2.5, 3.5, 6.0, 50.0):
        assert whitening.above(v, s) == int((np.linalg.eigvalsh(v) > s).sum())
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0) == 1


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("k", [1, 2, 5, 20])
def test_slices_are_eigenpairs(name, k):
    v = random_symmetric(SPECTRA[name])
    k = min(k, whitening.above(v, whitening.LEAST * whitening.largest(v)))
    pairs = whitening.leading(v, k)
    x = np.stack([c for _, c in pairs], 1)
    assert len(pairs) == k
    assert np.allclose([e for e, _ in pairs], np.sort(SPECTRA[name])[::-1][:k], rtol=0, atol=1e-13 * SPECTRA[name].max() * len(v))
    assert np.abs(x.T @ x - np.eye(k)).max() < 1e-10
    assert np.abs(v @ x - x * [e for e, _ in pairs]).max() < 1e-12 * SPECTRA[name].max()


def check_whitened(found, rows, components):
    """Held against exact sums and numpy's solver."""
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[j] for x in xs) for j in range(d)]
    centred = np.array([[float(x[j] - Fraction(sums[j], n)) for j in range(d)] for x in xs])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    got = defaultdict(dict)
    for r in found:
        got[r["vec_id"]][r["component"]] = r
    assert len(found) == n * k
    for i, (key, _) in enumerate(rows):
        assert sorted(got[key]) == list(range(1, k + 1))
        for c, r in got[key].items():
            assert r["n"] == n and r["deviation"] == sum((n * x - s) ** 2 for x, s in zip(xs[i], sums, strict=True))
            assert abs(r["explained"] - values[c - 1] / values.sum()) < 1e-9
            assert abs(abs(r["whitened"]) - abs(want[i, c - 1])) < 1e-6
            assert r["identity_error"] < 1e-8


def test_whitening(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=12) * np.linspace(3, 0.2, 12)).astype("float32").tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] * 12), (905, [1.0, 2.0]), (906, [3e38] * 12)]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(rows + odd, schema).selectExpr("*", "1 AS id", "2 AS x", "'k' AS component", "3 AS n").repartition(4)
    found = whitening.whiten(df, components=5)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(found.collect(), rows, 5)
    check_whitened(whitening.whiten(df).collect(), rows, 32)


def test_whitening_of_repeats_and_flat_directions(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(3, 7))
    rows = [(i, (r.normal(size=3).round(1) @ (base * 0 + np.eye(3, 7))).tolist()) for i in range(40)]  # four directions never vary
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_whitened(whitening.whiten(df).collect(), rows, 32)
    twice = whitening.whiten(df.unionByName(df).selectExpr("if(vec_id = 3, null, vec_id) AS vec_id", "embedding")).collect()
    assert len(twice) == 80 * 3 and sum(r["vec_id"] is None for r in twice) == 6
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.selectExpr("vec_id", "array(1D, 2D) AS embedding")).collect() == []


def test_deviation_beyond_long_is_null(spark):
    df = spark.createDataFrame([(i, [1e12 * i, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(df).collect()} == {None}


def test_queries_hold_all_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert QUERIES["op12_exact_dedup"](spark, SMALL).count() == docs.count()
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(QUERIES["op13_whitening"](spark, SMALL).collect(), vectors, 32)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_ranked_search"](spark, SMALL).collect()), key=str) == brute_ranking(texts, items, 10)
