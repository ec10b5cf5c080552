import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from nassaj.llm import bpe, packing

DOCS = "doc_id long, source string, text string, ids string, n long"


@pytest.fixture(scope="module")
def path():
    return bpe.vocabulary_file()


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def odd_texts(rng: random.Random, count: int):
    alphabets = [
        list("ab'sre tTlvd <|>\n\t 12!?é漢\x1c"), list("thereinga"), [" ", "x"], list("漢字かなカナ語文"),
        ["<|endoftext|>", "<|endo", "'re", "foo", " ", "  ", "\n", "9", "ß", "🎉", "👩‍👩‍👧"],
    ]
    for _ in range(count):
        yield "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 40)))
        yield "".join(rng.choices(rng.choice(alphabets), k=rng.randint(0, 500)))


def test_every_token_makes_ranks_and_merges_agree(path):
    assert bpe.encoder(path).by_rank is not None


def test_whole_and_tree_agree_with_the_library(path, library):
    enc, rng = bpe.encoder(path), random.Random(5)
    for text in odd_texts(rng, 150):
        want = library(text)
        assert enc.whole(text).tolist() == want
        for piece in (rng.randint(1, 9), rng.randint(20, 150)):
            assert enc.long(text, piece).tolist() == want
        assert enc.decode(np.array(want, np.int32)) == text


def test_rows_come_back_as_they_were(spark, path, library):
    far = 2**62 + 1
    rows = [(1, "a b c " * 50), (1, "a b c " * 50), (1, "other"), (2, None), (None, "x" * 300), (far, "y" * 99), (3, ""), (4, "über\n\n<|endoftext|> 's" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS ids", "'k' AS key", "1 AS no", "2 AS piece")
    out = bpe.encode(df, "doc_id", "text", path, piece_chars=64)
    assert out.columns == ["doc_id", "ids"]
    found = sorted((str(r["doc_id"]), list(r["ids"])) for r in out.collect())
    assert found == sorted((str(k), library(t or "")) for k, t in rows)
    decoded = {r["t"] for r in out.select(bpe.decode_column("ids", path).alias("t")).collect()}
    assert decoded == {t or "" for _, t in rows}
    assert bpe.encode(df.limit(0), "doc_id", "text", path).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_mixture_places_every_token_once(seed):
    r = random.Random(seed)
    totals = {f"s{i}": r.randint(1, 400) for i in range(r.randint(1, 6))} | ({None: r.randint(1, 50)} if seed % 2 else {})
    weights = None if seed % 3 else {s: r.choice([0.1, 0.5, 1, 7]) for s in totals}
    m, window = packing.Mixture(totals, weights, 50), 50
    out = [None] * sum(totals.values())
    for source, n in totals.items():
        at = 0
        while at < n:
            count = min(n - at, r.randint(1, 60))
            for place, size in m.runs(source, at, count):
                for k in range(size):
                    assert out[place + k] is None
                    out[place + k] = (source, at)
                at += size
    assert None not in out
    if not weights:  # every window is within a token of its share
        for w in range(len(out) // window):
            for s, n in totals.items():
                spent = m.spent(w + 1)[m.index[s]] - m.spent(w)[m.index[s]]
                assert abs(spent - window * n / len(out)) <= 1


@pytest.mark.parametrize("seed", range(6))
def test_mixture_by_deficits_kept_step_by_step(seed):
    import random
    from fractions import Fraction

    r = random.Random(seed)
    totals = {f"s{k}": r.randrange(1, 900) for k in range(r.randrange(1, 7))}
    weights = {s: r.randrange(1, 20) for s in totals} if seed % 2 else None
    m, share = packing.Mixture(totals, weights, 64), {s: Fraction((weights or totals)[s]) for s in totals}
    left, deficit, spent = {s: Fraction(n) for s, n in totals.items()}, dict.fromkeys(totals, Fraction(0)), dict.fromkeys(totals, 0)
    for w in range(1, sum(totals.values()) // 64 + 3):
        room = Fraction(64)
        while room and any(left.values()):
            active = [s for s in totals if left[s]]
            whole = sum(share[s] for s in active)
            step = min(room, *(left[s] * whole / share[s] for s in active))
            for s in active:
                left[s] -= step * share[s] / whole
                deficit[s] += step * share[s] / whole
            room -= step
        for s in totals:
            spent[s] += int(deficit[s])
            deficit[s] -= int(deficit[s])
        assert m.spent(w) == [spent[s] for s in m.names]
    assert spent == totals


def test_weights_steer_the_mixture():
    m = packing.Mixture({"a": 1000, "b": 1000}, {"a": 3, "b": 1}, 100)
    assert m.spent(4) == [300, 100] and m.spent(13) == [975, 325] and m.spent(20) == [1000, 1000]


def test_packing_is_gapless_and_true(spark, path, library):
    rows = [(k, f"s{k % 3}" if k % 7 else None, "" if k == 5 else None if k == 6 else f"word {k} " * (k % 40)) for k in range(120)]
    rows += [(9, "s0", "again"), (9, "s0", "again"), (200, "s1", "long " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS ids", "2 AS n", "3 AS offset")
    out = packing.pack(df.repartition(3), path, length=256, window_tokens=1024).collect()
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, parts in sequences.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 256 or k == max(sequences)
    want, got = defaultdict(int), defaultdict(int)
    pieces = defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        got[r["doc_id"]] += r["length"]
    texts = {k: t or "" for k, _, t in rows}
    for k, _, t in rows:
        want[k] += len(library(t or "")) + 1
    assert got == want
    for k, own in pieces.items():
        if k == 9:
            continue
        ids = np.array([*library(texts[k]), 1], "<u4")
        assert sorted(r["start"] for r in own) == [sum(x["length"] for x in own if x["start"] < r["start"]) for r in sorted(own, key=lambda r: r["start"])]
        for r in own:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert packing.pack(df.limit(0), path).count() == 0
    odd = spark.createDataFrame([(None, "s", "a"), (2**62 + 1, None, "b")], "doc_id long, source string, text string")
    assert {r["doc_id"] for r in packing.pack(odd.coalesce(1), path).collect()} == {None, 2**62 + 1}
