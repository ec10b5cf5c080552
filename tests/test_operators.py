import math
import random
import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nassaj.functions import blocks, stats
from nassaj.operators import entities, extract, gazetteer, hooks, metrics, pairing, roc, rouge, sequences, sieve, sizes, spans, split, tfidf
from nassaj.operators.entities import entity_groups
from nassaj.workload import views
from tests.conftest import plan_of

QUICK = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


# --- pairs and splits -----------------------------------------------------------

def test_pair(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id long, label string")
    b = spark.createDataFrame([(2, 5), (1, 4)], "id long, prediction int")
    rows = {r["id"]: (r["truth"], r["prediction"]) for r in pairing.pair(a, b, cast="string").collect()}
    assert rows == {1: ("x", "4"), 2: (None, "5")}


@pytest.mark.parametrize("ids", [[1], [1, 2, 3], [1, 2, 2]])
def test_pair_mismatch_fails(spark, ids):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, label string")
    b = spark.createDataFrame([(i, "x") for i in ids], "id long, prediction string")
    with pytest.raises(Exception, match="do not match at id"):
        pairing.pair(a, b).collect()


def test_label_dictionary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    assert [tuple(r) for r in split.label_dictionary(df).orderBy("label_id").collect()] == [("a", 0), ("b", 1)]


@pytest.mark.parametrize("skew", [[500, 40, 7], [5, 5], [9]])
def test_split_is_exact_and_stable(spark, skew):
    rows = [(i, f"l{k}") for k, n in enumerate(skew) for i in range(k * 1000, k * 1000 + n)]
    df = spark.createDataFrame(rows, "id long, label string")
    flagged = split.validation_flag(df, "id", "label")
    taken = Counter(r["label"] for r in flagged.where("is_validation").collect())
    assert taken == {f"l{k}": math.ceil(n / 5) for k, n in enumerate(skew)}
    again = split.validation_flag(df.repartition(7), "id", "label")
    assert sorted(map(tuple, flagged.collect())) == sorted(map(tuple, again.collect()))
    other = split.validation_flag(df, "id", "label", seed=1)
    assert sorted(map(tuple, flagged.collect())) != sorted(map(tuple, other.collect()))


def test_split_falls_back_without_enough_rows(spark):
    rows = [(i, x) for i, x in enumerate(["a", "a", "b", "b", "c"])]
    flagged = split.validation_flag(spark.createDataFrame(rows, "id long, label string"), "id", "label")
    assert flagged.where("is_validation").count() == 1


def test_folds_cover_every_class(spark):
    rows = [(i, "hot" if i % 10 else "cold") for i in range(90)]
    folds = split.stratified_folds(spark.createDataFrame(rows, "id long, label string"), "id", "label", 3)
    counts = Counter((r["label"], r["fold"]) for r in folds.collect())
    assert counts == {**{("hot", k): 27 for k in range(3)}, **{("cold", k): 3 for k in range(3)}}


def test_split_moves_no_text(spark, tmp_path):
    spark.createDataFrame([(i, "t", "ab"[i % 2]) for i in range(20)], "id long, text string, label string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(split.validation_flag(df, "id", "label"))
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


# --- features -------------------------------------------------------------------

def brute_tfidf(texts, limit):
    docs = []
    for t in texts:
        w = [x for x in "".join(c if c.isalnum() or c == "_" else " " for c in t.lower()).split() if len(x) > 1]
        docs.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    tf, df = Counter(), Counter()
    for d in docs:
        tf.update(d)
        df.update(d.keys())
    vocab = sorted(tf, key=lambda t: (-tf[t], t))[:limit]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for i, d in enumerate(docs):
        w = {t: (1 + math.log(n)) * idf[t] for t, n in d.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()})
    return idf, out


TEXTS = ["the cat sat on the mat", "the dog sat", "", "cat cat cat!", "عقد بيع شقة عقد", "zz"]


@pytest.mark.parametrize("limit", [3, 8, 5000])
def test_tfidf_against_brute_force(spark, limit):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    idf, weights = brute_tfidf(TEXTS, limit)
    model = tfidf.TfidfModel.fit(df, "text", limit)
    assert dict(zip(model.terms, model.idf)) == pytest.approx(idf)
    assert model.terms == sorted(model.terms)
    narrow = {(r["id"], r["term"]): r["weight"] for r in model.weights_long(df, "id", "text").collect()}
    assert narrow == pytest.approx(weights)
    table = tfidf.fit_table(df, "text", limit)
    wide = {(r["id"], r["term"]): r["weight"] for r in tfidf.weights_by_join(df, table, "id", "text").collect()}
    assert wide == pytest.approx(weights)
    vectors = {r["id"]: r["features"] for r in model.features(df, "text").collect()}
    assert len(vectors) == len(TEXTS) and vectors[2].numNonzeros() == 0
    for (i, t), w in weights.items():
        assert vectors[i][model.terms.index(t)] == pytest.approx(w)


def test_terms_do_not_span_marks(one):
    assert one(lambda c: tfidf.document_terms(c, (1, 1)), "هَذَا ab_1 c") == ["ab_1"]


def test_transform_shuffles_nothing(spark, tmp_path):
    spark.createDataFrame([(1, "some text")], "id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    model = tfidf.TfidfModel(["some", "text"], [1.0, 2.0])
    assert "Exchange hashpartitioning" not in plan_of(model.weights_long(df, "id", "text"))


# --- classification metrics -----------------------------------------------------

TRUTH = ["a", "a", "a", "b", "b", "c"]
GUESS = ["a", "a", "b", "b", "d", "a"]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(list(zip(TRUTH, GUESS)), "truth string, prediction string")
    counts = metrics.confusion_counts(df)
    m = metrics.classification_metrics(counts).first()
    # a: 2/3, 2/3, 2/3; b: 1/2, 1/2, 1/2; c and d: 0.
    assert m["accuracy"] == pytest.approx(0.5)
    assert m["f1_macro"] == pytest.approx((2 / 3 + 1 / 2) / 4)
    assert m["f1_weighted"] == pytest.approx((3 * 2 / 3 + 2 / 2) / 6)
    cells = {(r["truth"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(counts).collect()}
    assert len(cells) == 16 and sum(cells.values()) == 6 and cells["c", "a"] == 1
    some = metrics.confusion_matrix(counts, ["b", "a"]).collect()
    assert len(some) == 4 and sum(r["n"] for r in some) == 4
    rows = {r["label"]: r for r in metrics.classification_report(counts).collect()}
    assert set(rows) == {"a", "b", "c", "d", "accuracy", "macro avg", "weighted avg"}
    assert rows["d"]["support"] == 0 and rows["accuracy"]["f1"] == pytest.approx(0.5)
    assert rows["weighted avg"]["support"] == 6
    text = metrics.format_report(list(rows.values()))
    assert text.index("accuracy") < text.index("macro avg") < text.index("weighted avg")


@QUICK
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.2, 0.7, -1.0, 5.0])), min_size=2, max_size=60))
def test_roc_against_pairs(spark, rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    df = spark.createDataFrame([(str(y), s) for y, s in rows], "label string, score double")
    if not pos or not neg:
        with pytest.raises(Exception, match="positive and negative"):
            roc.roc_auc(df).collect()
        return
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert roc.roc_auc(df).first()[0] == pytest.approx(wins / len(pos) / len(neg))
    for r in roc.roc_points(df).collect():
        assert r["tpr"] == pytest.approx(sum(p >= r["threshold"] for p in pos) / len(pos))
        assert r["fpr"] == pytest.approx(sum(n >= r["threshold"] for n in neg) / len(neg))


def test_roc_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(str(int(rng.random() < 0.3)), rng.gauss(0, 1)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "label string, score double")
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    doubled = df.select(F.col("label").cast("double").alias("label"), "score")
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(doubled)
    assert roc.roc_auc(df).first()[0] == pytest.approx(expected)


# --- tags -----------------------------------------------------------------------

def loop_spans(tags):
    """Spans by walking the tags, in the words of the rules."""
    found, begin, prev, prev_kind = [], 0, "O", "_"
    for i, tag in enumerate([*tags, "O"]):
        head, rest = tag[0], tag[1:]
        kind = (rest.split("-", 1)[1] if "-" in rest else rest) or "_"
        ends = prev in "ES" or (prev in "BI" and head in "BSO") or (prev not in "O." and prev_kind != kind)
        starts = head in "BS" or (head in "EI" and prev in "ESO") or (head not in "O." and prev_kind != kind)
        if ends:
            found.append((prev_kind, begin, i - 1))
        if starts:
            begin = i
        prev, prev_kind = head, kind
    return found


@pytest.mark.parametrize("tags, expected", [
    (["B-PER", "I-PER", "O", "B-LOC"], [("PER", 0, 1), ("LOC", 3, 3)]),
    (["I-PER", "I-PER"], [("PER", 0, 1)]),
    (["B-PER", "B-PER"], [("PER", 0, 0), ("PER", 1, 1)]),
    (["B-PER", "I-LOC"], [("PER", 0, 0), ("LOC", 1, 1)]),
    (["O", "PROP", "PROP", "LOC"], [("ROP", 1, 2), ("OC", 3, 3)]),
    (["B-A", "E-A", "S-B"], [("A", 0, 1), ("B", 2, 2)]),
    (["B-DATE-X"], [("DATE-X", 0, 0)]),
    ([], []), (["O", "O"], []),
])
def test_span_rules(one, tags, expected):
    got = [tuple(r) for r in one(spans.entity_spans, tags, "array<string>")]
    assert got == expected == loop_spans(tags)


tag_lists = st.lists(st.sampled_from(["O", "B-A", "I-A", "E-A", "S-A", "B-B", "I-B", "LOC", "X", ".", "I"]), max_size=12)


@QUICK
@given(st.lists(tag_lists, min_size=1, max_size=40))
def test_spans_against_loop(spark, seqs):
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, tags array<string>")
    for r in df.select("id", spans.entity_spans(F.col("tags")).alias("s")).collect():
        assert [tuple(s) for s in r["s"]] == loop_spans(seqs[r["id"]])


def test_ner_scores_by_hand(spark):
    rows = [
        (1, ["B-P", "I-P", "O", "B-L"], ["B-P", "I-P", "O", "B-P"]),
        (2, ["B-L", "O"], ["B-L", "B-L"]),
    ]
    pairs = spark.createDataFrame(rows, "id long, truth array<string>, prediction array<string>")
    assert spans.token_accuracy(pairs).first()[0] == pytest.approx(4 / 6)
    m = spans.ner_metrics(pairs).first()
    assert (m["precision"], m["recall"]) == pytest.approx((2 / 4, 2 / 3))
    report = {r["label"]: r for r in spans.ner_report(pairs).collect()}
    assert report["P"]["precision"] == 0.5 and report["P"]["support"] == 1
    assert report["L"]["recall"] == 0.5 and report["micro avg"]["f1"] == pytest.approx(4 / 7)
    swapped = pairs.select("id", F.col("prediction").alias("truth"), F.col("truth").alias("prediction"))
    s = spans.ner_metrics(swapped).first()
    assert (s["precision"], s["recall"]) == pytest.approx((m["recall"], m["precision"]))


def test_ner_lengths_must_agree(spark):
    pairs = spark.createDataFrame([(1, ["O"], ["O", "O"])], "id long, truth array<string>, prediction array<string>")
    with pytest.raises(Exception, match="different length"):
        spans.token_accuracy(pairs).collect()


def test_sequences_from_rows(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, "c")], "id long, pos int, tag string")
    assert {r["id"]: r["tag"] for r in spans.sequences(df, "id", "pos", "tag").collect()} == {1: ["a", "b"], 2: ["c"]}


def test_align_and_pad(spark):
    df = spark.createDataFrame([([None, 0, 0, 1, 2, None], ["B-A", "O", "new"])], "w array<int>, t array<string>")
    ids = {"B-A": 0, "O": 1}
    for all_tokens, expected in ((True, [-100, 0, 0, 1, -100, -100]), (False, [-100, 0, -100, 1, -100, -100])):
        got = df.select(sequences.align_labels(F.col("w"), F.col("t"), ids, all_tokens)).first()[0]
        assert got == expected
    fit = df.select(sequences.fit_length(F.lit([1, 2, 3]), 2), sequences.fit_length(F.lit([1]), 3, 9)).first()
    assert list(fit) == [[1, 2], [1, 9, 9]]


def test_prepare_pairs(spark):
    df = spark.createDataFrame([([5, 6, 7], [8])], "input_ids array<int>, target_ids array<int>")
    plain = sequences.prepare_summary_pairs(df, max_input_length=4, max_target_length=2).first()
    assert (plain["input_ids"], plain["attention_mask"], plain["labels"]) == ([5, 6, 7, 0], [1, 1, 1, 0], [8, 0])
    masked = sequences.prepare_summary_pairs(df, max_input_length=2, max_target_length=2, mask_pad=True).first()
    assert (masked["input_ids"], masked["attention_mask"], masked["labels"]) == ([5, 6], [1, 1], [8, -100])


def test_guards(spark):
    empty = spark.createDataFrame([], "tokens array<string>, tags array<string>, text string, summary string")
    with pytest.raises(ValueError):
        sequences.check_tagged(empty)
    with pytest.raises(ValueError):
        sequences.check_pairs(empty)
    uneven = spark.createDataFrame([(["a"], ["O", "O"])], "tokens array<string>, tags array<string>")
    with pytest.raises(Exception, match="differ in number"):
        sequences.check_tagged(uneven).collect()
    one_sided = spark.createDataFrame([("a", None)], "text string, summary string")
    with pytest.raises(Exception, match="no summary"):
        sequences.check_pairs(one_sided).collect()


PIECES = [
    ("B-PER", 0.8, "Ah", 0, 2, False), ("O", 0.5, "##med", 2, 5, True), ("I-PER", 0.6, "Ali", 6, 9, False),
    ("O", 0.9, "in", 10, 12, False), ("LOC", 0.7, "Riyadh", 13, 19, False), ("B-PER", 0.4, "X", 20, 21, False),
]


@pytest.mark.parametrize("strategy, expected", [
    ("none", [("B-PER", 0.8, "Ah", 0, 2), ("I-PER", 0.6, "Ali", 6, 9), ("LOC", 0.7, "Riyadh", 13, 19), ("B-PER", 0.4, "X", 20, 21)]),
    ("simple", [("PER", 0.8, "Ah", 0, 2), ("PER", 0.6, "Ali", 6, 9), ("LOC", 0.7, "Riyadh", 13, 19), ("PER", 0.4, "X", 20, 21)]),
    ("first", [("PER", 0.7, "Ahmed Ali", 0, 9), ("LOC", 0.7, "Riyadh", 13, 19), ("PER", 0.4, "X", 20, 21)]),
])
def test_entity_groups(spark, strategy, expected):
    df = spark.createDataFrame([(PIECES,), ([],)], f"p {entities.PREDICTIONS}")
    got, none = [r[0] for r in df.select(entity_groups(F.col("p"), strategy)).collect()]
    assert none == []
    assert [(e["entity_group"], pytest.approx(e["score"]), e["word"], e["start"], e["end"]) for e in got] == expected


def loop_groups(pieces, whole_words):
    def cut(items, opens):
        runs = []
        for i, x in enumerate(items):
            if i == 0 or opens(x, items[i - 1]):
                runs.append([])
            runs[-1].append(x)
        return runs

    def joined(run):
        return " ".join(p[2] for p in run if p[2] is not None).replace(" ##", "")

    def kind(tag):
        return None if tag is None else re.sub("^[BI]-", "", tag)

    def opens(cur, prev):
        a, b = kind(cur[0]), kind(prev[0])
        return a is not None and (cur[0].startswith("B-") or (b is not None and a != b))

    if pieces is None:
        return None
    pieces = [p or (None,) * 6 for p in pieces]
    if whole_words:
        words = cut(pieces, lambda cur, prev: cur[5] is False)
        pieces = [(w[0][0], w[0][1], joined(w), w[0][3], w[-1][4], False) for w in words]
    out = []
    for run in cut(pieces, opens):
        total = 0.0
        for p in run:
            total = None if total is None or p[1] is None else total + p[1]
        if kind(run[0][0]) not in (None, "O"):
            out.append((kind(run[0][0]), None if total is None else total / len(run), joined(run), run[0][3], run[-1][4]))
    return out


def odd_pieces(seed, texts):
    r = random.Random(seed)
    tags = ["O", "O", "B-A", "I-A", "A", "B-B", "I-B", "B-B-A", "B-", "", "B-O", "b-A", None]

    def maybe(v):
        return None if r.random() < 0.1 else v

    def piece():
        values = (r.choice(tags), maybe(r.random()), r.choice(["x", "##y", "##", "a ##b", "é##", "", " ", None]),
                  maybe(r.randint(-9, 9)), maybe(r.randint(0, 2**31 - 1)), maybe(r.random() < 0.5))
        return maybe(values) if r.random() < 0.3 else values

    return [(i, maybe([piece() for _ in range(r.choice([0, 1, 2, 5, 9, 40]))])) for i in range(texts)]


@pytest.mark.parametrize("strategy", ["simple", "first"])
def test_entity_groups_against_loop(spark, strategy):
    rows = odd_pieces(7, 300) + [(300, [("A", 1e16, "x", 0, 1, False)] + [("A", 1.0, "y", 0, 1, False)] * 50)]
    df = spark.createDataFrame(rows, f"id long, p {entities.PREDICTIONS}")
    got = {r["id"]: r["e"] for r in df.select("id", entity_groups(F.col("p"), strategy).alias("e")).collect()}
    assert len(got) == len(rows)
    for i, pieces in rows:
        want = loop_groups(pieces, strategy == "first")
        assert (got[i] if got[i] is None else [tuple(e) for e in got[i]]) == want, pieces


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_blocks_of_rows(most):
    r = random.Random(most)
    lists = pa.array([None, [], *[[0] * r.randint(0, 9) for _ in range(60)]], pa.list_(pa.int8()))
    cut = list(blocks.blocks(lists, most))
    assert [first for first, _ in cut] == [0, *np.cumsum([n for _, n in cut])[:-1]] and sum(n for _, n in cut) == len(lists)
    assert all(n == 1 or blocks.list_lengths(lists.slice(first, n)).sum() <= most for first, n in cut)
    assert list(blocks.blocks(lists.slice(0, 0))) == [(0, 0)]


@pytest.mark.parametrize("size", [1, 300])
def test_pieces_of_texts(spark, tmp_path, size):
    r = random.Random(size)
    letters = ["a", "B", "é", "9", "日", "😀", "#", " ", "  ", "\n", " 12 ", "ABCDE"]
    texts = [(i, None if r.random() < 0.05 else "".join(r.choice(letters) for _ in range(r.randint(0, 60))), "x") for i in range(size)]
    texts += [(None, "Ab c", "x"), (1, "", "x"), (1, "é" * 1001 + " 7", "x")]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    tags = {(r["id"], " ".join(r["tokens"] or [])): r["truth"] for r in views.tagged(spark, str(tmp_path)).collect()}
    want = []
    for i, text, _ in texts:
        pieces = None if text is None else []
        for k, token in enumerate([] if text is None else text.split(" ")):
            for j in range(max(len(token) - 1, 0) // 5 + 1):
                part, tag, start = token[5 * j : 5 * j + 5], tags[i, text][k], k * 1000 + 5 * j
                pieces.append(("O" if j % 2 else tag, 1.0 / (len(token) + j + 1), "##" * (j > 0) + part, start, start + len(part), j > 0))
        want.append((i, pieces))
    found = views.piece_predictions(spark, str(tmp_path))
    assert "MapInArrow" in plan_of(found)
    got = [(r["id"], r["pieces"] if r["pieces"] is None else [tuple(p) for p in r["pieces"]]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entity_strategy_is_checked():
    with pytest.raises(ValueError, match="max"):
        entity_groups(None, "max")


def brute_gazetteer(text, phrases):
    words, best = text.split(), {}
    for phrase, kind in phrases:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                for j in range(i, i + len(p)):
                    key = (len(p), -i, kind)
                    if j not in best or key > best[j]:
                        best[j] = key
    return {(j, words[j], ("B-" if j == -first else "I-") + kind) for j, (_, first, kind) in best.items()}


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_gazetteer(spark, bits, monkeypatch):
    monkeypatch.setattr(gazetteer, "marked", partial(sieve.marked, bits=bits))
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 25))) for _ in range(20)]
    phrases = [("a", "ONE"), ("a b", "TWO"), ("b c a", "THREE"), ("a b c a b", "FIVE"), ("c c", "CC"), (" ", "NONE")]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    known = spark.createDataFrame(phrases, "phrase string, entity_type string")
    got = defaultdict(set)
    for r in gazetteer.gazetteer_tags(docs, known).collect():
        got[r["id"]].add((r["pos"], r["token"], r["tag"]))
    kept = [p for p in phrases if p[0].strip()]
    assert {i: got[i] for i in range(20)} == {i: brute_gazetteer(t, kept) for i, t in enumerate(texts)}
    assert gazetteer.gazetteer_tags(docs, known.limit(0)).columns == ["id", "pos", "token", "tag"]
    assert gazetteer.gazetteer_tags(docs, known.limit(0)).collect() == []


def test_sieve_lets_all_keys_through(spark):
    keys = spark.range(0, 5000, 7).selectExpr("xxhash64(id) AS h")
    rows = spark.range(5000).selectExpr("id", "xxhash64(id) AS h", "'x' AS word", "1 AS marks", "2 AS _word", "3 AS _marks")
    for bits in (64, 1 << 10, 1 << 24):
        told = sieve.marked(rows, "h", keys, bits)
        assert told.columns == [*rows.columns, "open"] and told.count() == 5000
        assert told.where("open AND id % 7 = 0").count() == 715
        assert bits < 1 << 24 or told.where("open").count() == 715
    assert sieve.marked(rows, "h", keys.limit(0)).where("open").count() == 0


def test_pairing_stops_at_ids_on_many_rows(spark):
    truth = spark.range(1_000_000).selectExpr("cast(null AS bigint) AS id", "'a' AS label")
    with pytest.raises(Exception, match="row of the truth has no id"):
        pairing.pair(truth, spark.range(3).selectExpr("id", "'a' AS prediction")).collect()
    truth = spark.range(1_000_000).selectExpr("7 AS id", "'a' AS label")
    pairs = pairing.pair(truth, spark.range(3).selectExpr("id", "'a' AS prediction"))
    with pytest.raises(Exception, match="truth and predictions do not match at id"):
        pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # counted in the tasks, then shuffled


def test_merged_summaries(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), " ".join(f"w{rng.randint(0, 40_000)}" for _ in range(60)), d) for d in range(4) for _ in range(400)]
    df = spark.createDataFrame([*rows, ("z", None, 1), (None, "one two", 2)], "lang string, text string, day int")
    parts = [stats.partial_summary(df.where(f"day = {d}"), "text", "lang") for d in range(4)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2].unionByName(parts[3]))
    want = {r["lang"]: r for r in stats.corpus_summary(df, "text", "lang").collect()}
    found = stats.merged_summary(merged, "lang").collect()
    assert len(found) == len(want) == 4
    for r in found:
        w = want[r["lang"]]
        assert [r[c] for c in ("documents", "words", "chars", "avg_word_length")] == [w[c] for c in ("documents", "words", "chars", "avg_word_length")]
        assert abs(r["unique_words"] - w["unique_words"]) <= 0.02 * w["unique_words"]
        assert abs(r["lexical_diversity"] - w["lexical_diversity"]) <= 0.02


# --- summaries ------------------------------------------------------------------

def brute_rouge(ref, hyp, n):
    def grams(t):
        w = t.lower().split()
        return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))

    r, h = grams(ref), grams(hyp)
    o = sum((r & h).values())
    p, q = o / max(sum(h.values()), 1), o / max(sum(r.values()), 1)
    return p, q, 2 * p * q / (p + q) if o else 0.0


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


sentence = st.lists(st.sampled_from(["aa", "bb", "cc", "شقة"]), max_size=9).map(" ".join)


@QUICK
@given(st.lists(st.tuples(sentence, sentence), min_size=1, max_size=30))
def test_rouge_against_brute_force(spark, pairs):
    df = spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(pairs)], "id long, truth string, prediction string")
    for row in rouge.rouge_scores(df).collect():
        ref, hyp = pairs[row["id"]]
        for n in (1, 2):
            got = [row[f"rouge{n}_{m}"] for m in rouge.MEASURES]
            assert got == pytest.approx(brute_rouge(ref, hyp, n))
        n = brute_lcs(ref.split(), hyp.split())
        assert row["rougeL_precision"] == pytest.approx(n / max(len(hyp.split()), 1))
        assert row["rougeL_recall"] == pytest.approx(n / max(len(ref.split()), 1))
        if ref and ref == hyp:
            assert row["rougeL_fmeasure"] == pytest.approx(1.0) == row["rouge1_fmeasure"]


def test_rouge_tokenizers_and_summary(spark):
    df = spark.createDataFrame([(1, "شقة جميلة", "شقة"), (2, "a b", "a b")], "id long, truth string, prediction string")
    ascii_only = {r["id"]: r for r in rouge.rouge_scores(df, tokenizer="ascii").collect()}
    assert ascii_only[1]["rouge1_fmeasure"] == 0.0 and ascii_only[2]["rouge1_fmeasure"] == 1.0
    summary = rouge.rouge_summary(rouge.rouge_scores(df)).first()
    assert summary["num_samples"] == 2 and summary["rouge1_recall"] == 0.75 and summary["rouge1_recall_std"] == 0.25
    stemmed = rouge.rouge_scores(df, stemmer=lambda t: F.transform(t, lambda w: F.substring(w, 1, 1)))
    assert stemmed.count() == 2
    with pytest.raises(ValueError):
        rouge.rouge_scores(df, tokenizer="latin")
    with pytest.raises(ValueError):
        rouge.rouge_scores(df, measures=("rouge9",))


def test_extractive_summary(spark):
    docs = [(1, "Common words here. Rare zebra quagga! Common words here again.\nOkapi"), (2, ""), (3, "one. two")]
    df = spark.createDataFrame(docs, "id long, text string")
    model = tfidf.TfidfModel.fit(df, "text")
    out = {r["id"]: r["summary"] for r in extract.extractive_summary(df, model, max_sentences=2).collect()}
    idf, _ = brute_tfidf([t for _, t in docs], 5000)

    def score(text):
        w = text.lower().split()
        n = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
        return sum((1 + math.log(k)) * idf[t] for t, k in n.items()) / len(n)

    parts = ["Common words here", "Rare zebra quagga", "Common words here again", "Okapi"]
    best = sorted(sorted(range(4), key=lambda i: (-round(score(parts[i]), 9), i))[:2])
    assert out == {1: " ".join(parts[i] for i in best), 3: "one two"}
    short = extract.extractive_summary(df, model, max_sentences=2, max_words=2).where("id = 1").first()
    assert short["summary"] == " ".join(out[1].split()[:2])
    assert "WindowGroupLimit" in plan_of(extract.extractive_summary(df, model))


# --- hooks ----------------------------------------------------------------------

def test_hook_results_ignore_batching(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("t"))
    expected = sorted(f"{i}!" for i in range(50))
    for size, parts in ((1, 1), (7, 3), (64, 5)):
        run = hooks.batch_model(lambda: lambda ts: [t + "!" for t in ts], "string", size)
        assert sorted(r[0] for r in df.repartition(parts).select(run(F.col("t"))).collect()) == expected
    with pytest.raises(ValueError):
        hooks.batch_model(lambda: None, "string", 0)


def test_hook_sends_results_after_every_call(spark):
    run = hooks.batch_model(lambda: lambda ts: [t + "!" for t in ts], "string", 3)
    sent = [list(s) for s in run.func(iter([pd.Series(list("abcdefg")), pd.Series(["h"])]))]
    assert sent == [["a!", "b!", "c!"], ["d!", "e!", "f!"], ["g!"], ["h!"]]


def test_hook_checks_result_count(spark):
    run = hooks.summarizer(lambda: lambda ts: [])
    with pytest.raises(Exception, match="0 results for 1 texts"):
        spark.createDataFrame([("a",)], "t string").select(run(F.col("t"))).collect()


# --- ROC ------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_roc_of_any_scores(spark, seed):
    import random

    r = random.Random(seed)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.7e308, -1.7e308, float("inf"), float("-inf"), float("nan"), 1.0, 2.0, 0.5, -1.0, -2.0]
    scores = odd + [r.choice(odd) for _ in range(20)] + [r.gauss(0, 1) for _ in range(60)] + [0.75 + r.random() * 1e-9 for _ in range(60)]
    rows = [(r.randint(0, 1), s) for s in scores]
    df = spark.createDataFrame(rows, "label int, score double")
    got = sorted(((r["fpr"], r["tpr"]) for r in roc.roc_points(df).collect()))
    key = lambda s: (s != s, 0.0 if s != s else s)
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    want = sorted({
        (sum(1 - y for y, s in rows if key(s) >= key(cut)) / neg, sum(y for y, s in rows if key(s) >= key(cut)) / pos) for cut in scores
    })
    assert [(round(a, 12), round(b, 12)) for a, b in dict.fromkeys(got)] == [(round(a, 12), round(b, 12)) for a, b in want]
    with pytest.raises(Exception, match="no label or no score"):
        roc.roc_auc(df.unionByName(spark.createDataFrame([(None, 1.0)], "label int, score double"))).collect()


# --- sizes ----------------------------------------------------------------------

def test_kept_tables_go_at_the_end(spark, tmp_path):
    df = spark.range(5)
    with sizes.kept(df, str(tmp_path)) as written:
        assert written.count() == 5 and len(list(tmp_path.iterdir())) == 1
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("named", [False, True])
def test_kept_tables_follow_the_session(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(sizes, "named_folder", lambda session: str(tmp_path) if named else None)
    df = spark.range(5)
    with sizes.kept(df) as held:
        assert held.count() == 5 and held.storageLevel.useMemory != named
        assert bool(list(tmp_path.iterdir())) == named
    assert not df.storageLevel.useMemory and not list(tmp_path.iterdir())


def test_collect_is_bounded(spark):
    assert len(sizes.collect_bounded(spark.range(5), "rows", 5)) == 5
    with pytest.raises(ValueError, match="more than 4 rows"):
        sizes.collect_bounded(spark.range(5), "rows", 4)


def test_spread(spark):
    assert sizes.spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(10, numPartitions=9)
    assert sizes.spread(many) is many
