"""No row is lost, paired wrongly or checked in vain."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from nassaj.operators import metrics, pairing, roc, sequences, spans, split
from nassaj.operators.stoplists import remove_listed_tokens
from nassaj.operators.tfidf import TfidfModel
from nassaj.plans import evaluate, jobs
from nassaj.plans.classify import Classifier, train_text_classification
from nassaj.sources import readers
from tests.conftest import plan_of

WORDS = {"sport": "team goal match player win", "food": "bread soup salt fresh cook"}


@pytest.mark.parametrize("rows", [[("1", 0.5), ("0", None), ("0", 0.1)], [("1", 0.5), (None, 0.2)]])
def test_roc_refuses_missing_values(spark, rows):
    df = spark.createDataFrame(rows, "label string, score double")
    for run in (roc.roc_points, roc.roc_auc):
        with pytest.raises(Exception, match="ROC: a row has no label or no score"):
            run(df).collect()


def test_roc_ends_at_one_over_many_parts(spark):
    df = spark.range(200).selectExpr("cast(id % 3 = 0 AS int) AS label", "(id * 37) % 101 / 7.0D AS score")
    points = roc.roc_points(df).orderBy("threshold").collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (1.0, 1.0)
    assert [p["tpr"] for p in points] == sorted((p["tpr"] for p in points), reverse=True)
    score = {r["score"]: r for r in df.groupBy("score").agg(F.sum("label").alias("p")).collect()}
    total = sum(r["p"] for r in score.values())
    for p in points:
        assert abs(p["tpr"] - sum(r["p"] for s, r in score.items() if s >= p["threshold"]) / total) < 1e-12


def test_null_labels_are_not_lost(spark):
    pairs = spark.createDataFrame([(1, "a", "a"), (2, "b", None), (3, "a", "b")], "id long, truth string, prediction string")
    with pytest.raises(Exception, match="a row has no prediction"):
        metrics.confusion_matrix(metrics.confusion_counts(pairs)).collect()
    with pytest.raises(Exception, match="a row has no prediction"):
        evaluate.evaluate_classification(pairs)


def test_null_labels_are_split_too(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 50 THEN null WHEN id < 75 THEN 'a' ELSE 'b' END AS label")
    found = split.validation_flag(df, "id", "label", 0.2)
    assert {(r[0], r[1]) for r in found.where("is_validation").groupBy("label").count().collect()} == {(None, 10), ("a", 5), ("b", 5)}
    folds = split.stratified_folds(df, "id", "label", 5).groupBy("label", "fold").count().collect()
    assert sorted(r["count"] for r in folds) == [5] * 10 + [10] * 5


def test_rows_are_numbered_by_file_name(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part-0").write_text("\n".join(f"a{i}" for i in range(3)))
    (tmp_path / "d" / "part-1").write_text("\n".join(f"b{i}" for i in range(50)))
    want = [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(50)]
    for size in ("40b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = readers.read_text(spark, str(tmp_path / "d"), row_ids=True).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r["text"] for r in sorted(rows)] == want and sorted(r["row_id"] for r in rows) == list(range(53))


def test_listed_tokens_leave_rows_one_to_one(spark):
    rows = [(1, "x", ["aa", "bb"]), (1, "y", ["aa"]), (1, "x", ["aa", "bb"]), (2, "z", None), (None, "n", ["c", "cc"])]
    df = spark.createDataFrame(rows, "id long, other string, tokens array<string>")
    out = remove_listed_tokens(df, spark.createDataFrame([("aa",)], "word string"))
    assert out.columns == df.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        (1, "x", ["bb"]), (1, "y", []), (1, "x", ["bb"]), (2, "z", None), (None, "n", ["cc"]),
    ]))


def test_preprocess_with_a_stopword_file(spark, tmp_path):
    (tmp_path / "in.txt").write_text("كتاب جميل جدا\nكتاب\nكتاب\n")
    (tmp_path / "stop.txt").write_text("كتاب\n")
    jobs.preprocess(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), apply_stemming=True, stopwords_path=str(tmp_path / "stop.txt"))
    rows = [r["tokens"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(rows) == [[], [], ["جميل", "جدا"]]


def test_checks_cannot_be_pruned(spark):
    truth = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, label string")
    guess = spark.createDataFrame([(1, "a")], "id long, prediction string")
    paired = pairing.pair(truth, guess)
    for use in (lambda: paired.count(), lambda: paired.select("id").collect()):
        with pytest.raises(Exception, match="do not match at id"):
            use()
    tagged = spark.createDataFrame([(1, ["a"], ["O", "O"])], "id long, tokens array<string>, tags array<string>")
    with pytest.raises(Exception, match="differ in number"):
        sequences.check_tagged(tagged).select("id").collect()
    texts = spark.createDataFrame([(1, "a", None)], "id long, text string, summary string")
    with pytest.raises(Exception, match="no text or no summary"):
        sequences.check_pairs(texts).count()
    tags = spark.createDataFrame([(1, ["O"], ["O", "O"])], "id long, truth array<string>, prediction array<string>")
    for scores in (spans.token_accuracy, spans.ner_metrics, spans.ner_report, spans.ner_tally):
        with pytest.raises(Exception, match="different length"):
            scores(tags).collect()


def test_csv_is_read_in_parallel(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("text,label\n" + "".join(f"word number {i} of many,l{i % 2}\n" for i in range(40_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = readers.read_any(spark, str(path))
        assert df.rdd.getNumPartitions() > 1 and df.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def training_file(tmp_path):
    path = tmp_path / "train.csv"
    lines = [f"{i},{' '.join(w.split()[(i + k) % 5] for k in range(4))},{name}" for i in range(30) for name, w in [list(WORDS.items())[i % 2]]]
    path.write_text("id,text,label\n" + "\n".join(lines) + "\n")
    return str(path)


def test_two_models_in_one_folder(spark, tmp_path):
    data, models = training_file(tmp_path), str(tmp_path / "models")
    for kind in ("logistic_regression", "linear_svc"):
        jobs.train_classifier(spark, data, models, kind, max_iter=20, staging=str(tmp_path))
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("kept-")]
    for kind in ("logistic_regression", "linear_svc"):
        out = str(tmp_path / f"guess_{kind}.csv")
        jobs.infer(spark, "classification", data, out, models, model_type=kind)
        by_id = jobs.evaluate(spark, "classification", data, out)
        assert by_id == jobs.evaluate(spark, "classification", data, out, by_position=True)
        direct = jobs.evaluate(spark, "classification", data, model_path=models, model_type=kind, label_names=["sport", "food"])
        assert direct["accuracy"] == by_id["accuracy"] == 1.0 and direct["confusion_matrix"] == [[15, 0], [0, 15]]
    with pytest.raises(ValueError, match="pass model_type"):
        jobs.infer(spark, "classification", data, str(tmp_path / "x"), models)
    model = Classifier.load(spark, models, "logistic_regression")
    assert "Python" not in plan_of(model.predict(spark.createDataFrame([("team goal",)], "text string")))


def test_training_reads_the_texts_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = [(i, " ".join(list(WORDS.values())[i % 2].split()[: 2 + i % 3]), list(WORDS)[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string, label string").select("id", seen("text").alias("text"), "label")
    model, _ = train_text_classification(df, "logistic_regression", staging=str(tmp_path), max_iter=20)
    assert model.accuracy == 1.0 and read.value == len(rows)


def test_vectors_are_those_of_the_weights(spark):
    df = spark.createDataFrame([(1, "aa bb aa cc"), (2, "bb"), (3, None), (4, "")], "id long, text string")
    model = TfidfModel.fit(df, "text")
    rows = model.weights(model.features(df, "text"), "text").collect()
    for r in rows:
        assert r["features"].size == model.size
        assert list(r["features"].indices) == r["indices"]
        assert r["features"].values.tolist() == pytest.approx(r["weights"])


def test_ner_job_with_a_gazetteer(spark, tmp_path):
    (tmp_path / "in.txt").write_text("we saw New York today\nnothing here\n")
    (tmp_path / "places.csv").write_text("phrase,entity_type\nNew York,LOC\n")
    out = jobs.infer(spark, "ner", str(tmp_path / "in.txt"), str(tmp_path / "out.json"), gazetteer_path=str(tmp_path / "places.csv"))
    found = {r["text"]: [(e["entity_group"], e["word"], e["start"], e["end"]) for e in r["entities"]] for r in out.collect()}
    assert found == {"we saw New York today": [("LOC", "New York", 2, 4)], "nothing here": []}
    with pytest.raises(RuntimeError, match="gazetteer"):
        jobs.infer(spark, "ner", str(tmp_path / "in.txt"), str(tmp_path / "out2.json"))


def test_ner_scores_come_from_one_tally(spark):
    rows = [(1, ["B-A", "I-A", "O"], ["B-A", "I-A", "B-B"]), (2, ["B-B"], ["O"]), (3, [], [])]
    pairs = spark.createDataFrame(rows, "id long, truth array<string>, prediction array<string>")
    got = evaluate.evaluate_ner(pairs)
    assert got["accuracy"] == spans.token_accuracy(pairs).first()["accuracy"]
    assert {k: got[k] for k in ("precision", "recall", "f1")} == spans.ner_metrics(pairs).first().asDict()
    assert {k: v["support"] for k, v in got["per_entity"].items() if k in "AB"} == {"A": 1, "B": 1}
    assert json.dumps(got)


def test_a_short_stopword_list_is_looked_up_in_place_and_a_long_one_joined(spark):
    rows = [(1, ["aa", "bb", "c", "aa"]), (2, ["bb", None]), (3, None), (4, []), (4, ["cc", "dd"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    words = spark.createDataFrame([("aa",), ("dd",), ("aa",), (None,)], "word string")
    short, long = remove_listed_tokens(df, words), remove_listed_tokens(df, words, max_inline=1)
    assert "Exchange" not in plan_of(short) and "Join" in plan_of(long)
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect())) == sorted(map(str, [
        Row(id=1, tokens=["bb"]), Row(id=2, tokens=["bb"]), Row(id=3, tokens=None), Row(id=4, tokens=[]), Row(id=4, tokens=["cc"]),
    ]))
    none = remove_listed_tokens(df, words.limit(0))
    assert none.where("id = 1").first()["tokens"] == ["aa", "bb", "aa"]
