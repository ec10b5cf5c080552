import json
import random

import pytest
from pyspark.sql import functions as F

from nassaj.operators import hooks, svc
from nassaj.plans import classify, jobs
from nassaj.plans.evaluate import evaluate_classification, evaluate_ner, evaluate_summarization, print_classification
from nassaj.sources import quoted as quoted_records
from nassaj.sources import readers, writers
from nassaj.streaming.preprocess import preprocess_stream, read_text_stream

CONTRACTS = {
    "بيع": ["عقد بيع شقة في الرياض", "عقد بيع فيلا في جدة"],
    "إيجار": ["اتفاقية إيجار منزل في جدة", "عقد إيجار مكتب في الدمام"],
    "رهن": ["وثيقة رهن عقار سكني", "عقد رهن أرض تجارية"],
}


@pytest.fixture
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for label, texts in CONTRACTS.items():
        for k in range(12):
            rows.append((len(rows), f"{rng.choice(texts)} رقم {k}", label))
    return spark.createDataFrame(rows, "id long, text string, label string")


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


# --- readers and writers --------------------------------------------------------

def test_read_text(spark, tmp_path):
    path = write(tmp_path / "a.txt", "  نص أول \n\n \nsecond line\r\nthird")
    assert [r[0] for r in readers.read_text(spark, path).collect()] == ["نص أول", "second line", "third"]
    numbered = readers.read_text(spark, path, row_ids=True)
    assert [tuple(r) for r in numbered.orderBy("row_id").collect()] == [(0, "نص أول"), (1, "second line"), (2, "third")]
    latin = write(tmp_path / "b.txt", "é\n", "latin-1")
    assert readers.load_text_data(spark, latin, encoding="iso-8859-1").first()[0] == "é"


def test_row_ids_over_many_partitions(spark, tmp_path):
    df = spark.range(1000, numPartitions=7)
    ids = readers.with_row_id(df, "row_id").orderBy("row_id").collect()
    assert [tuple(r) for r in ids] == [(i, i) for i in range(1000)]


def test_read_csv(spark, tmp_path):
    path = write(tmp_path / "a.csv", '﻿text,label\n"a ""q""\nb",01\nc,\n')
    assert [tuple(r) for r in readers.read_any(spark, path).collect()] == [('a "q"\nb', "01"), ("c", None)]
    odd = write(tmp_path / "odd.csv", 'n;t\r\n\r\n1;a 5" screen\r\n2;"x\r\n;y"\r\n3;"""q"" z"\r\n4;""\r\n5;"k"l"m;n\r\n')
    rows = readers.read_csv(spark, odd, "n int, t string", row_id="at", sep=";").collect()
    assert sorted(map(tuple, rows)) == [
        (0, 1, 'a 5" screen'), (1, 2, "x\r\n;y"), (2, 3, '"q" z'), (3, 4, ""), (4, 5, '"k"l"m'),
    ]
    (tmp_path / "latin.csv").write_bytes("t\né\n".encode("latin-1"))
    assert [r[0] for r in readers.read_csv(spark, str(tmp_path / "latin.csv"), encoding="ISO-8859-1").collect()] == ["é"]
    assert readers.read_csv(spark, write(tmp_path / "none.csv", "a,b\n")).collect() == []


def test_state_of_quotes():
    lines = ["", "a,b", '"a', 'a"', '"a"', '"a""', '"a"",', 'a,"b', 'x"y,"z', '"",""', '"""', '""",', ',"', '"a"b"c', '"a"b,"c']
    for line in lines:
        quoted, value = False, ""  # character by character
        for start in (False, True):
            quoted, fresh, i = start, not start, 0
            while i < len(line):
                if quoted:
                    if line[i : i + 2] == '""':
                        i += 1
                    elif line[i] == '"':
                        quoted = False
                elif line[i] == '"' and fresh:
                    quoted = True
                fresh, i = not quoted and line[i] == ",", i + 1
            assert quoted_records.ends_inside(line, start, ",") == quoted, (line, start)
        assert value == ""


@pytest.mark.parametrize("size", [64, 257, 1 << 20])
def test_csv_in_many_pieces(spark, tmp_path, size):
    import random

    r = random.Random(size)
    texts = ["plain", "", "line\nbreak", 'quo"te', '"', "\n\n", "a,b", '5" screen', "سطر\nآخر", "x" * 300 + "\n" + "y" * 300, ' " , " ']
    rows = [(str(i), r.choice(texts), r.choice(texts)) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, t string, u string")
    writers.save_csv(df.coalesce(2), str(tmp_path / "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = readers.read_csv(spark, str(tmp_path / "c"))
        assert sorted(map(tuple, found.collect())) == sorted(rows)
        numbered = readers.read_csv(spark, str(tmp_path / "c"), row_id="at")
        assert [tuple(x)[1:] for x in sorted(numbered.collect())] == rows
        assert sorted(x["at"] for x in numbered.collect()) == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_json(spark, tmp_path):
    many = write(tmp_path / "m.json", json.dumps([{"a": 1}, {"a": 2}]))
    single = write(tmp_path / "s.json", json.dumps({"a": 3}, indent=1))
    lines = write(tmp_path / "l.jsonl", '{"a": 4}\n\n{"a": 5}\n')
    values = lambda p, **k: [r["a"] for r in readers.read_any(spark, p, **k).collect()]
    assert (values(many), values(single), values(lines)) == ([1, 2], [3], [4, 5])
    assert values(lines, file_type="JSONL") == [4, 5]
    bad = write(tmp_path / "b.jsonl", '{"a": 4}\n{"a": \n')
    with pytest.raises(Exception):
        values(bad)
    with pytest.raises(ValueError, match="Unsupported file type: xml"):
        readers.read_any(spark, "x.xml")


def test_read_tagged_and_pairs(spark, tmp_path):
    record = {"tokens": ["عقد", "بيع"], "tags": ["O", "PROP"]}
    for name, text in (("t.json", json.dumps([record])), ("t.jsonl", json.dumps(record))):
        row = readers.read_tagged(spark, write(tmp_path / name, text)).first()
        assert (row["tokens"], row["tags"]) == (record["tokens"], record["tags"])
    mixed = [{"text": "a", "summary": "b"}, {"source": "c", "target": "d"}, {"text": "e"}]
    path = write(tmp_path / "p.json", json.dumps(mixed))
    assert [tuple(r) for r in readers.read_summary_pairs(spark, path).collect()] == [("a", "b"), ("c", "d"), ("e", "")]
    table = write(tmp_path / "p.csv", "text,summary\na,b\n")
    assert tuple(readers.read_summary_pairs(spark, table).first()) == ("a", "b")
    with pytest.raises(ValueError, match="summary"):
        readers.read_summary_pairs(spark, write(tmp_path / "q.csv", "text,other\na,b\n"))


def test_inference_input(spark, tmp_path):
    pick = lambda n, t: readers.read_inference_input(spark, write(tmp_path / n, t))[1]
    assert pick("a.csv", "id,Content\n1,x\n") == "Content"
    assert pick("b.csv", "first,other\n1,x\n") == "first"
    assert pick("c.csv", "Text,cleaned_text\n1,x\n") == "cleaned_text"
    assert pick("d.txt", "x\n") == "text"


def test_stopword_file(spark, tmp_path):
    path = write(tmp_path / "s.txt", " كلمة \n\nكلمة\nأخرى\n")
    assert sorted(r["word"] for r in readers.read_stopwords(spark, path).collect()) == ["أخرى", "كلمة"]
    with pytest.raises(Exception):
        readers.read_stopwords(spark, str(tmp_path / "none.txt"))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(["a", 'q"'], "x,\ny")], "t array<string>, text string")
    writers.save_csv(df, str(tmp_path / "c"))
    row = readers.read_csv(spark, str(tmp_path / "c")).first()
    assert json.loads(row["t"]) == ["a", 'q"'] and row["text"] == "x,\ny"
    writers.save_json(df, str(tmp_path / "j"))
    assert readers.read_jsonl(spark, str(tmp_path / "j")).first()["t"] == ["a", 'q"']
    lines = spark.createDataFrame([("سطر",)], "text string")
    writers.save_results(str(tmp_path / "x"), lines)
    assert readers.read_text(spark, str(tmp_path / "x")).first()[0] == "سطر"
    writers.save_document(spark, {"k": "قيمة"}, str(tmp_path / "d"))
    assert writers.load_document(spark, str(tmp_path / "d")) == {"k": "قيمة"}
    empty = spark.createDataFrame([], "prediction string")
    writers.save_predictions(empty, str(tmp_path / "e"), "classification")
    with pytest.raises(ValueError):
        writers.save_predictions(empty, str(tmp_path / "f"), "classification", "xlsx")


# --- training -------------------------------------------------------------------

@pytest.mark.parametrize("model_type", classify.MODEL_TYPES)
def test_train_save_load_predict(spark, labelled, tmp_path, model_type):
    out = str(tmp_path / "models")
    model, report = classify.train_text_classification(labelled, model_type, output_dir=out, max_iter=40)
    assert model.labels == sorted(CONTRACTS) and model.val_samples == 9
    assert model.accuracy == 1.0
    assert {"accuracy", "macro avg"} <= {r["label"] for r in report.collect()}
    loaded = classify.Classifier.load(spark, out)
    assert (loaded.model_type, loaded.accuracy) == (model_type, model.accuracy)
    a = {r["id"]: r["prediction"] for r in model.predict(labelled).collect()}
    b = {r["id"]: r["prediction"] for r in loaded.predict(labelled.repartition(5)).collect()}
    assert a == b and sum(a[r["id"]] == r["label"] for r in labelled.collect()) == 36
    proba = loaded.predict(labelled, return_proba=True).first()["probabilities"]
    if model_type == "linear_svc":
        assert proba is None
    else:
        assert set(proba) == set(CONTRACTS) and sum(proba.values()) == pytest.approx(1.0)


def test_two_models_in_one_folder(spark, labelled, tmp_path):
    out = str(tmp_path / "models")
    for t in classify.MODEL_TYPES:
        classify.train_text_classification(labelled, t, output_dir=out, max_iter=2)
    with pytest.raises(ValueError, match="pass model_type"):
        classify.Classifier.load(spark, out)
    assert classify.Classifier.load(spark, out, "linear_svc").model_type == "linear_svc"
    with pytest.raises(FileNotFoundError):
        classify.Classifier.load(spark, str(tmp_path / "none"))


def test_regularization_matches_the_summed_loss(spark):
    """At the optimum the gradient of C * sum(loss) + |w|^2 / 2 vanishes."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = (x[:, 0] + rng.normal(size=60) > 0).astype(float)
    df = spark.createDataFrame([(float(t), Vectors.dense(r)) for t, r in zip(y, x)], ["label", "features"])
    m = classify.estimator("logistic_regression", 2, 60, C=0.5, tol=1e-10).fit(df)
    w = m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + m.intercept)))
    assert np.allclose(0.5 * x.T @ (p - y) + w, 0, atol=1e-4)
    assert abs((p - y).sum()) < 1e-3


def dense_squared_hinge(x, t, C):
    """Newton with the whole Hessian."""
    import numpy as np

    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])

    def value(w):
        return w @ w / 2 + C * (np.maximum(0, 1 - t * (x @ w)) ** 2).sum()

    for _ in range(100):
        short = np.maximum(0, 1 - t * (x @ w))
        g = w - 2 * C * x.T @ (t * short)
        active = x[short > 0]
        s, step = np.linalg.solve(np.eye(len(w)) + 2 * C * active.T @ active, -g), 1.0
        while value(w + step * s) > value(w) and step > 1e-12:
            step /= 2
        w = w + step * s
    return w


def svc_rows(spark, classes, n=90, d=5):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(classes)
    centres = rng.normal(size=(classes, d)) * 2
    y = rng.integers(0, classes, n)
    x = centres[y] + rng.normal(size=(n, d))
    x[rng.random((n, d)) < 0.3] = 0
    x[0] = 0
    make = [Vectors.dense(r) if i % 2 else Vectors.sparse(d, [(j, float(v)) for j, v in enumerate(r) if v]) for i, r in enumerate(x)]
    rows = [(i, float(t), v, int(i % 3)) for i, (t, v) in enumerate(zip(y, make, strict=True))]
    return spark.createDataFrame(rows, ["id", "label", "features", "fold"]).repartition(3), x, y


@pytest.mark.parametrize("classes", [2, 3])
def test_squared_hinge_is_at_the_optimum(spark, classes):
    import numpy as np

    df, x, y = svc_rows(spark, classes)
    problems = [q for C in (0.1, 10.0) for f in (-1, 1) for q in svc.problems_of(classes, C, f)]
    found = svc.solve(df, problems, 1e-10, 100)
    for q, w in zip(problems, found, strict=True):
        kept = np.arange(len(y)) % 3 != q.left_out
        assert np.abs(w - dense_squared_hinge(x[kept], np.where(y[kept] == q.positive, 1.0, -1.0), q.C)).max() < 1e-6
    model = classify.estimator("linear_svc", classes, len(y), C=10.0).fit(df)
    margins = np.stack([np.append(r, 1) @ w for r in x for w in found[len(problems) // 2 :][: 1 if classes == 2 else classes]]).reshape(len(x), -1)
    want = (margins[:, 0] > 0).astype(int) if classes == 2 else margins.argmax(1)
    got = [int(r["prediction"]) for r in model.transform(df).orderBy("id").collect()]
    assert sum(a != b for a, b in zip(got, want, strict=True)) <= 1
    with pytest.raises(ValueError, match="Unknown loss"):
        classify.estimator("linear_svc", classes, 9, loss="log")


def test_grid_over_both_losses(spark, monkeypatch):
    """Scores of the shared passes are those of fits one by one."""
    import numpy as np

    df, x, y = svc_rows(spark, 3)
    scores = classify._squared_hinge_scores(df, 3, [{"C": 0.01}, {"C": 1.0}], tol=1e-8)
    for C, score in zip((0.01, 1.0), scores, strict=True):
        parts = []
        for f in range(3):
            out = np.arange(len(y)) % 3 == f
            ws = [dense_squared_hinge(x[~out], np.where(y[~out] == k, 1.0, -1.0), C) for k in range(3)]
            chosen = np.stack([np.hstack([x[out], np.ones((out.sum(), 1))]) @ w for w in ws], 1).argmax(1)
            f1 = [2 * ((chosen == k) & (y[out] == k)).sum() / max(1, (chosen == k).sum() + (y[out] == k).sum()) for k in range(3)]
            parts.append(np.mean(f1))
        assert score == pytest.approx(np.mean(parts), abs=1e-9)
    model, best, score = classify.search(df.drop("fold"), "linear_svc", 3, len(y), 42, max_iter=10, grid=(0.1, 1.0))
    assert set(best) == {"C", "loss"} and best["loss"] in classify.LOSSES and 0 < score <= 1
    assert model.transform(df).count() == len(y)
    _, best, _ = classify.search(df.drop("fold"), "linear_svc", 3, len(y), 42, max_iter=10, grid=(1.0,), loss="hinge")
    assert best == {"C": 1.0, "loss": "hinge"}


def test_grid_search(spark, labelled):
    model, _ = classify.train_text_classification(labelled, hyperparameter_tuning=True, max_iter=3)
    assert model.best_params["C"] in (0.1, 1.0, 10.0) and 0 <= model.best_score <= 1


def test_degenerate_training_raises(spark, labelled):
    train = classify.train_text_classification
    with pytest.raises(ValueError, match="at least two classes"):
        train(labelled.limit(0))
    with pytest.raises(ValueError, match="at least two classes"):
        train(labelled.where(F.col("label") == "رهن"))
    with pytest.raises(ValueError, match="Unknown model_type: forest"):
        train(labelled, "forest")
    with pytest.raises(ValueError, match="no column body"):
        train(labelled, text_col="body")
    with pytest.raises(Exception, match="no label"):
        train(labelled.withColumn("label", F.when(F.col("id") > 3, F.col("label"))))


# --- jobs -----------------------------------------------------------------------

def test_end_to_end(spark, tmp_path):
    lines = [t for texts in CONTRACTS.values() for t in texts for _ in range(5)]
    raw = write(tmp_path / "raw.txt", "\n".join(lines))
    jobs.preprocess(spark, raw, str(tmp_path / "clean.parquet"), apply_stemming=True)
    clean = spark.read.parquet(str(tmp_path / "clean.parquet"))
    assert clean.columns == ["text", "cleaned_text", "tokens", "stemmed_tokens"] and clean.count() == 30

    label = F.when(F.col("text").contains("بيع"), "بيع").when(F.col("text").contains("رهن"), "رهن").otherwise("إيجار")
    data = str(tmp_path / "data.parquet")
    readers.with_row_id(clean, "id").withColumn("label", label).write.parquet(data)
    models = str(tmp_path / "models")
    model, _ = jobs.train_classifier(spark, data, models)
    assert model.accuracy >= 0

    jobs.infer(spark, "classification", data, str(tmp_path / "pred.csv"), models)
    predicted = readers.read_csv(spark, str(tmp_path / "pred.csv"))
    assert predicted.count() == 30 and "prediction" in predicted.columns
    by_file = jobs.evaluate(spark, "classification", data, str(tmp_path / "pred.csv"), output_dir=str(tmp_path / "r"))
    by_model = jobs.evaluate(spark, "classification", data, model_path=models, text_column="cleaned_text")
    assert by_file == by_model
    saved = writers.load_document(spark, str(tmp_path / "r" / "classification_report.json"))
    assert saved["accuracy"] == by_file["accuracy"] and len(saved["confusion_matrix"]) == 3


def test_preprocess_to_csv(spark, tmp_path):
    raw = write(tmp_path / "raw.txt", "هَذَا نَص كلمة\nنص آخر")
    extra = write(tmp_path / "stop.txt", "كلمة\nنص")
    out = str(tmp_path / "out")
    jobs.preprocess(spark, raw, out, stopwords_path=extra)
    assert [r["tokens"] for r in spark.read.parquet(out).collect()] == [["كلمه"], ["اخر"]]
    jobs.preprocess(spark, raw, out, stopwords_path=extra, normalize_stopwords=True, output_type="csv")
    rows = readers.read_csv(spark, out).collect()
    assert [json.loads(r["tokens"]) for r in rows] == [[], ["اخر"]]
    jobs.preprocess(spark, raw, str(tmp_path / "all"), remove_stops=False)
    assert spark.read.parquet(str(tmp_path / "all")).first()["tokens"] == ["هذا", "نص", "كلمه"]


def test_infer_without_input_or_model(spark, tmp_path, labelled):
    empty = write(tmp_path / "e.txt", "\n\n")
    assert jobs.infer(spark, "summarization", empty, str(tmp_path / "o")) is None
    assert not (tmp_path / "o").exists()
    with pytest.raises(ValueError, match="Unknown task: translation"):
        jobs.infer(spark, "translation", empty, "o")
    with pytest.raises(FileNotFoundError):
        jobs.infer(spark, "classification", empty, "o", str(tmp_path / "none"))
    for task in ("classification", "ner"):
        with pytest.raises(RuntimeError, match="not loaded"):
            jobs.batch_process(labelled, task)


def test_ner_and_summary_inference(spark, tmp_path):
    def word_tagger():
        def tag(texts):
            out = []
            for text in texts:
                at, pieces = 0, []
                for w in text.split(" "):
                    pieces.append({"tag": "B-NUM" if w.isdigit() else "O", "score": 0.5, "word": w,
                                   "start": at, "end": at + len(w), "is_subword": False})
                    at += len(w) + 1
                out.append(pieces)
            return out

        return tag

    path = write(tmp_path / "t.txt", "شقة 12 غرفة\nبلا")
    jobs.infer(spark, "ner", path, str(tmp_path / "ner"), model_factory=word_tagger, batch_size=1)
    rows = {r["text"]: r["entities"] for r in readers.read_jsonl(spark, str(tmp_path / "ner")).collect()}
    assert rows["بلا"] == [] and rows["شقة 12 غرفة"][0]["word"] == "12" and rows["شقة 12 غرفة"][0]["start"] == 4
    first = lambda: lambda ts: [t.split()[0] for t in ts]
    jobs.infer(spark, "summarization", path, str(tmp_path / "sum"), model_factory=first)
    assert {r["summary"] for r in readers.read_csv(spark, str(tmp_path / "sum")).collect()} == {"شقة", "بلا"}
    built_in = jobs.infer(spark, "summarization", path, str(tmp_path / "sum2"))
    assert {r["text"]: r["summary"] for r in built_in.collect()} == {"شقة 12 غرفة": "شقة 12 غرفة", "بلا": "بلا"}


def test_prepare_jobs(spark, tmp_path):
    records = [{"tokens": ["a", "bb"], "tags": ["O", "B-X"]} for _ in range(20)]
    path = write(tmp_path / "n.jsonl", "\n".join(map(json.dumps, records)))
    jobs.prepare_ner(spark, path, str(tmp_path / "n"), lambda t: F.transform(t, lambda w, i: i), max_length=4)
    train, val = (spark.read.parquet(str(tmp_path / "n" / p)) for p in ("train", "validation"))
    assert (train.count(), val.count()) == (18, 2) and train.first()["labels"] == [1, 0, -100, -100]
    pairs = write(tmp_path / "p.csv", "text,summary\n" + "aa b,c\n" * 10)
    code = lambda c: F.transform(F.split(c, " "), F.length)
    jobs.prepare_seq2seq(spark, pairs, str(tmp_path / "s"), code, val_path=pairs, max_input_length=3, max_target_length=2)
    row = spark.read.parquet(str(tmp_path / "s" / "train")).first()
    assert (row["input_ids"], row["attention_mask"], row["labels"]) == ([2, 1, 0], [1, 1, 0], [1, 0])
    assert spark.read.parquet(str(tmp_path / "s" / "validation")).count() == 10


# --- evaluation -----------------------------------------------------------------

def pairs_of(spark, truth, guess, kind="string"):
    rows = list(zip(range(len(truth)), truth, guess))
    return spark.createDataFrame(rows, f"id long, truth {kind}, prediction {kind}")


def test_evaluate_classification(spark, tmp_path, capsys):
    pairs = pairs_of(spark, ["بيع", "إيجار", "بيع", "إيجار", "بيع"], ["بيع", "إيجار", "إيجار", "إيجار", "إيجار"])
    scores = spark.createDataFrame([("بيع", 0.9), ("إيجار", 0.2), ("بيع", 0.1)], "label string, score double")
    m = evaluate_classification(pairs, scores=scores, output_dir=str(tmp_path), prefix="x_")
    assert m["accuracy"] == pytest.approx(0.6) and m["confusion_matrix"] == [[2, 0], [2, 1]]
    assert m["roc_auc"] == pytest.approx(0.5)
    assert writers.load_document(spark, str(tmp_path / "x_classification_report.json")) == m
    turned = evaluate_classification(pairs, label_names=["بيع", "إيجار"])
    assert turned["confusion_matrix"] == [[1, 2], [0, 2]]
    with pytest.raises(ValueError, match="lacks"):
        evaluate_classification(pairs, label_names=["بيع", "رهن"])
    with pytest.raises(ValueError, match="nothing"):
        evaluate_classification(pairs.limit(0))
    print_classification(pairs)
    assert "weighted avg" in capsys.readouterr().out


def test_evaluate_ner_and_summaries(spark, tmp_path):
    ner = evaluate_ner(pairs_of(spark, [["B-A", "O"]], [["B-A", "O"]], "array<string>"), str(tmp_path))
    assert ner["f1"] == ner["accuracy"] == 1.0 and ner["per_entity"]["A"]["support"] == 1
    assert writers.load_document(spark, str(tmp_path / "ner_report.json"))["precision"] == 1.0
    rouge = evaluate_summarization(pairs_of(spark, ["شقة كبيرة"], ["شقة"]), str(tmp_path))
    assert rouge["num_samples"] == 1 and rouge["rouge1_recall"] == 0.5 and rouge["rougeL_precision"] == 1.0
    assert writers.load_document(spark, str(tmp_path / "summarization_report.json")) == rouge


def test_evaluate_files(spark, tmp_path):
    truth = write(tmp_path / "t.csv", "text,label\na,1\nb,0\n")
    guess = write(tmp_path / "g.csv", "n,prediction\n1,1\n2,1\n")
    assert jobs.evaluate(spark, "classification", truth, guess, by_position=True)["accuracy"] == 0.5
    with pytest.raises(ValueError, match="required"):
        jobs.evaluate(spark, "classification", truth)
    with pytest.raises(ValueError, match="required"):
        jobs.evaluate(spark, "ner", truth)
    tags = [{"id": "x", "tokens": ["a"], "tags": ["B-A"]}, {"id": "y", "tokens": ["a"], "tags": ["O"]}]
    one = write(tmp_path / "a.json", json.dumps(tags))
    two = write(tmp_path / "b.json", json.dumps(tags[::-1]))
    assert jobs.evaluate(spark, "ner", one, two)["f1"] == 1.0
    assert jobs.evaluate(spark, "ner", one, two, by_position=True)["f1"] == 0.0
    refs = write(tmp_path / "r.csv", "id,summary\n1,a b\n2,c\n")
    hyps = write(tmp_path / "h.csv", "id,prediction\n2,c\n1,a b\n")
    assert jobs.evaluate(spark, "summarization", refs, hyps)["rouge2_recall"] == 0.5


# --- streaming ------------------------------------------------------------------

def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.txt", "هَذَا نَص\n\n الكتاب ")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    query = preprocess_stream(read_text_stream(spark, str(folder)), out, check, apply_stemming=True)
    query.awaitTermination(60)
    write(folder / "b.txt", "بيت جديد")
    preprocess_stream(read_text_stream(spark, str(folder)), out, check, apply_stemming=True).awaitTermination(60)
    rows = {r["text"]: r["stemmed_tokens"] for r in spark.read.parquet(out).collect()}
    assert rows == {"هَذَا نَص": ["نص"], "الكتاب": ["كتاب"], "بيت جديد": ["يت", "جديد"]}


def test_factory_runs_once_per_worker():
    hooks._loaded.clear()
    calls = []
    for _ in range(3):
        hooks._load_once("k", lambda: calls.append(1) or (lambda t: t))
    assert calls == [1]
