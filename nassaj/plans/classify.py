"""Train and apply text classifiers."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.operators import svc
from nassaj.operators.metrics import classification_metrics, classification_report, confusion_counts
from nassaj.operators.sizes import MAX_LABELS, collect_bounded, kept
from nassaj.operators.split import stratified_folds, validation_flag
from nassaj.operators.svc import SquaredHingeSVC
from nassaj.operators.tfidf import TfidfModel
from nassaj.sources.writers import load_document, load_model, path_exists, save_document, save_model

MODEL_TYPES = ("logistic_regression", "linear_svc")
LR_ITERATIONS = 1000
SVC_ITERATIONS = 10_000
LOSSES = ("hinge", "squared_hinge")
TOLERANCE = 1e-4


class MacroF1(Evaluator):
    """Unweighted mean of the F1 of every class in the labels or predictions."""

    def _evaluate(self, dataset: DataFrame) -> float:
        pairs = dataset.select(F.col("label").alias("truth"), "prediction")
        return classification_metrics(confusion_counts(pairs)).first()["f1_macro"]

    def isLargerBetter(self) -> bool:
        return True


def estimator(
    model_type: str,
    classes: int,
    rows: int,
    C: float = 1.0,
    max_iter: int | None = None,
    tol: float = TOLERANCE,
    fit_intercept: bool = True,
    one_vs_rest: bool = False,
    loss: str = "squared_hinge",
):
    """A linear classifier with inverse regularization ``C`` over ``rows`` rows.

    ``C`` weighs the summed loss against half the squared norm; Spark weighs the
    mean loss, hence ``regParam = 1 / (C * rows)``. The SVC has squared hinge loss, its intercept regularised, or
    hinge loss, its intercept free, and one model per class beyond two classes.
    """
    if loss not in LOSSES:
        raise ValueError(f"Unknown loss: {loss}. Choose one of {', '.join(LOSSES)}.")
    if model_type == "linear_svc" and loss == "squared_hinge" and fit_intercept:
        return SquaredHingeSVC(classes=classes, C=C, tol=tol, max_iter=max_iter or SVC_ITERATIONS)
    common = {
        "regParam": 1.0 / (C * rows), "tol": tol, "fitIntercept": fit_intercept,
        "standardization": False, "featuresCol": "features", "labelCol": "label",
    }
    if model_type == "logistic_regression":
        lr = LogisticRegression(maxIter=max_iter or LR_ITERATIONS, elasticNetParam=0.0, **common)
        return OneVsRest(classifier=lr) if one_vs_rest and classes > 2 else lr
    svc = LinearSVC(maxIter=max_iter or SVC_ITERATIONS, **common)
    return svc if classes == 2 else OneVsRest(classifier=svc)


def _squared_hinge_scores(
    folded: DataFrame, classes: int, grid: list[dict], tol: float = TOLERANCE, max_iter: int | None = None
) -> list[float]:
    """Mean macro F1 over the folds of squared hinge candidates, all fitted in the same passes over the vectors."""
    folds = range(fixed.GRID_FOLDS)
    candidates = [[q for f in folds for q in svc.problems_of(classes, g["C"], f)] for g in grid]
    weights = svc.solve(folded, [q for qs in candidates for q in qs], tol, max_iter or SVC_ITERATIONS)
    split = np.split(weights, len(grid))
    counts = svc.held_out_counts(folded, classes, candidates, split).collect()  # cells of bounded tables
    table = folded.sparkSession.createDataFrame(counts, "candidate int, fold int, truth double, prediction double, n long")

    def score(k: int) -> float:
        parts = [classification_metrics(table.where(f"candidate = {k} AND fold = {f}")).first()["f1_macro"] for f in folds]
        return sum(parts) / len(parts)

    return [score(k) for k in range(len(grid))]


def search(
    train: DataFrame, model_type: str, classes: int, rows: int, seed: int, parallelism: int = 2, **params
) -> tuple[PipelineModel, dict, float]:
    """Three-fold grid search by macro F1 over C, and over the LR's multi-class form or the SVC's loss.

    Returns the model refitted on all rows, its parameters and its score. Candidates with squared hinge loss are fitted
    together, the others one by one.
    """
    fold_rows = rows - rows // fixed.GRID_FOLDS
    if model_type == "linear_svc":
        axis = [{"loss": x} for x in ([params.pop("loss")] if "loss" in params else LOSSES)]
    else:
        axis = [{"one_vs_rest": x} for x in ((False, True) if classes > 2 else (False,))]
    grid = [{"C": c, **x} for c in params.pop("grid", fixed.REGULARIZATION_GRID) for x in axis]
    together = [g for g in grid if g.get("loss") == "squared_hinge" and params.get("fit_intercept", True)]
    single = [g for g in grid if g not in together]
    scores: dict[int, float] = {}
    with kept(stratified_folds(train, "id", "label", fixed.GRID_FOLDS, seed)) as folded:
        if together:
            limits = {k: params[k] for k in ("tol", "max_iter") if k in params}
            found = _squared_hinge_scores(folded, classes, together, **limits)
            scores.update(zip(map(grid.index, together), found, strict=True))
        if single:
            stage = Pipeline(stages=[])
            candidates = [[estimator(model_type, classes, fold_rows, **g, **params)] for g in single]
            found = CrossValidator(
                estimator=stage,
                estimatorParamMaps=ParamGridBuilder().addGrid(stage.stages, candidates).build(),
                evaluator=MacroF1(), numFolds=fixed.GRID_FOLDS, foldCol="fold", seed=seed,
                parallelism=parallelism,
            ).fit(folded)
            scores.update(zip(map(grid.index, single), found.avgMetrics, strict=True))
    best = max(range(len(grid)), key=lambda i: scores[i])
    refit = Pipeline(stages=[estimator(model_type, classes, rows, **grid[best], **params)])
    return refit.fit(train), grid[best], scores[best]


@dataclass
class Classifier:
    """A fitted vocabulary and linear model with the labels they predict."""

    model_type: str
    labels: list[str]
    tfidf: TfidfModel
    model: PipelineModel
    accuracy: float | None = None
    val_samples: int | None = None
    best_params: dict | None = None
    best_score: float | None = None

    def predict_ids(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add ``prediction`` (label number) and the model's score columns."""
        return self.model.transform(self.tfidf.features(df, text_col)).drop("features")

    def predict(
        self, df: DataFrame, text_col: str = "text", return_proba: bool = False, output_col: str = "prediction"
    ) -> DataFrame:
        """Add the predicted label; ``return_proba`` adds a label-to-probability map.

        The map is null for models without probabilities, such as the SVC.
        """
        scored = self.predict_ids(df, text_col)
        label = label_of(F.col("prediction"), self.labels)
        added = [label.alias(output_col)]
        if return_proba:
            if "probability" in scored.columns:
                names = _listed(self.labels)
                proba = F.map_from_arrays(names, vector_to_array("probability"))
            else:
                proba = F.lit(None).cast("map<string,double>")
            added.append(proba.alias("probabilities"))
        kept = [c for c in df.columns if c not in (output_col, "probabilities")]
        return scored.select(*kept, *added)

    def save(self, spark: SparkSession, output_dir: str) -> None:
        """One folder per model type, so that two models never share a vocabulary."""
        base = f"{output_dir}/text_classification_{self.model_type}"
        save_model(self.model, f"{base}/model")
        self.tfidf.term_table(spark).write.mode("overwrite").parquet(f"{base}/vocabulary")
        save_document(spark, {
            "model_type": self.model_type,
            "labels": self.labels,
            "label_to_id": {label: i for i, label in enumerate(self.labels)},
            "accuracy": self.accuracy,
            "val_samples": self.val_samples,
            "ngram_range": list(self.tfidf.ngram_range),
        }, f"{base}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, model_dir: str, model_type: str | None = None) -> Classifier:
        """Load the model of ``model_dir``; name its type where there are two."""
        wanted = [model_type] if model_type else MODEL_TYPES
        found = [t for t in wanted if path_exists(spark, f"{model_dir}/text_classification_{t}/model")]
        if not found:
            raise FileNotFoundError(f"No classification model found in {model_dir}")
        if len(found) > 1:
            raise ValueError(f"{model_dir} holds {', '.join(found)}; pass model_type")
        base = f"{model_dir}/text_classification_{found[0]}"
        meta = load_document(spark, f"{base}/metadata")
        terms = spark.read.parquet(f"{base}/vocabulary").orderBy("idx").collect()
        tfidf = TfidfModel([r["term"] for r in terms], [r["idf"] for r in terms], tuple(meta["ngram_range"]))
        return cls(found[0], meta["labels"], tfidf, load_model(f"{base}/model"),
                   meta["accuracy"], meta["val_samples"])


def _listed(labels: list[str]):
    """Labels as one literal, however many."""
    return F.from_json(F.lit(json.dumps(labels)), "array<string>")


def label_of(prediction, labels: list[str]):
    """Label of a predicted number; numbers without a label stay as text."""
    number = prediction.cast("int")
    if not labels:
        return number.cast("string")
    names = _listed(labels)
    return F.coalesce(F.get(names, number), number.cast("string"))


def check_training_input(df: DataFrame, text_col: str, label_col: str, model_type: str) -> None:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"Unknown model_type: {model_type}. Choose one of {', '.join(MODEL_TYPES)}.")
    missing = [c for c in (text_col, label_col) if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the training data")


def train_text_classification(
    df: DataFrame,
    model_type: str = "logistic_regression",
    text_col: str = "text",
    label_col: str = "label",
    id_col: str = "id",
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SEED,
    max_features: int = fixed.MAX_FEATURES,
    ngram_range: tuple[int, int] = fixed.NGRAM_RANGE,
    output_dir: str | None = None,
    hyperparameter_tuning: bool = False,
    max_labels: int = MAX_LABELS,
    staging: str | None = None,
    **params,
) -> tuple[Classifier, DataFrame]:
    """Fit on the training part of a labelled corpus and score the rest.

    Returns the classifier and the per-class validation report. ``params`` go to
    :func:`estimator`. Rows without a label fail; an empty corpus, a single class or
    more than ``max_labels`` raises. Texts are read once and vectors made
    once; both are kept meanwhile in ``staging`` (see :func:`~nassaj.operators.sizes.kept`).
    """
    check_training_input(df, text_col, label_col, model_type)
    spark = df.sparkSession
    label = F.col(label_col).cast("string")
    given = df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.when(label.isNotNull(), label).otherwise(
            F.raise_error(F.lit("a training row has no label"))
        ).alias("label_text"),
    )
    with kept(given, folder=staging) as corpus:
        found = collect_bounded(corpus.select("label_text").distinct(), "distinct labels", max_labels)
        labels = sorted((r["label_text"] for r in found), key=lambda x: x.encode("utf-8"))
        if len(labels) < 2:
            raise ValueError(f"training needs at least two classes, found {len(labels)}")
        numbers = spark.createDataFrame(
            [(x, float(i)) for i, x in enumerate(labels)], "label_text string, label double"
        )
        split = validation_flag(corpus, "id", "label_text", test_size, seed).join(
            F.broadcast(numbers), "label_text"  # at most max_labels rows
        )
        train, held_out = split.where(~F.col("is_validation")), split.where("is_validation")

        tfidf = TfidfModel.fit(train, "text", max_features, ngram_range)
        best_params, best_score = None, None
        with kept(tfidf.features_in_batches(train, "text").select("id", "label", "features"), folder=staging) as vectors:
            rows = vectors.count()
            if hyperparameter_tuning:
                model, best_params, best_score = search(vectors, model_type, len(labels), rows, seed, **params)
            else:
                model = Pipeline(stages=[estimator(model_type, len(labels), rows, **params)]).fit(vectors)

        fitted = Classifier(model_type, labels, tfidf, model, best_params=best_params, best_score=best_score)
        predicted = fitted.predict(held_out, "text").select(
            F.col("label_text").alias("truth"), "prediction"
        )
        counts = collect_bounded(confusion_counts(predicted), "confusion cells", max_labels**2)
    if not counts:
        raise ValueError("the validation set is empty")
    table = spark.createDataFrame(counts, "truth string, prediction string, n long")
    fitted.accuracy = classification_metrics(table).first()["accuracy"]
    fitted.val_samples = sum(r["n"] for r in counts)
    if output_dir:
        fitted.save(spark, output_dir)
    return fitted, classification_report(table)
