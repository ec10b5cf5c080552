"""Evaluate predictions and write reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nassaj.operators.metrics import (
    classification_metrics, classification_report, confusion_counts, confusion_matrix, format_report, label_scores,
    report_rows,
)
from nassaj.operators.roc import roc_auc
from nassaj.operators.rouge import rouge_scores, rouge_summary
from nassaj.operators.sizes import MAX_LABELS, collect_bounded
from nassaj.operators.spans import micro_scores, ner_tally
from nassaj.sources.writers import save_document

_COLUMNS = ("precision", "recall", "f1", "support")


def _as_dict(rows: Sequence) -> dict:
    out = {}
    for r in rows:
        if r["label"] == "accuracy":
            out["accuracy"] = r["f1"]
        else:
            out[r["label"]] = {("f1-score" if c == "f1" else c): r[c] for c in _COLUMNS}
    return out


def _as_rows(report: dict) -> list[dict]:
    """The rows that :func:`_as_dict` was made from, as far as a printed report needs them."""
    total = report["macro avg"]["support"]
    return [
        {"label": k, "f1": v, "support": total} if k == "accuracy"
        else {"label": k, **{c: v["f1-score" if c == "f1" else c] for c in _COLUMNS}}
        for k, v in report.items()
    ]


def _save(df: DataFrame, metrics: dict, output_dir: str | None, name: str) -> None:
    if output_dir:
        save_document(df.sparkSession, metrics, f"{output_dir}/{name}")


def evaluate_classification(
    pairs: DataFrame,
    label_names: Sequence[str] | None = None,
    scores: DataFrame | None = None,
    output_dir: str | None = None,
    prefix: str = "",
    max_labels: int = MAX_LABELS,
) -> dict:
    """All classification metrics of ``id, truth, prediction`` rows.

    The result holds the whole matrix; more than ``max_labels`` labels raise, as does a null label.

    ``label_names`` orders the confusion matrix and must hold label values.
    ``scores`` (``label, score``) adds the ROC area when there are two labels, the
    second one being positive.
    """
    counted = collect_bounded(confusion_counts(pairs), "confusion cells", max_labels**2)
    if not counted:
        raise ValueError("nothing to evaluate")
    counts = pairs.sparkSession.createDataFrame(counted, "truth string, prediction string, n long")
    seen = sorted({r["truth"] for r in counted} | {r["prediction"] for r in counted})
    labels = [str(x) for x in label_names] if label_names else seen
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not set(seen) <= set(labels):
        raise ValueError(f"label_names lacks {sorted(set(seen) - set(labels))}")
    metrics = classification_metrics(counts).first().asDict()
    metrics["classification_report"] = _as_dict(classification_report(counts).collect())
    cells = {(r["truth"], r["prediction"]): r["n"] for r in confusion_matrix(counts, labels).collect()}
    metrics["confusion_matrix"] = [[cells[t, p] for p in labels] for t in labels]
    if scores is not None and len(labels) == 2:
        metrics["roc_auc"] = roc_auc(scores, positive=labels[1]).first()["roc_auc"]
    _save(pairs, metrics, output_dir, f"{prefix}classification_report.json")
    return metrics


def print_classification(pairs: DataFrame, label_names: Sequence[str] | None = None) -> dict:
    """:func:`evaluate_classification` with the report printed and nothing saved."""
    metrics = evaluate_classification(pairs, label_names)
    print(format_report(_as_rows(metrics["classification_report"])))
    return metrics


def evaluate_ner(
    pairs: DataFrame, output_dir: str | None = None, prefix: str = "", max_types: int = MAX_LABELS
) -> dict:
    """Token accuracy and span scores of ``id, truth, prediction`` tag arrays, from one pass over them."""
    rows = collect_bounded(ner_tally(pairs), "entity types", max_types)
    tallies = pairs.sparkSession.createDataFrame(rows, "label string, support long, predicted long, correct long")
    spans = tallies.where("label IS NOT NULL")
    tokens = next((r for r in rows if r["label"] is None), None)
    accuracy = tokens["correct"] / tokens["support"] if tokens and tokens["support"] else 0.0
    report = report_rows(label_scores(spans), accuracy=False).collect()
    metrics = {"accuracy": accuracy} | micro_scores(spans).first().asDict()
    metrics["per_entity"] = _as_dict(report)
    metrics["report_string"] = format_report(report)
    _save(pairs, metrics, output_dir, f"{prefix}ner_report.json")
    return metrics


def evaluate_summarization(
    pairs: DataFrame, output_dir: str | None = None, prefix: str = "", **options
) -> dict:
    """Mean and deviation of the ROUGE scores of ``id, truth, prediction`` texts."""
    texts = pairs.withColumns({c: F.col(c).cast("string") for c in ("truth", "prediction")})
    metrics = rouge_summary(rouge_scores(texts, **options)).first().asDict()
    _save(pairs, metrics, output_dir, f"{prefix}summarization_report.json")
    return metrics
