"""Classification metrics from one confusion aggregation (V1-V5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _or_zero(2 * p * r, p + r)


def confusion_counts(pairs: DataFrame) -> DataFrame:
    """``truth, prediction, n``; labels compared as strings. A null label fails the query."""

    def label(side: str) -> Column:
        missing = F.raise_error(F.lit(f"a row has no {side}"))
        return F.coalesce(F.col(side).cast("string"), missing.cast("string")).alias(side)

    return pairs.groupBy(label("truth"), label("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Every (truth, prediction) cell, zeros included, for the labels seen or given."""
    if labels is None:
        seen = counts.select(F.explode(F.array("truth", "prediction")).alias("label"))
        grid = seen.agg(F.array_sort(F.collect_set("label")).alias("labels"))
    else:
        grid = counts.sparkSession.createDataFrame([(list(map(str, labels)),)], "labels array<string>")
    cells = grid.select("labels", F.explode("labels").alias("truth")).select(
        "truth", F.explode("labels").alias("prediction")
    )
    return cells.join(counts, ["truth", "prediction"], "left").select(
        "truth", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def label_scores(tallies: DataFrame) -> DataFrame:
    """Precision, recall and F1 from ``label, support, predicted, correct``."""
    p = _or_zero(F.col("correct"), F.col("predicted"))
    r = _or_zero(F.col("correct"), F.col("support"))
    return (
        tallies.withColumns({"precision": p, "recall": r})
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )


def _per_label(counts: DataFrame) -> DataFrame:
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("correct")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("correct")),
    )
    tallies = counts.select(F.inline(sides)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")]
    )
    return label_scores(tallies)


def _averages(suffix: str) -> list[Column]:
    weighted = lambda c: _or_zero(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    take = F.avg if suffix == "macro" else weighted
    return [take(c).alias(f"{c}_{suffix}") for c in ("precision", "recall", "f1")]


def classification_metrics(counts: DataFrame) -> DataFrame:
    """One row: accuracy, and macro and weighted precision, recall and F1."""
    accuracy = _or_zero(F.sum("correct"), F.sum("support")).alias("accuracy")
    return _per_label(counts).agg(accuracy, *_averages("macro"), *_averages("weighted"))


def report_rows(scores: DataFrame, accuracy: bool) -> DataFrame:
    """Per-label rows plus the average rows, all from one grouping-sets pass.

    With ``accuracy`` the overall row is the accuracy; without it, it is the micro
    average over all labels.
    """
    s = ("precision", "recall", "f1")
    rolled = scores.rollup("label").agg(
        F.grouping("label").alias("overall"),
        *[F.avg(c).alias(c) for c in s],
        *[_or_zero(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}") for c in s],
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("correct").alias("correct"),
    )
    micro_p = _or_zero(F.col("correct"), F.col("predicted"))
    micro_r = _or_zero(F.col("correct"), F.col("support"))

    def row(name: Column, p: Column, r: Column, f: Column) -> Column:
        return F.struct(name.alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), F.col("support").alias("support"))

    first = (
        row(F.lit("accuracy"), micro_r, micro_r, micro_r)
        if accuracy
        else row(F.lit("micro avg"), micro_p, micro_r, _f1(micro_p, micro_r))
    )
    overall = F.array(
        first,
        row(F.lit("macro avg"), *[F.col(c) for c in s]),
        row(F.lit("weighted avg"), *[F.col(f"w_{c}") for c in s]),
    )
    single = F.array(row(F.col("label"), *[F.col(c) for c in s]))
    return rolled.select(
        F.inline(F.when(F.col("overall") == 1, overall).otherwise(single))
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """``label, precision, recall, f1, support`` with accuracy and average rows."""
    return report_rows(_per_label(counts), accuracy=True)


AVERAGE_ROWS = ("accuracy", "micro avg", "macro avg", "weighted avg")


def format_report(rows: Sequence, digits: int = 2) -> str:
    """The collected rows of a report as aligned text."""
    ordered = sorted(
        rows,
        key=lambda r: (AVERAGE_ROWS.index(r["label"]), "") if r["label"] in AVERAGE_ROWS else (-1, r["label"]),
    )
    width = max([len(str(r["label"])) for r in ordered] + [len("weighted avg")])
    lines = [f"{'':>{width}}  {'precision':>9} {'recall':>9} {'f1-score':>9} {'support':>9}", ""]
    for r in ordered:
        if r["label"] == "accuracy":
            cells = f"{'':>9} {'':>9} {r['f1']:>9.{digits}f}"
        else:
            cells = " ".join(f"{r[c]:>9.{digits}f}" for c in ("precision", "recall", "f1"))
        lines.append(f"{r['label']:>{width}}  {cells} {r['support']:>9}")
    return "\n".join(lines) + "\n"
