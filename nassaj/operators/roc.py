"""ROC curve and area for a binary score (V6, V7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PARTS = 16  # bits of a score's mantissa that part its octave
_LEAST, _MOST = -900.0, 1023.0  # exponents; smaller scores share the least octave
_NAN = 10_000


def _octave(score: Column) -> Column:
    """A number that grows with the score, one for every power of two and sign; NaN comes last, as Spark sorts it."""
    exponent = F.least(F.greatest(F.floor(F.log2(F.abs(score))).cast("double"), F.lit(_LEAST)), F.lit(_MOST))
    number = F.signum(score) * (exponent + 2000)
    return F.when(F.isnan(score), _NAN).when(score == 0, 0).when(F.abs(score) == float("inf"), F.signum(score) * 9000).otherwise(number).cast("int")


def _part(score: Column, octave: Column) -> Column:
    """Where in its octave a score lies: grows with the score."""
    scaled = score * F.pow(F.lit(2.0), F.lit(_PARTS) - (F.abs(octave) - 2000))
    return F.when(F.abs(octave).isin(0, 9000, _NAN), 0).otherwise(F.floor(scaled)).cast("bigint")


def _cumulative(df: DataFrame, label_col: str, score_col: str, positive: str) -> DataFrame:
    """Counts at each distinct score and running counts from the highest down.

    The running sum needs the global order of the scores, and comes in three steps, each from the totals of the next:
    over octaves (4,000 at most), over the parts of an octave (65,536), and over the scores of a part, which agree in
    their first 16 binary digits. So every task has its own piece, whatever the scores, and nothing is run when the query is built.
    """
    missing = F.raise_error(F.lit("ROC: a row has no label or no score"))
    label = F.coalesce(F.col(label_col).cast("string"), missing.cast("string"))
    score = F.coalesce(F.col(score_col).cast("double"), missing.cast("double"))
    is_positive = (label == F.lit(str(positive))).cast("long")
    by_score = df.groupBy(score.alias("score")).agg(F.sum(is_positive).alias("pos"), F.sum(1 - is_positive).alias("neg"))
    placed = by_score.withColumn("octave", _octave(F.col("score")))
    placed = placed.withColumn("part", _part(F.col("score"), F.col("octave")))

    def before(of: str, *within: str) -> tuple[Column, Column]:
        higher = Window.partitionBy(*within).orderBy(F.desc(of)).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("p").over(higher), F.lit(0)), F.coalesce(F.sum("n").over(higher), F.lit(0))

    parts = placed.groupBy("octave", "part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    octaves = parts.groupBy("octave").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, n = before("octave")
    everything = Window.partitionBy()
    octaves = octaves.select(
        "octave", p.alias("p_octave"), n.alias("n_octave"),
        F.sum("p").over(everything).alias("all_pos"), F.sum("n").over(everything).alias("all_neg"),
    )
    p, n = before("part", "octave")
    offsets = parts.select("octave", "part", p.alias("p_part"), n.alias("n_part"))
    down = Window.partitionBy("octave", "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # As many rows as there are octaves.
    return placed.join(offsets, ["octave", "part"]).join(F.broadcast(octaves), "octave").select(
        "score", "pos", "neg", "all_pos", "all_neg",
        (F.sum("pos").over(down) + F.col("p_part") + F.col("p_octave")).alias("tp"),
        (F.sum("neg").over(down) + F.col("n_part") + F.col("n_octave")).alias("fp"),
    )


def roc_points(
    df: DataFrame, label_col: str = "label", score_col: str = "score", positive: str = "1"
) -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score; no collinear point is dropped.

    A row without a label or a score raises, as the curve could not end at (1, 1).
    """
    return _cumulative(df, label_col, score_col, positive).select(
        F.col("score").alias("threshold"),
        F.when(F.col("all_neg") > 0, F.col("fp") / F.col("all_neg")).alias("fpr"),
        F.when(F.col("all_pos") > 0, F.col("tp") / F.col("all_pos")).alias("tpr"),
    )


def roc_auc(
    df: DataFrame, label_col: str = "label", score_col: str = "score", positive: str = "1"
) -> DataFrame:
    """Trapezoid area under :func:`roc_points`; fails when a class is missing."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.max("all_pos") * F.max("all_neg")
    return _cumulative(df, label_col, score_col, positive).agg(
        F.when(pairs > 0, area / pairs)
        .otherwise(F.raise_error(F.lit("ROC needs positive and negative rows")).cast("double"))
        .alias("roc_auc")
    )
