"""Bring truth and predictions together by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair(
    truth: DataFrame,
    prediction: DataFrame,
    id_col: str = "id",
    truth_col: str = "label",
    prediction_col: str = "prediction",
    cast: str | None = None,
) -> DataFrame:
    """``id, truth, prediction`` for every id; both sides must hold each id once.

    A missing, null or repeated id fails the query, whichever columns are asked for. Stacking
    and grouping instead of joining keeps a repeated id from multiplying rows before the check sees it; every
    task counts its own rows of an id before they are shuffled, and fails at a null id at once, so that ids on
    many rows never gather in one task. ``cast`` makes labels comparable when one file
    held them as numbers.
    """
    if cast:
        truth = truth.withColumn(truth_col, F.col(truth_col).cast(cast))
        prediction = prediction.withColumn(prediction_col, F.col(prediction_col).cast(cast))

    def named(side: str) -> Column:
        missing = F.raise_error(F.lit(f"a row of the {side} has no id"))
        return F.when(F.col(id_col).isNotNull(), F.col(id_col)).otherwise(missing).alias("id")

    left = truth.select(named("truth"), F.struct(F.col(truth_col).alias("v")).alias("truth"))
    right = prediction.select(
        named("predictions"), F.struct(F.col(prediction_col).alias("v")).alias("prediction")
    )
    grouped = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy("id")
        .agg(
            F.count("truth").alias("n_truth"),
            F.count("prediction").alias("n_prediction"),
            F.first("truth", ignorenulls=True).alias("truth"),
            F.first("prediction", ignorenulls=True).alias("prediction"),
        )
    )
    complete = (F.col("n_truth") == 1) & (F.col("n_prediction") == 1)
    problem = F.raise_error(
        F.concat(
            F.lit("truth and predictions do not match at id "), F.col("id").cast("string"),
            F.lit(": "), F.col("n_truth").cast("string"), F.lit(" truth and "),
            F.col("n_prediction").cast("string"), F.lit(" prediction rows"),
        )
    )
    return fail_unless(grouped, complete, problem).select(
        "id", F.col("truth.v").alias("truth"), F.col("prediction.v").alias("prediction")
    )


def fail_unless(df: DataFrame, good: Column, problem: Column) -> DataFrame:
    """``df``, failing with ``problem`` at a row that is not ``good``.

    The check is a filter, which is computed even where no column of the row is used.
    """
    return df.where(F.coalesce(good, F.lit(False)) | problem.cast("boolean"))


def pick_column(df: DataFrame, wanted: str, position: int) -> str:
    """``wanted`` if the table has it, else the column at ``position``."""
    return wanted if wanted in df.columns else df.columns[position]


def first_known(df: DataFrame, names: Sequence[str]) -> str:
    """First column whose lowercase name is in ``names``, else the first column."""
    return next((c for c in df.columns if c.lower() in names), df.columns[0])
