"""Label dictionary and reproducible splits.

Rows are ordered by the MD5 of their id and the seed, so a split depends on the
data alone, not on file layout or partitioning. No group is ever sorted in one
task: ranks are taken inside hash buckets of a group and offset by the counts of
the buckets before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.arrays import unnest
from nassaj.operators.sizes import collect_bounded

_BUCKET_DIGITS = 4  # 65,536 buckets per label


def label_dictionary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Distinct labels in sort order with ids from 0. One row per label."""
    labels = df.select(F.col(label_col).cast("string").alias("label")).distinct()
    by_label = Window.orderBy("label")  # over the label table only
    return labels.select("label", (F.row_number().over(by_label) - 1).alias("label_id"))


def tag_dictionary(df: DataFrame, tags_col: str = "tags") -> DataFrame:
    """:func:`label_dictionary` of the elements of an array column."""
    tags = unnest(df, F.array_distinct(tags_col), name="tag")
    return label_dictionary(tags, "tag").withColumnsRenamed({"label": "tag", "label_id": "tag_id"})


def order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def _group(by: str | None) -> Column:
    """The group of a row; rows without a label are a group of their own."""
    if not by:
        return F.lit("")
    return F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))


def _bucket_counts(keys: DataFrame) -> DataFrame:
    running = Window.partitionBy("_by").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        keys.groupBy("_by", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("_by")))
    )


def _keys(df: DataFrame, id_col: str, seed: int, by: str | None) -> DataFrame:
    return df.select(
        _group(by).alias("_by"),
        order_key(id_col, seed).alias("_key"),
        F.col(id_col).alias("_id"),
    ).withColumn("_bucket", F.substring("_key", 1, _BUCKET_DIGITS))


def hashed_rank(
    df: DataFrame, id_col: str, by: str | None = None, seed: int = fixed.SEED, name: str = "rank"
) -> DataFrame:
    """1-based rank of every row within its group, in hash order."""
    keyed = df.withColumns({
        "_by": _group(by),
        "_key": order_key(id_col, seed),
    }).withColumn("_bucket", F.substring("_key", 1, _BUCKET_DIGITS))
    before = _bucket_counts(_keys(df, id_col, seed, by)).select(
        "_by", "_bucket", (F.col("_upto") - F.col("_n")).alias("_before")
    )
    within = Window.partitionBy("_by", "_bucket").orderBy("_key", F.col(id_col))
    return (
        keyed.join(before, ["_by", "_bucket"])
        .withColumn(name, F.row_number().over(within) + F.col("_before"))
        .select(*df.columns, name)
    )


def _classes_if_stratifiable(df: DataFrame, by: str, test_size: float) -> int:
    """Number of classes when each has two rows and fits on both sides, else 0."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    smallest, classes, rows = counts.agg(F.min("n"), F.count(F.lit(1)), F.sum("n")).first()
    if not rows or smallest < 2:
        return 0
    held_out = math.ceil(round(test_size * rows, 9))
    return classes if min(held_out, rows - held_out) >= classes else 0


def validation_flag(
    df: DataFrame,
    id_col: str = "id",
    label_col: str | None = None,
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SEED,
    max_labels: int = 200_000,
) -> DataFrame:
    """Add ``is_validation``: the first ``ceil(test_size * n)`` rows of each label.

    Without a label column, or when the labels are too few to stratify by, the
    whole table is one group; counting them is a pass when the query is built. Rows
    without a label are one more group. The last validation keys, one per label, are found when the
    query is built and broadcast; more than ``max_labels`` labels raise. Only ids and labels are shuffled: they give the last
    validation key of each label, and the rows are then compared with that key in
    place.
    """
    classes = _classes_if_stratifiable(df, label_col, test_size) if label_col else 0
    by = label_col if classes else None
    keys = _keys(df, id_col, seed, by)
    want = F.ceil(F.round(F.lit(test_size) * F.col("_total"), 9))
    last_bucket = (
        _bucket_counts(keys)
        .withColumn("_need", want - (F.col("_upto") - F.col("_n")))
        .where((F.col("_need") >= 1) & (F.col("_need") <= F.col("_n")))
        .select("_by", "_bucket", "_need")
    )
    within = Window.partitionBy("_by").orderBy("_key", "_id")
    last = (
        keys.join(last_bucket, ["_by", "_bucket"])
        .withColumn("_rank", F.row_number().over(within))
        .where(F.col("_rank") == F.col("_need"))
        .select(F.col("_by").alias("_cut_by"), F.col("_key").alias("_cut_key"),
                F.col("_id").alias("_cut_id"))
    )
    # One row per label: found once, then as good as a literal for every later pass.
    rows = collect_bounded(last, "labels to split by", max_labels)
    last = F.broadcast(df.sparkSession.createDataFrame(rows, last.schema))
    key = order_key(id_col, seed)
    return (
        df.withColumn("_own", _group(by))
        .join(last, F.col("_own") == F.col("_cut_by"), "left")
        .withColumn(
            "is_validation",
            F.coalesce(
                (key < F.col("_cut_key"))
                | ((key == F.col("_cut_key")) & (F.col(id_col) <= F.col("_cut_id"))),
                F.lit(False),
            ),
        )
        .select(*df.columns, "is_validation")
    )


def stratified_folds(
    df: DataFrame, id_col: str, label_col: str, folds: int, seed: int = fixed.SEED, name: str = "fold"
) -> DataFrame:
    """Add a fold number from 0; every label is spread evenly over the folds."""
    ranked = hashed_rank(df, id_col, label_col, seed, "_fold_rank")
    return ranked.withColumn(
        name, ((F.col("_fold_rank") - 1) % folds).cast("int")
    ).drop("_fold_rank")
