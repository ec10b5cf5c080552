"""Summaries made of a text's own sentences: the built-in provider for Z3."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.arrays import unnest
from nassaj.functions.tokens import tokenize
from nassaj.operators.tfidf import TfidfModel

SENTENCE_END = r"[.!?؟\n]+"


def sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, pos, sentence`` with words separated by single spaces; empty ones left out."""
    pieces = F.split(F.coalesce(F.col(text_col), F.lit("")), SENTENCE_END)
    spaced = F.transform(pieces, lambda s: F.array_join(tokenize(s), " "))
    return unnest(df, F.filter(spaced, lambda s: s != ""), id_col, name="sentence", pos="pos")


def extractive_summary(
    df: DataFrame,
    model: TfidfModel,
    id_col: str = "id",
    text_col: str = "text",
    max_sentences: int = 3,
    max_words: int = fixed.SUMMARY_MAX_TARGET,
) -> DataFrame:
    """``id, summary``: the best sentences in text order, cut at ``max_words`` words.

    A sentence scores the mean weight (1 + ln tf) * idf of its distinct known terms.
    Every task keeps only its best rows of each text before the shuffle.
    """
    scored = model.raw_weights(sentences(df, id_col, text_col), "sentence").select(
        id_col, "pos", "sentence",
        F.round(
            F.when(
                F.size("weights") > 0,
                F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w) / F.size("weights"),
            ).otherwise(F.lit(0.0)),
            9,
        ).alias("score"),
    )
    best_first = Window.partitionBy(id_col).orderBy(F.desc("score"), "pos")
    chosen = (
        scored.withColumn("_rank", F.row_number().over(best_first))
        .where(F.col("_rank") <= max_sentences)
        .groupBy(id_col)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "sentence"))).alias("_rows"))
    )
    words = F.split(F.array_join(F.col("_rows.sentence"), " "), " ")
    return chosen.select(id_col, F.array_join(F.slice(words, 1, max_words), " ").alias("summary"))
