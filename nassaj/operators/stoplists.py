"""Stopword removal with a list too long for an expression (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.arrays import unnest
from nassaj.functions.clean import CleanConfig
from nassaj.operators.sieve import marked

#: Lists up to this length go to the tasks as a part of the plan.
MAX_INLINE = 10_000


def remove_listed_tokens(
    df: DataFrame, stopwords: DataFrame, tokens_col: str = "tokens", word_col: str = "word", max_inline: int = MAX_INLINE
) -> DataFrame:
    """``df`` with listed and one-character tokens out of its token arrays, in order.

    Rows stay one to one and keep all columns. The list is counted when the query is built. One of at most ``max_inline``
    words is looked up where the rows are, in one narrow pass. Of a longer one no task holds all: only tokens that pass a sieve of the list, of fixed size
    however long the list is, are sent to the join with it; those found come back as a short array, and the
    row's tokens are filtered against it in place. A null array stays null.
    """
    longer = F.filter(tokens_col, lambda t: F.length(t) > 1)
    listed = stopwords.select(F.col(word_col).alias("_token")).where(F.col("_token").isNotNull()).distinct()
    few = [r["_token"] for r in listed.limit(max_inline + 1).collect()]
    if len(few) <= max_inline:
        kept = F.filter(longer, lambda t: ~t.isin(few)) if few else longer
        return df.withColumn(tokens_col, kept).select(*df.columns)
    key = F.sha2(F.to_json(F.struct(F.col(tokens_col).alias("t"))), 256)
    hashed = unnest(df.select(key.alias("_key"), F.array_distinct(longer).alias("_t")), F.col("_t"), "_key", name="_token")
    hashed = hashed.withColumn("_hash", F.xxhash64("_token"))
    able = marked(hashed, "_hash", listed.select(F.xxhash64("_token").alias("_hash")), name="_open").where("_open")
    hits = able.join(listed, "_token", "left_semi").groupBy("_key").agg(F.collect_set("_token").alias("_listed"))
    none = F.coalesce("_listed", F.array().cast("array<string>"))
    return (
        df.withColumn("_key", key).join(hits, "_key", "left")
        .withColumn(tokens_col, F.filter(longer, lambda t: ~F.array_contains(none, t)))
        .select(*df.columns)
    )


def normal_words(words: DataFrame, config: CleanConfig, word_col: str = "word") -> DataFrame:
    """The list with its letters rewritten as cleaning does."""
    word = F.col(word_col)
    if config.normalize_alef:
        word = F.translate(word, fixed.ALEF_FORMS, fixed.ALEF * len(fixed.ALEF_FORMS))
    if config.normalize_teh_marbuta:
        word = F.translate(word, fixed.TEH_MARBUTA, fixed.HEH)
    return words.select(word.alias(word_col)).distinct()
