"""Per-text statistics as columns and their roll-up over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.arrays import let, unnest
from nassaj.functions.tokens import tokenize


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _letters(c: Column) -> Column:
    return F.length(F.regexp_replace(_text(c), fixed.WHITESPACE + "+", ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def word_count(c: Column) -> Column:
    return F.size(tokenize(c))


def char_count(c: Column) -> Column:
    """Code points, not bytes."""
    return F.length(_text(c))


def avg_word_length(c: Column) -> Column:
    return _ratio(_letters(c), word_count(c))


def arabic_char_ratio(c: Column) -> Column:
    arabic = F.length(F.regexp_replace(_text(c), fixed.NOT_ARABIC, ""))
    return _ratio(arabic, char_count(c))


def unique_word_count(c: Column) -> Column:
    return F.size(F.array_distinct(tokenize(c)))


def lexical_diversity(c: Column) -> Column:
    return let(tokenize(c), lambda w: _ratio(F.size(F.array_distinct(w)), F.size(w)))


def summary(c: Column) -> Column:
    """All six statistics as one struct; ratios are rounded to 2, 4 and 4 places.

    Rounding is half-up on the decimal form, so a tie such as 2.675 may end one
    unit away from a rounding of the binary value.
    """

    def counted(n: Column) -> Column:
        return F.struct(
            n["words"].alias("word_count"),
            char_count(c).alias("char_count"),
            F.round(_ratio(_letters(c), n["words"]), 2).alias("avg_word_length"),
            F.round(arabic_char_ratio(c), 4).alias("arabic_char_ratio"),
            n["distinct"].alias("unique_words"),
            F.round(_ratio(n["distinct"], n["words"]), 4).alias("lexical_diversity"),
        )

    sizes = let(
        tokenize(c),
        lambda w: F.struct(
            F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct")
        ),
    )
    return let(sizes, counted)


#: Binary logarithm of a sketch's size: estimates are within 2 % of the distinct words 19 times in 20.
SKETCH_SIZE = 14
_SUMS = ("n_words", "n_letters", "n_chars", "n_arabic")


def _text_and_words(df: DataFrame, text_column: str, by: str) -> DataFrame:
    """``_by, word`` and sums: one row with the text's own sums, and one without for each of its distinct words."""
    text = F.col(text_column)
    per_text = df.select(F.col(by).alias("_by"), tokenize(text).alias("words"), _letters(text).alias("letters"),
                         char_count(text).alias("chars"), arabic_char_ratio(text).alias("arabic"))
    nothing = F.lit(None).cast("bigint")
    own = F.struct(
        F.lit(None).cast("string").alias("word"), F.size("words").cast("bigint").alias("n_words"),
        F.col("letters").cast("bigint").alias("n_letters"), F.col("chars").cast("bigint").alias("n_chars"),
        F.col("arabic").cast("double").alias("n_arabic"),
    )
    words = F.transform(F.array_distinct("words"), lambda w: F.struct(
        w.alias("word"), nothing.alias("n_words"), nothing.alias("n_letters"), nothing.alias("n_chars"),
        F.lit(None).cast("double").alias("n_arabic"),
    ))
    return unnest(per_text, F.concat(F.array(own), words), "_by", name="w").select("_by", "w.*")


def _described(sums: DataFrame, by: str, unique_words: Column) -> DataFrame:
    return sums.select(
        F.col("_by").alias(by), "documents", F.col("n_words").alias("words"), F.col("n_chars").alias("chars"),
        _ratio(F.col("n_letters"), F.col("n_words")).alias("avg_word_length"),
        (F.col("n_arabic") / F.col("documents")).alias("avg_arabic_char_ratio"),
        unique_words.alias("unique_words"), _ratio(unique_words, F.col("n_words")).alias("lexical_diversity"),
    )


def corpus_summary(df: DataFrame, text_column: str, by: str) -> DataFrame:
    """The statistics of every group of texts, including its distinct words.

    Texts are read once. Words are reduced to the distinct ones of their text before the shuffle,
    and exchanged by (group, word), so one large group is spread over all tasks; the texts' own
    sums travel with them, added up in each task first.
    """
    rows = _text_and_words(df, text_column, by)
    by_word = rows.groupBy("_by", "word").agg(F.count("n_words").alias("documents"), *[F.sum(c).alias(c) for c in _SUMS])
    sums = by_word.groupBy("_by").agg(
        F.sum("documents").alias("documents"), *[F.sum(c).alias(c) for c in _SUMS], F.count("word").alias("unique")
    )
    return _described(sums, by, F.col("unique"))


def partial_summary(df: DataFrame, text_column: str, by: str) -> DataFrame:
    """Statistics of one part of a corpus, such as a day's, to be kept and merged with others by :func:`merged_summary`.

    Sums are exact; the distinct words are in a sketch of at most 2^``SKETCH_SIZE`` bytes, so that no word is shuffled. Groups
    are kept in the column ``by``.
    """
    rows = _text_and_words(df, text_column, by)
    return rows.groupBy(F.col("_by").alias(by)).agg(
        F.count("n_words").alias("documents"), *[F.sum(c).alias(c) for c in _SUMS], F.hll_sketch_agg("word", SKETCH_SIZE).alias("words_sketch")
    )


def merged_summary(parts: DataFrame, by: str) -> DataFrame:
    """The columns of :func:`corpus_summary` from the rows of any number of parts; ``unique_words`` is an estimate."""
    sums = parts.groupBy(F.col(by).alias("_by")).agg(
        F.sum("documents").alias("documents"), *[F.sum(c).alias(c) for c in _SUMS], F.hll_union_agg("words_sketch").alias("sketch")
    )
    return _described(sums, by, F.hll_sketch_estimate("sketch"))
