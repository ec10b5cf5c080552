"""Tag known phrases: the built-in tagger where no model is plugged in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nassaj.functions.arrays import positions, unnest
from nassaj.functions.tokens import tokenize
from nassaj.operators.entities import PREDICTIONS, entity_groups
from nassaj.operators.sieve import marked


def _phrases(gazetteer: DataFrame, phrase_col: str, type_col: str) -> DataFrame:
    """``phrase, length, start, entity_type``, one row per phrase; ``start`` is its first token."""
    words = tokenize(F.col(phrase_col))
    parts = gazetteer.select(words.alias("words"), F.col(type_col).alias("entity_type"))
    return (
        parts.where(F.size("words") > 0)
        .select(F.array_join("words", " ").alias("phrase"), F.size("words").alias("length"), F.col("words")[0].alias("start"), "entity_type")
        .groupBy("phrase", "length", "start")
        .agg(F.min("entity_type").alias("entity_type"))
    )


def gazetteer_tags(
    df: DataFrame,
    gazetteer: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    phrase_col: str = "phrase",
    type_col: str = "entity_type",
) -> DataFrame:
    """``id, pos, token, tag`` of every token inside a known phrase.

    Where phrases overlap, a token belongs to the longest, then the earliest one;
    the first token of its phrase is tagged B-, the others I-. The plan is the same for any number of phrases: tokens that
    cannot begin one are dropped by a sieve of fixed size; the others are joined with the lengths of the phrases that begin so,
    and the runs of these lengths with the phrases. The longest phrase is found when the query is built.
    """
    known = _phrases(gazetteer, phrase_col, type_col)
    longest = known.agg(F.max("length")).first()[0] or 0
    starts = known.groupBy("start").agg(F.collect_set("length").alias("lengths"))
    tokens = df.select(id_col, tokenize(F.col(text_col)).alias("tokens"))
    runs = F.transform(positions(F.size("tokens")), lambda i: F.struct(
        i.alias("first"), F.get("tokens", i).alias("start"), F.slice("tokens", i + 1, F.lit(longest)).alias("run")
    ))
    placed = unnest(tokens, runs, id_col, name="at").select(id_col, "at.*").withColumn("_hash", F.xxhash64("start"))
    able = marked(placed, "_hash", starts.select(F.xxhash64("start").alias("_hash")), name="_open").where("_open")
    sized = able.select(id_col, "first", "start", "run").join(starts, "start")
    sized = unnest(sized, F.filter("lengths", lambda n: n <= F.size("run")), id_col, "first", "run", name="length")
    found = sized.select(id_col, "first", "length", F.array_join(F.slice("run", F.lit(1), F.col("length")), " ").alias("phrase")).join(
        known.drop("start"), ["phrase", "length"]
    )
    covered = unnest(
        found, F.split("phrase", " "), id_col, "length", "first", "entity_type", name="token", pos="offset"
    )
    best = F.max(F.struct(
        F.col("length"), (-F.col("first")).alias("order"), F.col("entity_type"), F.col("token")
    )).alias("best")
    pos = F.col("first") + F.col("offset")
    return covered.groupBy(id_col, pos.alias("pos")).agg(best).select(
        id_col, "pos", F.col("best.token").alias("token"),
        F.concat(
            F.when(F.col("pos") == -F.col("best.order"), F.lit("B-")).otherwise(F.lit("I-")),
            F.col("best.entity_type"),
        ).alias("tag"),
    )


def gazetteer_entities(
    df: DataFrame, gazetteer: DataFrame, id_col: str = "id", text_col: str = "text",
    phrase_col: str = "phrase", type_col: str = "entity_type", strategy: str = "simple",
) -> DataFrame:
    """``id, entities`` of the texts with a known phrase: groups as a tagger gives them, with score 1.

    ``start`` and ``end`` number tokens, not characters.
    """
    tags = gazetteer_tags(df, gazetteer, id_col, text_col, phrase_col, type_col)
    piece = F.struct(
        F.col("pos"), F.col("tag"), F.lit(1.0).alias("score"), F.col("token").alias("word"),
        F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.lit(False).alias("is_subword"),
    )
    rows = tags.groupBy(id_col).agg(F.array_sort(F.collect_list(piece)).alias("p"))
    pieces = F.transform("p", lambda p: F.struct(*[p[c].alias(c) for c in ("tag", "score", "word", "start", "end", "is_subword")]))
    return rows.select(id_col, entity_groups(pieces.cast(PREDICTIONS), strategy).alias("entities"))
