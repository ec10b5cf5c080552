"""Inputs of the registered queries, derived from the given tables.

The tables hold no Arabic text, so ``documents`` is respelled letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nassaj.functions.arrays import let
from nassaj.functions.blocks import blocks, list_lengths
from nassaj.operators.entities import PREDICTIONS
from nassaj.operators.sizes import spread

# --- fixed values: the respelling of Latin letters, digits and marks ------------
LATIN = "abcdefghijklmnopqrstuvwxyz0123456789,?;"
ARABIC = "أبةدَفإهيوكلمنـتقرسطعآشصاذ" + "".join(map(chr, range(0x0660, 0x066A))) + "،؟؛"

PIECE = 5  # letters per subword piece


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, text``, on all cores."""
    return spread(table(spark, sf_dir, "documents", "doc_id", "lang", "text"))


def respell(c: Column) -> Column:
    return F.translate(F.lower(c), LATIN, ARABIC)


def respelled(word: str) -> str:
    return word.lower().translate(str.maketrans(LATIN, ARABIC))


def docs_ar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, text`` in Arabic letters."""
    return documents(spark, sf_dir).select("doc_id", "lang", respell(F.col("text")).alias("text"))


def labelled(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """``id, text, label`` of the labelled documents."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", target)
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col(target).cast("string").alias("label")
    )


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, truth, prediction``: event types, guessed as ``error`` for large values."""
    guess = F.when(F.col("value") > 10, F.lit("error")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("truth"), guess.alias("prediction")
    )


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("label"), F.col("value").alias("score")
    )


def tagged(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """``id, tokens, truth, prediction``: numbers and capitalized runs as entities.

    The prediction misses every 7th token and mistakes the tag head of every 11th. ``ordered`` rows are in the order of
    their ids; the texts are put in order, not the longer arrays made of them.
    """

    def kind(t: Column) -> Column:
        return (
            F.when(t.rlike(r"\A[0-9]+\z"), F.lit("NUM"))
            .when(t.rlike(r"\A\p{Lu}"), F.lit("CAP"))
            .otherwise(F.lit("O"))
        )

    def tags(kinds: Column) -> Column:
        return F.transform(kinds, lambda k, i: F.when(k == "O", k).otherwise(F.concat(
            F.when((k == "CAP") & F.coalesce(F.get(kinds, i - 1) == "CAP", F.lit(False)), F.lit("I-"))
            .otherwise(F.lit("B-")),
            k,
        )))

    def guess(t: Column, i: Column) -> Column:
        return (
            F.when(i % 7 == 6, F.lit("O"))
            .when(i % 11 == 10, F.regexp_replace(t, "^B-", "I-"))
            .otherwise(t)
        )

    docs = table(spark, sf_dir, "documents", "doc_id", "text").orderBy("doc_id") if ordered else documents(spark, sf_dir)
    docs = docs.select(F.col("doc_id").alias("id"), F.split("text", " ").alias("tokens"))
    docs = docs.withColumn("truth", let(F.transform("tokens", kind), tags))
    return docs.withColumn("prediction", F.transform("truth", guess))


def word_ids(tokens: Column) -> Column:
    """The word of every piece: a piece per five letters, special pieces at both ends."""
    edge = F.array(F.lit(None).cast("int"))
    repeated = F.flatten(F.transform(
        tokens,
        lambda t, i: F.array_repeat(i, F.floor(F.length(t) / PIECE).cast("int") + 1),
    ))
    return F.concat(edge, repeated, edge)


def subword_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, word_ids, tags``."""
    return tagged(spark, sf_dir).select(
        "id", word_ids(F.col("tokens")).alias("word_ids"), F.col("truth").alias("tags")
    )


def _pieces(tokens: pa.Array, tags: pa.Array) -> pa.Array:
    """Pieces of some texts: the bytes of all their tokens, cut at every fifth letter of a token."""
    lengths, words = list_lengths(tokens), tokens.flatten()
    starts = np.append(0, np.cumsum(lengths))
    data = np.frombuffer(b"" if not len(words) else pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")[0].as_buffer(), np.uint8)
    letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each begins, and the end
    size = pc.utf8_length(words).to_numpy().astype(np.int64)
    many = np.maximum(size - 1, 0) // PIECE + 1
    ends = np.append(0, np.cumsum(many))
    word = np.repeat(np.arange(len(words)), many)
    j = np.arange(len(word)) - ends[word]
    cuts = np.append(letters[(np.cumsum(size) - size)[word] + j * PIECE], len(data)).astype(np.int32)
    text = pa.StringArray.from_buffers(len(word), pa.py_buffer(cuts), pa.py_buffer(data))
    mark = pa.array(["", "##"]).take(pa.array((j > 0).astype(np.int8)))
    start = (word - np.repeat(starts[:-1], lengths)[word]) * 1000 + j * PIECE
    pieces = pa.StructArray.from_arrays([
        pc.if_else(pa.array(j % 2 == 1), "O", tags.flatten().take(pa.array(word))),
        pa.array(1.0 / (size[word] + j + 1)),
        pc.binary_join_element_wise(mark, text, ""),
        pa.array(start, pa.int32()),
        pa.array(start + np.minimum(size[word] - j * PIECE, PIECE), pa.int32()),
        pa.array(j > 0),
    ], ["tag", "score", "word", "start", "end", "is_subword"])
    return pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), pieces, mask=tokens.is_null())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            ids, tokens, tags = batch.slice(*block).columns
            yield pa.RecordBatch.from_arrays([ids, _pieces(tokens, tags)], ["id", "pieces"])


def piece_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, pieces``: tokens cut into pieces; every second piece of a token is untagged."""
    df = tagged(spark, sf_dir).select("id", "tokens", "truth")
    pieces = T.StructField("pieces", T.DataType.fromDDL(PREDICTIONS))
    return df.mapInArrow(_cut, T.StructType([df.schema["id"], pieces]))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, truth, prediction``: each turn of a conversation and the turn after it."""
    turns = spread(table(spark, sf_dir, "conversations", "conv_id", "turn", "text"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction"))
    return turns.join(after, ["conv_id", "turn"]).select(
        F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("text").alias("truth"), "prediction"
    )


def benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``phrase, entity_type``: the sentences of the benchmark passages."""
    sentences = F.explode(F.split("text", r"[.!?\n]+")).alias("phrase")
    return table(spark, sf_dir, "benchmark").select(
        sentences, F.when(F.col("item_id") % 2 == 0, F.lit("EVEN")).otherwise(F.lit("ODD")).alias("entity_type")
    )
