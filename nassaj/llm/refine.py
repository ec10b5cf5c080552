"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole text.

Texts are equal when identical after lower-casing A-Z alone. Only texts of one length and one beginning can be equal, so
a first read takes both, which needs no more than ``PREFIX`` characters of a text, and counts them. Pairs of length and
beginning that occur more than once are marked in a sieve of ``SIEVE_BITS`` bits, one bit for each by its hash. The second
read hashes the whole text only where that bit is set, and only these rows are shuffled, as hashes. Two pairs can share
a bit: then a text that is alone is hashed in full and found alone there, so the result does not depend on the size
of the sieve.

Equal texts are counted in ``PARTS`` parts of a group, then over the parts, so that no task gets a large group whole.

Null texts count as empty, and all empty texts are equal. Of equal texts the row with the largest key stays; null
keys come before all others, and of rows that repeat the key as well exactly one stays. Every row is in the result,
whatever its other columns hold. No rows: no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.operators.sieve import SIEVE_BITS, marked
from nassaj.llm.staging import stage

PREFIX = 128
PARTS = 64


def normalised(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def exact_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", digest_all: bool = False, bits: int = SIEVE_BITS
) -> DataFrame:
    """``<key>, keep_id, group_size, kept, text_sha256`` of every row.

    ``text_sha256`` is that of the normalised text, null where no full hash was needed unless ``digest_all``.
    """
    docs = df.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("pair", F.xxhash64(F.length("text"), normalised(F.substring("text", 1, PREFIX))))
    shared = docs.groupBy("pair").count().where("count > 1")
    full = F.unhex(F.sha2(normalised(F.col("text")), 256))
    rows = stage(
        marked(docs, "pair", shared, bits).select(
            F.monotonically_increasing_id().alias("row"), "key", "open",
            (full if digest_all else F.when(F.col("open"), full)).alias("hash"),
        ),
        "refine-rows",
    )
    same = rows.where("open").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)))
    parts = same.groupBy("hash", "part").agg(F.count("*").alias("n"), F.max(F.struct("key", "row")).alias("last"))
    groups = parts.groupBy("hash").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    told = parts.select("hash", "part").join(groups.where("n > 1"), "hash")
    judged = same.join(told, ["hash", "part"], "left").select(
        "key", F.when(F.col("last").isNull(), F.col("key")).otherwise(F.col("last.key")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"), "hash",
    )
    alone = rows.where("NOT open").select(
        "key", F.col("key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "hash"
    )
    return judged.unionByName(alone).select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("hash")).alias("text_sha256")
    )
