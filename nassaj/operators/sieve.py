"""Sieves: which rows can be among a set of keys, told by one bit for every hash.

A sieve goes to all tasks as at most ``SIEVE_BITS / 64`` rows of 16 bytes, however many keys there are. Rows whose bit
is clear are surely not among the keys, and stay where they are; the few others are worth a join. A bit that several
keys share lets more rows through, so whatever follows has to be exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIEVE_BITS = 1 << 24


def _word(bit: Column) -> Column:
    return F.shiftright(bit, 6)


def sieve(keys: DataFrame, column: str, bits: int = SIEVE_BITS) -> DataFrame:
    """``word, marks``: 64 bits a row, the bits of all values of a bigint ``column`` set."""
    bit = F.pmod(F.col(column), F.lit(bits).cast("bigint"))
    marked = keys.select(_word(bit).alias("word"), (bit % 64).cast("int").alias("place"))
    return marked.select("word", F.expr("shiftleft(1L, place)").alias("mark")).groupBy("word").agg(F.bit_or("mark").alias("marks"))


def marked(df: DataFrame, column: str, keys: DataFrame, bits: int = SIEVE_BITS, name: str = "open") -> DataFrame:
    """``df`` with a boolean ``name``: false where the bigint ``column`` is surely not in that of ``keys``."""
    at, mark = "_word", "_marks"
    while {at, mark} & set(df.columns):
        at, mark = f"{at}_", f"{mark}_"
    bit = F.pmod(F.col(column), F.lit(bits).cast("bigint"))
    marks = F.broadcast(sieve(keys, column, bits).toDF(at, mark))  # at most bits / 64 rows
    told = df.withColumn(at, _word(bit)).join(marks, at, "left")
    is_set = F.getbit(mark, (bit % 64).cast("int")) == 1
    return told.withColumn(name, F.coalesce(is_set, F.lit(False))).select(*df.columns, name)
