"""Placement by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size: from an offset, on
by a fixed skip. The shards take turns; each claims the first slot of its order that is free, until
none is. Slots are even to within one per shard (to within the weights, if given), and when a shard
comes or goes few other slots change hands. A key goes to the shard that holds its hashed slot.

The table has ``slots`` rows, a parameter, whatever the input; it is broadcast, and each row is placed
by one hash and one probe. No row moves. Equal keys go to the same shard, so a repeated key is as hot
as it is; give ``salt`` (a second column) to spread the rows of a hot key. Null keys and salts count as
empty strings. Other columns are kept as they are; a column named like a result is replaced by it.
"""

from __future__ import annotations

from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 65_537
FILE_BYTES = 128 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """The shard, by its place in ``shards``, that holds each slot.

    A shard of weight w takes w turns in a round.
    """
    if not _is_prime(slots):
        raise ValueError("the number of slots has to be prime")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, at least one and at most one per slot")
    orders = []
    for name in shards:
        h = md5(name.encode()).hexdigest()
        orders.append([int(h[:15], 16) % slots, int(h[16:31], 16) % (slots - 1) + 1])
    turns = [k for k, name in enumerate(shards) for _ in range((weights or {}).get(name, 1))]
    if not turns:
        raise ValueError("every shard has weight 0")
    table, free = [-1] * slots, slots
    while True:
        for k in turns:
            at, skip = orders[k]
            while table[at] >= 0:
                at = (at + skip) % slots
            table[at] = k
            orders[k][0] = (at + skip) % slots
            free -= 1
            if not free:
                return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    """``slot, shard`` of every slot."""
    holders = ",".join(map(str, fill(shards, slots, weights)))
    names = F.array(*map(F.lit, shards))
    holder = F.split(F.lit(holders), ",")[F.col("id").cast("int")].cast("int")
    return spark.range(slots).select(F.col("id").alias("slot"), names[holder].alias("shard"))


def slot(key: Column | str, slots: int = SLOTS, salt: Column | str | None = None) -> Column:
    """The slot of a key: 60 bits of the MD5 of its text."""

    def text(c: Column | str) -> Column:
        return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))

    whole = text(key) if salt is None else F.concat_ws("\0", text(key), text(salt))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("bigint") % slots


def place(
    df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None,
    salt: str | None = None,
) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``."""
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    rows = df.select(*(df[c] for c in kept), slot(df[key], slots, df[salt] if salt else None).alias("slot"))
    return rows.join(F.broadcast(lookup(df.sparkSession, shards, slots, weights)), "slot").select(*kept, "slot", "shard")


def _bytes(df: DataFrame) -> Column:
    """About what a row takes: its values as text, nested ones as JSON."""
    texts = [
        F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name).cast("string")
        for f in df.schema
    ]
    return reduce(Column.__add__, [F.coalesce(F.octet_length(t), F.lit(0)).cast("bigint") for t in texts])


def write(placed: DataFrame, path: str, files_per_shard: int | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Write placed rows as one folder per shard, ``files_per_shard`` files at most in each.

    If not given, a shard has a file for every ``file_bytes`` of its rows as text, which reads ``placed`` once more.
    Rows are dealt by a hash of all their columns, so a hot key is spread over the files of its shard, and a task that
    is run again deals as before. Rows that are equal in every column lie in one file.
    """
    part, files, many = "_part_of_shard", "_files_of_shard", []
    rows = placed.withColumn(files, F.lit(files_per_shard).cast("bigint"))
    if not files_per_shard:
        size = F.sum(_bytes(placed))
        counts = placed.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(size / file_bytes)).cast("bigint").alias(files)).collect()
        many = [max(1, sum(r[files] for r in counts))]  # a row per shard
        rows = placed.join(F.broadcast(placed.sparkSession.createDataFrame(counts, f"shard string, {files} bigint")), "shard")
    whole = [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in placed.schema]
    rows = rows.withColumn(part, F.pmod(F.xxhash64(*whole), F.col(files)))
    rows.repartition(*many, "shard", part).drop(part, files).write.partitionBy("shard").parquet(path)
