"""Mixture-controlled packing: deficit round-robin over source queues, a window at a time.

Each source is a queue of its documents, token by token. A window is ``window_tokens`` of the
output; in it every queue that still holds tokens earns its share of them, spends whole tokens and
carries the unspent fraction, its deficit, into the next window. What a queue has spent after ``w``
windows is therefore the floor of its earnings, a number that every task can compute alone: nothing
is handed from task to task, and the deficits reach over partitions as they reach over windows.
When a queue runs dry the others share its part from then on.

Windows follow one another without gaps and are cut into sequences of ``length`` tokens, so every
sequence but the last is full. Documents are cut at window and sequence ends only; a queue gives
long runs to each window, so most documents stay whole.

A document is its ids and the end id. Null text is an empty document: the end id alone. Null source
is a queue of its own. Repeated rows are packed as often as they come. No table, no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nassaj.llm import bpe
from nassaj.llm.staging import stage
from nassaj.operators.sizes import collect_bounded

LENGTH = 2048
MAX_SOURCES = 5_000
CACHED_COUNTS = 2_000_000
WINDOW_TOKENS = 64 * LENGTH
PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string"
)


class Mixture:
    """What each queue has spent after so many windows.

    ``totals`` are the tokens of each queue, ``weights`` its share (default: in proportion to the
    totals, so that all queues end together). Queues are in the order of their names, null first.
    """

    def __init__(self, totals: dict, weights: dict | None, window_tokens: int) -> None:
        self.names = sorted((s for s, n in totals.items() if n), key=lambda s: (s is not None, s or ""))
        self.totals = [int(totals[s]) for s in self.names]
        share = [Fraction(str((weights or totals).get(s, 0))) for s in self.names]
        if any(x <= 0 for x in share):
            raise ValueError("every source needs a weight above 0")
        self.window, self.total = window_tokens, sum(self.totals)
        self.index = {s: k for k, s in enumerate(self.names)}
        # Breakpoints: tokens put out when a queue runs dry, and what each has earned by then.
        self.breaks, self.earned = [Fraction(0)], [[Fraction(0)] * len(share)]
        self.rates: list[list[Fraction]] = []
        active = set(range(len(share)))
        while active:
            whole = sum(share[k] for k in active)
            rate = [share[k] / whole if k in active else Fraction(0) for k in range(len(share))]
            last = self.earned[-1]
            step = min((self.totals[k] - last[k]) / rate[k] for k in active)
            now = [a + r * step for a, r in zip(last, rate, strict=True)]
            self.rates.append(rate)
            self.breaks.append(self.breaks[-1] + step)
            self.earned.append(now)
            active -= {k for k in active if now[k] == self.totals[k]}
        self.cache: dict[int, list[int]] = {}
        self.last: dict[int, int] = {}

    def spent(self, w: int) -> list[int]:
        """Tokens that each queue has given to the first ``w`` windows."""
        if w not in self.cache:
            if len(self.cache) * len(self.names) > CACHED_COUNTS:
                self.cache.clear()
            at = Fraction(w * self.window)
            if at >= self.total:
                self.cache[w] = list(self.totals)
            else:
                k = bisect_right(self.breaks, at) - 1
                more = at - self.breaks[k]
                self.cache[w] = [int(e + r * more) for e, r in zip(self.earned[k], self.rates[k], strict=True)]
        return self.cache[w]

    def window_of(self, queue: int, position: int) -> int:
        """The window that takes a queue's token; sought from the last one found, in doubling steps."""
        low = self.last.get(queue, 0)
        if self.spent(low)[queue] > position:
            low = 0
        step = 1
        while self.spent(low + step)[queue] <= position:
            low, step = low + step, 2 * step
        high = low + step
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.spent(mid)[queue] <= position else (low, mid)
        self.last[queue] = low
        return low

    def runs(self, source, position: int, count: int) -> Iterator[tuple[int, int]]:
        """Places in the output of a queue's tokens, as runs ``(place, length)``."""
        queue = self.index[source]
        w = self.window_of(queue, position)
        while count:
            before, after = self.spent(w), self.spent(w + 1)
            n = min(count, after[queue] - position)
            if n > 0:
                yield sum(before) + sum(after[:queue]) - sum(before[:queue]) + position - before[queue], n
                position, count = position + n, count - n
            w += 1


def _encode(path: str, end_id: int, key: str):
    """Ids of each document, and how many tokens of its source the task has met before it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = bpe.encoder(path)
        met: dict = {}
        kind = "<u2" if max(len(enc.tokens) - 1, end_id) < 1 << 16 else "<u4"
        for df in batches:
            packed, sizes, before = [], [], []
            for text, source in zip(df["text"], df["source"], strict=True):
                ids = np.append(enc.long(text or ""), end_id).astype(kind)
                packed.append(ids.tobytes())
                sizes.append(len(ids))
                before.append(met.get(source, 0))
                met[source] = before[-1] + len(ids)
            yield pd.DataFrame({
                "key": df["key"], "source": df["source"], "part": df["part"], "ids": packed, "n": sizes,
                "before": before,
            })

    return run


def _place(mixture: Mixture, length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows: list[tuple] = []
            for key, source, data, n, at in zip(df["key"], df["source"], df["ids"], df["n"], df["at"], strict=True):
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                start = 0
                for place, count in mixture.runs(source, int(at), int(n)):
                    while count:
                        sequence, offset = divmod(place, length)
                        size = min(count, length - offset)
                        crc = zlib.crc32(ids[start : start + size].tobytes())
                        rows.append((key, start, size, crc, n, sequence, offset, source))
                        start, place, count = start + size, place + size, count - size
            yield pd.DataFrame(rows, columns=["key", *(f.split()[0] for f in PIECES.split(", "))])

    return run


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: dict | None = None, length: int = LENGTH, window_tokens: int = WINDOW_TOKENS, end_id: int = 1,
    max_sources: int = MAX_SOURCES,
) -> DataFrame:
    """One row per piece: the key, where the piece starts in its document and its length, the CRC-32
    of its ids, the document's tokens, sequence and offset, and the source.

    The ids are written once to the shared folder; sums over the written parts, one row for each
    source and part, give each part its place in the queues. Every task knows all queues, so more than
    ``max_sources`` of them raise.
    """
    # Keys go through Python as text: numbers with nulls among them would lose digits there.
    rows = docs.select(
        F.col(key).cast("string").alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"),
        F.spark_partition_id().alias("part"),
    )
    ids_schema = T.StructType([
        rows.schema["key"], T.StructField("source", T.StringType()), T.StructField("part", T.IntegerType()),
        T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("before", T.LongType()),
    ])
    ids = stage(rows.mapInPandas(_encode(path, end_id, key), ids_schema), "packing-ids")
    sums = stage(ids.groupBy("source", "part").agg(F.sum("n").alias("tokens")), "packing-sums")
    per_source = sums.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    totals = {r["source"]: r["tokens"] for r in collect_bounded(per_source, "sources", max_sources)}
    mixture = Mixture(totals, weights, window_tokens)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("s"), F.col("part").alias("p"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"),
    )
    placed = ids.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "key", "source", "ids", "n", (F.col("base") + F.col("before")).alias("at")
    )
    pieces = placed.mapInPandas(_place(mixture, length), "key string, " + PIECES)
    return pieces.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)
