"""Exact top-k inner products by a vector-approximation file.

Every component is quantised into one of 256 cells of its dimension. A first scan reads the cells
alone and bounds each score from both sides by matrix products; per query, what cannot reach the
k-th best lower bound is out. The exact vectors of the rest are read in the order of their bounds:
first the most promising few, and then whatever can still beat or tie the k-th result so far, until
nothing can. The result is certain and exact.

Vectors that are equal after rounding share one entry of the file, with the k + 1 smallest ids, all
that a top-k with ties to smaller ids can need: a vector that many rows hold costs no more than one.
Queries are scanned in blocks of about ``QUERY_BLOCK``, each against all entries, many blocks in a job; what
follows takes all queries together.

A vector that is null or empty, or holds a null or non-finite component, takes no part, neither as
query nor as candidate. Rows that repeat an id count once, with the smallest vector. A query sees the
candidates of its own dimension. No vectors or no queries: no rows. Fewer than k candidates: all of
them. A score beyond the range of long is null, in its right place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nassaj.llm.staging import stage

QUERY_BLOCK = 1024
#: Blocks of queries that one job scans for; each is a broadcast of its own.
BLOCKS_A_JOB = 16
CELLS = 256
#: Vectors, smallest hashes first, whose quantiles cut the cells. Every vector is filed and bounded.
EDGE_SAMPLE = 4096
#: Entries of the file that a task bounds together.
SCAN_ROWS = 2048
FIRST_READ = 4


def rounded(vector: Column | str, scale: int) -> Column:
    """``floor(scale * x)`` of each component, or null where the vector takes no part."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when((F.size(v) > 0) & finite, F.transform(v, lambda x: F.floor(x.cast("double") * scale)))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """``entry, ids, vector``: each distinct vector once, with its k + 1 smallest ids; ``entry`` is the smallest."""
    by_id = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = by_id.withColumn("nth", first).where(F.col("nth") <= k + 1)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("entry"), "ids", "vector")


def _edges(file: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every cell, dimension by dimension."""
    spread = file.select(F.posexplode("vector").alias("d", "x")).groupBy("d").agg(F.min("x"), F.max("x")).collect()
    low, high = np.zeros((2, dim))
    for d, a, b in spread:
        low[d], high[d] = a, b
    sample = file.select("vector").orderBy(F.xxhash64("entry"), "entry").limit(EDGE_SAMPLE).collect()
    cuts = np.quantile(np.array([r[0] for r in sample], float), np.linspace(0, 1, CELLS + 1)[1:-1], axis=0).T
    upper = np.concatenate([np.floor(cuts), high[:, None]], axis=1)  # a cell holds (upper of the one before, upper]
    lower = np.concatenate([low[:, None], np.minimum(np.floor(cuts) + 1, high[:, None])], axis=1)
    return np.minimum(lower, upper), np.maximum(lower, upper)


def _file_cells(upper: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            v = np.array(df["vector"].tolist(), float).reshape(len(df), len(upper))
            cells = np.stack([np.searchsorted(u[:-1], v[:, d]) for d, u in enumerate(upper)], 1).astype(np.uint8)
            yield pd.DataFrame({"entry": df["entry"], "cells": [c.tobytes() for c in cells]})

    return run


def _scan(lower: np.ndarray, upper: np.ndarray, queries, k: int):
    """Entries that may be among a query's k + 1 best of what the task has seen, with their bounds."""
    dims, exact = np.arange(len(lower)), 2.0**52

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = queries.value
        plus, minus = np.maximum(q, 0).T, np.maximum(-q, 0).T
        best = np.full((len(ids), k + 1), -np.inf)
        for df in batches:
            for at in range(0, len(df), SCAN_ROWS):
                part = df.iloc[at : at + SCAN_ROWS]
                c = np.frombuffer(b"".join(part["cells"]), np.uint8).reshape(len(part), len(lower))
                lo, hi = lower[dims, c], upper[dims, c]
                top, bottom = hi @ plus - lo @ minus, lo @ plus - hi @ minus
                size = np.maximum(np.abs(lo), np.abs(hi)).sum(1).max() * np.abs(q).max()
                if size >= exact:  # room for what float sums lose
                    top, bottom = top + size * 2.0**-44, bottom - size * 2.0**-44
                seen = np.concatenate([best, bottom.T], 1)
                best = -np.partition(-seen, k, axis=1)[:, : k + 1]
                e, i = np.nonzero(top >= best[:, k])
                yield pd.DataFrame({
                    "query_id": ids[i], "entry": part["entry"].to_numpy()[e], "top": top[e, i], "bottom": bottom[e, i],
                })

    return run


def _exact(df: DataFrame, wide: bool) -> DataFrame:
    """``query_id, id, score`` of pairs whose vectors have been read."""
    kind = "decimal(38,0)" if wide else "bigint"
    product = F.zip_with("vector", "q", lambda a, b: (a.cast(kind) * b.cast(kind)).cast(kind))
    score = F.aggregate(product, F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))
    pairs = df.select("query_id", F.explode("ids").alias("id"), score.alias("score"))
    return pairs.where(F.col("id") != F.col("query_id"))


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scanned(cells: DataFrame, asking: DataFrame, bounds: tuple, k: int) -> DataFrame:
    """What the scan leaves of every query's entries; a job takes ``BLOCKS_A_JOB`` blocks of queries."""
    spark, blocks = cells.sparkSession, max(1, -(-asking.count() // QUERY_BLOCK))
    numbered = asking.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    written = []
    for first in range(0, blocks, BLOCKS_A_JOB):
        rows = defaultdict(list)
        for r in numbered.where(F.col("block").between(first, first + BLOCKS_A_JOB - 1)).collect():
            rows[r["block"]].append(r)
        scans = []
        for block in rows.values():
            queries = np.array([r["id"] for r in block], np.int64), np.array([r["vector"] for r in block], float)
            scan = _scan(*bounds, spark.sparkContext.broadcast(queries), k)
            scans.append(cells.mapInPandas(scan, "query_id bigint, entry bigint, top double, bottom double"))
        if scans:
            written.append(stage(reduce(DataFrame.unionAll, scans), "va-scan").staged_path)
    return spark.read.parquet(*written)


def _searched(file: DataFrame, cells: DataFrame, asking: DataFrame, bounds: tuple, k: int, wide: bool) -> DataFrame:
    """The results of all queries of one dimension. A task sends no more than it needs of a query's ranked rows."""
    found = _scanned(cells, asking, bounds, k)
    by_bottom = Window.partitionBy("query_id").orderBy(F.desc("bottom"))
    floors = (
        found.withColumn("nth", F.row_number().over(by_bottom)).where(F.col("nth") <= k + 1)
        .groupBy("query_id").agg(F.min("bottom").alias("floor"), F.count("*").alias("n"))
    )
    reaching = found.join(floors, "query_id").where((F.col("n") <= k) | (F.col("top") >= F.col("floor")))
    open_ = stage(reaching.select("query_id", "entry", "top"), "va-open")
    by_top = Window.partitionBy("query_id").orderBy(F.desc("top"), "entry")
    first = open_.withColumn("place", F.row_number().over(by_top)).where(F.col("place") <= FIRST_READ * (k + 1))
    first = stage(first.select("query_id", "entry"), "va-first")
    vectors = asking.select(F.col("id").alias("query_id"), F.col("vector").alias("q"))

    def read(some: DataFrame) -> DataFrame:
        return _exact(some.join(file, "entry").join(vectors, "query_id"), wide)

    begun = stage(_ranked(read(first), k).drop("rank"), "va-begun")
    kth = begun.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    left = open_.join(first, ["query_id", "entry"], "left_anti").join(kth, "query_id", "left")
    left = left.where((F.coalesce("n", F.lit(0)) < k) | (F.col("top") >= F.col("kth").cast("double")))
    everything = begun.unionByName(read(left.select("query_id", "entry")))
    return stage(_ranked(everything, k), "va-result")


def top_k(
    df: DataFrame, id: str, vector: str, is_query: Column, k: int = 10, scale: int = 1024
) -> DataFrame:
    """``query_id, rank, <id>, score`` for the rows where ``is_query`` holds, against all rows but their own."""
    spark = df.sparkSession
    source = df.select(F.col(id).cast("bigint").alias("id"), rounded(vector, scale).alias("vector"), is_query.alias("asks"))
    rows = source.where(F.col("vector").isNotNull() & F.col("id").isNotNull())
    file_all = stage(entries(rows, k), "va-file")
    asking = stage(rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector")), "va-queries")
    results = []
    for (dim,) in asking.select(F.size("vector")).distinct().collect():
        file = file_all.where(F.size("vector") == dim)
        bounds = _edges(file, dim)
        wide = float(np.abs(bounds).max()) ** 2 * dim >= 2.0**62
        cells = stage(file.select("entry", "vector").mapInPandas(_file_cells(bounds[1]), "entry bigint, cells binary"), "va-cells")
        own = asking.where(F.size("vector") == dim)
        results.append(_searched(file, cells, own, bounds, k, wide))
    columns = ["query_id bigint", "rank int", "id bigint", "score bigint"]
    if not results:
        return spark.createDataFrame([], ", ".join(columns)).withColumnRenamed("id", id)
    out = spark.read.parquet(*(r.staged_path for r in results))
    return out.select("query_id", "rank", F.col("id").alias(id), F.expr("try_cast(score AS bigint)").alias("score"))
