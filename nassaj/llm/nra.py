"""Ranked lexical search by NRA: impact-sorted lists, read in order, no random access.

Terms are runs of digits, ASCII letters (lowered) and characters beyond ASCII. A first read of the documents counts
them: N documents with a term, L terms in all, and df of every term asked for. A second read makes, in each task and
for so many postings at a time, the lists of the terms asked for, each sorted by impact, and answers every query on
them. Per document a lower bound holds what has been read of it, an upper bound adds the last impact read of each list
where it has not been met. Lists are read on, twice as far each time, until no unseen document and no seen one with an
open score can reach the k-th score, be it of these lists or of lists before: then members, ties and scores are final.
A task sends k rows per query; postings are neither shuffled nor written.

The score of a document sums ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over a query's distinct terms, with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + (90 * n * N) div L`` for its n terms.

Null and empty texts hold no term: as documents they are never found, as queries they find nothing. Every row is a
document, and every row a query, of its own, whether its id is null or repeated; equal scores go by id, null last.
Other columns are not looked at. Fewer than k documents with a score above 0: all of them. Empty tables: no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nassaj.llm.staging import stage

#: Characters of queries that go to the tasks together; more are further branches of the same job.
QUERY_CHARS = 1 << 24
#: Postings of a task that are sorted and searched together.
POSTINGS = 1 << 20
FIRST_READ = 16
#: A query's rows are ranked in so many groups before they meet.
GROUPS = 64

_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEPT).split() if text else []


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that reach the k-th score, or ``floor`` if that is more, and their final scores.

    ``lists`` hold documents and gains, gains falling; a document is at most once in a list.
    """
    low = np.zeros(documents, np.int64)
    longest = max((len(docs) for docs, _ in lists), default=0)
    read, depth = 0, FIRST_READ
    while True:
        for docs, gains in lists:
            low[docs[read:depth]] += gains[read:depth]
        kth = max(floor, 1, int(np.partition(low, -k)[-k]) if documents >= k else 0)
        last = [int(gains[depth - 1]) if depth < len(gains) else 0 for _, gains in lists]
        unread = sum(last)
        if unread < kth:  # no document that has not been met can enter
            rest = np.full(documents, unread)
            for (docs, _), gain in zip(lists, last, strict=True):
                if gain:
                    rest[docs[:depth]] -= gain
            able = low + rest >= kth
            if not rest[able].any():
                found = np.flatnonzero(able)
                return found, low[found]
        elif depth >= longest:
            found = np.flatnonzero(low >= kth)
            return found, low[found]
        read, depth = depth, 2 * depth


def _count(sent):
    """How many documents of the task hold each term, how many hold any (-1), and their terms in all (-2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value[0]
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                words = terms(text.as_py())
                if words:
                    counts[-1] += 1
                    counts[-2] += len(words)
                    counts.update(numbers[t] for t in numbers.keys() & set(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["term", "n"]
        )

    return run


class _Best:
    """The k best of each query in what a task has searched: scores, whether the id is null, ids."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.rows = k, [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))] * queries

    def floor(self, query: int) -> int:
        scores = self.rows[query][0]
        return int(scores[-1]) if len(scores) == self.k else 0

    def add(self, query: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        s, m, i = (np.concatenate(pair) for pair in zip(self.rows[query], (scores, missing, ids), strict=True))
        order = np.lexsort((i, m, -s))[: self.k]
        self.rows[query] = s[order], m[order], i[order]


def _search(sent, k: int, documents: int, length: int, weights: np.ndarray):
    def lists_of(term: list[int], doc: list[int], tf: list[int], sizes: list[int]):
        """Documents and impacts by term, impacts falling, and where each term begins."""
        t, d, f = np.array(term, np.int64), np.array(doc, np.int64), np.array(tf, np.int64)
        m = np.array([10 + 90 * n * documents // length for n in sizes], np.int64)
        impact = (1_000_000_000 * f) // (1000 * f + 8 * m[d])
        order = np.lexsort((d, -impact, t))
        return d[order], impact[order], np.searchsorted(t[order], np.arange(len(weights) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, queries = sent.value
        best = _Best(len(queries), k)
        term: list[int] = []
        doc: list[int] = []
        tf: list[int] = []
        sizes: list[int] = []
        keys: list[int | None] = []

        def answer() -> None:
            docs, impacts, begins = lists_of(term, doc, tf, sizes)
            missing = np.array([key is None for key in keys])
            ids = np.array([key or 0 for key in keys], np.int64)
            for q, (_, _, wanted) in enumerate(queries):
                lists = [(docs[begins[t] : begins[t + 1]], impacts[begins[t] : begins[t + 1]] * weights[t]) for t in wanted if begins[t] < begins[t + 1]]
                found, scores = nra(lists, len(keys), k, best.floor(q))
                best.add(q, scores, missing[found], ids[found])
            for kept in (term, doc, tf, sizes, keys):
                kept.clear()

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                words = terms(text.as_py())
                counts = Counter(words)
                held = numbers.keys() & counts.keys()
                if held:
                    term.extend(numbers[t] for t in held)
                    doc.extend([len(keys)] * len(held))
                    tf.extend(counts[t] for t in held)
                    sizes.append(len(words))
                    keys.append(key.as_py())
                if len(term) >= POSTINGS:
                    answer()
        if keys:
            answer()
        for (row, name, _), (scores, missing, ids) in zip(queries, best.rows, strict=True):
            if len(scores):
                same = [pa.array([x] * len(scores), pa.int64()) for x in (row, name)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(ids, mask=missing), pa.array(scores)], ["row", "item", "id", "score"])

    return run


def _found(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    """The k best of every task for some queries."""
    wanted = [(r["row"], r["item"], sorted(set(terms(r["text"])))) for r in rows]
    numbers = {t: i for i, t in enumerate(sorted({t for _, _, ts in wanted for t in ts}))}
    sent = docs.sparkSession.sparkContext.broadcast((numbers, [(row, item, [numbers[t] for t in ts]) for row, item, ts in wanted]))
    counted = docs.select("text").mapInArrow(_count(sent), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect()}  # a row per term asked for
    documents, length = counts.get(-1, 0), counts.get(-2, 0)
    if not documents:
        return None
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(numbers))]
    search = _search(sent, k, documents, length, np.array(weights, np.int64))
    return docs.mapInArrow(search, "row bigint, item bigint, id bigint, score bigint")


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text",
    k: int = 10,
) -> DataFrame:
    """``<item>, rank, <key>, score``: the k highest scores above 0 of every row of ``items``."""
    spark = docs.sparkSession
    corpus = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    asked = stage(items.select(
        F.monotonically_increasing_id().alias("row"), F.col(item).cast("bigint").alias("item"), F.col(query).alias("text")
    ), "nra-queries")
    blocks = -(-(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // QUERY_CHARS)
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).collect()
        more = _found(corpus, rows, k) if rows else None
        found = more if found is None else found.unionByName(more) if more is not None else found
    if found is None:
        found = spark.createDataFrame([], "row bigint, item bigint, id bigint, score bigint")
    group = F.pmod(F.xxhash64("id", "score"), F.lit(GROUPS))
    best = _ranked(_ranked(found.withColumn("group", group), k, "row", "group"), k, "row")
    return best.select(F.col("item").alias(item), "rank", F.col("id").alias(key), "score")
