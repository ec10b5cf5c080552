"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set is its distinct n-word shingles, ASCII letters lowered, as 64-bit hashes; with fewer
words than n the whole sequence is the one shingle; without words, or with null text, the set is
empty and links with nothing. Documents link when ``100 * common >= percent * union``.

1. Every set gets a 64-bit digest, its node; equal sets are one node from here on, however many rows hold
   it. Two different sets share a digest once in 2^64 pairs.
   The same pass counts all shingles into a sketch of ``SKETCH`` counters.
2. Shingles are ordered by count, rare first, ties by hash. Two sets that link share a shingle among
   their first ``size - ceil(percent * size) + 1``; only these are shuffled. A shingle with one node
   is dropped there, one with very many is dealt out in blocks. A task that meets a node again does not send it again.
3. Round one pairs each node with one pivot per shared shingle: as many pairs as rows, however large the group.
   Pairs pass the length and positional filters where they are made, and are made distinct. The sets of their
   nodes are made once, with profiles of about four shingles a bin for the suffix filter; what passes is verified
   once on the whole sets. Links give components.
4. Round two takes the shingles whose nodes still lie in different components, and pairs the nodes
   outside the shingle's main component with those of other components, in blocks: all that is left to find.

No link between components is missed; pairs inside a component found in round one are not needed.
``jaccard_links`` is the second mode: it makes every pair of nodes that share a prefix shingle, verifies each
once, and knows all links; as many as a group has pairs.

Rows are told apart by their text, not by their key: null and repeated keys lose no link. A component is named by its
smallest key, by null if all its keys are null. A row without words is a component of its own, named by its own
key. Repeated rows stay rows. Other columns are not looked at. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nassaj.llm.components import components
from nassaj.operators.sieve import marked
from nassaj.llm.staging import release, stage

SHINGLE, PERCENT = 5, 80
#: Counters of the sketch, kept in 64ths of an octave. The more shingles share a counter, the more documents one has to be
#: in to stand out: with 1,000 in each, about a hundred. Order stays common to all documents, so no link depends on it.
SKETCH = 1 << 22
CHUNK = 1 << 13
STEPS = 64
#: A shingle is dealt out in blocks from so many documents on, if they are as many times the mean of all counters.
HOT, HOT_MEANS = 1024, 4
#: About so many nodes of a shingle are a block.
BLOCK = 256


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(w))
    count = len(w) - size + 1
    h = np.full(count, size, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + count]
        h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def digest(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _profile(hashes: np.ndarray) -> list[int]:
    """How many hashes fall in each of equal ranges: a power of two of them, 64 at least, for about four hashes each."""
    bits = max(6, (len(hashes) // 4).bit_length())
    return np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).tolist()


_SUMMARY = "key string, print bigint, n bigint, node bigint, chunk int, counts binary"


def _summarise(n: int):
    """A row per document, and the task's part of the sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SKETCH, np.uint32)
        for df in batches:
            rows = []
            for key, mark, text in zip(df["key"], df["print"], df["text"], strict=True):
                h = shingles(text, n)
                np.add.at(counts, (h & np.uint64(SKETCH - 1)).astype(np.int64), 1)
                rows.append((key, mark, len(h), digest(h), None, None))
            yield pd.DataFrame(rows, columns=["key", "print", "n", "node", "chunk", "counts"])
        if counts.any():
            parts = counts.reshape(-1, CHUNK)
            packed = [p.astype("<u1" if p.max() < 1 << 8 else "<u4").tobytes() for p in parts]
            yield pd.DataFrame({
                "key": None, "print": None, "n": None, "node": None, "chunk": range(len(parts)), "counts": packed,
            })

    return run


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for df in batches:
        for chunk, data in zip(df["chunk"], df["counts"], strict=True):
            sums.setdefault(chunk, np.zeros(CHUNK, np.uint64))
            sums[chunk] += np.frombuffer(data, "<u1" if len(data) == CHUNK else "<u4")
    for chunk, total in sums.items():
        steps = np.floor(STEPS * np.log2(total + 1.0)).astype("<u2")
        yield pd.DataFrame({"chunk": [chunk], "counts": [steps.tobytes()], "total": [int(total.sum())]})


def _prefixes(n: int, percent: int, sketch, hot: float, size: int):
    """The first shingles of each set in the common order, with their places.

    ``block`` is 0 but for shingles in ``hot`` documents or more, whose nodes are dealt over blocks 1, 2, ..
    of about ``size``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for df in batches:
            keys, nodes, sizes, places, blocks = [], [], [], [], []
            for text in df["text"]:
                h = shingles(text, n)
                node = digest(h)
                if not len(h) or node in seen:
                    continue
                if len(seen) < 1_000_000:  # only spares sending a node twice
                    seen.add(node)
                steps = sketch.value[(h & np.uint64(SKETCH - 1)).astype(np.int64)]
                first = np.lexsort((h, steps))[: len(h) - (percent * len(h) + 99) // 100 + 1]
                found = 2.0 ** (steps[first] / STEPS)
                keys.append(h[first].view(np.int64))
                nodes.append(np.full(len(first), node))
                sizes.append(np.full(len(first), len(h)))
                places.append(np.arange(len(first)))
                blocks.append(np.where(found < hot, 0, 1 + node % np.ceil(found / size).astype(np.int64)))
            if keys:
                yield pd.DataFrame({
                    "shingle": np.concatenate(keys), "node": np.concatenate(nodes), "n": np.concatenate(sizes), "pos": np.concatenate(places),
                    "block": np.concatenate(blocks),
                })

    return run


_SETS = "node bigint, left boolean, right boolean, n int, bins array<smallint>, hashes binary"


def _sets(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            found = [shingles(t, n) for t in df["text"]]
            yield df[["node", "left", "right"]].assign(
                n=[len(h) for h in found], bins=[_profile(h) for h in found], hashes=[h.tobytes() for h in found]
            )

    return run


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            linked = []
            for a, b in zip(df["hashes_x"], df["hashes_y"], strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield df.loc[linked, ["x", "y"]]

    return run


def _may_link(percent: int, nx, px, ny, py):
    """Length filter, and positional filter for a pair's first common shingle."""
    need = percent * (nx + ny)  # common * (100 + percent) >= percent * (nx + ny)
    rest = F.least(nx - px, ny - py)
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (rest * (100 + percent) >= need)


def _overlap_bound(a: str, b: str) -> Column:
    """Suffix filter: sets parted by hash have at most the smaller count of each part in common."""

    def coarse(bins: str, other: str) -> Column:
        """Ranges of a finer profile are joined to those of the other."""
        width = (F.size(bins) / F.size(other)).cast("int")
        ranges = F.transform(F.sequence(F.lit(0), F.size(other) - 1), lambda i: F.aggregate(
            F.slice(bins, i * width + 1, width), F.lit(0), lambda s, x: s + x
        ))
        return F.when(width > 1, ranges).otherwise(F.col(bins).cast("array<int>"))

    return F.aggregate(F.zip_with(coarse(a, b), coarse(b, a), lambda p, q: F.least(p, q)), F.lit(0), lambda s, x: s + x)


class _Join:
    """``docs`` has ``key`` and ``text``; keys are text here, empty where null."""

    def __init__(self, docs: DataFrame, n: int, percent: int) -> None:
        self.n, self.percent, self.spark = n, percent, docs.sparkSession
        key = F.coalesce(F.col("key").cast("string"), F.lit(""))
        self.docs = docs.select(key.alias("key"), F.xxhash64("text").alias("print"), "text")
        summary = stage(self.docs.mapInPandas(_summarise(n), _SUMMARY), "jaccard-summary")
        self.rows = summary.where("chunk IS NULL").select("key", "print", "n", "node")
        parts = summary.where("chunk IS NOT NULL").select("chunk", "counts")
        sums = parts.repartition("chunk").mapInPandas(_add_up, "chunk int, counts binary, total bigint").collect()
        table = np.zeros(SKETCH, np.uint16)
        for r in sums:  # 2 * SKETCH bytes, whatever the input
            table[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], "<u2")
        self.hot = max(HOT, HOT_MEANS * sum(r["total"] for r in sums) / SKETCH)
        self.sketch = self.spark.sparkContext.broadcast(table)

    def shared(self) -> DataFrame:
        """Prefix rows whose shingle has more than one node, with the pivot of the shingle and block.

        The pivot is the node that has the shingle earliest: it has the fewest rare shingles, so of a group
        of near copies it is the one that the others were made from, or the closest to it.
        """
        rows = self.docs.select("text").mapInPandas(
            _prefixes(self.n, self.percent, self.sketch, self.hot, BLOCK), "shingle bigint, node bigint, n int, pos int, block int"
        )
        same = Window.partitionBy("shingle", "block")
        wide = rows.withColumns({
            "pivot": F.min(F.struct("pos", "node", "n")).over(same),
            "low": F.min("node").over(same), "high": F.max("node").over(same),
        })
        return stage(wide.where("low != high OR block > 0").drop("low", "high"), "jaccard-shared")

    def _near(self, a: str, b: str) -> Column:
        return _may_link(self.percent, F.col(f"{a}n"), F.col(f"{a}pos"), F.col(f"{b}n"), F.col(f"{b}pos"))

    def pivoted(self, shared: DataFrame) -> DataFrame:
        """Distinct pairs of a shingle's pivot and its other nodes; the blocks of a shingle have one pivot."""
        pivots = shared.where("block > 0").select("shingle", "block", "pivot").distinct()
        tops = pivots.groupBy("shingle").agg(F.min("pivot").alias("pivot"))
        tops = pivots.select("shingle", "block").join(tops, "shingle")
        hot = shared.where("block > 0").drop("pivot").join(tops, ["shingle", "block"])
        rows = shared.where("block = 0").unionByName(hot)
        pairs = rows.where((F.col("node") != F.col("pivot.node")) & self._near("", "pivot."))
        return pairs.select(F.col("pivot.node").alias("x"), F.col("node").alias("y")).distinct()

    def texts(self, nodes: DataFrame) -> DataFrame:
        """``nodes`` with one text of each. Only rows that pass a sieve of the nodes' fingerprints are moved."""
        named = self.rows.groupBy("node").agg(F.min(F.struct("key", "print")).alias("row"))
        wanted = stage(nodes.join(named, "node").select(*nodes.columns, "row.*"), "jaccard-wanted")
        some = marked(self.docs.where("text IS NOT NULL"), "print", wanted.select("print")).where("open")
        once = some.groupBy("key", "print").agg(F.first("text").alias("text"))
        return wanted.join(once, ["key", "print"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs of nodes, those that link."""
        sides = pairs.select(F.col("x").alias("node"), F.lit(True).alias("left")).unionByName(
            pairs.select(F.col("y").alias("node"), F.lit(False).alias("left"))
        )
        nodes = sides.groupBy("node").agg(F.max("left").alias("left"), F.max(~F.col("left")).alias("right"))
        sets = stage(self.texts(nodes).select("node", "left", "right", "text").mapInPandas(_sets(self.n), _SETS), "jaccard-sets")

        def side(which: str, end: str, *columns: str) -> DataFrame:
            return sets.where(which).select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

        need = (F.col("n_x") + F.col("n_y")) * self.percent
        passed = _overlap_bound("bins_x", "bins_y") * (100 + self.percent) >= need
        sized = pairs.join(side("left", "x", "n", "bins"), "x").join(side("right", "y", "n", "bins"), "y")
        open_ = stage(sized.where(passed).select("x", "y"), "jaccard-open")
        both = open_.join(side("right", "y", "hashes"), "y").join(side("left", "x", "hashes"), "x")
        linked = stage(both.mapInPandas(_verify(self.percent), "x bigint, y bigint"), "jaccard-links")
        for done in (open_, sets):
            release(done)
        return linked

    def labels(self) -> DataFrame:
        """``key, n, label`` of every row; the label is its component's, null without words."""
        shared = self.shared()
        first = stage(self.pivoted(shared), "jaccard-round1")
        links = self.links(first)
        second = stage(self.left_over(self.mixed(shared, components(links, "x", "y"))).join(first, ["x", "y"], "left_anti"), "jaccard-round2")
        for done in (shared, first):
            release(done)
        found = components(links.unionByName(self.links(second)), "x", "y")
        rows = self.rows.select("key", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        return rows.join(found, "node", "left").select("key", "n", F.coalesce("label", "node").alias("label"))

    def all_links(self) -> DataFrame:
        """Every pair of nodes that links, smaller node first."""
        shared = self.shared().drop("pivot", "block")
        sizes = shared.groupBy("shingle").agg(F.count("*").alias("k"))
        rows = shared.join(sizes, "shingle").withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "shingle"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select(
            "shingle", "node", "n", "pos", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        )
        a, b = rows.alias("a"), rows.alias("b")
        met = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("shingle", "low", "high")]
        once = (F.col("a.low") == F.col("a.high")) | (F.col("a.own") != F.col("b.own"))
        pairs = a.join(b, met[0] & met[1] & met[2] & once & self._near("a.", "b.") & (F.col("a.node") < F.col("b.node")))
        return self.links(stage(pairs.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).distinct(), "jaccard-pairs"))

    def mixed(self, shared: DataFrame, labels: DataFrame) -> DataFrame:
        """Prefix rows whose shingle has nodes of different components, with their own and the shingle's main one.

        ``blocks`` is over how many blocks the nodes outside the main component are dealt.
        """
        part = shared.select("shingle", "node", "n", "pos").join(labels, "node", "left")
        part = stage(part.select("shingle", "node", "n", "pos", F.coalesce("label", "node").alias("part")), "jaccard-parts")
        sizes = part.groupBy("shingle", "part").agg(F.count("*").alias("k"))
        main = sizes.groupBy("shingle").agg(
            F.max_by("part", F.struct("k", "part")).alias("main"), F.max("k").alias("most"), F.sum("k").alias("all")
        ).where("most < all")
        blocks = F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int")
        main = stage(main.select("shingle", "main", blocks.alias("blocks")), "jaccard-main")  # written, so that a large shingle's rows can be split
        return stage(part.join(main, "shingle"), "jaccard-mixed")

    def left_over(self, mixed: DataFrame) -> DataFrame:
        """Pairs across components that share a prefix shingle, smaller node first."""
        outside = mixed.where("part != main").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        every = mixed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        a, b = outside.alias("a"), every.alias("b")
        met = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.block") == F.col("b.block"))
        pairs = a.join(b, met & (F.col("a.part") != F.col("b.part")) & self._near("a.", "b."))
        return pairs.select(F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")).distinct()


def jaccard_labels(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``<key>, n_shingles, label`` of every row, keys as text (null: empty); rows of one component share a label.

    The label is null where the text has no words.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = _Join(rows, shingle, percent).labels()
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "label")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``<key>, n_shingles, component_id`` of every row; the component is named by its smallest key."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    found = stage(_Join(rows, shingle, percent).labels(), "jaccard-rows")
    found = found.withColumn("key", F.expr("nullif(key, '')").cast("bigint"))
    smallest = found.where("label IS NOT NULL").groupBy("label").agg(F.min("key").alias("component"))
    smallest = stage(smallest, "jaccard-names")  # a written side lets adaptive execution split a large component's rows
    own = F.when(F.col("label").isNull(), F.col("key")).otherwise(F.col("component"))
    return found.join(smallest, "label", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def jaccard_links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """All links, as two tables: rows and pairs.

    Rows: ``<key>, n_shingles, set_id, n_links`` of every row. Equal sets have one ``set_id``, null without words;
    ``n_links`` counts the other rows that link with the row, those of an equal set among them. Pairs: ``x, y``,
    each two different sets that link, once. Rows count as they are, with null and repeated keys too.
    """
    join = _Join(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle, percent)
    pairs = join.all_links()
    members = join.rows.where("n > 0").groupBy("node").agg(F.count("*").alias("members"))
    both = pairs.select("x", "y").unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    linked = both.join(members.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.sum("members").alias("far"))
    counts = members.join(linked.withColumnRenamed("x", "node"), "node", "left")
    counts = counts.select("node", (F.col("members") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    sets = join.rows.select("key", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(counts, "node", "left")
    rows = sets.select(
        F.expr("nullif(key, '')").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
        F.col("node").alias("set_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
    return rows, pairs
