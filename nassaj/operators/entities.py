"""Group token predictions of a tagger into entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from nassaj.functions.arrays import let, positions

STRATEGIES = ("none", "simple", "first")
OUTSIDE = "O"
PREDICTIONS = (
    "array<struct<tag:string,score:double,word:string,start:int,end:int,is_subword:boolean>>"
)


def _kind(tag: Column) -> Column:
    return F.regexp_replace(tag, "^[BI]-", "")


def _joined(run: Column) -> Column:
    """Words with spaces between; continuation pieces are attached."""
    return F.replace(F.array_join(F.transform(run, lambda p: p["word"]), " "), F.lit(" ##"), F.lit(""))


def _runs(pieces: Column, starts: Callable[[Column], Column], whole_words: bool) -> Column:
    """The groups of words that begin at ``starts``; a word has the tag and score of its first piece.

    Where neither a word nor the one before it is tagged, types are not compared, and words are joined
    in the groups that stay only.
    """

    def grouped(p: Column, tags: Column, s: Column) -> Column:
        def tag(k: Column) -> Column:
            return F.get(tags, F.get(s, k))

        def opens(at: Column, k: Column) -> Column:
            cur, prev = F.get(tags, at), tag(k - 1)
            return (k == 0) | (((cur != OUTSIDE) | (prev != OUTSIDE)) & (
                F.startswith(cur, F.lit("B-")) | (_kind(cur) != _kind(prev))
            ))

        def begin(k: Column) -> Column:
            return F.coalesce(F.get(s, k), F.size(p))

        def words(k: Column, n: Column) -> Column:
            if not whole_words:
                return _joined(F.slice(p, begin(k) + 1, n))
            cut = F.transform(F.slice(s, k + 1, n), lambda at, i: _joined(F.slice(p, at + 1, begin(k + i + 1) - at)))
            return F.replace(F.array_join(cut, " "), F.lit(" ##"), F.lit(""))

        def group(k: Column, end: Column) -> Column:
            total = F.aggregate(F.slice(s, k + 1, end - k), F.lit(0.0), lambda acc, at: acc + F.get(p, at)["score"])
            named = F.struct(
                _kind(tag(k)).alias("entity_group"), (total / (end - k)).alias("score"), words(k, end - k).alias("word"),
                F.get(p, begin(k))["start"].alias("start"), F.get(p, begin(end) - 1)["end"].alias("end"),
            )
            return F.when(_kind(tag(k)) != OUTSIDE, named)

        bounds = F.filter(F.transform(s, lambda at, k: F.when(opens(at, k), k)), lambda k: k.isNotNull())
        found = let(bounds, lambda b: F.transform(b, lambda k, j: group(k, F.coalesce(F.get(b, j + 1), F.size(s)))))
        return F.filter(found, lambda e: e.isNotNull())

    return let(pieces, lambda p: let(p["tag"], lambda tags: let(starts(p), lambda s: grouped(p, tags, s))))


def entity_groups(predictions: Column, strategy: str = "simple") -> Column:
    """``array<struct<entity_group, score, word, start, end>>`` of one text.

    ``simple`` joins neighbouring pieces of one type, ``first`` joins pieces to words
    before, ``none`` keeps pieces apart. A ``B-`` tag always opens a new entity, and a
    bare tag continues one of its own type. Untagged pieces end an entity and are
    left out.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown aggregation strategy: {strategy}")
    if strategy == "none":
        named = F.transform(predictions, lambda p: F.struct(
            p["tag"].alias("entity_group"), p["score"].alias("score"), p["word"].alias("word"),
            p["start"].alias("start"), p["end"].alias("end"),
        ))
        return F.filter(named, lambda e: e["entity_group"] != OUTSIDE)
    if strategy == "simple":
        return _runs(predictions, lambda p: positions(F.size(p)), False)
    return _runs(predictions, lambda p: let(p["is_subword"], lambda sub: F.filter(
        positions(F.size(sub)), lambda i: (i == 0) | ~F.get(sub, i)
    )), True)
