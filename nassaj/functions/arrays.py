"""Small array helpers that work inside one row, hence without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A plain reference inside a lambda is recomputed for every element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(
    df: DataFrame, array: Column, *keep: str | Column, name: str = "item", pos: str | None = None
) -> DataFrame:
    """One row per element, with the columns ``keep``.

    A plain ``explode`` makes the optimizer add a filter on the size of the array,
    which computes the whole array expression a second time and, pushed to the scan,
    before any repartitioning. The outer form with the empty rows dropped does not.
    """
    if pos:
        return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).where(F.col(pos).isNotNull())
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def positions(size: Column) -> Column:
    """``[0, 1, .., size - 1]``, empty for size 0."""
    return F.slice(F.sequence(F.lit(0), F.greatest(size, F.lit(1))), F.lit(1), size)


def value_counts(values: Column) -> Column:
    """``array<T>`` to the sorted ``array<struct<value: T, n: int>>`` of its distinct values."""

    def from_sorted(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            positions(size),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("value"),
                    (F.coalesce(F.get(s, k + 1), size) - start).alias("n"),
                ),
            ),
        )

    return let(F.sort_array(values), from_sorted)


def ngrams(words: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring words."""
    if n == 1:
        return words

    def joined(w: Column) -> Column:
        count = F.greatest(F.size(w) - F.lit(n - 1), F.lit(0))
        return F.transform(
            F.slice(w, F.lit(1), count),
            lambda first, i: F.concat_ws(" ", first, *[F.get(w, i + k) for k in range(1, n)]),
        )

    return let(words, joined)
