"""ROUGE-1, ROUGE-2 and ROUGE-L of text pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nassaj.functions.arrays import let, ngrams, value_counts

TOKENIZERS = {"unicode": r"[\p{L}\p{N}]+", "ascii": "[a-z0-9]+"}
MEASURES = ("precision", "recall", "fmeasure")


def rouge_tokens(
    c: Column, tokenizer: str = "unicode", stemmer: Callable[[Column], Column] | None = None
) -> Column:
    """Lowercase tokens. ``ascii`` drops every other letter, so Arabic gives none."""
    if tokenizer not in TOKENIZERS:
        raise ValueError(f"Unknown tokenizer: {tokenizer}")
    text = F.lower(F.coalesce(c, F.lit("")))
    tokens = F.regexp_extract_all(text, F.lit(TOKENIZERS[tokenizer]), F.lit(0))
    return stemmer(tokens) if stemmer else tokens


def _numbered(grams: Column) -> Column:
    """Make repeated grams distinct by numbering them."""
    return F.flatten(F.transform(value_counts(grams), lambda g: F.transform(
        F.sequence(F.lit(1), g["n"]), lambda k: F.concat_ws("#", k.cast("string"), g["value"])
    )))


def _repeats(grams: Column) -> Column:
    """Every occurrence of a gram but its first."""
    return let(F.sort_array(grams), lambda s: F.filter(s, lambda g, i: g == F.get(s, i - 1)))


def _overlap(a: Column, b: Column, levels: int = 2) -> Column:
    """Size of the multiset intersection.

    It is the set intersection plus the overlap of the repeats. The repeats are
    few, and those left after ``levels`` rounds are compared by number.
    """
    if levels == 0:
        return F.size(F.array_intersect(_numbered(a), _numbered(b)))
    more = let(_repeats(a), lambda ra: let(_repeats(b), lambda rb: _overlap(ra, rb, levels - 1)))
    return F.size(F.array_intersect(a, b)) + more


def _gram_overlap(ref: Column, hyp: Column, n: int) -> Column:
    return let(ngrams(ref, n), lambda r: let(ngrams(hyp, n), lambda h: _overlap(r, h)))


def _scores(prefix: str, overlap: Column, ref_n: Column, hyp_n: Column) -> list[Column]:
    p = overlap / F.greatest(hyp_n, F.lit(1))
    r = overlap / F.greatest(ref_n, F.lit(1))
    f = F.when(overlap > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return [x.alias(f"{prefix}_{m}") for x, m in zip((p, r, f), MEASURES, strict=True)]


def _lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence with one bit per token of ``a``."""
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        match = row & where.get(token, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.IntegerType())
def lcs_length(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """LCS length of two space-joined token texts."""
    for refs, hyps in batches:
        yield pd.Series(
            [_lcs_length(r.split(), h.split()) for r, h in zip(refs, hyps, strict=True)],
            dtype="int32",
        )


def rouge_scores(
    pairs: DataFrame,
    reference_col: str = "truth",
    hypothesis_col: str = "prediction",
    measures: tuple[str, ...] = ("rouge1", "rouge2", "rougeL"),
    tokenizer: str = "unicode",
    stemmer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add precision, recall and F of each measure to every pair.

    A pair is scored where it is, without exploding or shuffling its grams.
    """
    out = pairs.withColumns({
        "_ref": rouge_tokens(F.col(reference_col), tokenizer, stemmer),
        "_hyp": rouge_tokens(F.col(hypothesis_col), tokenizer, stemmer),
    })
    names = [c for c in pairs.columns]
    for measure in measures:
        if measure == "rougeL":
            overlap = lcs_length(F.array_join("_ref", " "), F.array_join("_hyp", " "))
            sizes = (F.size("_ref"), F.size("_hyp"))
        elif measure in ("rouge1", "rouge2"):
            n = int(measure[-1])
            overlap = _gram_overlap(F.col("_ref"), F.col("_hyp"), n)
            sizes = tuple(F.greatest(F.size(c) - (n - 1), F.lit(0)) for c in ("_ref", "_hyp"))
        else:
            raise ValueError(f"Unknown measure: {measure}")
        out = out.withColumn(f"_{measure}", overlap)
        out = out.select("*", *_scores(measure, F.col(f"_{measure}"), *sizes))
        names += [f"{measure}_{m}" for m in MEASURES]
    return out.select(*names)


def rouge_summary(scores: DataFrame, digits: int = 4) -> DataFrame:
    """One row: mean and population deviation of every score, and ``num_samples``."""
    columns = [c for c in scores.columns if c.startswith("rouge")]
    return scores.agg(
        F.count(F.lit(1)).alias("num_samples"),
        *[F.round(F.avg(c), digits).alias(c) for c in columns],
        *[F.round(F.stddev_pop(c), digits).alias(f"{c}_std") for c in columns],
    )
