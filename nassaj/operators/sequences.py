"""Prepare token/tag and text/summary rows for sequence models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.arrays import let
from nassaj.operators.pairing import fail_unless
from nassaj.operators.sizes import MAX_LABELS, collect_bounded
from nassaj.operators.split import tag_dictionary


def check_tagged(df: DataFrame, tokens_col: str = "tokens", tags_col: str = "tags") -> DataFrame:
    """Raise on an empty table; fail rows whose tokens and tags differ in number."""
    if df.isEmpty():
        raise ValueError("Training tokens and tags must be provided.")
    same = F.coalesce(F.size(tokens_col) == F.size(tags_col), F.lit(False))
    problem = F.raise_error(F.lit("tokens and tags of a row differ in number"))
    return fail_unless(df, same, problem)


def check_pairs(df: DataFrame, text_col: str = "text", summary_col: str = "summary") -> DataFrame:
    """Raise on an empty table; fail rows that lack one side."""
    if df.isEmpty():
        raise ValueError("Training texts and summaries must be provided.")
    both = F.col(text_col).isNotNull() & F.col(summary_col).isNotNull()
    problem = F.raise_error(F.lit("a row has no text or no summary"))
    return fail_unless(df, both, problem)


def align_labels(
    word_ids: Column, tags: Column, tag_ids: dict[str, int], label_all_tokens: bool = True
) -> Column:
    """One label id per subword piece.

    Special tokens (null word id) and unknown tags get -100, as do the later
    pieces of a word unless ``label_all_tokens``.
    """
    ignored = F.lit(fixed.IGNORED_LABEL)
    if tag_ids:
        pairs = [F.lit(x) for item in tag_ids.items() for x in item]
        known = F.create_map(*pairs)
        numbered = F.transform(tags, lambda t: F.coalesce(F.try_element_at(known, t), ignored))
    else:
        numbered = F.transform(tags, lambda t: ignored)

    def labels(ids: Column) -> Column:
        def label(word: Column, i: Column) -> Column:
            labelled = word.isNotNull()
            if not label_all_tokens:
                labelled = labelled & ~word.eqNullSafe(F.get(word_ids, i - 1))
            return F.when(labelled, F.coalesce(F.get(ids, word), ignored)).otherwise(ignored)

        return F.transform(word_ids, label)

    return let(numbered, labels)


def fit_length(ids: Column, length: int, pad: int = 0) -> Column:
    """Truncate or right-pad an id sequence to ``length``."""
    kept = F.slice(ids, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(pad).cast("int"), F.lit(length) - F.size(kept)))


def prepare_tagged(
    df: DataFrame,
    word_ids_col: str = "word_ids",
    tags_col: str = "tags",
    label_all_tokens: bool = True,
    max_length: int = fixed.TAGGER_MAX_LENGTH,
    max_tags: int = MAX_LABELS,
) -> DataFrame:
    """Add ``labels``: aligned with the pieces and of length ``max_length``.

    The tags are numbered when the query is built; more than ``max_tags`` raise.
    """
    rows = collect_bounded(tag_dictionary(df, tags_col), "distinct tags", max_tags)
    tag_ids = {r["tag"]: r["tag_id"] for r in rows}
    labels = align_labels(F.col(word_ids_col), F.col(tags_col), tag_ids, label_all_tokens)
    return df.withColumn("labels", fit_length(labels, max_length, fixed.IGNORED_LABEL))


def prepare_summary_pairs(
    df: DataFrame,
    input_ids_col: str = "input_ids",
    target_ids_col: str = "target_ids",
    max_input_length: int = fixed.SUMMARY_MAX_INPUT,
    max_target_length: int = fixed.SUMMARY_MAX_TARGET,
    pad: int = 0,
    mask_pad: bool = False,
) -> DataFrame:
    """Fixed-length ``input_ids``, ``attention_mask`` and ``labels``.

    Padding stays in the labels as it is; ``mask_pad`` turns it into -100.
    """
    source, target = F.col(input_ids_col), F.col(target_ids_col)
    ones = F.transform(source, lambda x: F.lit(1))
    fill = fixed.IGNORED_LABEL if mask_pad else pad
    return df.withColumns({
        "input_ids": fit_length(source, max_input_length, pad),
        "attention_mask": fit_length(ones, max_input_length),
        "labels": fit_length(target, max_target_length, fill),
    })
