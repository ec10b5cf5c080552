"""Entity spans of tag sequences and their scores.

Sequences are arrays, so spans are found, and truth and prediction compared,
inside the row. Only per-type tallies are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.functions.arrays import let, unnest
from nassaj.operators.metrics import label_scores, report_rows

_NO_TYPE = "_"
_OUTSIDE = "O"


def sequences(df: DataFrame, id_col: str, pos_col: str, *value_cols: str) -> DataFrame:
    """Exploded ``id, pos, value..`` rows back to one row of arrays per id."""
    rows = F.array_sort(F.collect_list(F.struct(pos_col, *value_cols))).alias("_rows")
    grouped = df.groupBy(id_col).agg(rows)
    return grouped.select(id_col, *[F.col(f"_rows.{c}").alias(c) for c in value_cols])


def _parsed(tag: Column) -> Column:
    rest = F.substring(tag, 2, 2**31 - 1)
    kind = F.substr(rest, F.instr(rest, F.lit("-")) + 1)
    return F.struct(
        F.when(F.length(tag) > 0, F.substring(tag, 1, 1)).otherwise(F.lit(_OUTSIDE)).alias("head"),
        F.when(F.length(kind) > 0, kind).otherwise(F.lit(_NO_TYPE)).alias("kind"),
    )


def _ends(prev: Column, cur: Column) -> Column:
    """A span that reaches ``prev`` does not go on into ``cur``."""
    return (
        prev["head"].isin("E", "S")
        | (prev["head"].isin("B", "I") & cur["head"].isin("B", "S", "O"))
        | (~prev["head"].isin("O", ".") & (prev["kind"] != cur["kind"]))
    )


def _starts(prev: Column, cur: Column) -> Column:
    return (
        cur["head"].isin("B", "S")
        | (cur["head"].isin("E", "I") & prev["head"].isin("E", "S", "O"))
        | (~cur["head"].isin("O", ".") & (prev["kind"] != cur["kind"]))
    )


def entity_spans(tags: Column) -> Column:
    """``array<string>`` of tags to ``array<struct<entity_type, first, last>>``.

    Understands B-/I-/E-/S- tags and bare ones. A bare tag's type is what follows
    its first character, so ``LOC`` counts as head ``L`` and type ``OC``; equal bare
    neighbours form one span.
    """
    outside = F.array(F.lit(_OUTSIDE))

    def boundaries(known: Column) -> Column:
        # Between two outside tags, the usual case, nothing starts or ends.
        steps = F.zip_with(
            F.concat(outside, known),
            F.concat(known, outside),
            lambda prev, cur: F.when(
                (prev != _OUTSIDE) | (cur != _OUTSIDE),
                F.struct(_parsed(prev).alias("prev"), _parsed(cur).alias("cur")),
            ),
        )
        placed = F.transform(steps, lambda s, i: F.when(s.isNotNull(), F.struct(
            i.alias("at"),
            s["prev"]["kind"].alias("kind"),
            _ends(s["prev"], s["cur"]).alias("ends"),
            _starts(s["prev"], s["cur"]).alias("starts"),
        )))
        return F.filter(placed, lambda e: F.coalesce(e["ends"] | e["starts"], F.lit(False)))

    def spans(events: Column) -> Column:
        def span(e: Column, i: Column) -> Column:
            before = F.get(events, i - 1)
            earlier = F.filter(events, lambda x: x["starts"] & (x["at"] < e["at"]))
            first = F.when(before["starts"], before["at"]).otherwise(
                F.coalesce(F.get(earlier, F.size(earlier) - 1)["at"], F.lit(0))
            )
            return F.when(e["ends"], F.struct(
                e["kind"].alias("entity_type"), first.alias("first"), (e["at"] - 1).alias("last")
            ))

        return F.filter(F.transform(events, span), lambda s: s.isNotNull())

    known = F.coalesce(tags, F.array().cast("array<string>"))
    return let(let(known, boundaries), spans)


def span_rows(df: DataFrame, id_col: str = "id", tags_col: str = "tags") -> DataFrame:
    """``id, entity_type, first, last``, one row per span."""
    return unnest(df, entity_spans(F.col(tags_col)), id_col, name="span").select(id_col, "span.*")


def _if_same_length(value: Column) -> Column:
    """``value``, failing where truth and prediction differ in length.

    Part of the value and no filter: a filter would be pushed to the scan and compute both sequences a second time there.
    """
    problem = F.raise_error(F.concat(
        F.lit("tag sequences of different length at id "), F.col("id").cast("string")
    ))
    return F.when(F.size("truth") == F.size("prediction"), value).otherwise(problem)


def token_accuracy(pairs: DataFrame) -> DataFrame:
    """One row: the share of equal tags over all tokens."""
    equal = F.size(F.filter(F.zip_with("truth", "prediction", lambda a, b: a == b), lambda x: x))
    checked = pairs.select(_if_same_length(equal).alias("hits"), F.size("truth").alias("tokens"))
    tokens = F.sum("tokens")
    return checked.agg(
        F.when(tokens > 0, F.sum("hits") / tokens).otherwise(F.lit(0.0)).alias("accuracy")
    )


def _span_tallies(pairs: DataFrame) -> DataFrame:
    """``label, support, predicted, correct`` per entity type."""
    return _tallied(pairs)


def _tallied(pairs: DataFrame, *more: Column) -> DataFrame:
    """The tallies of all spans, and of further rows."""
    # Text keys let array_intersect hash; it compares structs pairwise.
    def keys(tags: str) -> Column:
        return F.array_distinct(F.transform(
            entity_spans(F.col(tags)),
            lambda s: F.concat_ws(":", s["first"], s["last"], s["entity_type"]),
        ))

    extra = F.concat(*more) if more else F.array().cast(
        "array<struct<label:string,support:int,predicted:int,correct:int>>"
    )
    per_row = pairs.select(
        _if_same_length(keys("truth")).alias("t"), keys("prediction").alias("p"), extra.alias("more")
    )
    per_row = per_row.select("t", "p", F.array_intersect("t", "p").alias("both"), "more")

    def tally(keyed: str, counted: str) -> Column:
        return F.transform(keyed, lambda k: F.struct(
            F.get(F.split(k, ":", 3), F.lit(2)).alias("label"),
            *[F.lit(int(c == counted)).alias(c) for c in ("support", "predicted", "correct")],
        ))

    sides = [tally("t", "support"), tally("p", "predicted"), tally("both", "correct")]
    return unnest(per_row, F.concat(*sides, F.col("more")), name="s").select("s.*").groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")]
    )


def ner_metrics(pairs: DataFrame) -> DataFrame:
    """One row: micro precision, recall and F1 over exactly matching spans."""
    return micro_scores(_span_tallies(pairs))


def micro_scores(tallies: DataFrame) -> DataFrame:
    total = tallies.agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("support", "predicted", "correct")
    ])
    return label_scores(total).select("precision", "recall", "f1")


def ner_report(pairs: DataFrame) -> DataFrame:
    """``label, precision, recall, f1, support`` per entity type with average rows."""
    return report_rows(label_scores(_span_tallies(pairs)), accuracy=False)


def ner_tally(pairs: DataFrame) -> DataFrame:
    """``label, support, predicted, correct`` per entity type, and the tags in a row without a label:
    how many there are, and in how many both sides agree. One pass gives all scores."""
    same = F.size(F.filter(F.zip_with("truth", "prediction", lambda a, b: a == b), lambda x: x))
    return _tallied(pairs, F.array(F.struct(
        F.lit(None).cast("string").alias("label"), F.size("truth").alias("support"),
        F.size("prediction").alias("predicted"), same.alias("correct"),
    )))
