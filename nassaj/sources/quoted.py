"""Records of CSV files whose quoted values may hold line breaks, cut in parallel.

A task reads the lines of one block of a file and cannot know whether its first line begins inside quotes. So a first pass
over the lines with a quote finds, for every block, the state at its end for both states at its beginning. Composing
these in the order of the blocks gives every block its true state (one row a block is all that is put in order).
The second pass cuts records only outside quotes. A record that runs over the end of a block leaves its pieces in
several tasks; these alone are shuffled and joined.

A quote opens only at the beginning of a value and closes at one that is not doubled; others, such as inch marks, are
plain characters. Lines end at ``\\n`` or ``\\r\\n``. Blank lines between records are no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nassaj.operators.sizes import collect_bounded

#: Blocks whose state or first number goes to the tasks: a row for 128 MB of a file, as Spark cuts them.
MOST_BLOCKS = 2_000_000
#: Characters of a record in several blocks; a quote that is never closed would make the rest of a file one record.
LONGEST_RECORD = 1 << 28

_LINES = "file bigint, start bigint, value string"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside or outside quotes ends inside them."""
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
            at += 1
        while True:  # to the quote that closes
            at = line.find('"', at)
            if at < 0:
                return True
            if not line.startswith('"', at + 1):
                break
            at += 2
        inside = False
        at = line.find(sep, at + 1)  # what follows a closed value belongs to it
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """``file, path, start, value``: the lines of each block, in order within it."""
    value: Column = F.col("value")
    if encoding.lower().replace("-", "") != "utf8":
        value = F.decode(value.cast("binary"), encoding)
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"), value.alias("value"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[str]]]:
    """Lines of one block at a time."""
    for batch in batches:
        places = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        values = batch.column(2).to_pylist()
        begin = 0
        for i in range(1, len(places) + 1):
            if i == len(places) or places[i] != places[begin]:
                yield places[begin], values[begin:i]
                begin = i


def _states(sep: str):
    """By block and state at its beginning: the state at its end, whether the quotes never close, and records begun."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[list]] = {}
        for place, lines in _runs(batches):
            both = found.setdefault(place, [[False, False, 0], [True, True, 0]])
            for line in lines:
                for state in both:
                    inside = state[0]
                    state[2] += not inside and not line.isspace() and line != ""
                    state[0] = ends_inside(line, inside, sep) if '"' in line else inside
                    state[1] &= state[0]
        for (file, start), (out, in_) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (file, start, out[0], out[2], in_[0], in_[1], in_[2])],
                ["file", "start", "out_ends", "out_records", "in_ends", "in_stays", "in_records"],
            )

    return run


def blocks(lines: DataFrame, sep: str, numbered: bool) -> DataFrame:
    """``file, start, inside, opener, first``: the state at the beginning of each block, which block opened it, and the number of
    its first record over all files in the order of their names."""
    shape = "file bigint, start bigint, out_ends boolean, out_records bigint, in_ends boolean, in_stays boolean, in_records bigint"
    looked = lines if numbered else lines.where(F.contains("value", F.lit('"')))
    found = looked.select("file", "start", "value").mapInArrow(_states(sep), shape)
    found = found.groupBy("file", "start").agg(*[F.first(c).alias(c) for c in found.columns[2:]])
    if numbered:
        found = found.join(lines.select("file", "path").distinct(), "file")
    else:
        found = found.withColumn("path", F.lit(""))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A block either sets the state, whatever it was, or turns it, or leaves it.
    sets = F.col("out_ends") == F.col("in_ends")
    since = F.coalesce(F.sum(sets.cast("int")).over(before), F.lit(0))
    set_to = F.coalesce(F.last(F.when(sets, F.col("out_ends")), ignorenulls=True).over(before), F.lit(False))
    found = found.withColumns({"since": since, "set_to": set_to, "turns": F.col("out_ends") & ~F.col("in_ends")})
    within = Window.partitionBy("file", "since").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # The block that sets the state is the first but for the file's beginning; its own turn is not counted.
    turned = F.coalesce(F.sum((F.col("turns") & ~sets).cast("int")).over(within), F.lit(0)) % 2 == 1
    found = found.withColumn("inside", F.col("set_to") != turned)
    opens = F.when(F.col("inside"), F.col("in_ends") & ~F.col("in_stays")).otherwise(F.col("out_ends"))
    opener = F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)
    records = F.when(F.col("inside"), F.col("in_records")).otherwise(F.col("out_records")) - (F.col("start") == 0).cast("int")
    earlier = Window.orderBy("path", "file", "start").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(records).over(earlier), F.lit(0)) if numbered else F.lit(0)
    return found.select("file", "start", "inside", F.when(F.col("inside"), opener).alias("opener"), first.cast("bigint").alias("first"))


_PIECES = "file bigint, opener bigint, start bigint, id bigint, value string"


def _cut(sent, sep: str, pieces: bool):
    """Whole records, or the pieces of those in several blocks; the first record of a file is its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        at: tuple[int, int] | None = None
        inside, opener, number, open_ = False, None, 0, []
        rows: list[tuple] = []

        def close(whole: bool) -> None:
            """The record or piece that has been gathered ends here."""
            nonlocal open_, opener
            file, start = at
            header = start == 0 and number == first - 1 and opener is None
            if (opener is not None or not whole) == pieces and not header:
                rows.append((file, start if opener is None else opener, start, number, "\n".join(open_)))
            open_, opener = [], None

        def sent_rows() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 5
            rows.clear()
            kinds = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "opener", "start", "id", "value"]
            )

        first = 0
        for place, lines in _runs(batches):
            if place != at:
                if open_:
                    close(False)
                at = place
                inside, opener, first = known.get(place, (False, None, 0))
                number = first - 1 - (place[1] == 0)  # of the record before
            for line in lines:
                if not inside:
                    if not line or line.isspace():
                        continue
                    number += 1
                open_.append(line)
                inside = ends_inside(line, inside, sep) if '"' in line else inside
                if not inside:
                    close(True)
            if rows:
                yield sent_rows()
        if open_:
            close(False)
        if rows:
            yield sent_rows()

    return run


def records(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "utf-8", numbered: bool = False
) -> DataFrame:
    """``id, value`` of every record but the headers; ``id`` numbers them only if asked to."""
    lines = _lines(spark, path, encoding)
    starts = blocks(lines, sep, numbered)
    wanted = starts if numbered else starts.where("inside")
    told = {(r["file"], r["start"]): (r["inside"], r["opener"], r["first"]) for r in collect_bounded(wanted, "blocks of CSV files", MOST_BLOCKS)}
    sent = spark.sparkContext.broadcast(told)
    plain = lines.select("file", "start", "value")
    whole = plain.mapInArrow(_cut(sent, sep, False), _PIECES).select("id", "value")
    met = {(file, start) for (file, start), (inside, _, _) in told.items() if inside}
    if not met:
        return whole
    # Blocks that begin inside quotes, and those that end so.
    parts = {*met, *((file, told[file, start][1]) for file, start in met)}
    some = spark.createDataFrame(sorted(parts), "file bigint, start bigint")
    cut = plain.join(F.broadcast(some), ["file", "start"], "left_semi").mapInArrow(_cut(sent, sep, True), _PIECES)  # at most MOST_BLOCKS rows
    joined = cut.groupBy("file", "opener").agg(
        F.min_by("id", "start").alias("id"), F.sum(F.length("value")).alias("size"), F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts")
    )
    too_long = F.raise_error(F.lit("a quoted value is never closed, or longer than a record may be"))
    value = F.when(F.col("size") > LONGEST_RECORD, too_long.cast("string")).otherwise(F.array_join("parts.value", "\n"))
    return whole.unionByName(joined.select("id", value.alias("value")))
