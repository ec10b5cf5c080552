"""Read text corpora and labelled, tagged or paired records."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nassaj.functions import fixed
from nassaj.operators.pairing import first_known
from nassaj.sources.quoted import records

#: Stands for a quoted empty value while a record is parsed.
_EMPTY = "\0"
FILE_TYPES = ("csv", "json", "jsonl", "txt", "parquet")
TAGGED = T.StructType([
    T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
])


def strip(c: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    w = fixed.WHITESPACE
    return F.regexp_replace(c, rf"\A{w}+|{w}+\z", "")


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number rows 0, 1, .. in the order of their files' names and of their places in them.

    For tables read from files. The numbers do not depend on how the files are split. A first pass
    counts the rows of each block that a task reads at once; one row per block is all that is put in order and sent to all
    tasks, so that the rows themselves stay where they are.
    """
    placed = df.select(
        "*", F.monotonically_increasing_id().alias("_at"), F.input_file_name().alias("_file"),
        F.input_file_block_start().alias("_block"),
    ).withColumn("_part", F.shiftright("_at", 33))
    at = ["_file", "_block", "_part"]
    blocks = placed.groupBy(*at).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*at, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(starts), at).withColumn(name, F.col("_at") + F.col("_shift")).select(name, *df.columns)


def read_text(
    spark: SparkSession, path: str, column: str = "text", encoding: str = "utf-8", row_ids: bool = False
) -> DataFrame:
    """One row per non-blank line, stripped.

    ``encoding`` must keep ASCII line ends as single bytes.
    """
    raw = spark.read.text(path)
    value = F.col("value")
    if encoding.lower().replace("-", "") != "utf8":
        value = F.decode(value.cast("binary"), encoding)
    lines = raw.select(strip(value).alias(column)).where(F.col(column) != "")
    return with_row_id(lines) if row_ids else lines


load_text_data = read_text


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None, row_id: str | None = None, **options,
) -> DataFrame:
    """CSV with a header; all columns are strings unless ``schema`` says otherwise.

    Files are read in parallel pieces, with line breaks in quotes too (see :mod:`nassaj.sources.quoted`); the states of the
    pieces are found when the query is built. Values are read as Spark reads CSV, by its options (``sep``,
    ``nullValue``, ..), but that a quoted empty value is an empty text, an unquoted one null; ``encoding`` must
    keep ASCII as single bytes. ``row_id`` adds a column that numbers the rows 0, 1, .. in the order of the files'
    names and of their places in them.
    """
    sep = options.pop("sep", options.pop("delimiter", ","))
    encoding = options.pop("encoding", options.pop("charset", "utf-8"))
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": _EMPTY, **options}
    if schema is None:
        names = spark.read.options(header=True, encoding=encoding, **options).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    found = records(spark, path, sep, encoding, row_id is not None)
    kind = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    text = F.regexp_replace("value", r"\r\z", "")
    parsed = found.select("id", F.from_csv(text, kind, {k: str(v) for k, v in options.items()}).alias("r"))
    values = [
        F.when(F.col("r")[f.name] == _EMPTY, "").otherwise(F.col("r")[f.name]).alias(f.name)
        if isinstance(f.dataType, T.StringType) and options["emptyValue"] == _EMPTY else F.col("r")[f.name].alias(f.name)
        for f in schema
    ]
    return parsed.select(*([F.col("id").alias(row_id)] if row_id else []), *values)


def read_numbered(spark: SparkSession, path: str, name: str, file_type: str | None = None, **options) -> DataFrame:
    """:func:`read_any` with the rows numbered in the order of the files' names and of their places in them."""
    if (file_type or _extension(path)).lower().lstrip(".") == "csv":
        return read_csv(spark, path, row_id=name, **options)
    return with_row_id(read_any(spark, path, file_type, **options), name)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One JSON document per file: an array gives its elements, an object one row."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=True, mode="FAILFAST")


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One JSON object per line; blank lines are skipped, bad ones raise."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, mode="FAILFAST")


def _extension(path: str) -> str:
    return PurePosixPath(path).suffix.lower().lstrip(".")


def read_any(spark: SparkSession, path: str, file_type: str | None = None, **options) -> DataFrame:
    """Choose the reader by ``file_type`` or by the extension of ``path``."""
    kind = (file_type or _extension(path)).lower().lstrip(".")
    if kind not in FILE_TYPES:
        raise ValueError(f"Unsupported file type: {kind}")
    if kind == "parquet":
        return spark.read.parquet(path)
    readers = {"csv": read_csv, "json": read_json, "jsonl": read_jsonl, "txt": read_text}
    return readers[kind](spark, path, **options)


def read_tagged(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """Token and tag sequences: a ``.json`` array, else JSON Lines."""
    schema = TAGGED
    if id_col:
        schema = T.StructType([T.StructField(id_col, T.StringType()), *TAGGED.fields])
    read = read_json if _extension(path) == "json" else read_jsonl
    return read(spark, path, schema)


def with_summary_columns(df: DataFrame) -> DataFrame:
    """``text`` (else ``source``) and ``summary`` (else ``target``), missing as ``""``."""

    def first_of(*names: str) -> Column:
        known = [F.col(n).cast("string") for n in names if n in df.columns]
        return F.coalesce(*known, F.lit(""))

    kept = [c for c in df.columns if c not in ("text", "source", "summary", "target")]
    return df.select(
        *kept, first_of("text", "source").alias("text"), first_of("summary", "target").alias("summary")
    )


def read_summary_pairs(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text and summary pairs from CSV, JSON or JSON Lines; ``row_id`` numbers the rows of CSV."""
    kind = _extension(path)
    if kind == "csv":
        df = read_csv(spark, path, **options)
        missing = [c for c in ("text", "summary") if c not in df.columns]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {path}")
        return with_summary_columns(df)
    return with_summary_columns((read_json if kind == "json" else read_jsonl)(spark, path, **options))


def read_inference_input(spark: SparkSession, path: str, **options) -> tuple[DataFrame, str]:
    """A corpus and the name of its text column.

    Cleaned text is preferred to raw text when a table has both.
    """
    kind = _extension(path)
    if kind not in ("csv", "parquet"):
        return read_text(spark, path, **options), "text"
    df = read_any(spark, path, **options)
    if "cleaned_text" in df.columns:
        return df, "cleaned_text"
    return df, first_known(df, ("text", "content"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word``: extra stopwords, one per line of the file; a missing file raises."""
    return read_text(spark, path, "word").distinct()
