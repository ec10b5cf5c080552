"""Write results, reports and models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in a folder, as :func:`~nassaj.sources.readers.read_csv` reads it back.

    Nested columns become JSON text. Texts keep their white space; an empty text is quoted, a null is not.
    """
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode(mode).csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row; characters stay as they are."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def save_text(df: DataFrame, path: str, column: str = "text", mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def save_results(path: str, df: DataFrame, column: str = "text") -> None:
    """:func:`save_text` with the path first."""
    save_text(df, path, column)


def save_document(spark: SparkSession, content: dict, path: str) -> None:
    """A small dictionary as one indented JSON file in the folder ``path``."""
    text = json.dumps(content, ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


SINKS = {"csv": save_csv, "json": save_json, "parquet": lambda df, p: df.write.mode("overwrite").parquet(p)}


def save_predictions(df: DataFrame, path: str, task: str, file_type: str | None = None) -> None:
    """Entities go to JSON, the other tasks to CSV, unless ``file_type`` is given."""
    kind = file_type or ("json" if task == "ner" else "csv")
    if kind not in SINKS:
        raise ValueError(f"Unsupported file type: {kind}")
    SINKS[kind](df, path)
