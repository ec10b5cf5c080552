"""The preprocess job over files as they arrive.

Cleaning, tokens and stems are stateless, so they apply to a stream unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nassaj.functions.clean import CleanConfig
from nassaj.functions.tokens import TextProcessor
from nassaj.sources.readers import strip


def read_text_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Non-blank lines of the text files that appear in ``folder``."""
    lines = spark.readStream.text(folder)
    return lines.select(strip(F.col("value")).alias("text")).where(F.col("text") != "")


def preprocess_stream(
    texts: DataFrame,
    output_path: str,
    checkpoint_path: str,
    config: CleanConfig | Mapping[str, bool] | None = None,
    remove_stops: bool = True,
    apply_stemming: bool = False,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append processed texts to Parquet, each once, using the checkpoint folder."""
    processed = TextProcessor(config).run_on_dataframe(texts, "text", remove_stops, apply_stemming)
    return (
        processed.writeStream.format("parquet").outputMode("append")
        .option("path", output_path).option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
