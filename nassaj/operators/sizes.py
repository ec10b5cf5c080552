"""Tables kept in the shared folder, small inputs on all cores, and bounded collects."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

MAX_LABELS = 5_000


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores when the input has fewer pieces than that.

    Text work is bound by the processor, and a file of one row group is one task.
    Inputs with pieces for every core, as all large ones, are left as they are. For
    file scans: counting the partitions of a shuffled table would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def named_folder(spark: SparkSession) -> str | None:
    """The shared folder that the session names, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


@contextmanager
def kept(df: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """``df`` written once for repeated passes, removed at the end of the ``with`` block.

    The folder is the one given, else the one that ``spark.checkpoint.dir`` names; all executors have to
    share it. Where none is named the rows are cached on the executors, to be computed again where lost.
    """
    spark = df.sparkSession
    folder = folder or named_folder(spark)
    if folder is None:
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield cached
        finally:
            cached.unpersist()
        return
    path = f"{folder.rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def collect_bounded(df: DataFrame, what: str, max_rows: int) -> list:
    """Rows of a table that has to be small; one that is not raises instead of filling the driver."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}")
    return rows
