"""Tables written once to the shared folder and read again.

The folder is the one that ``spark.checkpoint.dir`` names, so every executor reads the same
files and a lost executor costs no recomputation. A local session that names none takes the
temporary folder. An application's tables lie in one folder below it, removed when its JVM ends, whether or
not the session was stopped before.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_homes: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def _home(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _homes:
        _homes[app] = f"{shared_folder(spark).rstrip('/')}/staged-{app}-{uuid.uuid4().hex[:8]}"
        path, system = _at(spark, _homes[app])
        system.mkdirs(path)
        system.deleteOnExit(path)
    return _homes[app]


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def drop(spark: SparkSession, folder: str) -> None:
    path, system = _at(spark, folder)
    system.delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the application's folder that nothing lies at."""
    return f"{_home(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and return the written table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def release(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    drop(df.sparkSession, df.staged_path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand Python whole texts a few hundred at a time, so that a batch with long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
