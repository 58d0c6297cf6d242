"""Written intermediate tables.

Work that several passes share is written as Parquet into the shared folder that the cluster names in
``spark.checkpoint.dir``. That cuts the lineage, survives the loss of executors, and later passes read
only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediates, taken from the session's settings."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallyguard-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tallyguard/{application}/{label}-{uuid.uuid4().hex}"


def write_to(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a folder and return the table that reads it back; without ``compression`` as the session says."""
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_once(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder and return the table that reads it back."""
    return write_to(df, scratch_path(df.sparkSession, label), compression)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all files in it; one that is not there is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has written; tables that read it are gone with it."""
    remove_folder(spark, f"{shared_root(spark)}/tallyguard/{spark.sparkContext.applicationId}")
