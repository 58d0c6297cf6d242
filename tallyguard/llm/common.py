"""What the text operators share: reading, row keys, files in the shared folder, state kept by a Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


#: bytes of rows after which a Python worker gets its next batch, for sessions that leave Spark's default as it is
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of ``BATCH_BYTES``, unless the session names a size of its own.

    Executor and worker both hold whole batches. Spark's defaults allow 10,000 rows, which is some 30 MB of texts of
    3 KB, and several times that where a task holds them as buffers, as strings and as what is made of them.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def plain(docs: DataFrame, *more: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty) and the named columns; whatever else a table holds cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )


def text_key(text: str | Column = "text") -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text))


def with_keys(docs: DataFrame) -> DataFrame:
    """Row table without texts: ``doc_id``, ``key`` of the text."""
    return plain(docs).select("doc_id", text_key().alias("key"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per different text: ``key``, ``text`` and ``copies``.

    Copies are counted on 16-byte keys first; a text is moved once for each task that holds it at most.
    """
    keyed = plain(docs).select(text_key().alias("key"), "text")
    return keyed.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def rows_chosen(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """``docs`` with all its columns, joined ``how`` (left_semi, left_anti) with ``doc_id``, ``key`` of ``chosen``."""
    names = []
    for name in ("_id", "_key", "_chosen_id", "_chosen_key"):
        while name in docs.columns:
            name = f"_{name}"
        names.append(name)
    own_id, own_key, id_, key = names
    named = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_key: text_key(F.coalesce("text", F.lit("")))})
    chosen = chosen.select(F.col("doc_id").alias(id_), F.col("key").alias(key)).distinct()
    same = named[own_id].eqNullSafe(chosen[id_]) & (named[own_key] == chosen[key])
    return named.join(chosen, same, how).drop(own_id, own_key)


def file_system(uri: str):
    """The file system of a folder and the folder's path there, on any machine that reaches the folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def worker_state(name: str, build: Callable[[], Any]) -> Any:
    """An object that later tasks of the same Python worker find again."""
    kept = sys.modules.setdefault("_tallyguard_worker", types.ModuleType("_tallyguard_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, build())
    return getattr(kept, name)
