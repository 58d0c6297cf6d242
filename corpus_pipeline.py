"""A training corpus from raw documents: five stages, each over all that the one before it kept.

language     documents whose language is rejected go
copies       one document of each group of SimHash near-duplicates stays
benchmark    documents that hold a test item go
secrets      secrets in texts are replaced by a mark; all documents stay
packing      token ids of all documents in sequences of 4096

Every stage but the last returns all columns of its input. A stage's result is written as Parquet into the shared
folder and read again, which cuts the lineage. Texts reach Python workers in batches of 4 MB.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyguard.llm import decontaminate, language, packing, secret_scan, simhash  # noqa: E402
from tallyguard.llm.common import bound_batches, documents  # noqa: E402
from tallyguard.plans.scratch import write_once  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return simhash.keep_one(docs, shingle=3, distance=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return secret_scan.redact(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack(docs, capacity=4096).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", identify_language),
    ("copies", drop_copies),
    ("benchmark", drop_benchmark),
    ("secrets", hide_secrets),
    ("packing", pack_tokens),
]

#: fingerprints, scores, tags and token ids cannot be expressed in SQL; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
