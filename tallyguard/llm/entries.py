"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm import (
    decontaminate,
    frames,
    imatch,
    language,
    licenses,
    merkle,
    packing,
    secret_scan,
    seed_extend,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
)
from tallyguard.llm.common import documents
from tallyguard.llm.oracle import SQL  # noqa: F401 - part of what this module offers
from tallyguard.plans.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(documents(spark, folder), capacity=4096)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["end"] - s["start"])


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffix_dedup.remove_repeated_bytes(documents(spark, folder), length=400)
    return rows.select(
        "doc_id",
        F.col("units").alias("n_bytes"),
        _removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, then all pages (``doc_id`` null), which have markup and addresses; each table has its own model."""
    none, own = F.lit(None).cast("long"), lambda name: F.col(name).cast("long").alias(name)
    docs = language.from_documents(documents(spark, folder), own("doc_id"), none.alias("page_id"))
    pages = language.from_pages(spark.read.parquet(f"{folder}/pages.parquet"), none.alias("doc_id"), own("page_id"))
    rows = language.identify(docs).unionByName(language.identify(pages))
    posterior = F.round("posterior", 6).alias("posterior")
    return rows.select("doc_id", "page_id", "declared", "host", "suffix", "language", posterior, "accepted")


def op9_seed_extend(spark: SparkSession, folder: str) -> DataFrame:
    rows = seed_extend.remove_repeated_words(documents(spark, folder), length=35)
    return rows.select(
        "doc_id", F.col("units").alias("n_words"), _removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_imatch(spark: SparkSession, folder: str) -> DataFrame:
    rows = imatch.fingerprints(documents(spark, folder))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        imatch.fingerprint_text("fingerprint").alias("fingerprint"),
        imatch.fingerprint_text("edited_fingerprint").alias("edited_fingerprint"),
        imatch.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        imatch.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.retrieve(documents(spark, folder), items).filter("confirmed")
    scores = [F.round(c, 6).alias(c) for c in ("score", "share", "question_overlap", "answer_overlap")]
    return found.select("doc_id", "item_id", *scores, "first_word")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    rows = licenses.scan(documents(spark, folder))
    base, first = F.col("places.label"), F.col("places.first")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, F.col("matches.label"))).alias("labels"),
        F.when(F.size("matches") > 0, 1.0).when(F.size("places") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def _kind(name: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    rows = secret_scan.scan(documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return rows.select(
        "doc_id",
        _kind("assign").alias("n_assign"),
        _kind("access").alias("n_access"),
        _kind("hex").alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "ids")
    frames.write_ids(documents(spark, folder), target)
    return frames.read_ids(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, folder), shingle=3, distance=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_counts.count_tokens(documents(spark, folder))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the documents, by crc32, claim a leaf whose text has lost its line breaks."""
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_of(merkle.COLUMNS, text=bare))
    rows = merkle.manifest(
        documents(spark, folder), claimed=F.coalesce(claimed, merkle.leaf_of(merkle.COLUMNS))
    )
    rows = rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.col("claimed"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    rows = spelling.variants(documents(spark, folder), least=5, occurrences=3, every=97, ratio=2)
    return rows.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_imatch": op3_imatch,
    "op4_decontamination": op4_decontamination,
    "op5_licenses": op5_licenses,
    "op6_secrets": op6_secrets,
    "op7_token_files": op7_token_files,
    "op8_language_id": op8_language_id,
    "op9_seed_extend": op9_seed_extend,
    "op10_simhash": op10_simhash,
    "op11_token_counts": op11_token_counts,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
}
