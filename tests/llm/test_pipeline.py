from __future__ import annotations

import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from tallyguard.llm import common, decontaminate, language, secret_scan, simhash
from tallyguard.plans.scratch import write_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = write_once(stage(spark, docs, SMALL), f"test-{name}")
        found[name] = (docs, after)
        docs = after
    return found


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "copies", "benchmark", "secrets", "packing"]
    for name, (_, after) in stages.items():
        if name != "packing":
            assert after.columns == COLUMNS and after.count() == len(ids(after))


def test_language_stage(stages):
    before, after = stages["language"]
    found = language.identify(language.from_documents(before, "doc_id")).collect()
    assert ids(after) == {r.doc_id for r in found if r.accepted}


def test_copies_stage(stages):
    before, after = stages["copies"]
    assert ids(after) == {r.component_id for r in simhash.near_duplicates(before).collect()}


def test_benchmark_stage(spark, stages):
    before, after = stages["benchmark"]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before.collect() if any(i in " ".join(r.text.split()) for i in items)}
    assert leaks and leaks.isdisjoint(ids(after))
    confirmed = decontaminate.retrieve(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).filter("confirmed")
    assert ids(before) - ids(after) == {r.doc_id for r in confirmed.collect()}


def test_secrets_stage(stages):
    before, after = stages["secrets"]
    texts = {r.doc_id: r for r in after.collect()}
    assert ids(before) == set(texts)
    for r in before.collect():
        if not secret_scan.base_spans(r.text) and texts[r.doc_id].text != r.text:
            assert "<SECRET>" in texts[r.doc_id].text
    assert not any(secret_scan.base_spans(r.text) for r in texts.values())
    assert all(r.n_chars == len(r.text) for r in texts.values())


def test_packing_stage(stages):
    before, after = stages["packing"]
    pieces = after.collect()
    assert {p.doc_id for p in pieces} == ids(before)
    total = {p.doc_id: p.doc_tokens for p in pieces}
    held: dict = {}
    for p in pieces:
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
    assert held == total


def test_workers_get_batches_of_bounded_size(spark):
    key, text = "spark.sql.execution.arrow.maxBytesPerBatch", "x" * 100_000
    kept = spark.conf.getAll.get(key)
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), *[F.lit(None).cast("string").alias(c) for c in COLUMNS[2:4]], F.lit(1).alias("n_chars"))
    sizes = lambda: [r.n for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    try:
        spark.conf.unset(key)
        corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
        assert max(sizes()) < 2 * common.BATCH_BYTES and sum(sizes()) > 40_000_000
        spark.conf.set(key, str(1 << 20))  # a size that the session names stays
        common.bound_batches(spark)
        assert max(sizes()) < 2 << 20
    finally:
        spark.conf.unset(key)
        if kept is not None:
            spark.conf.set(key, kept)
