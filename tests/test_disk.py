"""Disk that a run takes: shuffle files go with their query, tables are written once and compressed well."""

from __future__ import annotations

import os
import time
from types import SimpleNamespace

from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL
from tallyguard import schemas
from tallyguard.operators import rules, staging
from tallyguard.plans import scratch, workspace
from tallyguard.session import SHORT_LIVED, bound_tasks
from tallyguard.sources import files


def _texts(df):
    return sorted(map(str, df.collect()))


def _shuffle_files(spark):
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def _ledger(raw_rows):
    rows = [{"amount": 100.0 + n, "department": ("IT", "HR")[n % 2], "transaction_date": f"2024-0{n % 3 + 1}-10"} for n in range(40)]
    rows += [{"amount": 9990.0}, {"amount": 9990.0}, {"approver_id": " "}, {"department": None}, {"amount": -1.0}]
    return raw_rows(*rows, {"transaction_id": "T1", "amount": 7.0}, {"transaction_id": "T3", "amount": 8.0})


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """run_tiers, run_staged, run_kpis, source_enriched_csv, source_ledger_parquet (F1 to F5)."""
    fresh = spark.newSession()
    key = next(iter(SHORT_LIVED))
    fresh.conf.set(key, "false")
    bound_tasks(fresh)
    assert fresh.conf.get(key) == "false"  # a session's own value stays
    there = _shuffle_files(spark)
    df = spark.range(20_000).withColumn("k", F.hash("id")).repartition(8, "k")
    df.write.parquet(str(tmp_path / "table"))
    until = time.time() + 10
    while (left := _shuffle_files(spark) - there) and time.time() < until:
        time.sleep(0.1)
    assert not left
    counts = df.groupBy((F.col("id") % 7).alias("g")).count().orderBy("g")
    assert counts.collect() == counts.collect()  # a plan that runs again makes its files again


def test_publish_gives_what_the_operators_give(spark, raw_rows, tmp_path):
    """run_tiers, run_staged, run_kpis (F1, F2, F3): one copy of each ledger, rows shuffled by month once."""
    raw = _ledger(raw_rows)
    ws = workspace.Workspace(raw, None)
    ws.arrivals
    ws.publish(str(tmp_path))
    staged, flagged = staging.stage(raw), rules.score_ledger(staging.stage(raw))
    assert ws.staged.schema.names == staged.schema.names and ws.flagged.columns == flagged.columns == list(schemas.FLAGGED_COLUMNS)
    assert [f.dataType for f in ws.staged.schema] == [f.dataType for f in staged.schema]
    assert _texts(ws.staged) == _texts(staged) and _texts(ws.flagged) == _texts(flagged)
    assert not os.path.exists(ws._arrivals_folder.removeprefix("file:")) and "enriched" not in vars(ws)
    assert {f.split("/")[-4] for f in ws.staged.inputFiles()} == {"staged"} and "_grouped" in vars(ws)
    months = [row["count"] for row in ws.staged.groupBy("transaction_year", "transaction_month").count().collect()]
    assert len(ws.staged.inputFiles()) == len(ws.flagged.inputFiles()) == len(months) == 3  # small months are not scattered
    assert ws.enriched.count() == sum(months) and set(ws.enriched.columns) == set(schemas.ENRICHED_COLUMNS)


def test_run_is_not_staged_again_for_its_columns(spark):
    """run_tiers, run_staged, run_kpis (F1, F2, F3): before, the columns were asked of a second staging and scoring."""
    folder = f"{SMALL}/."  # a workspace of its own
    found = {name: contract.queries()[name](spark, folder) for name in ("run_staged", "run_kpis", "run_tiers")}
    ws = contract._workspace(spark, folder)
    assert not {"arrivals", "staged", "flagged", "_grouped"} & set(vars(ws))
    assert found["run_staged"].count() == 4647 and len(found["run_staged"].columns) == len(schemas.STAGED_COLUMNS)
    assert found["run_kpis"].first()["Total_Transactions"] == 4647
    assert dict(found["run_tiers"].dtypes)["txn_count"] == "bigint"
    for name in ("staged", "flagged"):
        assert all(f"/ledger/{name}/" in path for path in ws.run.tables[name].inputFiles())
    assert ws.run.tables["enriched"].count() == 4647 and ws.run.tables["quarantine"].count() >= 0


def test_tables_are_written_with_the_better_codec(raw_rows):
    """source_enriched_csv (F4)."""
    ws = workspace.Workspace(_ledger(raw_rows), None)
    for table in (ws.arrivals, ws._grouped, ws._scored):
        assert all(path.endswith(f".{files.COMPRESSION}.parquet") for path in table.inputFiles())


def test_rows_gathered_after_the_shuffle_or_before(spark, tmp_path):
    rows = spark.range(60).select("id", (F.col("id") % 3).alias("part"))
    twice = lambda df: df.withColumn("twice", F.col("id") * 2)
    files.write_parquet(rows, str(tmp_path / "a"), ("part",), then=twice)
    table = spark.read.parquet(str(tmp_path / "a"))
    assert sorted(map(tuple, table.select("id", "part", "twice").collect())) == [(n, n % 3, 2 * n) for n in range(60)]
    files.write_parquet(table, str(tmp_path / "b"), ("part",), gathered=True)
    again = spark.read.parquet(str(tmp_path / "b"))
    assert _texts(again) == _texts(table) and len(again.inputFiles()) == len(table.inputFiles())


def test_feed_in_order_leaves_no_second_copy(spark, raw_rows, tmp_path, monkeypatch):
    """source_ledger_parquet (F5): the feed is written before it is sorted, and that copy goes."""
    raw, paths = _ledger(raw_rows), {}
    made = lambda session, label: paths.setdefault(label, scratch.scratch_path(session, label))
    monkeypatch.setattr(contract, "scratch_path", made)
    back = contract._parquet_feed(SimpleNamespace(raw=raw))
    assert _texts(back) == _texts(staging.stage(raw))
    there = {label: os.path.exists(path.removeprefix("file:")) for label, path in paths.items()}
    assert there == {"feed": True, "whole": False}
