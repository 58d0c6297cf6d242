from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__ as contract
from tallyguard import schemas
from tallyguard.operators import rules, staging
from tallyguard.plans.audit_run import run_audit
from tallyguard.sources import files, ledger
from tallyguard.operators.rolling import day_totals, rolling_spend
from tallyguard.streaming import controls, corrections, state


def test_ledger_csv_round_trip(spark, raw_rows, tmp_path):
    raw = raw_rows({"description": 'with "quotes", commas'}, {"approver_id": None}, {"invoice_number": ""})
    files.write_csv(raw, str(tmp_path / "feed"))
    back = files.read_ledger_csv(spark, str(tmp_path / "feed"))
    assert staging.stage(back).orderBy("transaction_id").collect() == staging.stage(raw).orderBy("transaction_id").collect()


def test_feed_without_ordinal(spark, raw_rows, tmp_path):
    raw = raw_rows({"transaction_id": "A", "amount": 2.0}, {"transaction_id": "A", "amount": 1.0}).drop("ingest_seq")
    raw.coalesce(1).write.parquet(str(tmp_path / "feed"))
    feed = files.read_ledger_parquet(spark, str(tmp_path / "feed"))
    assert [r["amount"] for r in staging.stage(feed).collect()] == [2.0]
    files.write_csv(raw, str(tmp_path / "csv"), single_file=True)
    plain = files.read_ledger_csv(spark, str(tmp_path / "csv"), arrival=False)
    assert plain.where("ingest_seq is null").count() == 2
    with pytest.raises(Exception, match="no arrival ordinal"):
        staging.stage(plain).collect()
    assert [r["amount"] for r in staging.stage(plain, order=("amount",)).collect()] == [1.0]
    with pytest.raises(ValueError, match="no arrival ordinal"):
        staging.stage(raw)


def test_written_feed_has_no_fixed_number_of_files(spark, raw_rows, many_parts, monkeypatch):
    from types import SimpleNamespace

    read, paths = files.read_ledger_parquet, []
    monkeypatch.setattr(files, "read_ledger_parquet", lambda session, path: paths.append(path) or read(session, path))
    raw = raw_rows(*[{} for _ in range(200)])
    back = contract._parquet_feed(SimpleNamespace(raw=raw))
    assert sorted(r.transaction_id for r in back.collect()) == sorted(f"T{i}" for i in range(1, 201))
    assert len(spark.read.parquet(paths[0]).inputFiles()) == 8  # spark.sql.shuffle.partitions of the tests


def test_files_come_before_rows(spark, raw_rows, tmp_path):
    """Of an id in two files, the one in the earlier file arrived first, whatever its row."""
    for name, rows in (("a", [{"transaction_id": "B"}, {"transaction_id": "A", "amount": 100.0}]), ("b", [{"transaction_id": "A", "amount": 999.0}])):
        raw_rows(*rows).drop("ingest_seq").coalesce(1).write.parquet(str(tmp_path / name))
    feed = files.read_ledger_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert {r["transaction_id"]: r["amount"] for r in staging.stage(feed).collect()}["A"] == 100.0


def test_cells_with_line_breaks(spark, raw_rows, tmp_path):
    files.write_csv(raw_rows({"description": "two\nlines"}, {}), str(tmp_path / "feed"))
    assert files.read_ledger_csv(spark, str(tmp_path / "feed"), multi_line=True).count() == 2


def test_lines_with_orphan_keys_stay(spark):
    tables = ledger.load_tables(spark, SMALL, ledger.LEDGER_TABLES)
    missing = {**tables, "supplier": tables["supplier"].where("s_suppkey > 3"), "customer": tables["customer"].where("c_custkey % 5 > 0")}
    whole, raw = ledger.derive_ledger(tables, ()), ledger.derive_ledger(missing, ())
    assert raw.count() == whole.count()
    staged, held = staging.stage(raw).count(), staging.quarantine(raw)
    assert held.count() > 0 and staged + held.count() == staging.stage(whole).count() + staging.quarantine(whole).count()
    assert {"vendor_name", "department"} <= {c for r in held.collect() for c in r["missing_columns"].split(",")}


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_vendor_master(spark, str(tmp_path / "absent.csv"))


def test_tables_and_views(spark, raw_rows):
    staged = staging.stage(raw_rows({}, {}))
    files.replace_table(staged, "staged_ledger")
    files.replace_table(staged.limit(1), "staged_ledger")
    assert spark.table("staged_ledger").count() == 1
    files.append_table(staged.where("transaction_id = 'T2'"), "staged_ledger")
    assert spark.table("staged_ledger").count() == 2
    files.publish_view(rules.score_ledger(spark.table("staged_ledger")), "flagged_view")
    assert spark.sql("SELECT sum(risk_score) AS s FROM flagged_view").first()["s"] == 70
    files.replace_table(spark.table("flagged_view"), "flagged_ledger")
    assert files.read_flagged(spark, "flagged_ledger").count() == 2


def test_union_keeps_duplicates(raw_rows):
    raw = raw_rows({})
    assert files.union_feeds(raw, raw.select(*reversed(raw.columns)), raw).count() == 3


def test_whole_audit(spark, tmp_path):
    supplier = ledger.load_tables(spark, SMALL, ("supplier",))["supplier"]
    out = str(tmp_path / "out")
    result = run_audit(
        ledger.load_ledger(spark, SMALL), ledger.vendor_master_from(supplier), out, fact_partitions=("risk_tier",)
    )
    assert set(result.seconds) == {"score", "analyse", "export"}
    fact = spark.read.parquet(f"{out}/star/fact_parquet")
    assert fact.count() == 4647 and set(fact.columns) == {*schemas.FACT_COLUMNS, "transaction_year", "transaction_month"}
    for name in ("staged", "flagged"):
        ledger_table = spark.read.parquet(f"{out}/ledger/{name}")
        assert ledger_table.count() == 4647
        assert "PartitionFilters: [isnotnull(transaction_year" in ledger_table.where("transaction_year = 1996")._jdf.queryExecution().toString()
    counts = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/processed/row_counts").first()
    assert counts["raw_rows"] == sum(counts) - counts["raw_rows"] and counts["staged_rows"] == 4647
    enriched = files.read_enriched_csv(spark, f"{out}/processed/enriched_transactions")
    assert enriched.count() == 4647
    assert enriched.columns == list(schemas.ENRICHED_COLUMNS)
    assert enriched.where("transaction_date is null or amount is null or risk_tier is null").count() == 0
    kpis = spark.read.option("header", True).csv(f"{out}/processed/kpis").first()
    assert (kpis["Total_Transactions"], kpis["Critical_Risk_Count"]) == ("4647", "24")
    assert spark.read.option("header", True).csv(f"{out}/processed/top_50").count() == 50


@pytest.fixture
def payments(spark, tmp_path):
    """Events in three files, to be read one file per batch."""
    start = dt.datetime(2024, 1, 1)
    rows = [
        [(1, 0, 7, "a", 49.0), (2, 1, 7, "a", 49.0), (3, 2, 8, "a", 49.0)],
        [(4, 30, 7, "a", 49.0), (5, 31, 9, "b", 120.0), (6, 32, 9, "b", 120.0)],
        [(7, 500, 9, "b", 120.0), (8, 501, 8, "b", 1.0)],
    ]
    for number, part in enumerate(rows):
        frame = spark.createDataFrame(
            [(i, start + dt.timedelta(hours=h), u, t, v, "{}") for i, h, u, t, v in part], schemas.EVENTS
        )
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{number}"))
    folder = str(tmp_path / "in/*")
    return lambda: ledger.event_rows(
        controls.read_files(spark, folder, schemas.EVENTS, files_per_batch=1), controls.utc_instant("ts")
    )


def test_block_across_batches(payments):
    decided = {r["event_id"]: r["decision"] for r in controls.release_or_block(payments()).collect()}
    assert decided == {
        1: "released", 2: "blocked", 3: "released", 4: "blocked",
        5: "released", 6: "blocked", 7: "blocked", 8: "released",
    }


def test_block_goes_on_after_a_restart(spark, tmp_path):
    """A second run with the same folder sees only new files, and still knows what was paid before."""
    start = dt.datetime(2024, 1, 1)

    def feed(*rows):
        frame = spark.createDataFrame([(i, start, u, "a", 49.0, "{}") for i, u in rows], schemas.EVENTS)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        events = controls.read_files(spark, str(tmp_path / "in"), schemas.EVENTS)
        rows = ledger.event_rows(events, controls.utc_instant("ts"))
        return {r["event_id"]: r["decision"] for r in controls.release_or_block(rows, str(tmp_path / "out")).collect()}

    feed((1, 7), (2, 8))
    assert run() == {1: "released", 2: "released"}
    feed((3, 7), (4, 9))
    assert run() == {1: "released", 2: "released", 3: "blocked", 4: "released"}


def test_live_folders_are_the_digits_of_the_number():
    assert state.live_folders(0, 4) == []
    assert state.live_folders(7, 4) == [(1, 0), (0, 4), (0, 5), (0, 6)]
    assert state.live_folders(16 + 4, 4) == [(2, 0), (1, 16)]
    for batches in range(1, 300):
        held = [n for level, start in state.live_folders(batches, 3) for n in range(start, start + 3**level)]
        assert held == list(range(batches))


def _folders(root):
    return sorted(str(p.relative_to(root)) for p in root.glob("level=*/start=*"))


def test_state_is_merged_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = StructType().add("k", "string").add("n", "long").add("part", "integer")
    fold = lambda rows: rows.groupBy("k", "part").agg(F.sum("n").alias("n")).select("k", "n", "part")
    kept = state.BatchState(str(tmp_path), schema, "part", fold, fan=2)
    for number in range(9):
        for _ in range(2 if number % 4 == 3 else 1):  # some batches are interrupted after they were merged
            rows = spark.createDataFrame([("a", 1, 0), (f"b{number}", 1, 1)], schema)
            kept.add(rows if number != 4 else rows.limit(0), number)
            kept.merge(spark, number)
        found = kept.before(spark, number + 1, [0, 1]).groupBy("k").agg(F.sum("n").alias("n")).collect()
        batches = [n for n in range(number + 1) if n != 4]
        assert {r.k: r.n for r in found} == {"a": len(batches), **{f"b{n}": 1 for n in batches}}
        assert len(_folders(tmp_path)) <= 9
    assert kept.before(spark, 9, [0]).select("k").distinct().collect() == [("a",)]
    assert kept.before(spark, 0, [0]) is None and kept.before(spark, 3, []) is None
    assert _folders(tmp_path) == ["level=0/start=8", "level=3/start=0"]


def test_files_of_released_keys_do_not_grow_with_batches(spark, payments, tmp_path):
    target = tmp_path / "paid"
    plain = {r["event_id"]: r["decision"] for r in controls.release_or_block(payments()).collect()}
    merged = controls.release_or_block(payments(), str(target), fan=2, buckets=8)
    assert {r["event_id"]: r["decision"] for r in merged.collect()} == plain
    assert _folders(target / "keys") == ["level=0/start=2", "level=1/start=0"]
    assert len(list((target / "keys/level=1").rglob("*.parquet"))) <= 3  # at most one file for each of three keys


def _weeks(rows):
    named = rows.select("vendor_id", "department", "transaction_date", *corrections.WEEK_COLUMNS)
    return sorted((tuple(r) for r in named.collect()), key=str)


def test_late_rows_correct_their_weeks(spark, tmp_path):
    """Days come in any order, one micro-batch each, over a month's end and with a vendor that has no number."""
    start, sent = dt.datetime(2024, 1, 28), []
    for number, (day, user) in enumerate([(9, 1), (3, 1), (0, 1), (9, 2), (8, 1), (3, 1), (40, 1), (2, None), (3, None)]):
        row = (number, start + dt.timedelta(days=day), user, "a", 48.0 + number, "{}")
        frame = spark.createDataFrame([row], schemas.EVENTS)
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        sent.append(row)
        events = controls.read_files(spark, str(tmp_path / "in"), schemas.EVENTS)
        rows = ledger.event_rows(events, controls.utc_instant("ts"))
        versions = corrections.rolling_versions(rows, str(tmp_path / "out"), fan=2)
        arrived = ledger.event_rows(spark.createDataFrame(sent, schemas.EVENTS), controls.utc_instant("ts"))
        if number in (2, 5, 8):
            assert _weeks(corrections.latest(versions)) == _weeks(rolling_spend(arrived))
    counts = {(r.vendor_id, r.transaction_date.isoformat()): r.versions for r in corrections.latest(versions).collect()}
    assert counts[("VND-1", "2024-02-06")] == 4 and counts[("VND-1", "2024-01-31")] == 3 and counts[("VND-1", "2024-03-08")] == 1


def test_weeks_are_found_without_repeating_days(spark):
    """Days repeated for their weeks were broadcast by the size of the days before that: the driver ran out of memory."""
    start = dt.datetime(2024, 1, 28)
    sent = [(n, start + dt.timedelta(days=day), user, "a", 48.0 + n, "{}") for n, (day, user) in enumerate([(0, 1), (6, 1), (7, 1), (20, 1), (3, 2), (5, None)])]
    days = day_totals(ledger.event_rows(spark.createDataFrame(sent, schemas.EVENTS)), corrections.BY)
    fresh = days.where("transaction_date in ('2024-01-28', '2024-02-02')")
    weeks = corrections.weeks_touched(days, fresh, corrections.BY)
    plan = weeks._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Broadcast" not in plan
    found = {(r.vendor_id, r.transaction_date.isoformat()): (r.rolling_transactions, r.rolling_spend) for r in weeks.collect()}
    assert found == {("VND-1", "2024-01-28"): (1, 4800.0), ("VND-1", "2024-02-03"): (2, 9700.0), (None, "2024-02-02"): (1, 5300.0)}


def test_large_csv_is_compressed_and_reads_back(spark, tmp_path):
    rows = spark.range(20000).selectExpr("id", "concat('VND-', id % 7) as vendor")
    files.write_csv(rows, str(tmp_path / "many"))
    files.write_csv(rows.limit(3), str(tmp_path / "few"), single_file=True)
    parts = [p for p in (tmp_path / "many").glob("part-*")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts) and sum(p.stat().st_size for p in parts) < 100_000
    assert [p.suffix for p in (tmp_path / "few").glob("part-*")] == [".csv"]
    assert files.read_csv(spark, str(tmp_path / "many"), rows.schema).exceptAll(rows).isEmpty()
    assert files.read_csv(spark, str(tmp_path / "many"), rows.schema).count() == 20000


def test_missing_invoices_are_released(spark, payments):
    batch = spark.createDataFrame([("A", 1, "V", None, 1.0), ("B", 2, "V", None, 1.0)],
                                  "transaction_id string, event_time int, vendor_id string, invoice_number string, amount double")
    assert {r["decision"] for r in controls.decide_batch(batch, None).collect()} == {"released"}


def test_an_id_sent_twice_is_released_once(spark):
    rows = [("T1", 1, "V", "I", 5.0), ("T1", 1, "V", "I", 5.0), ("T2", 2, "V", "I", 5.0), (None, 3, "V", "J", 5.0)]
    batch = spark.createDataFrame(rows, "transaction_id string, event_time int, vendor_id string, invoice_number string, amount double")
    decided = sorted((r["transaction_id"] or "", r["decision"]) for r in controls.decide_batch(batch, None).collect())
    assert decided == [("", "released"), ("T1", "blocked"), ("T1", "released"), ("T2", "blocked")]


def test_rows_without_invoice_pass_the_state(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start, "V", None, 1.0), ("B", start, "V", None, 1.0), ("C", start, "V", "I", 1.0), ("D", start, "V", "I", 1.0)]
    schema = "transaction_id string, event_time timestamp, vendor_id string, invoice_number string, amount double"
    frame = spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = controls.read_files(spark, str(tmp_path / "in"), frame.schema)
    found = [r["transaction_id"] for r in controls.drain(controls.first_within(stream), "first").collect()]
    assert {"A", "B"} <= set(found) and len(found) == 3


def test_state_limited_block(payments):
    kept = controls.drain(controls.first_within(payments(), "4 days"), "first")
    found = {r["event_id"] for r in kept.collect()}
    assert {1, 3, 5, 8} <= found and not found & {2, 4, 6}


def test_stream_rules_equal_batch(spark):
    stream = contract._event_stream(spark, SMALL)
    events = contract._events(spark, SMALL)
    baseline = rules.department_baseline(events)
    drained = controls.drain(controls.rules(stream, baseline), "rules")
    batch = controls.rules(events, baseline)
    assert drained.exceptAll(batch).count() == 0 and batch.exceptAll(drained).count() == 0


def test_event_time_does_not_depend_on_the_session_zone(spark):
    def seconds():
        rows = contract._events(spark, SMALL).select(F.unix_seconds("event_time")).orderBy("event_id")
        return rows.limit(5).collect()

    before = seconds()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert seconds() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
