from __future__ import annotations

from tallyguard import schemas
from tallyguard.operators import quality, staging


def _by_id(df):
    return {row["transaction_id"]: row for row in df.collect()}


def test_first_arrival_wins_even_if_invalid(raw_rows):
    raw = raw_rows(
        {"transaction_id": "A", "amount": -5.0, "ingest_seq": 1},
        {"transaction_id": "A", "amount": 10.0, "ingest_seq": 2},
        {"transaction_id": "B", "amount": 20.0, "ingest_seq": 9},
        {"transaction_id": "B", "amount": 30.0, "ingest_seq": 3},
    )
    staged = _by_id(staging.stage(raw))
    assert set(staged) == {"B"}
    assert staged["B"]["amount"] == 30.0


def test_rejects_are_the_rest(raw_rows):
    raw = raw_rows(*[{"transaction_id": "A", "ingest_seq": n} for n in (5, 3, 4)], {"transaction_id": "B"})
    rejects = staging.dedup_rejects(raw).collect()
    assert sorted((r["ingest_seq"], r["arrival_number"], r["arrivals"]) for r in rejects) == [(4, 2, 3), (5, 3, 3)]


def test_amount_filter_is_on_the_raw_amount(raw_rows):
    raw = raw_rows(*[{"amount": a} for a in (None, 0.0, -5.0, 0.004, 0.5)])
    assert {k: r["amount"] for k, r in _by_id(staging.stage(raw)).items()} == {"T4": 0.0, "T5": 0.5}


def test_cleansing(raw_rows):
    raw = raw_rows(
        {"currency": "  ", "approver_id": "   ", "invoice_number": " INV-9 ", "is_anomaly": None},
        {"currency": " GBP ", "approver_id": "\t", "is_anomaly": 1, "anomaly_type": "X"},
    )
    staged = _by_id(staging.stage(raw))
    assert staged["T1"]["currency"] == "USD" and staged["T2"]["currency"] == "GBP"
    assert staged["T1"]["approver_id"] is None and staged["T2"]["approver_id"] == "\t"
    assert staged["T1"]["invoice_number"] == "INV-9"
    assert staged["T1"]["vendor_name"] == "Vendor One"
    assert (staged["T1"]["ground_truth_anomaly"], staged["T1"]["ground_truth_type"]) == (0, "BENIGN_NORMAL")
    assert (staged["T2"]["ground_truth_anomaly"], staged["T2"]["ground_truth_type"]) == (1, "X")


def test_calendar_columns(raw_rows):
    raw = raw_rows({"transaction_date": "2024-03-02"}, {"transaction_date": "2024-03-03"}, {})
    found = {k: (r["day_of_week"], r["day_name"], r["is_weekend"]) for k, r in _by_id(staging.stage(raw)).items()}
    assert found == {"T1": (6, "Saturday", 1), "T2": (0, "Sunday", 1), "T3": (5, "Friday", 0)}


def test_schema(raw_rows):
    staged = staging.stage(raw_rows({}))
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in schemas.STAGED]


def test_bad_text_goes_to_quarantine(raw_rows):
    raw = raw_rows(
        {"amount": "12.345"},
        {"amount": "abc"},
        {"amount": "NaN"},
        {"amount": "5", "transaction_date": "01/02/2024"},
        {"amount": "5", "department": None},
        {"amount": "-1", "department": None},
        schema=schemas.RAW_LEDGER_TEXT,
    )
    assert {k: r["amount"] for k, r in _by_id(staging.stage(raw)).items()} == {"T1": 12.35}
    bad = {k: r["missing_columns"] for k, r in _by_id(staging.quarantine(raw)).items()}
    assert bad["T2"] == "amount" and bad["T3"] == "amount" and bad["T5"] == "department"
    assert bad["T4"] == "transaction_date,transaction_year,transaction_month,day_of_week,day_name"
    assert set(bad) == {"T2", "T3", "T4", "T5"}


def test_quality_checks(raw_rows, spark):
    raw = raw_rows(
        {"transaction_id": "A"},
        {"transaction_id": "A"},
        {"transaction_id": None},
        {"transaction_id": "B", "approver_id": None, "amount": 1000.01},
        {"transaction_id": "C", "approver_id": None, "amount": 1000.0, "vendor_id": "V9"},
    )
    assert {(r[0], r[1]) for r in quality.pk_violations(raw).collect()} == {("A", 2), (None, 1)}
    nulls = {r[0]: r[1] for r in quality.null_counts(raw, ("approver_id", "vendor_id")).collect()}
    assert nulls == {"approver_id": 2, "vendor_id": 0}
    assert [r["transaction_id"] for r in quality.unapproved_over(raw).collect()] == ["B"]
    master = spark.createDataFrame([("V1", "n", "d", "Low")], schemas.VENDOR_MASTER)
    assert [tuple(r) for r in quality.orphans(raw, master, "vendor_id").collect()] == [("V9", 1)]
    assert [tuple(r) for r in quality.known_members(raw, master, "vendor_id").collect()] == [("V1", 4)]


def test_one_pass_gives_staged_and_quarantine(raw_rows):
    rows = [{}, {"amount": -1.0}, {"amount": None}, {"department": None}, {"transaction_id": None}, {"transaction_id": None},
            {"transaction_id": "T1", "amount": 7.0}, {"department": None, "amount": 0.0}, {"transaction_date": "31/31/2024"}]
    raw = raw_rows(*rows)
    found = staging.arrivals(raw)
    assert {r["fate"] for r in found.collect()} == {"staged", "quarantined", "dropped"}
    for part, whole in ((staging.staged_of(found), staging.stage(raw)), (staging.quarantined_of(found), staging.quarantine(raw))):
        assert part.schema.names == whole.schema.names
        assert part.exceptAll(whole).isEmpty() and whole.exceptAll(part).isEmpty() and not whole.isEmpty()
    assert staging.row_counts(raw, found).first().asDict() == {
        "raw_rows": 9, "staged_rows": staging.stage(raw).count(), "quarantined_rows": staging.quarantine(raw).count(),
        "repeated_rows": 2, "dropped_rows": 3,
    }
