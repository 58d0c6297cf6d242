from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.operators import detect, features, rules
from tallyguard.operators.priority import with_narrative


def _flags(df, name):
    return [row[name] for row in df.orderBy("n").collect()]


def _amounts(spark, values):
    return spark.createDataFrame(list(enumerate(map(float, values))), "n int, amount double")


def test_structuring_bands(spark):
    values = [4799.99, 4800, 4999.99, 5000, 9499.99, 9500, 9999.99, 47999.99, 48000, 49999.99, 50000]
    want = [0, 1, 1, 0, 0, 1, 1, 0, 1, 1, 0]
    frame = _amounts(spark, values)
    assert _flags(frame.withColumn("f", rules.threshold_structuring(F.col("amount"))), "f") == want
    assert _flags(features.add_features(frame), "is_structuring_candidate") == want


def test_round_sums(spark):
    frame = _amounts(spark, [4999.99, 5000, 5000.01, 7500, 10000])
    assert _flags(frame.withColumn("f", rules.round_amount(F.col("amount"))), "f") == [0, 1, 0, 0, 1]
    wider = features.add_features(_amounts(spark, [999, 1000, 7000, 7500]))
    assert _flags(wider, "is_clean_round_sum") == [0, 1, 1, 0]


def test_first_digit_and_distance(spark):
    frame = features.add_features(_amounts(spark, [0.5, 1.0, 987.65, 12345678.9, 7000]))
    assert _flags(frame, "first_digit") == [0, 1, 9, 1, 7]
    assert _flags(frame, "threshold_dist")[-1] == 2000.0


def test_weekend_floor(staged_rows):
    staged = staged_rows(
        {"transaction_date": "2024-03-02", "amount": 14999.99},
        {"transaction_date": "2024-03-02", "amount": 15000.0},
        {"transaction_date": "2024-03-01", "amount": 15000.0},
    )
    flagged = {r["transaction_id"]: r["flag_weekend_posting"] for r in rules.score_ledger(staged).collect()}
    assert flagged == {"T1": 0, "T2": 1, "T3": 0}


def test_spike_is_strict(staged_rows):
    # mean 100, one row exactly five times the mean
    rows = [{"amount": 500.0}, *[{"amount": 20.0, "invoice_number": f"I{n}"} for n in range(5)]]
    flagged = rules.score_ledger(staged_rows(*rows)).collect()
    assert {r["dept_baseline_mean"] for r in flagged} == {100.0}
    assert sum(r["flag_spend_spike"] for r in flagged) == 0


def test_duplicates_flag_all_members_but_never_without_invoice(staged_rows):
    staged = staged_rows(
        {"invoice_number": "A"},
        {"invoice_number": "A", "transaction_date": "2024-03-04"},
        {"invoice_number": "A", "amount": 100.01},
        {"invoice_number": None},
        {"invoice_number": None},
    )
    flagged = {r["transaction_id"]: r for r in rules.score_ledger(staged).collect()}
    assert [flagged[f"T{n}"]["flag_duplicate_invoice"] for n in range(1, 6)] == [1, 1, 0, 0, 0]
    assert flagged["T4"]["flag_missing_governance"] == 1
    report = detect.duplicate_invoices(staged).collect()
    assert [(r["transaction_id"], r["duplicate_instance_num"], r["total_duplicate_occurrences"]) for r in report] == [
        ("T1", 1, 2),
        ("T2", 2, 2),
    ]


def _scored(spark, **flags):
    names = list(rules.DEFAULT.weights)
    row = tuple(flags.get(name.removeprefix("flag_"), 0) for name in names)
    return rules.with_score(spark.createDataFrame([row], ", ".join(f"{n} int" for n in names))).first()


@pytest.mark.parametrize(
    ("flags", "score", "tier", "reason"),
    [
        ({}, 0, "Low", "Normal Verified Business Spend"),
        ({"round_amount": 1}, 20, "Medium", "Suspicious Round-Sum Billing"),
        ({"duplicate_invoice": 1}, 35, "High", "Potential Duplicate Invoice Payment"),
        ({"threshold_structuring": 1, "spend_spike": 1}, 60, "Critical", "Approval Limit Structuring / Split Purchase"),
        ({"spend_spike": 1, "missing_governance": 1}, 55, "High", "Extreme Statistical Spend Outlier"),
        ({"missing_governance": 1, "round_amount": 1}, 45, "High", "Unverified Transaction - Missing Governance"),
        ({"weekend_posting": 1}, 20, "Medium", "High-Value Off-Hours / Weekend Posting"),
        (
            {"duplicate_invoice": 1, "threshold_structuring": 1, "missing_governance": 1, "spend_spike": 1},
            100,
            "Critical",
            "Potential Duplicate Invoice Payment",
        ),
    ],
)
def test_score_tier_reason(spark, flags, score, tier, reason):
    row = _scored(spark, **flags)
    assert (row["risk_score"], row["risk_tier"], row["primary_flag_reason"]) == (score, tier, reason)
    assert row["total_rules_triggered"] == len(flags)


def test_flagged_schema(staged_rows):
    flagged = rules.score_ledger(staged_rows({}))
    assert [(f.name, f.dataType) for f in flagged.schema] == [(f.name, f.dataType) for f in schemas.FLAGGED]


def test_narrative_wording(spark):
    columns = (
        "vendor_name string, amount double, dept_spend_multiplier double, dept_baseline_mean double, day_name string, "
        "flag_duplicate_invoice int, flag_threshold_structuring int, flag_spend_spike int, stat_zscore_flag int, "
        "flag_missing_governance int, flag_weekend_posting int, flag_round_amount int, ml_iso_forest_flag int, "
        "ml_anomaly_score double"
    )
    rows = [
        ("ACME", 75000.0, 5.25, 13382.2557, "Saturday", 1, 0, 1, 0, 0, 1, 1, 1, 91.5),
        ("ACME", 4999.5, 5.35, 1000.0, "Monday", 0, 1, 0, 1, 1, 0, 0, 0, 10.0),
        ("ACME", 1.0, 1.0, 1.0, "Monday", 0, 0, 0, 0, 0, 0, 0, 0, 1.0),
    ]
    found = [r[-1] for r in with_narrative(spark.createDataFrame(rows, columns)).collect()]
    assert found == [
        "Duplicate invoice detected for vendor 'ACME' ($75,000.00); Spend spike (5.2x department norm of $13,382.26); "
        "High-value post executed on Saturday; Unusual clean round-sum retainer billing; "
        "High ML Isolation Forest score (91.5/100)",
        "Amount $4,999.50 structured immediately below approval threshold; "
        "Spend spike (5.3x department norm of $1,000.00); Missing mandatory approver ID or invoice voucher",
        "Elevated risk characteristics",
    ]
