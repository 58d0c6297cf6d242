from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.operators import agreement, aggregates, benford, detect, measures, outliers, rolling, rules, star


def _by(df, key):
    return {row[key]: row for row in df.collect()}


def test_equal_vendor_spend_shares_the_cumulative_percentage(staged_rows):
    staged = staged_rows(
        {"vendor_id": "A", "amount": 50.0},
        {"vendor_id": "B", "amount": 25.0},
        {"vendor_id": "C", "amount": 25.0},
    )
    rows = aggregates.vendor_concentration(staged).collect()
    assert [(r["vendor_id"], r["cumulative_spend_pct"]) for r in rows] == [("A", 50.0), ("B", 100.0), ("C", 100.0)]
    # ties beyond the cut still count
    assert aggregates.vendor_concentration(staged, k=2).collect()[1]["cumulative_spend_pct"] == 100.0


def test_months_compare_with_present_and_with_calendar_neighbours(staged_rows):
    staged = staged_rows(
        {"transaction_date": "2024-01-15", "amount": 100.0},
        {"transaction_date": "2024-03-15", "amount": 150.0},
        {"transaction_date": "2025-03-15", "amount": 300.0},
    )
    growth = [r["mom_growth_pct"] for r in aggregates.monthly_velocity(staged).collect()]
    assert growth == [None, 50.0, 100.0]
    assert [r["mom_spend_growth"] for r in measures.month_over_month(staged).collect()] == [0.0, 0.0, 0.0]
    yearly = measures.same_period_last_year(staged).collect()
    assert [(r["spend_previous_year"], r["yoy_spend_growth"]) for r in yearly] == [(None, 0.0), (None, 0.0), (150.0, 1.0)]


def test_january_follows_december(staged_rows):
    staged = staged_rows(
        {"transaction_date": "2023-12-15", "amount": 100.0}, {"transaction_date": "2024-01-15", "amount": 110.0}
    )
    assert [r["mom_spend_growth"] for r in measures.month_over_month(staged).collect()] == [0.0, 0.1]


@pytest.mark.parametrize("n", [7, 99, 100, 101, 250, 1003])
def test_extreme_spend_tiles(staged_rows, many_parts, n):
    # many ties, so that tile borders fall inside them
    rows = [
        {"transaction_id": f"T{k:04d}", "invoice_number": f"I{k}", "amount": float(1 + k % 5), "transaction_date": f"2024-01-{1 + k % 28:02d}"}
        for k in range(n)
    ]
    staged = staged_rows(*rows)
    order = sorted(rows, key=lambda r: (r["amount"], r["transaction_id"]))
    size, longer = divmod(n, 100)
    want, position = {}, 0
    for tile in range(1, 101):
        for row in order[position : position + size + (tile <= longer)]:
            want[row["transaction_id"]] = tile
        position += size + (tile <= longer)
    running, total = {}, 0.0
    for row in sorted(rows, key=lambda r: (r["transaction_date"], r["transaction_id"])):
        total += row["amount"]
        running[row["transaction_id"]] = total
    found = detect.extreme_spend(staged).collect()
    assert {r["transaction_id"]: r["dept_amount_percentile"] for r in found} == {k: t for k, t in want.items() if t >= 99}
    assert all(r["dept_cumulative_ytd_spend"] == running[r["transaction_id"]] for r in found)


def test_neighbours_come_from_the_whole_ledger(staged_rows, many_parts):
    staged = staged_rows(
        {"transaction_date": "2024-01-01", "amount": 10.0},
        {"transaction_date": "2024-01-02", "amount": 4900.0},
        {"transaction_date": "2024-01-03", "amount": 30.0},
        {"transaction_date": "2024-01-02", "amount": 9900.0, "approver_id": None},
    )
    rows = _by(detect.structuring_sequences(staged), "transaction_id")
    assert (rows["T2"]["prev_txn_amount"], rows["T2"]["next_txn_amount"]) == (10.0, 30.0)
    assert rows["T2"]["threshold_limit_targeted"] == 5000
    assert (rows["T4"]["prev_txn_amount"], rows["T4"]["next_txn_amount"]) == (None, None)


def test_outliers_with_no_spread(spark):
    rows = [("flat", f"f{k}", 10.0) for k in range(5)] + [("single", "s", 7.0)]
    rows += [("mostly", f"m{k}", 10.0) for k in range(9)] + [("mostly", "m9", 1000.0)]
    df = spark.createDataFrame(rows, "department string, transaction_id string, amount double")
    both = _by(outliers.add_statistics(df), "transaction_id")
    assert both["f0"]["stat_zscore"] == 0.0 and both["f0"]["stat_zscore_flag"] == 0
    assert both["s"]["stat_zscore"] is None and both["s"]["stat_zscore_flag"] == 0
    # zero deviation falls back on the sample deviation of the amounts
    deviation = math.sqrt((9 * 99.0**2 + 891.0**2) / 9)
    assert both["m9"]["stat_zscore"] == pytest.approx(0.6745 * 990 / (deviation + 1e-6))
    assert both["m9"]["stat_iqr_flag"] == 1 and both["m0"]["stat_iqr_flag"] == 0
    mad = _by(outliers.mad_outliers(df), "transaction_id")
    iqr = _by(outliers.iqr_outliers(df), "transaction_id")
    for key, row in both.items():
        assert row["stat_zscore"] == mad[key]["stat_zscore"] and row["iqr_upper_bound"] == iqr[key]["iqr_upper_bound"]


def test_outliers_by_sketch(spark):
    df = spark.range(1000).select(
        F.lit("d").alias("department"), F.col("id").cast("string").alias("transaction_id"), F.col("id").cast("double").alias("amount")
    )
    exact, sketch = (outliers.iqr_outliers(df, method=m).first()["iqr_upper_bound"] for m in ("exact", "approx"))
    assert sketch == pytest.approx(exact, rel=0.01)


def test_benford_has_nine_rows(spark):
    df = spark.createDataFrame([(100.0,), (150.0,), (900.0,), (0.5,)], "amount double")
    rows = benford.benford(df).collect()
    assert [r["Digit"] for r in rows] == list(range(1, 10))
    assert rows[0]["Actual_Observed_Pct"] == 66.67 and rows[1]["Actual_Observed_Pct"] == 0.0
    assert rows[0]["Expected_Benford_Pct"] == 30.1 and rows[0]["Deviation_Pct"] == 36.57


def test_constant_detector_has_no_correlation(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (0, 1)], "a int, b int")
    rows = agreement.detector_correlation(df, {"a": F.col("a"), "b": F.col("b")}).collect()
    found = {(r["detector"], r["other"]): r["correlation"] for r in rows}
    assert found == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}


def test_vendor_without_transactions_has_zeros(spark, staged_rows):
    flagged = rules.score_ledger(staged_rows({}))
    master = spark.createDataFrame([("V1", "one", "d", "Low"), ("V2", "two", "d", "High")], schemas.VENDOR_MASTER)
    rows = _by(star.dim_vendor(flagged, master), "vendor_id")
    assert [rows["V2"][c] for c in rows["V2"].__fields__[4:]] == [0.0, 0, 0, 0, 0.0]
    assert rows["V1"]["Total_Invoiced"] == 100.0


def test_rolling_week_and_evasion(staged_rows):
    staged = staged_rows(
        {"transaction_date": "2024-01-01", "amount": 3000.0},
        {"transaction_date": "2024-01-07", "amount": 2500.0},
        {"transaction_date": "2024-01-08", "amount": 100.0},
        {"transaction_date": "2024-01-14", "amount": 6000.0},
    )
    rows = rolling.rolling_spend(staged).orderBy("transaction_date").collect()
    assert [r["rolling_spend"] for r in rows] == [3000.0, 5500.0, 2600.0, 6100.0]
    assert [r["evaded_limit"] for r in rows] == [None, 5000, None, None]
    assert rolling.split_purchase_alerts(staged).count() == 1


def test_empty_ledger(staged_rows):
    staged = staged_rows({"amount": -1.0})
    assert staged.count() == 0
    flagged = rules.score_ledger(staged)
    assert flagged.count() == 0
    assert aggregates.kpi_row(flagged).first()["Total_Transactions"] == 0
    assert star.dim_date(flagged).count() == 0
    assert detect.duplicate_invoices(staged).count() == 0
    assert measures.measure(flagged, ["total_spend", "anomaly_rate"]).first()["anomaly_rate"] == 0.0
    assert len(benford.benford(staged).collect()) == 9


def test_slicers(staged_rows):
    flagged = rules.score_ledger(
        staged_rows(
            {"transaction_date": "2023-02-01", "vendor_id": "A"},
            {"transaction_date": "2024-02-01", "vendor_id": "B", "approver_id": "X"},
            {"transaction_date": "2024-05-01", "vendor_id": "C", "department": "HR"},
        )
    )
    ids = lambda **s: {r["transaction_id"] for r in measures.slice_ledger(flagged, **s).collect()}
    assert ids(years=[2024], quarters=[1]) == {"T2"}
    assert ids(departments=["HR"]) == {"T3"}
    assert ids(vendors=["A", "C"]) == {"T1", "T3"}
    assert ids(approvers=["X"]) == {"T2"} and ids(tiers=["Critical"]) == set()
    assert len(ids(reasons=["Normal Verified Business Spend"])) == 3


def test_only_the_wanted_labels_are_planted(spark):
    from conftest import SMALL

    from tallyguard.sources import ledger, perturb

    tables = ledger.load_tables(spark, SMALL, ledger.LEDGER_TABLES)
    lines = tables["lineitem"].count()
    clean = ledger.derive_ledger(tables, kinds=())
    assert clean.count() == lines and clean.where("anomaly_type is not null").count() == 0
    two = ledger.derive_ledger(tables, kinds=(perturb.ROUND, perturb.REFED)).groupBy("anomaly_type").count()
    found = {r["anomaly_type"]: r["count"] for r in two.collect()}
    assert set(found) == {None, "ANOM_ROUND_AMOUNT", "ANOM_DUPLICATE_TXN_ID"}
    assert sum(found.values()) == lines + found["ANOM_DUPLICATE_TXN_ID"]
