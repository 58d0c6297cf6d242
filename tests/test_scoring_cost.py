"""Rounding, dates and digits by arithmetic give what the formatters give; tables are written without what follows from a row."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.functions import calendar, money
from tallyguard.operators import rules, staging
from tallyguard.plans import workspace


def _values(spark):
    draw = random.Random(7)
    exact = [0.0, -0.0, 0.005, 1.005, 2.675, -2.675, 0.995, 9.995, 0.1 + 0.2, 1e-9, 5e-4, 1e9, 999999999.995, 1e15, 1e300]
    exact += [999999999999999.9, float("nan"), float("inf"), float("-inf"), None]
    exact += [k / 1000 for k in range(5, 4000, 5)] + [draw.uniform(0, 3000) for _ in range(2000)]
    exact += [10 ** draw.uniform(-6, 18) * draw.choice((1, -1)) for _ in range(2000)]
    return spark.createDataFrame([(v,) for v in exact], "v double")


def _differ(df, new, old):
    text = lambda c: c.cast("string")  # tells the zeros apart
    return df.where(~text(new).eqNullSafe(text(old))).collect()


def test_round_cents_is_round(spark):
    assert _differ(_values(spark), money.round_cents("v"), F.round("v", 2)) == []


def test_leading_digit_is_that_of_the_text(spark):
    digit = F.regexp_extract(F.col("v").cast("string"), "^([1-9])", 1)
    by_text = F.coalesce(F.nullif(digit, F.lit("")).cast("int"), F.lit(0))
    assert _differ(_values(spark), money.leading_digit(F.col("v")), by_text) == []


def test_dates_are_those_of_the_formatter(spark):
    texts = "2024-02-29 2023-02-29 0000-01-01 0001-01-01 2024-13-01 2024-1-1 2024 +2024-01-01 12024-01-01 31/31/1996 today".split()
    texts += ["", " 2024-01-01", "2024-01-01 ", "2024-01-01\n", "1582-10-10", "9999-12-31", "2024-01-01T00:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert _differ(df, calendar.parse_date(F.col("t")), F.try_to_date("t", "yyyy-MM-dd")) == []
    step = F.nullif(F.col("id"), F.lit(9)).cast("int")
    days = spark.range(40).select(F.date_add(F.lit("1999-12-20").cast("date"), step).alias("d"))
    assert days.where(calendar.day_name(F.col("d")).isNull()).count() == 1
    assert _differ(days, calendar.day_name(F.col("d")), F.date_format("d", "EEEE")) == []


def test_written_tables_leave_out_what_follows_from_a_row(spark, raw_rows):
    """flagged_count (F15), backtest_with_ml (F18): before, every derived column was written two or three times."""
    rows = [{"amount": 100.0 + n, "department": ("IT", "HR")[n % 2], "vendor_id": f"V{n % 3}"} for n in range(40)]
    rows += [{"amount": 9990.0}, {"amount": 9990.0}, {"approver_id": " "}, {"department": None}, {"amount": -1.0}]
    raw = raw_rows(*rows)
    ws = workspace.Workspace(raw, None)
    derived = set(staging.calendar_columns(F.col("transaction_date"))) | {"risk_tier", "risk_score", "primary_flag_reason"}
    assert not derived & set(ws.arrivals.columns)
    assert not derived & set(ws._grouped.columns)
    assert not (derived | {"log_amount", "stat_zscore"}) & set(ws._scored.columns)
    # and the tables are what the operators give on their own
    plain = rules.score_ledger(staging.stage(raw))
    assert ws.flagged.columns == plain.columns == list(schemas.FLAGGED_COLUMNS)
    assert sorted(map(str, ws.flagged.collect())) == sorted(map(str, plain.collect()))
    assert sorted(map(str, ws.staged.collect())) == sorted(map(str, staging.stage(raw).collect()))
    held = staging.quarantine(raw)
    assert sorted(map(str, staging.quarantined_of(ws.arrivals).collect())) == sorted(map(str, held.collect()))
    assert ws.enriched.columns == [*ws.statistics.columns, "ml_iso_forest_flag", "ml_anomaly_score"]
    same = ws.enriched.select(*ws.statistics.columns)
    assert sorted(map(str, same.collect())) == sorted(map(str, ws.statistics.collect()))
