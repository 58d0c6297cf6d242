"""Declared schemas: nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(columns: dict) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_TEXT, _INT, _DOUBLE = StringType(), IntegerType(), DoubleType()

RAW_COLUMNS = {
    "transaction_id": _TEXT,
    "transaction_date": _TEXT,
    "account_id": _TEXT,
    "department": _TEXT,
    "vendor_id": _TEXT,
    "vendor_name": _TEXT,
    "amount": _DOUBLE,
    "currency": _TEXT,
    "payment_method": _TEXT,
    "invoice_number": _TEXT,
    "approver_id": _TEXT,
    "transaction_type": _TEXT,
    "description": _TEXT,
    "is_anomaly": _INT,
    "anomaly_type": _TEXT,
}

#: the feed as delivered, without an arrival ordinal
RAW_FEED = _struct(RAW_COLUMNS)
#: the feed with its arrival ordinal, which keep-first deduplication needs
RAW_LEDGER = _struct({**RAW_COLUMNS, "ingest_seq": LongType()})
#: the same feed with amounts as text, for sources that are not clean
RAW_LEDGER_TEXT = _struct({**RAW_COLUMNS, "amount": _TEXT, "ingest_seq": LongType()})

VENDOR_MASTER = _struct(
    {"vendor_id": _TEXT, "vendor_name": _TEXT, "primary_department": _TEXT, "risk_tier": _TEXT}
)

STAGED_COLUMNS = {
    "transaction_id": _TEXT,
    "transaction_date": DateType(),
    "transaction_year": _INT,
    "transaction_month": _INT,
    "day_of_week": _INT,
    "day_name": _TEXT,
    "is_weekend": _INT,
    "account_id": _TEXT,
    "department": _TEXT,
    "vendor_id": _TEXT,
    "vendor_name": _TEXT,
    "amount": _DOUBLE,
    "currency": _TEXT,
    "payment_method": _TEXT,
    "invoice_number": _TEXT,
    "approver_id": _TEXT,
    "transaction_type": _TEXT,
    "description": _TEXT,
    "ground_truth_anomaly": _INT,
    "ground_truth_type": _TEXT,
}
STAGED = _struct(STAGED_COLUMNS)

#: staged columns that must hold a value; rows that break this go to quarantine
STAGED_REQUIRED = (
    "transaction_date",
    "transaction_year",
    "transaction_month",
    "day_of_week",
    "day_name",
    "is_weekend",
    "account_id",
    "department",
    "vendor_id",
    "vendor_name",
    "amount",
    "currency",
    "payment_method",
    "transaction_type",
)
VENDOR_REQUIRED = ("vendor_name", "primary_department", "risk_tier")

_LABELS = ("ground_truth_anomaly", "ground_truth_type")
FLAGGED_COLUMNS = {
    **{name: kind for name, kind in STAGED_COLUMNS.items() if name not in _LABELS},
    "dept_baseline_mean": _DOUBLE,
    "dept_spend_multiplier": _DOUBLE,
    "flag_duplicate_invoice": _INT,
    "flag_round_amount": _INT,
    "flag_threshold_structuring": _INT,
    "flag_weekend_posting": _INT,
    "flag_missing_governance": _INT,
    "flag_spend_spike": _INT,
    "total_rules_triggered": _INT,
    "risk_score": _INT,
    "risk_tier": _TEXT,
    "primary_flag_reason": _TEXT,
    "ground_truth_anomaly": _INT,
    "ground_truth_type": _TEXT,
}
FLAGGED = _struct(FLAGGED_COLUMNS)

ENRICHED_COLUMNS = {
    **FLAGGED_COLUMNS,
    "log_amount": _DOUBLE,
    "threshold_dist": _DOUBLE,
    "is_structuring_candidate": _INT,
    "first_digit": _INT,
    "is_clean_round_sum": _INT,
    "stat_iqr_flag": _INT,
    "iqr_upper_bound": _DOUBLE,
    "stat_zscore": _DOUBLE,
    "stat_zscore_flag": _INT,
    "ml_iso_forest_flag": _INT,
    "ml_anomaly_score": _DOUBLE,
}
ENRICHED = _struct(ENRICHED_COLUMNS)

#: the reporting fact, in delivery order
FACT_COLUMNS = (
    "transaction_id",
    "DateKey",
    "transaction_date",
    "account_id",
    "department",
    "vendor_id",
    "vendor_name",
    "amount",
    "currency",
    "payment_method",
    "invoice_number",
    "approver_id",
    "transaction_type",
    "is_weekend",
    "dept_spend_multiplier",
    "risk_score",
    "risk_tier",
    "ml_anomaly_score",
    "primary_flag_reason",
    "flag_duplicate_invoice",
    "flag_round_amount",
    "flag_threshold_structuring",
    "flag_weekend_posting",
    "flag_missing_governance",
    "flag_spend_spike",
    "stat_iqr_flag",
    "stat_zscore_flag",
    "ml_iso_forest_flag",
    "ground_truth_anomaly",
    "ground_truth_type",
)

#: the event feed that the streaming controls read
EVENTS = _struct(
    {
        "event_id": LongType(),
        "ts": TimestampNTZType(),
        "user_id": LongType(),
        "event_type": _TEXT,
        "value": _DOUBLE,
        "props": _TEXT,
    }
)
