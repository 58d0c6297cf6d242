"""Datasets behind the report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import cents, money_sum
from tallyguard.operators.measures import measure, slice_ledger
from tallyguard.plans.quantiles import exact_quantiles

# The five cards of the first page.
CARDS = ("total_spend", "value_at_risk", "anomaly_rate", "critical_risk_count", "duplicate_invoice_count")

# Columns of the investigation grid, in display order.
LEDGER_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "department",
    "vendor_name",
    "amount",
    "risk_score",
    "risk_tier",
    "ml_anomaly_score",
    "primary_flag_reason",
    "approver_id",
    "invoice_number",
)


def kpi_cards(fact: DataFrame) -> DataFrame:
    return measure(fact, CARDS)


def spend_by_tier(fact: DataFrame) -> DataFrame:
    return measure(fact, ["total_spend", "total_transactions"], ["risk_tier"])


def monthly_exposure(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Spend and flagged spend per calendar month; months without rows show no spend.

    The fact is summed per day before it meets the date dimension.
    """
    days = fact.groupBy("DateKey").agg(
        F.sum(cents()).alias("_cents"),
        F.sum(F.when(F.col("risk_tier") != "Low", cents()).otherwise(F.lit(0))).alias("_flagged"),
    )
    return (
        dates.join(days, "DateKey", "left")
        .groupBy("Year", "MonthNumber", "MonthYear")
        .agg(
            F.round(F.coalesce(F.sum("_cents"), F.lit(0)) / 100.0, 2).alias("total_spend"),
            F.round(F.coalesce(F.sum("_flagged"), F.lit(0)) / 100.0, 2).alias("total_flagged_spend"),
        )
        .orderBy("Year", "MonthNumber")
    )


def department_exposure(fact: DataFrame) -> DataFrame:
    return measure(fact, ["value_at_risk", "total_spend"], ["department"]).orderBy(
        F.desc("value_at_risk"), "department"
    )


def payment_by_tier(fact: DataFrame) -> DataFrame:
    return measure(fact, ["total_spend", "total_transactions"], ["payment_method", "risk_tier"])


def exposure_by_reason(fact: DataFrame) -> DataFrame:
    names = ["total_spend", "total_transactions", "average_transaction_amount"]
    return measure(fact, names, ["primary_flag_reason"]).orderBy(F.desc("total_spend"))


def amount_score_points(fact: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Points of the amount by score plot: one row per distinct point, with how many rows share it."""
    points = fact.where(F.col("amount").between(0, config.scatter_amount))
    return points.groupBy("department", "amount", "risk_score").agg(F.count(F.lit(1)).alias("point_rows"))


def weekend_by_day(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """High-value weekend spend per day of the week, named by the date dimension."""
    days = (
        fact.where(F.col("flag_weekend_posting") == 1)
        .groupBy("DateKey")
        .agg(F.sum(cents()).alias("_cents"), F.count(F.lit(1)).alias("_rows"))
    )
    return days.join(dates.select("DateKey", "DayOfWeekNumber", "DayOfWeekName"), "DateKey").groupBy(
        "DayOfWeekNumber", "DayOfWeekName"
    ).agg(
        F.round(F.sum("_cents") / 100.0, 2).alias("weekend_high_value_spend"),
        F.sum("_rows").alias("weekend_flagged_count"),
    )


def rules_against_model(fact: DataFrame) -> DataFrame:
    """Rule engine and isolation forest side by side: rows for each pair of verdicts."""
    return fact.groupBy(
        F.when(F.col("risk_tier") != "Low", F.lit(1)).otherwise(F.lit(0)).alias("rules"),
        F.col("ml_iso_forest_flag").alias("forest"),
    ).agg(F.count(F.lit(1)).alias("overlap_rows"))


def vendor_quadrants(vendors: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Vendors by spend and mean score, split at the median spend and a fixed score."""
    median = exact_quantiles(vendors, "Total_Invoiced", {"median": 0.5}).select("median").scalar()
    spend = F.when(F.col("Total_Invoiced") > F.col("median_spend"), F.lit("high spend")).otherwise(F.lit("low spend"))
    risk = F.when(F.col("Avg_Risk_Score") > config.quadrant_score, F.lit("high risk")).otherwise(F.lit("low risk"))
    return vendors.withColumn("median_spend", F.round(median, 4)).select(
        "vendor_id",
        "vendor_name",
        F.round("Total_Invoiced", 2).alias("Total_Invoiced"),
        F.round("Avg_Risk_Score", 4).alias("Avg_Risk_Score"),
        "Duplicate_Invoice_Count",
        "median_spend",
        F.concat_ws(", ", spend, risk).alias("quadrant"),
    )


def exposed_vendors(vendors: DataFrame, k: int = 20) -> DataFrame:
    return (
        vendors.select(
            "vendor_id",
            "vendor_name",
            "primary_department",
            F.round("Total_Invoiced", 2).alias("Total_Invoiced"),
            "Duplicate_Invoice_Count",
            F.round("Avg_Risk_Score", 4).alias("Avg_Risk_Score"),
            "risk_tier",
        )
        .orderBy(F.desc("Total_Invoiced"), "vendor_id")
        .limit(k)
    )


def approval_breakdown(fact: DataFrame) -> DataFrame:
    """Rows and spend with and without complete governance, per department."""
    return fact.groupBy("department", "flag_missing_governance").agg(
        F.count(F.lit(1)).alias("transactions"), F.round(money_sum(), 2).alias("spend")
    )


def investigation_ledger(df: DataFrame, ml: bool = True, **slicers) -> DataFrame:
    """The grid of single transactions, with drill-through filters; see ``slice_ledger``."""
    columns = [name for name in LEDGER_COLUMNS if ml or name != "ml_anomaly_score"]
    return slice_ledger(df, **slicers).select(*columns)
