"""Star schema: date, department and vendor dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.config import LOWEST_TIER
from tallyguard.functions import calendar
from tallyguard.functions.money import count_where, money_avg, money_sum
from tallyguard.plans.ordered import ordered_windows
from tallyguard.plans.small_side import bounded


def dim_date(df: DataFrame, column: str = "transaction_date") -> DataFrame:
    """One row per calendar day from the first to the last date of the ledger."""
    span = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("Date")
    )
    day = F.col("Date")
    return days.select(
        "Date",
        calendar.date_key(day).alias("DateKey"),
        F.year(day).alias("Year"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("Quarter"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.date_format(day, "MMM yyyy").alias("MonthYear"),
        F.dayofmonth(day).alias("DayOfMonth"),
        calendar.monday_one(day).alias("DayOfWeekNumber"),
        calendar.day_name(day).alias("DayOfWeekName"),
        F.when(calendar.monday_one(day).isin(6, 7), F.lit(1)).otherwise(F.lit(0)).alias("IsWeekend"),
        F.concat(F.lit("FY"), F.year(day).cast("string")).alias("FiscalYear"),
    )


def department_measures(df: DataFrame) -> DataFrame:
    risky = F.col("risk_tier").isin("High", "Critical")
    return df.groupBy("department").agg(
        money_sum().alias("Total_Spend"),
        F.count("transaction_id").alias("Transaction_Count"),
        money_avg().alias("Avg_Transaction_Size"),
        count_where(risky).alias("High_Risk_Transactions"),
    )


def dim_department(df: DataFrame) -> DataFrame:
    """Measures per department with a key from 1 in alphabetical order."""
    measures = department_measures(df)
    small = bounded(measures)
    if small is not None:
        keyed = small.withColumn("DepartmentKey", F.row_number().over(Window.orderBy("department")).cast("long"))
    else:
        keyed = ordered_windows(measures, [], ["department"], number="DepartmentKey")
    share = F.try_divide(F.col("High_Risk_Transactions"), F.col("Transaction_Count")) * 100
    return keyed.withColumn("Risk_Concentration_Pct", F.bround(share, 2))


def vendor_measures(df: DataFrame) -> DataFrame:
    return df.groupBy("vendor_id").agg(
        money_sum().alias("Total_Invoiced"),
        F.count("transaction_id").alias("Invoice_Count"),
        F.sum("flag_duplicate_invoice").alias("Duplicate_Invoice_Count"),
        count_where(F.col("risk_tier") != LOWEST_TIER).alias("Flagged_Count"),
        F.avg("risk_score").alias("Avg_Risk_Score"),
    )


def dim_vendor(df: DataFrame, master: DataFrame) -> DataFrame:
    """Every vendor of the master with its measures; a vendor without transactions has zeros.

    Both sides have one row per vendor, so the join has no hot key.
    """
    measures = ["Total_Invoiced", "Invoice_Count", "Duplicate_Invoice_Count", "Flagged_Count", "Avg_Risk_Score"]
    return master.join(vendor_measures(df), "vendor_id", "left").na.fill(0, measures)


def fact(df: DataFrame, ml: bool = True) -> DataFrame:
    """The reporting fact; without ``ml`` the two model columns are left out."""
    model = ("ml_anomaly_score", "ml_iso_forest_flag")
    columns = [name for name in schemas.FACT_COLUMNS if ml or name not in model]
    return df.withColumn("DateKey", calendar.date_key(F.col("transaction_date"))).select(*columns)
