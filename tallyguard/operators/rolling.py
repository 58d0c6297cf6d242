"""Rolling spend per vendor and department, to see limits being split over several payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import cents, in_any_band


#: what is known of a week
WEEK_COLUMNS = ("rolling_spend", "rolling_transactions", "largest_payment", "near_limit_payments", "evaded_limit")


def day_totals(df: DataFrame, by: tuple[str, ...], config: AuditConfig = DEFAULT) -> DataFrame:
    """Rows per vendor, department and day; sums and maxima of these give any longer window."""
    return df.groupBy(*by, "transaction_date").agg(
        F.sum(cents()).alias("_cents"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("amount").alias("_largest"),
        F.sum(F.when(in_any_band(F.col("amount"), config.bands), F.lit(1)).otherwise(F.lit(0))).alias("_near"),
    )


def with_evaded_limit(weeks: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    evaded = F.lit(None).cast("int")
    for limit in config.limits:
        split = (F.col("rolling_spend") >= limit) & (F.col("largest_payment") < limit)
        evaded = F.when(split, F.lit(limit)).otherwise(evaded)
    return weeks.withColumn("evaded_limit", evaded)


def rolling_spend(df: DataFrame, by: tuple[str, ...] = ("vendor_id", "department"), config: AuditConfig = DEFAULT) -> DataFrame:
    """Per vendor, department and day with rows: spend of the last seven days, and the limit it evades.

    ``evaded_limit`` is the highest approval limit that the window's spend reaches although every single
    payment in it stays below; null if there is none. Rows are summed per day first, so a window group has
    at most one row per calendar day.
    """
    days = day_totals(df, by, config)
    week = (
        Window.partitionBy(*by)
        .orderBy(F.datediff("transaction_date", F.lit("1970-01-01").cast("date")))
        .rangeBetween(-(config.rolling_days - 1), Window.currentRow)
    )
    placed = days.withColumns(
        {
            "rolling_spend": F.round(F.sum("_cents").over(week) / 100.0, 2),
            "rolling_transactions": F.sum("_rows").over(week),
            "largest_payment": F.max("_largest").over(week),
            "near_limit_payments": F.sum("_near").over(week),
        }
    )
    return with_evaded_limit(placed, config).select(*by, "transaction_date", *WEEK_COLUMNS)


def split_purchase_alerts(df: DataFrame, by: tuple[str, ...] = ("vendor_id", "department"), config: AuditConfig = DEFAULT) -> DataFrame:
    return rolling_spend(df, by, config).where(F.col("evaded_limit").isNotNull())
