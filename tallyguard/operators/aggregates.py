"""Summaries of the staged and the flagged ledger.

Each is one grouped aggregate with map-side combine. Windows run only on results that are already grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.config import BENIGN_LABEL, LOWEST_TIER
from tallyguard.functions.calendar import period_label
from tallyguard.functions.money import cents, count_where, money_avg, money_sum, share_pct
from tallyguard.plans.quantiles import exact_quantiles
from tallyguard.plans.small_side import attach_group_values, settle


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def dept_profile(staged: DataFrame) -> DataFrame:
    weekend = F.col("is_weekend") == 1
    return (
        staged.groupBy("department")
        .agg(
            _rows("total_transactions"),
            F.round(money_sum(), 2).alias("total_spend"),
            F.round(money_avg(), 2).alias("avg_transaction_amount"),
            F.round(F.min("amount"), 2).alias("min_amount"),
            F.round(F.max("amount"), 2).alias("max_amount"),
            count_where(weekend).alias("weekend_transaction_count"),
            count_where(F.col("approver_id").isNull()).alias("unapproved_transaction_count"),
            F.round(money_sum(where=weekend), 2).alias("weekend_spend_total"),
        )
        .orderBy(F.desc("total_spend"), "department")
    )


def dept_range(staged: DataFrame) -> DataFrame:
    """Mean, smallest and largest amount per department."""
    return staged.groupBy("department").agg(
        F.round(money_avg(), 2).alias("dept_avg_spend"),
        F.min("amount").alias("dept_min_spend"),
        F.max("amount").alias("dept_max_spend"),
    )


def vendor_totals(staged: DataFrame) -> DataFrame:
    return staged.groupBy("vendor_id", "vendor_name", "department").agg(
        _rows("transaction_count"), F.sum(cents()).alias("_cents")
    )


def vendor_concentration(staged: DataFrame, k: int = 25) -> DataFrame:
    """The k largest (vendor, department) spends with their share and the cumulative share down to them.

    The cumulative share of a spend counts everyone who spends as much or more, so equal spends share a value.
    Only the k largest distinct spends are needed for it; vendors are never ordered in one task.
    """
    totals = settle(vendor_totals(staged), "vendors")  # the ledger is read once
    top = totals.orderBy(F.desc("_cents"), "vendor_id", "department").limit(k)
    levels = totals.groupBy("_cents").agg(F.sum("_cents").alias("_level")).orderBy(F.desc("_cents")).limit(k)
    down_to = Window.orderBy(F.desc("_cents")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = levels.select("_cents", F.sum("_level").over(down_to).alias("_cumulative"))
    grand = totals.agg(F.sum("_cents").alias("_total"))
    # at most k rows on either side of the join
    return (
        top.join(F.broadcast(cumulative), "_cents")
        .withColumn("_total", grand.scalar())
        .select(
            "vendor_id",
            "vendor_name",
            "department",
            "transaction_count",
            F.round(F.col("_cents") / 100.0, 2).alias("total_vendor_spend"),
            share_pct(F.col("_cents"), F.col("_total")).alias("pct_of_global_spend"),
            share_pct(F.col("_cumulative"), F.col("_total")).alias("cumulative_spend_pct"),
        )
        .orderBy(F.desc("total_vendor_spend"), "vendor_id", "department")
    )


def monthly_velocity(staged: DataFrame) -> DataFrame:
    """Volume and spend per month and growth over the previous month that has any rows."""
    months = staged.groupBy("transaction_year", "transaction_month").agg(
        _rows("transaction_volume"), F.sum(cents()).alias("_cents")
    )
    # the calendar bounds the number of months
    previous = F.lag("_cents").over(Window.orderBy("transaction_year", "transaction_month"))
    return (
        months.withColumn("_previous", previous)
        .select(
            "transaction_year",
            "transaction_month",
            "transaction_volume",
            F.round(F.col("_cents") / 100.0, 2).alias("monthly_spend"),
            F.round(F.col("_cents") / 100.0 / F.col("transaction_volume"), 2).alias("monthly_avg_ticket"),
            share_pct(F.col("_cents") - F.col("_previous"), F.col("_previous")).alias("mom_growth_pct"),
        )
        .orderBy("transaction_year", "transaction_month")
    )


def payment_exposure(staged: DataFrame) -> DataFrame:
    methods = settle(staged.groupBy("payment_method").agg(_rows("total_transactions"), F.sum(cents()).alias("_cents")))
    total = methods.agg(F.sum("_cents")).scalar()
    return (
        methods.withColumn("_total", total)
        .select(
            "payment_method",
            "total_transactions",
            F.round(F.col("_cents") / 100.0, 2).alias("total_amount"),
            F.round(F.col("_cents") / 100.0 / F.col("total_transactions"), 2).alias("avg_amount"),
            share_pct(F.col("_cents"), F.col("_total")).alias("spend_share_pct"),
        )
        .orderBy(F.desc("total_amount"), "payment_method")
    )


def currency_mix(staged: DataFrame) -> DataFrame:
    """Rows and unconverted spend per currency."""
    return staged.groupBy("currency").agg(_rows("transactions"), F.round(money_sum(), 2).alias("spend"))


def tier_summary(flagged: DataFrame) -> DataFrame:
    return (
        flagged.groupBy("risk_tier")
        .agg(
            _rows("txn_count"),
            F.round(money_sum(), 2).alias("total_spend"),
            F.round(F.avg("risk_score"), 1).alias("avg_risk_score"),
        )
        .orderBy(F.desc("avg_risk_score"))
    )


def flagged_count(flagged: DataFrame) -> DataFrame:
    """Rows above the lowest tier and their percentage of all rows."""
    hit = F.col("risk_tier") != LOWEST_TIER
    return flagged.agg(
        count_where(hit).alias("flagged_transactions"),
        _rows("staged_transactions"),
        share_pct(count_where(hit), F.count(F.lit(1))).alias("flagged_pct"),
    )


def kpi_row(flagged: DataFrame) -> DataFrame:
    """The one-row table behind the report cards."""
    tier = F.col("risk_tier")
    hit = tier != LOWEST_TIER
    return flagged.agg(
        _rows("Total_Transactions"),
        F.round(money_sum(), 2).alias("Total_Spend_USD"),
        count_where(hit).alias("Total_Flagged_Transactions"),
        F.round(money_sum(where=hit), 2).alias("Total_Flagged_Spend_USD"),
        count_where(tier == "Critical").alias("Critical_Risk_Count"),
        F.round(money_sum(where=tier == "Critical"), 2).alias("Critical_Risk_Spend_USD"),
        count_where(tier == "High").alias("High_Risk_Count"),
        F.round(money_sum(where=tier == "High"), 2).alias("High_Risk_Spend_USD"),
        F.sum("flag_duplicate_invoice").alias("Duplicate_Invoices_Count"),
        F.sum("flag_threshold_structuring").alias("Structuring_Anomalies_Count"),
        F.sum("flag_weekend_posting").alias("Weekend_Spend_Anomalies_Count"),
    )


def monthly_flagged(flagged: DataFrame) -> DataFrame:
    return (
        flagged.groupBy("transaction_year", "transaction_month")
        .agg(
            F.round(money_sum(), 2).alias("total_spend"),
            F.round(money_sum(where=F.col("risk_tier") != LOWEST_TIER), 2).alias("flagged_spend"),
        )
        .withColumn("Period", period_label(F.col("transaction_year"), F.col("transaction_month")))
        .orderBy("Period")
    )


def _with_share(counts: DataFrame, count_col: str, share_col: str) -> DataFrame:
    counts = settle(counts)
    total = counts.agg(F.sum(count_col)).scalar()
    return (
        counts.withColumn("_total", total)
        .withColumn(share_col, share_pct(F.col(count_col), F.col("_total")))
        .drop("_total")
    )


def tier_share(flagged: DataFrame) -> DataFrame:
    return _with_share(flagged.groupBy("risk_tier").agg(_rows("tier_rows")), "tier_rows", "tier_pct")


def typology_mix(raw: DataFrame, label: str = "anomaly_type") -> DataFrame:
    """Rows per label, untouched rows included, with their percentage."""
    named = raw.withColumn("typology", F.coalesce(label, F.lit(BENIGN_LABEL)))
    counts = named.groupBy("typology").agg(_rows("typology_rows"))
    return _with_share(counts, "typology_rows", "typology_pct").orderBy(F.desc("typology_rows"), "typology")


def ledger_profile(raw: DataFrame) -> DataFrame:
    """Rows, date range, sum, mean and exact median of the feed."""
    summary = raw.agg(
        _rows("total_rows"),
        F.min("transaction_date").cast("string").alias("first_date"),
        F.max("transaction_date").cast("string").alias("last_date"),
        F.round(F.sum("amount"), 2).alias("gross_spend"),
        F.round(F.avg("amount"), 2).alias("mean_amount"),
    )
    median = exact_quantiles(raw, "amount", {"median": 0.5}).select("median")
    return summary.withColumn("median_amount", F.round(median.scalar(), 2))


def boxplot_stats(df: DataFrame, by: str = "department") -> DataFrame:
    """Quartiles, whiskers (the outermost amounts within 1.5 interquartile ranges) and points beyond them."""
    quartiles = exact_quantiles(df, "amount", {"q25": 0.25, "median": 0.5, "q75": 0.75}, [by])
    rows = attach_group_values(
        df.select(by, "amount", "transaction_id"), quartiles, [by], "n", "transaction_id", "inner"
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = F.col("amount").between(F.col("q25") - reach, F.col("q75") + reach)
    return rows.groupBy(by).agg(
        *[F.round(F.max(name), 4).alias(name) for name in ("q25", "median", "q75")],
        F.min(F.when(inside, F.col("amount"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("amount"))).alias("whisker_high"),
        count_where(~inside).alias("outside"),
    )
