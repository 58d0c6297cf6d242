"""Report measures by name, to be evaluated under any grouping and any slicer."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.config import LOWEST_TIER
from tallyguard.functions.money import cents, count_where, money_avg, money_sum, safe_ratio
from tallyguard.plans.small_side import settle


def _tier(*names: str) -> Column:
    return F.col("risk_tier").isin(*names)


def _on(flag_name: str) -> Column:
    return F.col(flag_name) == 1


def _spend(where: Column | None = None) -> Column:
    return F.round(money_sum(where=where), 2)


def _flagged() -> Column:
    return F.col("risk_tier") != LOWEST_TIER


#: measure name -> aggregate over the fact
MEASURES: dict[str, Callable[[], Column]] = {
    "total_spend": lambda: _spend(),
    "total_transactions": lambda: F.count(F.lit(1)),
    "total_flagged_spend": lambda: _spend(_flagged()),
    "value_at_risk": lambda: _spend(_tier("High", "Critical")),
    "anomaly_rate": lambda: F.round(safe_ratio(money_sum(where=_flagged()), money_sum()), 6),
    "var_rate": lambda: F.round(safe_ratio(money_sum(where=_tier("High", "Critical")), money_sum()), 6),
    "high_risk_transaction_count": lambda: count_where(_tier("High", "Critical")),
    "critical_risk_count": lambda: count_where(_tier("Critical")),
    "average_transaction_amount": lambda: F.round(money_avg(), 2),
    "average_risk_score": lambda: F.round(F.avg("risk_score"), 4),
    "duplicate_invoice_count": lambda: count_where(_on("flag_duplicate_invoice")),
    "duplicate_invoice_exposure": lambda: _spend(_on("flag_duplicate_invoice")),
    "structuring_transaction_count": lambda: count_where(_on("flag_threshold_structuring")),
    "structuring_spend_exposure": lambda: _spend(_on("flag_threshold_structuring")),
    "weekend_flagged_count": lambda: count_where(_on("flag_weekend_posting")),
    "weekend_high_value_spend": lambda: _spend(_on("flag_weekend_posting")),
    "missing_governance_count": lambda: count_where(_on("flag_missing_governance")),
    "statistical_spikes_count": lambda: count_where(_on("flag_spend_spike")),
    "ml_detections": lambda: count_where(_on("ml_iso_forest_flag")),
}
#: measures that do not need the model columns
RULE_MEASURES = tuple(name for name in MEASURES if name != "ml_detections")


def slice_ledger(
    df: DataFrame,
    years: Sequence[int] = (),
    quarters: Sequence[int] = (),
    departments: Sequence[str] = (),
    reasons: Sequence[str] = (),
    approvers: Sequence[str] = (),
    vendors: Sequence[str] = (),
    tiers: Sequence[str] = (),
) -> DataFrame:
    """Report slicers and drill-through filters; an empty list keeps everything.

    All but the quarter are plain comparisons of stored columns, which reach the scan; years become date ranges.
    """
    by_column = {
        "department": departments,
        "primary_flag_reason": reasons,
        "approver_id": approvers,
        "vendor_id": vendors,
        "risk_tier": tiers,
    }
    for name, wanted in by_column.items():
        if wanted:
            df = df.where(F.col(name).isin(*wanted))
    if years:
        day, spans = F.col("transaction_date"), F.lit(False)
        for year in years:
            spans = spans | ((day >= F.lit(f"{year}-01-01").cast("date")) & (day <= F.lit(f"{year}-12-31").cast("date")))
        df = df.where(spans)
    if quarters:
        df = df.where(F.quarter("transaction_date").isin(*quarters))
    return df


def measure(df: DataFrame, names: Sequence[str], by: Sequence[str | Column] = (), where: Column | None = None) -> DataFrame:
    """The named measures per group of ``by``, or one row without it."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*by).agg(*[MEASURES[name]().alias(name) for name in names])


def _period_cents(df: DataFrame, by: Sequence[str], grain: str) -> tuple[list[str], DataFrame]:
    """Spend in cents per calendar period and group. The calendar bounds the number of periods."""
    parts = {"Year": F.year("transaction_date"), "MonthNumber": F.month("transaction_date")}
    names = ["Year"] if grain == "year" else ["Year", "MonthNumber"]
    columns = [parts[name].alias(name) for name in names]
    periods = df.groupBy(*by, *columns).agg(F.sum(cents()).alias("_cents"))
    return [*by, *names], settle(periods, "periods")  # joined with itself: the ledger is read once


def same_period_last_year(df: DataFrame, by: Sequence[str] = (), grain: str = "month") -> DataFrame:
    """Spend per month or year beside the same period a year earlier, with growth; 0 without an earlier one."""
    keys, periods = _period_cents(df, by, grain)
    earlier = periods.withColumn("Year", F.col("Year") + 1)
    return _growth(keys, periods, earlier, "spend_previous_year", "yoy_spend_growth")


def month_over_month(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Monthly spend beside the previous calendar month, with growth; 0 where that month has no rows."""
    keys, periods = _period_cents(df, by, "month")
    december = F.col("MonthNumber") == 12
    earlier = periods.withColumns(
        {
            "Year": F.when(december, F.col("Year") + 1).otherwise(F.col("Year")),
            "MonthNumber": F.when(december, F.lit(1)).otherwise(F.col("MonthNumber") + 1),
        }
    )
    return _growth(keys, periods, earlier, "spend_previous_month", "mom_spend_growth")


def _growth(keys: list[str], periods: DataFrame, earlier: DataFrame, previous_name: str, growth_name: str) -> DataFrame:
    """Both sides have one row per group and period."""
    change = F.col("_cents") - F.col("_earlier")
    return (
        periods.join(earlier.withColumnRenamed("_cents", "_earlier"), keys, "left")
        .select(
            *keys,
            F.round(F.col("_cents") / 100.0, 2).alias("total_spend"),
            F.round(F.col("_earlier") / 100.0, 2).alias(previous_name),
            F.round(safe_ratio(change, F.col("_earlier")), 6).alias(growth_name),
        )
        .orderBy(*keys)
    )
