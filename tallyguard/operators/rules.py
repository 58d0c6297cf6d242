"""The six audit rules, the composite score and its tier and reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.config import DEFAULT, LOWEST_TIER, NO_REASON, RULE_REASONS, AuditConfig
from tallyguard.functions.money import flag, in_any_band, money_avg, round_cents
from tallyguard.operators.staging import repeated_groups
from tallyguard.plans.scratch import write_once
from tallyguard.plans.small_side import attach_group_values

DUPLICATE_KEY = ["vendor_id", "invoice_number", "amount"]


def duplicate_groups(staged: DataFrame) -> DataFrame:
    """(vendor, invoice, amount) values billed more than once; rows without an invoice never count."""
    return repeated_groups(staged.where(F.col("invoice_number").isNotNull()), DUPLICATE_KEY, "invoice_rows")


def department_baseline(staged: DataFrame) -> DataFrame:
    return staged.groupBy("department").agg(
        money_avg().alias("dept_baseline_mean"), F.count(F.lit(1)).alias("dept_rows")
    )


def round_amount(amount: Column, config: AuditConfig = DEFAULT) -> Column:
    whole = amount == F.round(amount, 0)
    multiple = amount.cast("long") % config.round_step == 0
    return flag((amount >= config.round_floor) & whole & multiple)


def threshold_structuring(amount: Column, config: AuditConfig = DEFAULT) -> Column:
    return flag(in_any_band(amount, config.bands))


def weekend_posting(is_weekend: Column, amount: Column, config: AuditConfig = DEFAULT) -> Column:
    return flag((is_weekend == 1) & (amount >= config.weekend_floor))


def missing_governance(approver: Column, invoice: Column) -> Column:
    return flag(approver.isNull() | invoice.isNull())


def spend_spike(amount: Column, baseline: Column, config: AuditConfig = DEFAULT) -> Column:
    return flag(amount > baseline * config.spike_multiple)


def spend_multiplier(amount: Column, baseline: Column) -> Column:
    return round_cents(F.try_divide(amount, baseline))


def raw_score(config: AuditConfig = DEFAULT) -> Column:
    total = F.lit(0)
    for name, points in config.weights.items():
        total = total + F.col(name) * points
    return total


def risk_tier(score: Column, config: AuditConfig = DEFAULT) -> Column:
    tier = F.lit(LOWEST_TIER)
    for name, floor in reversed(config.tiers):
        tier = F.when(score >= floor, F.lit(name)).otherwise(tier)
    return tier


def primary_reason() -> Column:
    reason = F.lit(NO_REASON)
    for name, text in reversed(RULE_REASONS):
        reason = F.when(F.col(name) == 1, F.lit(text)).otherwise(reason)
    return reason


def with_row_rules(df: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """The rules that need nothing but the row and its ``dept_baseline_mean``."""
    amount, baseline = F.col("amount"), F.col("dept_baseline_mean")
    return df.withColumns(
        {
            "dept_spend_multiplier": spend_multiplier(amount, baseline),
            "flag_round_amount": round_amount(amount, config),
            "flag_threshold_structuring": threshold_structuring(amount, config),
            "flag_weekend_posting": weekend_posting(F.col("is_weekend"), amount, config),
            "flag_missing_governance": missing_governance(F.col("approver_id"), F.col("invoice_number")),
            "flag_spend_spike": spend_spike(amount, baseline, config),
        }
    )


def with_score(df: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Rule count, capped score, tier and reason from the six flags."""
    triggered = F.lit(0)
    for name in config.weights:
        triggered = triggered + F.col(name)
    return (
        df.withColumn("_raw_score", raw_score(config))
        .withColumns(
            {
                "total_rules_triggered": triggered,
                "risk_score": F.least("_raw_score", F.lit(config.score_cap)),
                "risk_tier": risk_tier(F.col("_raw_score"), config),
                "primary_flag_reason": primary_reason(),
            }
        )
        .drop("_raw_score")
    )


def with_group_values(staged: DataFrame) -> DataFrame:
    """Staged ledger with what the rules take from a row's groups: ``flag_duplicate_invoice``, ``dept_baseline_mean``.

    Duplicate groups and department means are aggregated first (with map-side combine) and joined to the
    rows; a window per department or per invoice would put each group in one task. ``staged`` is read three
    times, so it should be a written table. A null department matches no baseline and drops out.
    """
    repeats = write_once(duplicate_groups(staged), "duplicates")
    rows = attach_group_values(staged, repeats, DUPLICATE_KEY, "invoice_rows", "transaction_id", "left", settled=True)
    rows = rows.withColumn("flag_duplicate_invoice", flag(F.col("invoice_rows") > 1))
    rows = attach_group_values(
        rows, department_baseline(staged), ["department"], "dept_rows", "transaction_id", "inner"
    )
    return rows.drop("invoice_rows", "dept_rows")


def judged(rows: DataFrame, config: AuditConfig = DEFAULT, more: Sequence[str] = ()) -> DataFrame:
    """Flagged ledger from the rows of ``with_group_values``; all that it adds follows from the row itself.

    ``more`` names columns to keep after those of the flagged ledger.
    """
    return with_score(with_row_rules(rows, config), config).select(*schemas.FLAGGED_COLUMNS, *more)


def score_ledger(staged: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Staged ledger to flagged ledger."""
    return judged(with_group_values(staged), config)
