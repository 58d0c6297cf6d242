"""Forensic reports: repeated invoices, structuring sequences, extreme spend per department."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import cents, targeted_limit
from tallyguard.operators.rules import DUPLICATE_KEY, department_baseline, duplicate_groups
from tallyguard.plans.ordered import ordered_windows
from tallyguard.plans.quantiles import order_statistics
from tallyguard.plans.scratch import write_once
from tallyguard.plans.small_side import attach_group_values, settle


def duplicate_invoices(staged: DataFrame) -> DataFrame:
    """Every row of a repeated (vendor, invoice, amount), numbered by date and id.

    Only members of repeated groups are sorted.
    """
    repeats = write_once(duplicate_groups(staged), "duplicates")
    narrow = staged.select(
        "transaction_id", "transaction_date", "vendor_id", "vendor_name", "invoice_number", "amount"
    )
    members = attach_group_values(
        narrow, repeats, DUPLICATE_KEY, "invoice_rows", "transaction_id", "inner", settled=True
    )
    numbered = ordered_windows(
        write_once(members, "members"), DUPLICATE_KEY, ["transaction_date", "transaction_id"], number="duplicate_instance_num"
    )
    return numbered.select(
        *narrow.columns, "duplicate_instance_num", F.col("invoice_rows").alias("total_duplicate_occurrences")
    ).orderBy("vendor_id", "invoice_number", "transaction_date", "transaction_id")


def structuring_sequences(staged: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Payments just below a limit, with the payments before and after by the same department and approver.

    The neighbours come from the whole ledger; the filter on the band follows. A missing approver is a group
    of its own.
    """
    narrow = staged.select("transaction_id", "transaction_date", "department", "approver_id", "amount")
    placed = ordered_windows(
        narrow,
        ["department", "approver_id"],
        ["transaction_date", "transaction_id"],
        lag={"prev_txn_amount": "amount", "prev_txn_date": "transaction_date"},
        lead={"next_txn_amount": "amount"},
    )
    return (
        placed.withColumn("threshold_limit_targeted", targeted_limit(F.col("amount"), config.bands))
        .where(F.col("threshold_limit_targeted").isNotNull())
        .select(
            *narrow.columns,
            "threshold_limit_targeted",
            "prev_txn_amount",
            "prev_txn_date",
            "next_txn_amount",
        )
        .orderBy("department", "transaction_date", "transaction_id")
    )


def _tile_start(n, tile: int, tiles: int):
    """0-based rank at which a tile starts: the first ``n % tiles`` tiles are one row longer."""
    size, longer = F.floor(n / tiles), n % tiles
    return F.lit(tile - 1) * size + F.least(F.lit(tile - 1), longer)


def extreme_spend(staged: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """Rows in the top percentile tiles of their department's amounts, with mean and running spend.

    Which amount opens each reported tile is found by counting; only rows at or above the lowest of those
    amounts are ordered to number ties. The running sum needs every row in order and is carried across
    range partitions.
    """
    tiles, cut = config.ntile, config.ntile_cut
    reported = range(cut, tiles + 1)
    picks = {str(tile): lambda n, tile=tile: F.least(_tile_start(n, tile, tiles), n - 1) for tile in reported}
    opening = order_statistics(staged, "amount", ["department"], picks)
    thresholds = opening.groupBy("department").agg(
        F.max("n").alias("dept_rows"),
        F.min("value").alias("lowest_amount"),
        F.min("below").alias("rows_below"),
    )
    baseline = department_baseline(staged).drop("dept_rows")
    departments = settle(thresholds.join(baseline, "department"))

    narrow = staged.select("transaction_id", "transaction_date", "department", "vendor_name", "amount")
    rows = attach_group_values(narrow, departments, ["department"], "dept_rows", "transaction_id", "inner", settled=True)
    high = F.col("amount") >= F.col("lowest_amount")

    ranked = ordered_windows(
        rows.where(high), ["department"], ["amount", "transaction_id"], number="_number"
    ).withColumn("_rank", F.col("_number") + F.col("rows_below") - 1)
    # a department with fewer rows than tiles fills tile k with its k-th row
    tile = F.lit(0)
    for number in reported:
        tile = F.when(F.col("_rank") >= _tile_start(F.col("dept_rows"), number, tiles), F.lit(number)).otherwise(tile)
    top = ranked.withColumn("dept_amount_percentile", tile).where(F.col("dept_amount_percentile") >= cut)

    running = (
        ordered_windows(
            rows.withColumn("_cents", cents()),
            ["department"],
            ["transaction_date", "transaction_id"],
            running={"_running": "_cents"},
        )
        .where(high)
        .select("transaction_id", "_running")
    )
    return (
        top.join(running, "transaction_id")
        .select(
            *narrow.columns,
            F.round("dept_baseline_mean", 2).alias("dept_avg_spend"),
            F.round(F.try_divide("amount", "dept_baseline_mean"), 2).alias("ratio_to_dept_avg"),
            "dept_amount_percentile",
            F.round(F.col("_running") / 100.0, 2).alias("dept_cumulative_ytd_spend"),
        )
        .orderBy(F.desc("amount"), "transaction_id")
    )
