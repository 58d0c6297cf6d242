"""Data-quality checks: what a database would enforce as constraints, as reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import count_where


def pk_violations(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Key values that occur more than once, and a missing key however often it occurs."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.where((F.col("occurrences") > 1) | F.col(key).isNull())


def null_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per column with its number of missing values; a single pass over the table."""
    totals = df.agg(*[count_where(F.col(name).isNull()).alias(name) for name in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_count")) for name in columns])
    )
    return totals.select(pairs.alias("pair")).select("pair.column_name", "pair.null_count")


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values without a dimension row, with how many ledger rows use them.

    Counted before the join, so a hot key is one row.
    """
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("ledger_rows"))
    return used.join(dimension.select(key).distinct(), key, "left_anti")


def known_members(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values that do have a dimension row, with how many ledger rows use them."""
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("ledger_rows"))
    return used.join(dimension.select(key).distinct(), key, "left_semi")


def unapproved_over(df: DataFrame, limit: float | None = None, config: AuditConfig = DEFAULT) -> DataFrame:
    """Payments above the limit that nobody approved."""
    floor = config.approver_limit if limit is None else limit
    return df.where(F.col("approver_id").isNull() & (F.col("amount") > floor))
