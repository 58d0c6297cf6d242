"""Known anomalies labelled into a copy of a ledger, to backtest the detectors.

Every base row has a ``slot`` from 0 to 999 by key arithmetic, so the choice is the same on every run and on
every engine. All rows are kept: a slot decides which label, if any, a row gets.

Needs the ledger columns plus ``slot``, ``line_key`` (order-line), ``supplier_no`` and ``part_no``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Label:
    name: str
    first_slot: int
    last_slot: int

    def chosen(self) -> Column:
        return F.col("slot").between(self.first_slot, self.last_slot)


# Typology labels. The slots are this test bed's own.
ROUND = Label("ANOM_ROUND_AMOUNT", 0, 11)
STRUCTURING = Label("ANOM_THRESHOLD_STRUCTURING", 12, 25)
WEEKEND = Label("ANOM_WEEKEND_HOLIDAY", 26, 35)
GOVERNANCE = Label("ANOM_MISSING_GOVERNANCE", 36, 45)
OUTLIER = Label("ANOM_STATISTICAL_OUTLIER", 46, 53)
RESUBMITTED = Label("ANOM_DUPLICATE_INVOICE", 54, 63)
REFED = Label("ANOM_DUPLICATE_TXN_ID", 64, 68)
IN_PLACE = (ROUND, STRUCTURING, WEEKEND, GOVERNANCE, OUTLIER)
KINDS = (*IN_PLACE, RESUBMITTED, REFED)

# Amounts billed as round sums.
ROUND_AMOUNTS = (5000.0, 10000.0, 15000.0, 25000.0, 40000.0, 50000.0, 75000.0, 100000.0)
# Amounts just below approval limits.
STRUCTURED_AMOUNTS = (4850.0, 4995.0, 9650.0, 9990.0, 48500.0, 49980.0)
# mean amount that outliers are a multiple of
OUTLIER_BASE = 4774


def _pick(values: tuple[float, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _round_amounts(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "amount", F.when(ROUND.chosen(), _pick(ROUND_AMOUNTS, F.col("supplier_no"))).otherwise(F.col("amount"))
    )


def _structured_amounts(df: DataFrame) -> DataFrame:
    picked = _pick(STRUCTURED_AMOUNTS, F.col("supplier_no"))
    return df.withColumn("amount", F.when(STRUCTURING.chosen(), picked).otherwise(F.col("amount")))


def _off_hours(df: DataFrame) -> DataFrame:
    """About two thirds move to the Sunday of their week, the rest to 4 July; amounts become large."""
    day = F.col("transaction_date")
    moved = F.when(F.col("supplier_no") % 3 != 0, F.date_add(day, 6 - F.weekday(day))).otherwise(
        F.make_date(F.year(day), F.lit(7), F.lit(4))
    )
    large = 18000 + (F.col("part_no") * 7919 % 7700000) / 100.0
    return df.withColumns(
        {
            "transaction_date": F.when(WEEKEND.chosen(), moved).otherwise(day),
            "amount": F.when(WEEKEND.chosen(), large).otherwise(F.col("amount")),
        }
    )


def _missing_governance(df: DataFrame) -> DataFrame:
    """Invoice gone, approver blanked, or both."""
    which = F.col("supplier_no") % 3
    return df.withColumns(
        {
            "invoice_number": F.when(GOVERNANCE.chosen() & which.isin(1, 2), F.lit(None)).otherwise(
                F.col("invoice_number")
            ),
            "approver_id": F.when(GOVERNANCE.chosen() & which.isin(0, 2), F.lit("  ")).otherwise(
                F.col("approver_id")
            ),
        }
    )


def _outliers(df: DataFrame) -> DataFrame:
    extreme = (OUTLIER_BASE * (20 + F.col("part_no") % 46)).cast("double")
    return df.withColumn("amount", F.when(OUTLIER.chosen(), extreme).otherwise(F.col("amount")))


_IN_PLACE_STEPS = {
    ROUND: _round_amounts,
    STRUCTURING: _structured_amounts,
    WEEKEND: _off_hours,
    GOVERNANCE: _missing_governance,
    OUTLIER: _outliers,
}


def _with_copies(df: DataFrame, kinds: tuple[Label, ...]) -> DataFrame:
    """Chosen rows once more: a cloned invoice under a new id, or the same id fed again.

    The copies come out of an explode, so the base is read once.
    """
    original = F.lit("original")
    versions = F.array(original)
    for kind in (RESUBMITTED, REFED):
        if kind in kinds:
            versions = F.when(kind.chosen(), F.array(original, F.lit(kind.name))).otherwise(versions)
    rows = df.withColumn("version", F.explode(versions))
    cloned = F.col("version") == RESUBMITTED.name
    refed = F.col("version") == REFED.name
    return rows.withColumns(
        {
            "transaction_id": F.when(
                cloned, F.concat(F.lit("TXN-DUP-"), F.col("line_key"), F.lit("-"), F.col("part_no").cast("string"))
            ).otherwise(F.col("transaction_id")),
            "transaction_date": F.when(
                cloned, F.date_add("transaction_date", (F.col("supplier_no") % 4).cast("int"))
            ).otherwise(F.col("transaction_date")),
            "amount": F.when(refed, F.round(F.col("amount") + 1.0, 2)).otherwise(F.col("amount")),
            "ingest_seq": F.when(refed, F.col("ingest_seq") + 500000).otherwise(F.col("ingest_seq")),
            "description": F.when(cloned, F.concat(F.lit("[RE-SUBMITTED] "), F.col("description")))
            .when(refed, F.concat(F.lit("[DUPLICATE_FEED_RECORD] "), F.col("description")))
            .otherwise(F.col("description")),
        }
    )


def perturb(df: DataFrame, kinds: tuple[Label, ...] = KINDS) -> DataFrame:
    """Apply the given kinds and set ``is_anomaly`` and ``anomaly_type`` (null on untouched rows)."""
    label = F.lit(None).cast("string")
    for kind in IN_PLACE:
        if kind in kinds:
            df = _IN_PLACE_STEPS[kind](df)
            label = F.when(kind.chosen(), F.lit(kind.name)).otherwise(label)
    rows = _with_copies(df, kinds).withColumn(
        "anomaly_type", F.when(F.col("version") != "original", F.col("version")).otherwise(label)
    )
    return rows.withColumn("is_anomaly", F.when(F.col("anomaly_type").isNotNull(), F.lit(1)))
