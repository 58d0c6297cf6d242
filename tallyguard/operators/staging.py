"""From raw feed to staged ledger: keep-first deduplication, cleansing, typing, calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyguard import schemas
from tallyguard.config import BENIGN_LABEL, DEFAULT_CURRENCY
from tallyguard.functions import calendar
from tallyguard.functions.money import clean_text, round_cents
from tallyguard.plans.ordered import ordered_windows
from tallyguard.plans.scratch import write_once
from tallyguard.plans.small_side import attach_group_values

#: arrival order; the later columns only break ties
ARRIVAL = ("ingest_seq", "amount", "transaction_date")


def arrival_order(raw: DataFrame) -> tuple[str, ...]:
    """The order in which a feed's rows arrived: file, then row, where the feed knows its files."""
    if "ingest_seq" not in raw.columns:
        raise ValueError("the feed has no arrival ordinal: name the columns that order it")
    return ("source_file", *ARRIVAL) if "source_file" in raw.columns else ARRIVAL


def dedup_first(df: DataFrame, key: str = "transaction_id", order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Keep the first row per key by ``order``.

    The filter on the row number makes Spark limit each key to one row per input partition before the
    shuffle, so a key that repeats without end sends one row per task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_arrival", F.row_number().over(first)).where(F.col("_arrival") == 1).drop("_arrival")


def repeated_groups(df: DataFrame, keys: list[str], count_as: str) -> DataFrame:
    """Groups with more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def dedup_rejects(df: DataFrame, key: str = "transaction_id", order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The rows that ``dedup_first`` leaves out, with their place in the order of arrival."""
    narrow = df.select(key, *order)
    groups = repeated_groups(narrow, [key], "arrivals")
    members = attach_group_values(narrow, groups, [key], "arrivals", order[0], "inner")
    numbered = ordered_windows(write_once(members, "members"), [key], list(order), number="arrival_number")
    return numbered.where(F.col("arrival_number") > 1)


def _amount(df: DataFrame) -> Column:
    """Text that is not a number becomes null and never a zero amount."""
    if isinstance(df.schema["amount"].dataType, StringType):
        number = F.trim("amount").try_cast("double")
        return F.when(~F.isnan(number), number)
    return F.col("amount").cast("double")


#: source columns that may not be missing; the other required columns follow from these
_REQUIRED_SOURCES = (
    "account_id",
    "department",
    "vendor_id",
    "vendor_name",
    "payment_method",
    "transaction_type",
)


def _first_arrivals(raw: DataFrame, order: tuple[str, ...] | None) -> DataFrame:
    """Deduplicated feed with the amount as a number and the date as a date.

    Without a named ``order`` arrival decides, and a row without its ordinal is an error.
    """
    if order is None:
        order = arrival_order(raw)
        missing = F.raise_error(F.lit("a row has no arrival ordinal: name the columns that order the feed"))
        raw = raw.withColumn("ingest_seq", F.coalesce("ingest_seq", missing.cast("long")))
    day = calendar.parse_date(F.col("transaction_date").cast("string"))
    raw = raw.withColumn("_amount", _amount(raw))
    if isinstance(raw.schema["amount"].dataType, StringType):  # as numbers, not as text, amounts break ties
        order = tuple("_amount" if name == "amount" else name for name in order)
    return dedup_first(raw, order=order).withColumn("_day", day)


def _complete() -> Column:
    """Tested on the source columns, so that the filter does not repeat the cleansing expressions."""
    valid = F.col("_day").isNotNull() & F.col("_amount").isNotNull()
    for name in _REQUIRED_SOURCES:
        valid = valid & F.col(name).isNotNull()
    return valid


def calendar_columns(day: Column) -> dict[str, Column]:
    """The staged columns that follow from the date."""
    weekday = calendar.sunday_zero(day)
    return {
        "transaction_year": F.year(day),
        "transaction_month": F.month(day),
        "day_of_week": weekday,
        "day_name": calendar.day_name(day),
        "is_weekend": F.when(weekday.isin(0, 6), F.lit(1)).otherwise(F.lit(0)),
    }


def _cleansed() -> list[Column]:
    return [
        F.col("transaction_id"),
        F.col("_day").alias("transaction_date"),
        *[value.alias(name) for name, value in calendar_columns(F.col("_day")).items()],
        F.trim("account_id").alias("account_id"),
        F.trim("department").alias("department"),
        F.trim("vendor_id").alias("vendor_id"),
        F.trim("vendor_name").alias("vendor_name"),
        round_cents("_amount").alias("amount"),
        F.coalesce(clean_text("currency"), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.trim("payment_method").alias("payment_method"),
        clean_text("invoice_number").alias("invoice_number"),
        clean_text("approver_id").alias("approver_id"),
        F.trim("transaction_type").alias("transaction_type"),
        F.trim("description").alias("description"),
        F.coalesce("is_anomaly", F.lit(0)).alias("ground_truth_anomaly"),
        F.coalesce("anomaly_type", F.lit(BENIGN_LABEL)).alias("ground_truth_type"),
    ]


def _stageable() -> Column:
    """The amount is tested before rounding."""
    return (F.col("_amount") > 0) & _complete()


def _held() -> Column:
    unreadable = F.col("amount").isNotNull() & F.col("_amount").isNull()
    return (unreadable | (F.col("_amount") > 0)) & ~_complete()


def _missing() -> Column:
    missing = F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in schemas.STAGED_REQUIRED])
    return missing.alias("missing_columns")


def stage(raw: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """The staged ledger.

    Deduplication comes first, so an id whose first arrival has no positive amount is gone altogether. Rows that
    lack a required value are left to ``quarantine``.
    """
    return _first_arrivals(raw, order).where(_stageable()).select(*_cleansed())


def quarantine(raw: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """First arrivals that could not be staged for lack of a required value, with the columns at fault.

    Rows without any amount, or with one that is not positive, are dropped by rule and do not show here.
    """
    return _first_arrivals(raw, order).where(_held()).select(*_cleansed()).select("*", _missing())


#: what becomes of a first arrival
STAGED, QUARANTINED, DROPPED = "staged", "quarantined", "dropped"


def arrivals(raw: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """All first arrivals, cleansed, with their ``fate``: one pass for the rows of ``stage`` and of ``quarantine``.

    What follows from other columns is left to ``staged_of`` and ``quarantined_of``, so that it is not written.
    """
    fate = F.when(_stageable(), F.lit(STAGED)).when(_held(), F.lit(QUARANTINED)).otherwise(F.lit(DROPPED))
    rows = _first_arrivals(raw, order).select(*_cleansed(), fate.alias("fate"))
    return rows.drop(*calendar_columns(F.col("transaction_date")))


def _of_fate(found: DataFrame, fate: str) -> DataFrame:
    day, rest = found.columns[:2], found.columns[2:]
    added = calendar_columns(F.col("transaction_date"))
    rows = found.where(F.col("fate") == fate).withColumns(added)
    return rows.select(*day, *added, *rest).drop("fate")


def staged_of(found: DataFrame) -> DataFrame:
    """``stage`` from the written ``arrivals``."""
    return _of_fate(found, STAGED)


def quarantined_of(found: DataFrame) -> DataFrame:
    """``quarantine`` from the written ``arrivals``."""
    return _of_fate(found, QUARANTINED).select("*", _missing())


def staged_count(staged: DataFrame) -> DataFrame:
    return staged.agg(F.count(F.lit(1)).alias("staged_transactions"))


def row_counts(raw: DataFrame, found: DataFrame) -> DataFrame:
    """One row: how many raw rows are staged, in quarantine, repeats of an id, or dropped for their amount.

    ``found`` are the written ``arrivals`` of ``raw``, of which each id has one.
    """
    rows = raw.count()
    fates = {row["fate"]: row["count"] for row in found.groupBy("fate").count().collect()}  # three at most
    values = {
        "raw_rows": rows,
        "staged_rows": fates.get(STAGED, 0),
        "quarantined_rows": fates.get(QUARANTINED, 0),
        "repeated_rows": rows - sum(fates.values()),
        "dropped_rows": fates.get(DROPPED, 0),
    }
    return raw.sparkSession.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in values.items()])
