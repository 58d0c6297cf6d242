"""Rolling weeks on a stream that are put right when rows come late.

``controls.rolling_spend`` gives each window once and drops what comes after the watermark. Here a micro-batch
gives every week that its rows fall into as it stands with them, whenever they come: the latest version of each
week equals ``operators.rolling.rolling_spend`` over all rows that have arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.operators.rolling import WEEK_COLUMNS, day_totals, with_evaded_limit
from tallyguard.plans.scratch import scratch_path
from tallyguard.streaming.controls import MERGED_BATCHES, run_batches
from tallyguard.streaming.state import BatchState

BY = ("vendor_id", "department")


def _summed(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Totals of days that hold several rows, from as many batches."""
    totals = {"_cents": F.sum, "_rows": F.sum, "_largest": F.max, "_near": F.sum}
    return rows.groupBy(*keys).agg(*[total(name).alias(name) for name, total in totals.items()], *more)


def _month() -> Column:
    return (F.year("transaction_date") * 12 + F.month("transaction_date")).cast("int")


def weeks_touched(days: DataFrame, fresh: DataFrame, by: tuple[str, ...], config: AuditConfig = DEFAULT) -> DataFrame:
    """The weeks that days of ``fresh`` fall into, from the totals of all ``days``; a week ends on a day with rows.

    Days of ``fresh`` are marked, and one window a week long sums and looks for marks: no day is repeated for its
    weeks, and a window group has at most one row per calendar day.
    """
    keys, named = [*by, "transaction_date"], ("_cents", "_rows", "_largest", "_near")
    marks = fresh.select(*keys, *[F.lit(None).cast(days.schema[name].dataType).alias(name) for name in named], F.lit(1).alias("_mark"))
    rows = days.select(*keys, *named, F.lit(0).alias("_mark")).unionByName(marks)
    week = (
        Window.partitionBy(*by)
        .orderBy(F.datediff("transaction_date", F.lit("1970-01-01").cast("date")))
        .rangeBetween(-(config.rolling_days - 1), Window.currentRow)
    )
    placed = _summed(rows, keys, F.max("_mark").alias("_mark")).select(
        *keys,
        F.col("_rows").alias("_own"),
        F.round(F.sum("_cents").over(week) / 100.0, 2).alias("rolling_spend"),
        F.sum("_rows").over(week).alias("rolling_transactions"),
        F.max("_largest").over(week).alias("largest_payment"),
        F.sum("_near").over(week).alias("near_limit_payments"),
        F.max("_mark").over(week).alias("_mark"),
    )
    weeks = placed.where((F.col("_mark") == 1) & F.col("_own").isNotNull())
    return with_evaded_limit(weeks, config).select(*keys, *WEEK_COLUMNS)


def rolling_versions(
    stream: DataFrame,
    target: str | None = None,
    by: tuple[str, ...] = BY,
    fan: int = MERGED_BATCHES,
    config: AuditConfig = DEFAULT,
) -> DataFrame:
    """Weeks as each micro-batch left them, with the batch's number as ``version``.

    Kept between batches are totals per vendor, department and day, in parts by month: a batch reads the months
    it touches. Hot vendors are summed map-side first, and a vendor has one row per day and batch, merged as batches
    go on. A repeated batch writes its folders again. Rows without a date fall into no week.
    """
    spark = stream.sparkSession
    target = target or scratch_path(spark, "weeks")
    dated = stream.where(F.col("transaction_date").isNotNull())
    schema = StructType.fromJson(day_totals(dated, by, config).withColumn("_month", _month()).schema.jsonValue())
    keys = [*by, "transaction_date"]
    kept = BatchState(f"{target}/days", schema, "_month", lambda rows: _summed(rows, [*keys, "_month"]), fan)
    empty = spark.createDataFrame([], schema)
    weeks = weeks_touched(empty, empty, by, config).schema

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        kept.add(day_totals(batch, by, config).withColumn("_month", _month()), number)
        fresh = kept.batch(session, number)
        months = {r["_month"] + shift for r in fresh.select("_month").distinct().collect() for shift in (-1, 0, 1)}
        earlier = kept.before(session, number, sorted(months))
        days = fresh if earlier is None else earlier.unionByName(fresh)
        weeks_touched(days, fresh, by, config).write.mode("overwrite").parquet(f"{target}/weeks/version={number}")
        kept.merge(session, number)

    run_batches(dated, handle, target)
    versions = StructType.fromJson(weeks.jsonValue()).add("version", "integer")
    return spark.read.schema(versions).parquet(f"{target}/weeks")


def latest(versions: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """Each week as the last micro-batch that touched it left it."""
    last = F.max_by(F.struct(*WEEK_COLUMNS), "version").alias("_week")
    weeks = versions.groupBy(*by, "transaction_date").agg(last, F.count(F.lit(1)).alias("versions"))
    return weeks.select(*by, "transaction_date", "_week.*", "versions")
