"""Audit controls on streams of ledger rows.

Streams carry the columns of ``sources.ledger.event_rows``: id, event time, date, department, vendor,
amount, invoice and approver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions import calendar
from tallyguard.functions.money import cents, flag
from tallyguard.operators.features import add_features
from tallyguard.operators.forest import Calibration, Forest, path_score, with_verdict
from tallyguard.operators.rules import DUPLICATE_KEY, with_row_rules
from tallyguard.operators.staging import dedup_first
from tallyguard.plans.scratch import scratch_path, write_once
from tallyguard.plans.small_side import bounded
from tallyguard.streaming.state import BatchState


def utc_instant(column: str) -> Column:
    """A timestamp without zone, read as UTC whatever the session's zone is."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return local.cast("timestamp")


def read_files(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, in bounded micro-batches."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run the stream over everything that is there now, into files, and return them as a table."""
    spark = stream.sparkSession
    target = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{target}/rows")
        .option("checkpointLocation", f"{target}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{target}/rows")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], target: str) -> None:
    """Hand every micro-batch of what is there now to ``handle``; progress is kept below ``target``."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def rolling_spend(
    stream: DataFrame,
    by: tuple[str, ...] = ("vendor_id", "department"),
    lateness: str = "1 day",
    config: AuditConfig = DEFAULT,
) -> DataFrame:
    """Spend per vendor and department in windows of seven days that start every day.

    A window is given out once the watermark has passed its end; rows later than that are dropped.
    ``corrections.rolling_versions`` drops none.
    """
    span, step = f"{config.rolling_days} days", "1 day"
    windows = (
        stream.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", span, step), *by)
        .agg(
            F.sum(cents()).alias("_cents"),
            F.count(F.lit(1)).alias("window_transactions"),
            F.max("amount").alias("largest_payment"),
        )
    )
    first_day = F.floor(F.unix_seconds("window.start") / 86400).cast("int")
    evaded = F.lit(None).cast("int")
    spend = F.round(F.col("_cents") / 100.0, 2)
    for limit in config.limits:
        evaded = F.when((spend >= limit) & (F.col("largest_payment") < limit), F.lit(limit)).otherwise(evaded)
    return windows.select(
        F.date_add(F.lit("1970-01-01").cast("date"), first_day).alias("window_start"),
        *by,
        spend.alias("window_spend"),
        "window_transactions",
        "largest_payment",
        evaded.alias("evaded_limit"),
    )


def first_within(stream: DataFrame, lateness: str = "4 days", key: list[str] | None = None) -> DataFrame:
    """Let through one row per (vendor, invoice, amount) as long as the state remembers it.

    State is bounded by the watermark, so a copy that comes later than ``lateness`` is let through too;
    ``release_or_block`` has no such limit. A row that lacks a part of the key, such as one without an invoice,
    equals no other and passes around the state.
    """
    key = key or DUPLICATE_KEY
    whole = F.lit(True)
    for name in key:
        whole = whole & F.col(name).isNotNull()
    timed = stream.withWatermark("event_time", lateness)
    return timed.where(whole).dropDuplicatesWithinWatermark(key).unionByName(timed.where(~whole))


#: parts of the released keys by hash; a batch reads those that its own keys fall into
KEY_BUCKETS = 256
#: batches, or folders of one level, whose released keys are merged
MERGED_BATCHES = 16


def _key_bucket(buckets: int) -> Column:
    return F.pmod(F.hash(*DUPLICATE_KEY), F.lit(buckets)).cast("int")


def decide_batch(batch: DataFrame, released: DataFrame | None, order: tuple[str, ...] = ("event_time", "transaction_id")) -> DataFrame:
    """``released`` or ``blocked`` for every row of a batch, given the keys released before.

    Of each (vendor, invoice, amount) exactly one row, the first, is released, unless one was released earlier; a
    row sent again under the same id is a row of its own. A row that lacks a part of the key is always released. Each
    key is cut to one row per task before the shuffle, and verdicts meet their rows by a number that is unique.
    """
    numbered = write_once(batch.withColumn("_row", F.monotonically_increasing_id()), "batch")
    whole = F.lit(True)
    for name in DUPLICATE_KEY:
        whole = whole & F.col(name).isNotNull()
    columns = dict.fromkeys(["_row", *order, *DUPLICATE_KEY])
    packed = numbered.where(whole).select(*columns).withColumn("_key", F.struct(*DUPLICATE_KEY))
    winners = dedup_first(packed, key="_key", order=(*order, "_row")).drop("_key")
    if released is not None:
        winners = winners.join(released.select(*DUPLICATE_KEY), DUPLICATE_KEY, "left_anti")
    chosen = winners.select("_row", F.lit("released").alias("_verdict"))
    verdict = F.when(~whole, F.lit("released")).otherwise(F.coalesce(F.col("_verdict"), F.lit("blocked")))
    return numbered.join(chosen, "_row", "left").withColumn("decision", verdict).drop("_verdict", "_row")


def release_or_block(stream: DataFrame, target: str | None = None, fan: int = MERGED_BATCHES, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Pre-payment duplicate block over everything that is there now; returns all rows with a decision.

    Every micro-batch is a folder below ``target``, and a repeated batch overwrites its folder, so a restart
    does not count a row twice. What is kept for later batches are the released keys alone, by hash of the key;
    a batch reads only the parts its own keys fall into, also those of an earlier run with the same ``target``.
    The keys of every ``fan`` batches are merged, so their files grow with the keys and not with the batches.
    """
    spark = stream.sparkSession
    target = target or scratch_path(spark, "payments")
    rows = f"{target}/rows"
    decided = StructType.fromJson(stream.schema.jsonValue()).add("decision", "string")
    stored = StructType.fromJson(decided.jsonValue()).add("batch", "integer")
    kept = StructType([stream.schema[name] for name in DUPLICATE_KEY]).add("bucket", "integer")
    keys = BatchState(f"{target}/keys", kept, "bucket", fan=fan)

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        touched = [r["bucket"] for r in batch.select(_key_bucket(buckets).alias("bucket")).distinct().collect()]  # few
        released = keys.before(session, number, touched)
        decide_batch(batch, released).select(*decided.names).write.mode("overwrite").parquet(f"{rows}/batch={number}")
        done = session.read.schema(decided).parquet(f"{rows}/batch={number}").where("decision = 'released'")
        keys.add(done.select(*DUPLICATE_KEY).na.drop().withColumn("bucket", _key_bucket(buckets)), number)
        keys.merge(session, number)

    run_batches(stream, handle, target)
    return spark.read.schema(stored).parquet(rows).drop("batch")


def with_baseline(stream: DataFrame, baseline: DataFrame) -> DataFrame:
    """Join the static department means; they are broadcast if their number has been checked to be small."""
    means = baseline.select("department", "dept_baseline_mean")
    small = bounded(means)
    return stream.join(F.broadcast(small) if small is not None else means, "department")


def rules(stream: DataFrame, baseline: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    """The rules that need no other row, and the approver gate, on every row of the stream."""
    weekday = calendar.sunday_zero(F.col("transaction_date"))
    rows = with_baseline(stream, baseline).withColumn(
        "is_weekend", F.when(weekday.isin(0, 6), F.lit(1)).otherwise(F.lit(0))
    )
    gate = F.col("approver_id").isNull() & (F.col("amount") > config.approver_limit)
    return with_row_rules(rows, config).withColumn("blocked_unapproved", flag(gate))


def forest_screen(stream: DataFrame, baseline: DataFrame, forest: Forest, calibration: Calibration, config: AuditConfig = DEFAULT) -> DataFrame:
    """Score rows before payment with a forest that was fitted and calibrated on a batch."""
    rows = rules(stream, baseline, config).withColumn(
        "day_of_week", calendar.sunday_zero(F.col("transaction_date"))
    )
    scored = add_features(rows, config).withColumn("ml_raw_score", path_score(forest))
    return with_verdict(scored, calibration).drop("ml_raw_score")
