"""Session settings for the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: runtime settings the plans rely on; sizes stay with whoever runs the cluster
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: most bytes of shuffled or stored data for one task, for sessions that leave Spark's defaults as they are
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

#: shuffle files go when the query that wrote them ends; by default they stay until the driver's JVM happens to collect garbage
SHORT_LIVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def bound_tasks(spark: SparkSession) -> None:
    """Give tasks less to sort than Spark's defaults do and keep shuffle files no longer than a query needs them, unless the
    session names values of its own.

    A ledger row takes ten to twenty times as much memory as shuffled or in Parquet. At 64 and 128 MB a task, the
    sorts of whole rows outgrow their share of an executor's memory and spill.
    """
    named = spark.conf.getAll
    for key, value in {**TASK_BYTES, **SHORT_LIVED}.items():
        if key not in named:
            spark.conf.set(key, str(value))


def build_session(app: str = "tallyguard", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    bound_tasks(session)
    return session
