"""Readers and writers. Schemas are declared; a missing input fails at read with Spark's own error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyguard import schemas

#: of ledgers written as Parquet: about a fifth smaller than Spark's default
COMPRESSION = "zstd"


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Blank cells are null; quotes inside quoted text are doubled.

    ``multi_line`` reads quoted cells with line breaks; a file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_ledger_csv(spark: SparkSession, path: str, arrival: bool = True, multi_line: bool = False) -> DataFrame:
    """The raw feed. With ``arrival`` the files carry ``ingest_seq`` as last column.

    CSV rows have no position that survives a distributed read, so a feed without the ordinal gets a null
    one; staging then fails unless the caller names the columns that order the feed.
    """
    if arrival:
        return read_csv(spark, path, schemas.RAW_LEDGER_TEXT, multi_line)
    feed = read_csv(spark, path, schemas.RAW_FEED, multi_line)
    return feed.withColumn("ingest_seq", F.lit(None).cast("long"))


def read_vendor_master(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.VENDOR_MASTER)


def read_ledger_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A Parquet feed without an ordinal: arrival is file order, then row position in the file."""
    feed = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if "ingest_seq" in feed.columns:
        return feed
    return feed.select(
        *schemas.RAW_COLUMNS,
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("ingest_seq"),
    )


def read_flagged(spark: SparkSession, table_or_path: str) -> DataFrame:
    """The materialised flagged ledger, by table name or by Parquet folder."""
    if "/" in table_or_path:
        return spark.read.schema(schemas.FLAGGED).parquet(table_or_path)
    return spark.table(table_or_path)


def read_table_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet folder that ``write_parquet`` wrote, with its columns in the order of ``schema``."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_enriched_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ENRICHED)


def union_feeds(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all feeds, matched by column name; duplicates are kept for staging to judge."""
    merged = first
    for feed in others:
        merged = merged.unionByName(feed)
    return merged


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Full refresh: the old content, if any, is replaced."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Append a batch to a Parquet table once: sent again under the same name, it takes its own place.

    A batch is a folder of the table, and Spark commits the folder as a whole.
    """
    rows = df.withColumn("batch", F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def refresh_parts(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace the folders that ``df`` has rows for; files of all others stay as they are."""
    rows = df.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header: one plain file with ``single_file``, for results of bounded size, such as top-k reports;
    else part files that are gzip-compressed, as ledgers in plain text take many times the disk of their source."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("escape", '"').option("dateFormat", "yyyy-MM-dd")
    writer.option("compression", "none" if single_file else "gzip").csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    then: Callable[[DataFrame], DataFrame] | None = None,
    gathered: bool = False,
) -> None:
    """Parquet; with ``partition_by`` rows are gathered per folder, in several files where a folder is large.

    ``then`` adds what follows from a row once rows are gathered, so that it is not shuffled. ``gathered`` says that ``df`` reads
    files in which a folder's rows lie together already; each part of them then gives a file.
    """
    # a rebalance splits large folders and merges small ones, so a hot month is many files
    rows = df.hint("rebalance", *partition_by) if partition_by and not gathered else df
    rows = then(rows) if then else rows
    rows.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None, compression=COMPRESSION)
