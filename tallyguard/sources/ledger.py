"""Adapters from other tables to the canonical raw ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.sources.perturb import KINDS, Label, perturb


def order_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """Order lines as ledger rows, before any label is planted.

    Customer joins the orders first, so that the large join carries two small strings, and lines come to it with their unit
    price in cents and a plain date, which take less of its shuffle than what they follow from. No side is hinted:
    Spark broadcasts by measured size and splits skewed partitions of the shuffle joins. A line whose order,
    customer or supplier is missing stays, with nulls, for the quarantine to report.
    """
    buyers = tables["orders"].join(
        tables["customer"].select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    lines = tables["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("_day"),
        F.floor(F.rint(F.col("l_extendedprice") * 100) / F.col("l_quantity")).alias("_unit_cents"),
    )
    rows = (
        lines.join(
            buyers.select("o_orderkey", "o_custkey", "o_orderpriority", "c_mktsegment"),
            F.col("l_orderkey") == F.col("o_orderkey"),
            "left",
        )
        .join(tables["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    line_key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    currency = (
        F.when(F.col("o_custkey") % 20 == 0, F.lit(""))
        .when(F.col("o_custkey") % 20 == 1, F.lit("EUR"))
        .when(F.col("o_custkey") % 20 == 2, F.lit(" GBP "))
        .otherwise(F.lit("USD"))
    )
    kind = (
        F.when(F.col("l_returnflag") == "R", F.lit("Expense Reimbursement"))
        .when(F.col("l_returnflag") == "A", F.lit("Procurement Contract"))
        .otherwise(F.lit("Vendor Invoice"))
    )
    return rows.select(
        F.concat(F.lit("TXN-"), line_key).alias("transaction_id"),
        F.col("_day").alias("transaction_date"),
        F.concat(F.lit("GL-"), "l_returnflag", "l_linestatus").alias("account_id"),
        F.col("c_mktsegment").alias("department"),
        F.concat(F.lit("VND-"), F.col("l_suppkey").cast("string")).alias("vendor_id"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("vendor_name"),
        (F.col("_unit_cents") / 100.0).alias("amount"),
        currency.alias("currency"),
        F.col("o_orderpriority").alias("payment_method"),
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string")).alias("invoice_number"),
        F.concat(
            F.lit("EMP-"), F.substring("c_mktsegment", 1, 3), F.lit("-"), (F.col("o_custkey") % 3).cast("string")
        ).alias("approver_id"),
        kind.alias("transaction_type"),
        F.concat(kind, F.lit(" - "), F.col("s_name")).alias("description"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("ingest_seq"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 1000).alias("slot"),
        line_key.alias("line_key"),
        F.col("l_suppkey").alias("supplier_no"),
        F.col("l_partkey").alias("part_no"),
    )


def derive_ledger(tables: dict[str, DataFrame], kinds: tuple[Label, ...] = KINDS) -> DataFrame:
    """Raw ledger with labelled perturbations, in the canonical schema."""
    rows = perturb(order_lines(tables), kinds)
    return rows.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schemas.RAW_LEDGER]
    )


def event_rows(events: DataFrame, event_time: Column | None = None) -> DataFrame:
    """Events as ledger rows for the streaming controls; works on a stream and on a table."""
    moment = event_time if event_time is not None else F.col("ts").cast("timestamp")
    vendor = F.concat(F.lit("VND-"), F.col("user_id").cast("string"))
    amount = F.rint(F.col("value") * 100)
    day = F.col("ts").cast("date")
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("transaction_id"),
        moment.alias("event_time"),
        day.alias("transaction_date"),
        F.col("event_type").alias("department"),
        vendor.alias("vendor_id"),
        amount.alias("amount"),
        F.concat_ws(
            "-", F.lit("INV"), F.col("user_id").cast("string"), F.col("event_type"), amount.cast("long").cast("string")
        ).alias("invoice_number"),
        F.concat(F.lit("EMP-"), F.col("event_type")).alias("approver_id"),
    )


def load_tables(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


#: tables that the order-line ledger is derived from
LEDGER_TABLES = ("lineitem", "orders", "customer", "supplier")


def load_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of a folder of source tables."""
    return derive_ledger(load_tables(spark, folder, LEDGER_TABLES))


def vendor_master_from(supplier: DataFrame) -> DataFrame:
    """Vendor master from the supplier table; the tier follows from the account balance."""
    tier = (
        F.when(F.col("s_acctbal") < 0, F.lit("High"))
        .when(F.col("s_acctbal") < 1000, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )
    return supplier.select(
        F.concat(F.lit("VND-"), F.col("s_suppkey").cast("string")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.concat(F.lit("NATION-"), F.col("s_nationkey").cast("string")).alias("primary_department"),
        tier.alias("risk_tier"),
    )
