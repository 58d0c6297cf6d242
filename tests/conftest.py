from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallyguard import schemas  # noqa: E402
from tallyguard.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_parts(spark):
    """Keep every shuffle partition, so that small groups really span several of them."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


RAW_DEFAULTS = {
    "transaction_id": "T1",
    "transaction_date": "2024-03-01",  # a Friday
    "account_id": "GL-1",
    "department": "IT",
    "vendor_id": "V1",
    "vendor_name": " Vendor One ",
    "amount": 100.0,
    "currency": "USD",
    "payment_method": "ACH",
    "invoice_number": "INV-1",
    "approver_id": "EMP-1",
    "transaction_type": "Vendor Invoice",
    "description": "text",
    "is_anomaly": None,
    "anomaly_type": None,
}


@pytest.fixture
def raw_rows(spark):
    """Build a raw feed from partial rows; ids and arrival follow the position unless given."""

    def build(*rows, schema=schemas.RAW_LEDGER):
        full = []
        for position, row in enumerate(rows, 1):
            base = {**RAW_DEFAULTS, "transaction_id": f"T{position}", "ingest_seq": position, **row}
            full.append(tuple(base[name] for name in schema.names))
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def staged_rows(raw_rows):
    from tallyguard.operators.staging import stage

    return lambda *rows: stage(raw_rows(*rows))
