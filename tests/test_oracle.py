"""Every query against its SQL on the small tables, and the invariants that tie the results together."""

from __future__ import annotations

import pytest
from compare import compare, sql_connection
from conftest import SMALL

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], SQL[name], SMALL) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    tiers = {row["risk_tier"]: row["txn_count"] for row in contract.entry(spark).collect()}
    assert tiers == {"Critical": 24, "High": 130, "Medium": 341, "Low": 4152}


def test_totals_agree_across_tables(spark):
    def rows(name):
        return QUERIES[name](spark, SMALL).collect()

    total = rows("kpi_row")[0]
    for table, spend, count in (
        ("dim_department", "Total_Spend", "Transaction_Count"),
        ("dim_vendor", "Total_Invoiced", "Invoice_Count"),
    ):
        found = rows(table)
        assert round(sum(r[spend] for r in found), 2) == total["Total_Spend_USD"]
        assert sum(r[count] for r in found) == total["Total_Transactions"]
    risky = sum(r["High_Risk_Transactions"] for r in rows("dim_department"))
    assert risky == total["Critical_Risk_Count"] + total["High_Risk_Count"]
    assert sum(r["Flagged_Count"] for r in rows("dim_vendor")) == total["Total_Flagged_Transactions"]
    assert sum(r["tier_rows"] for r in rows("tier_share")) == total["Total_Transactions"]
