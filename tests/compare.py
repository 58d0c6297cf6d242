"""Run every query beside its SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_rows, spark_names, sql_rows, sql_names) -> str | None:
    """What differs between two results, or None."""
    if sorted(spark_names) != sorted(sql_names):
        return f"columns {sorted(set(spark_names) ^ set(sql_names))}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} against {len(sql_rows)}"
    left, right = _sorted_rows(spark_rows, spark_names), _sorted_rows(sql_rows, sql_names)
    unequal = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(unequal)} rows, first {unequal[0]}" if unequal else None


def compare(spark, connection, query, sql, folder) -> str | None:
    frame = query(spark, folder)
    rows = [tuple(row) for row in frame.collect()]
    result = connection.execute(sql)
    return differences(rows, frame.columns, result.fetchall(), [d[0] for d in result.description])


if __name__ == "__main__":
    import __spark_entry__ as contract
    from tallyguard.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = sql_connection(folder), contract.oracle_sql(), 0
    print("entry", contract.entry(spark).count())
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sqls:
                found = compare(spark, connection, query, sqls[name], folder)
                verdict = "ok" if found is None else f"DIFFERS {found}"
            else:
                verdict = f"rows only: {query(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"FAILED {str(error)[:600]}"
        bad += verdict.startswith(("DIFFERS", "FAILED"))
        print(f"{name:28s} {time.time() - began:6.2f}s  {verdict[:900]}", flush=True)
    missing = set(sqls) - set(contract.queries())
    print(f"{bad} bad; sql without query: {sorted(missing)}")
    spark.stop()
