"""Run queries next to their DuckDB statements and compare names, counts and exact values.

    python -m checks.compare [scale-factor folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from roadrisk.session import session

from . import queries, roles


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in roles.SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return float(value) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=lambda row: [repr(v) for v in row])


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """Differences of one query, none if it matches."""
    df = queries.QUERIES[name](spark, sf_dir)
    got = _sorted(df.columns, df.collect())
    if name not in queries.ORACLES:
        return [] if got else ["no rows"]
    cursor = connection.execute(queries.ORACLES[name])
    names = [column[0] for column in cursor.description]
    want = _sorted(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns: only Spark {set(df.columns) - set(names)}, only SQL {set(names) - set(df.columns)}"]
    out = []
    if len(got) != len(want):
        out.append(f"rows: Spark {len(got)}, SQL {len(want)}")
    columns = sorted(names)
    for left, right in zip(got, want):
        if left != right:
            out.append("; ".join(f"{c}: {a!r} != {b!r}" for c, a, b in zip(columns, left, right) if a != b))
    if not want:
        out.append("SQL gives no rows")
    return out


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = session("compare", "local[8]", **{
        "spark.log.level": "OFF", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    failed = 0
    for name in arguments[1:] or list(queries.QUERIES):
        start = time.time()
        try:
            problems = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(problems)
        kind = "sql " if name in queries.ORACLES else "rows"
        print(f"{'FAIL' if problems else 'ok':4} {kind} {time.time() - start:6.2f}s {name}", flush=True)
        for problem in problems[:3]:
            print("       ", problem[:1500])
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
