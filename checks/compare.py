"""Run every query and its SQL counterpart over one folder of tables and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from changefeed.session import build_session
from checks.oracle import oracle_sql
from checks.queries import QUERIES


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def as_bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], bag


def expected(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    return as_bag([column[0] for column in result.description], result.fetchall())


def compare(spark, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = as_bag(df.columns, df.collect())
    took = f"{time.time() - started:.1f}s"
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{sum(got[1].values())} rows, no SQL, {took}"
    want = expected(connection, sql)
    if got == want:
        return True, f"{sum(want[1].values())} rows, {took}"
    missing, extra = want[1] - got[1], got[1] - want[1]
    return False, (
        f"columns {got[0]} / {want[0]}; {sum(got[1].values())} rows / {sum(want[1].values())};"
        f" missing {list(missing)[:2]}; extra {list(extra)[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = tables(sf_dir)
    failed = 0
    for name in names or QUERIES:
        same, report = compare(spark, connection, sf_dir, name)
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name}: {report}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
