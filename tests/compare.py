"""Compare a Spark result with the SQL oracle, row by row and in any order.

As a script: ``python -m tests.compare <sf_dir> [query ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str | None]:
    """(rows, None) if equal, else (rows, what differs)."""
    answer = connection.execute(sql)
    expected_columns = [c[0] for c in answer.description]
    if sorted(spark_df.columns) != sorted(expected_columns):
        return 0, f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    columns = sorted(expected_columns)
    places = [expected_columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in places) for row in answer.fetchall())
    actual = Counter(tuple(row) for row in spark_df.select(*columns).collect())
    rows = sum(actual.values())
    if expected == actual:
        return rows, None
    missing, extra = expected - actual, actual - expected
    return rows, (
        f"{sum(missing.values())} missing, {sum(extra.values())} extra of {sum(expected.values())}; "
        f"missing {list(missing)[:2]}; extra {list(extra)[:2]}; columns {columns}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from benchledger.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    sql, failed = oracle_sql(), 0
    for name in names or list(queries()):
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in sql:
                rows, problem = difference(df, connection, sql[name])
            else:
                rows, problem = len(df.collect()), None
        except Exception as error:  # noqa: BLE001 - a report over all queries
            rows, problem = 0, str(error)[:800]
        failed += problem is not None
        verdict = "FAIL" if problem else "ok" if name in sql else "rows"
        print(f"{name:26s} {verdict:4s} {rows:8d} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
