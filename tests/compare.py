"""Run queries in Spark and their SQL in DuckDB on the same files and compare the rows.

    python tests/compare.py FOLDER [--sql] [NAME...]

``--sql`` leaves out the queries without SQL.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _text(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def normalise(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def differences(spark_columns, spark_rows, sql_columns, sql_rows, tolerance: float = 0.0) -> str:
    """Empty when equal, else what differs first."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(set(spark_columns) ^ set(sql_columns))[:6]}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} against {len(sql_rows)}"
    ours, theirs = normalise(spark_columns, spark_rows), normalise(sql_columns, sql_rows)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tallyloom.session import build_session

    folder, only_sql = sys.argv[1], "--sql" in sys.argv
    wanted = [a for a in sys.argv[2:] if a != "--sql"]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sql, bad = oracle_sql(), 0
    for name, build in queries().items():
        if (wanted and name not in wanted) or (only_sql and name not in sql):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            rows = [tuple(r) for r in df.collect()]
        except Exception as error:  # noqa: BLE001
            print(f"FAIL {name}: {str(error)[:1500]}")
            bad += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(rows)} in {took:.1f}s")
            continue
        try:
            result = connection.execute(sql[name])
            columns = [d[0] for d in result.description]
            problem = differences(df.columns, rows, columns, result.fetchall())
        except Exception as error:  # noqa: BLE001
            problem = f"SQL: {str(error)[:800]}"
        bad += bool(problem)
        print(f"{'DIFF' if problem else 'ok  '} {name}: {len(rows)} in {took:.1f}s {problem[:700]}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
