"""Compare a query's rows with its SQL on DuckDB, value by value.

    python tests/oracle_check.py <directory> [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(directory)):
        name, kind = os.path.splitext(file)
        if kind == ".parquet":
            path = os.path.join(directory, file)
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return str(value)


def rows_of(table) -> tuple[list[str], list[str], list[tuple]]:
    columns = sorted(table.column_names)
    types = [str(table.schema.field(c).type) for c in columns]
    data = [table.column(c).to_pylist() for c in columns]
    rows = sorted(tuple(_plain(v) for v in row) for row in zip(*data))
    return columns, types, rows


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences, empty when all agree."""
    left = rows_of(spark_df.toArrow())
    right = rows_of(connection.sql(sql).to_arrow_table())
    problems = []
    if left[0] != right[0]:
        return [f"columns {set(left[0]) ^ set(right[0])}"]
    for name, a, b in zip(left[0], left[1], right[1]):
        if a.replace("large_", "") != b.replace("large_", ""):
            problems.append(f"type of {name}: {a} / {b}")
    if len(left[2]) != len(right[2]):
        problems.append(f"rows {len(left[2])} / {len(right[2])}")
    for a, b in zip(left[2], right[2]):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
            problems.append(f"first difference {cells[:4]}")
            break
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    directory = sys.argv[1]
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    connection = duck(directory)
    bad = 0
    for name in names:
        started = time.time()
        try:
            frame = queries[name](spark, directory)
            if name in sqls:
                problems = compare(frame, connection, sqls[name])
            else:
                problems = []
                print(f"{name}: {frame.toArrow().num_rows} rows only", flush=True)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        status = "; ".join(problems) if problems else "ok"
        print(f"{time.time() - started:6.1f}s {name}: {status}", flush=True)
    print(f"{len(names)} queries, {bad} differ; without SQL: {sorted(set(queries) - set(sqls))}")
