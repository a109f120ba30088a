"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row),
    )


# Types DuckDB and Spark name differently.
_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """An empty text if rows, names and types agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cursor = connection.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    for column, kind in df.dtypes:
        if _SPARK_TO_DUCK.get(kind) != expected_types[column]:
            return f"{column} is {kind} instead of {expected_types[column]}"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    ours, theirs = _sorted_rows(df.columns, got), _sorted_rows(columns, expected)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} instead of {b}"
    return "" if got else "no rows"


if __name__ == "__main__":
    from gaugeflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(contract.queries())
    session = build_session(
        "local[8]", shuffle_partitions=8, spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    for query_name in names:
        started = time.time()
        try:
            problem = compare(session, duck, sf, query_name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{query_name:26s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
