"""Run registered queries next to their SQL and compare rows as bags."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.UTC).replace(tzinfo=None)
    return value


# Spark types and the DuckDB types they answer to.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def compare(spark, connection, query, sql, sf_dir):
    """Differences between a query and its SQL; an empty list if there are none."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    cursor = connection.execute(sql)
    described = {c[0]: str(c[1]) for c in cursor.description}
    expected_rows = cursor.fetchall()
    order = {name: i for i, name in enumerate(described)}
    if sorted(order) != names:
        return [f"columns {names} != {sorted(order)}"]
    problems = []
    for name, spark_type in df.dtypes:
        if _TYPES.get(spark_type) != described[name]:
            problems.append(f"type of {name}: {spark_type} against {described[name]}")
    actual = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    expected = Counter(tuple(plain(row[order[n]]) for n in names) for row in expected_rows)
    if not expected:
        problems.append("the SQL gives no rows")
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        problems.append(
            f"{actual.total()} rows against {expected.total()}; "
            f"extra {extra.most_common(2)}; missing {missing.most_common(2)}"
        )
    return problems
