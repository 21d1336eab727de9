"""Run registered queries and their SQL on the same tables and compare the rows.

``python -m checks.compare [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def differences(spark: SparkSession, connection, sf_dir: str, name: str) -> list[str]:
    """What differs between the Spark query ``name`` and its SQL; empty if nothing does."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = connection.execute(oracle_sql()[name])
    sql_columns = sorted(entry[0] for entry in cursor.description)
    if columns != sql_columns:
        return [f"columns {columns} against {sql_columns}"]
    order = [[entry[0] for entry in cursor.description].index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    found = []
    if expected != actual:
        found.append(f"{sum(actual.values())} rows against {sum(expected.values())}")
        found += [f"only here: {row}" for row in list((actual - expected).elements())[:2]]
        found += [f"only in SQL: {row}" for row in list((expected - actual).elements())[:2]]
    if not actual:
        found.append("no rows")
    return found


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        found = differences(spark, connection, sf_dir, name)
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {' | '.join(found)}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
