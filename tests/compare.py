"""Run registered queries in Spark and in DuckDB and compare their rows.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import atexit
import os
import shutil
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tablewright-tests-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def rows(df, *order):
    """Rows as tuples, sorted as text so that nulls may occur."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plain(value):
    if isinstance(value, float):
        return ("float", f"{value:.9g}")
    return (type(value).__name__, value)


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, name: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = entry_points.queries()[name](spark, sf_dir)
    columns, rows = df.columns, df.collect()
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = connection.execute(entry_points.oracle_sql()[name])
    expected_columns = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    connection.close()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(set(columns) ^ set(expected_columns))}"
    mine, expected = _rows(columns, rows), _rows(expected_columns, expected_rows)
    if mine == expected:
        return None if rows else "no rows"
    extra, lacking = mine - expected, expected - mine
    return f"{len(rows)} rows, expected {len(expected_rows)}; extra {list(extra)[:2]}; lacking {list(lacking)[:2]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = os.path.join("/root/testdata", f"sf{args.sf}")
    spark = session()
    failed = 0
    for name in args.names or entry_points.oracle_sql():
        started = time.time()
        try:
            problem = compare(spark, name, sf_dir)
        except Exception as error:  # one broken query should not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
