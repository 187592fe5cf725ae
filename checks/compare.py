"""Run registered queries and their SQL side by side: python -m checks.compare SF_DIR [names]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import CATALOG
from checks.oracle import ORACLE


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "hour") and hasattr(value, "date"):
        return value.date() if (value.hour, value.minute, value.second) == (0, 0, 0) else value
    return value


def sql_rows(connection, text: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(text)
    return [d[0] for d in cursor.description], cursor.fetchall()


def canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """None when Spark and SQL agree on column names and every value."""
    df = CATALOG[name](spark, sf_dir)
    names, expected = sql_rows(connection, ORACLE[name])
    if sorted(df.columns) != sorted(names):
        return f"columns only in Spark {set(df.columns) - set(names)}, only in SQL {set(names) - set(df.columns)}"
    left = canonical(df.columns, [tuple(r) for r in df.collect()])
    right = canonical(names, expected)
    if len(left) != len(right):
        return f"rows {len(left)} in Spark, {len(right)} in SQL"
    for a, b in zip(left, right, strict=True):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(sorted(names), a, b, strict=True) if x != y]
            return f"{sum(x != y for x, y in zip(left, right, strict=True))} rows differ, first {diff} in {a}"[:600]
    return None


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {table.stem} as select * from '{table}'")
    return connection


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or ORACLE:
        started = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names or ORACLE)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
