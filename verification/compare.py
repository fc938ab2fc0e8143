"""Run registered queries beside their SQL and compare the rows, order aside.

    python -m verification.compare [folder of parquet tables] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def normalised(columns: list[str], rows) -> Counter:
    """Rows as a multiset, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def difference(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    """None where both agree, otherwise what differs."""
    result = query(spark, sf_dir)
    expected = duckdb_over(sf_dir).execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} expected {sorted(names)}"
    want = normalised(names, expected.fetchall())
    have = normalised(result.columns, result.collect())
    if want == have:
        return None
    missing, extra = want - have, have - want
    return (
        f"{have.total()} rows, expected {want.total()}; columns {sorted(names)}; "
        f"missing {list(missing.items())[:3]}; unexpected {list(extra.items())[:3]}"
    )


def main(arguments: list[str]) -> int:
    from verification.oracle import ORACLE
    from verification.queries import QUERIES

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in arguments[1:] or QUERIES:
        started = time.time()
        try:
            problem = difference(spark, sf_dir, QUERIES[name], ORACLE[name])
        except Exception as error:  # reported per query
            problem = f"{type(error).__name__}: {error}"[:1500]
        failed += problem is not None
        print(f"{name:32} {time.time() - started:6.1f}s {problem or 'equal'}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
