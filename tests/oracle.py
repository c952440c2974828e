"""Compare registered queries with their SQL on the supplied tables.

Usage: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, function, sql: str | None, sf_dir: str) -> str:
    """Empty when both sides agree, otherwise what differs."""
    result = function(spark, sf_dir)
    rows = result.collect()
    if sql is None:
        return ""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    left, right = _bag(result.columns, rows), _bag(columns, cursor.fetchall())
    if left == right:
        return ""
    only_left, only_right = left - right, right - left
    return (
        f"{len(rows)} rows, {sum(only_left.values())} only in Spark, "
        f"{sum(only_right.values())} only in SQL; for example "
        f"{list(only_left.items())[:2]} against {list(only_right.items())[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from hazardlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "oracle",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, name, function, sql.get(name), sf_dir)
        except Exception as error:  # report every query, whatever it raises
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
