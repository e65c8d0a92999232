"""Runs registered queries beside their SQL text and compares the rows.

    python tests/compare.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    if hasattr(value, "as_tuple") or (isinstance(value, (int, float)) and not isinstance(value, bool)):
        return float(value) if not isinstance(value, int) else value
    if hasattr(value, "hour") and (value.hour, value.minute, value.second, value.microsecond) == (0, 0, 0, 0):
        return value.date().isoformat()
    return str(value) if not isinstance(value, bool) else value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark_df, db, sql: str) -> str | None:
    """None when columns and rows agree exactly, else what differs."""
    mine = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = db.execute(sql)
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {sorted(set(mine[0]) ^ set(theirs[0]))}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            where = [(n, p, q) for n, p, q in zip(mine[0], a, b) if p != q]
            return f"{where[:4]}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad, sqls = connect(folder), 0, entry.oracle_sql()
    for name, build in entry.queries().items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            found = differences(df, db, sqls[name]) if name in sqls else f"rows {df.count()}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error).strip().splitlines()[0][:300]}"
        took = time.time() - start
        state = "ok" if found is None else ("--" if name not in sqls and found.startswith("rows") else "BAD")
        bad += state == "BAD"
        print(f"{state:4}{name:34}{took:6.1f}s {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(1 if main(args[0], args[1:]) else 0)
