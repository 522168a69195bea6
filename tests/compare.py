"""Run registered queries and their SQL side by side: ``python -m tests.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return value


def _table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got_columns, got = _table(df.columns, df.collect())
    result = con.execute(sql)
    columns, want = _table([d[0] for d in result.description], result.fetchall())
    found = []
    if got_columns != columns:
        found.append(f"columns {got_columns} != {columns}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    if not found:
        wrong = [(g, w) for g, w in zip(got, want) if g != w]
        found += [f"{len(wrong)} rows differ, e.g. {wrong[:2]}"] if wrong else []
    else:
        missing = sorted(set(want) - set(got), key=repr)[:2], sorted(set(got) - set(want), key=repr)[:2]
        found.append(f"only in SQL {missing[0]}, only in Spark {missing[1]}")
    return found


def main() -> None:
    from eventide.catalog.queries import CHECKS, QUERIES
    from eventide.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con = database(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = differences(df, con, CHECKS[name]) if name in CHECKS else [] if df.count() >= 0 else []
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:3000]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:32s} {time.time() - began:6.2f}s {'; '.join(found)[:4000]}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()
