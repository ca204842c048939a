"""Run registered queries against their oracle SQL in DuckDB.

    python -m suite.check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from suite.base import ORACLES, QUERIES, TABLES
from tablesync.session import build_session


def plain(value):
    """One value in a form both engines share."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shown, key=repr)


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normal(columns, cursor.fetchall())


def compare(spark, sf_dir: str, name: str) -> tuple[str, float, int]:
    """'match', 'rows only' or a short note on the difference; seconds; row count."""
    started = time.monotonic()
    df = QUERIES[name](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.monotonic() - started
    if name not in ORACLES:
        return "rows only", seconds, len(got[1])
    want = oracle(sf_dir, ORACLES[name])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", seconds, len(got[1])
    if got[1] != want[1]:
        mine = [r for r in got[1] if r not in set(want[1])][:2] if len(got[1]) < 50_000 else "many"
        theirs = [r for r in want[1] if r not in set(got[1])][:2] if len(got[1]) < 50_000 else "many"
        return f"rows {len(got[1])} vs {len(want[1])}: {mine} != {theirs}", seconds, len(got[1])
    return "match", seconds, len(got[1])


def main(argv: list[str]) -> int:
    import suite  # noqa: F401

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name in argv[1:] or QUERIES:
        try:
            outcome, seconds, rows = compare(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            outcome, seconds, rows = f"FAILED {type(error).__name__}: {str(error)[:600]}", 0.0, 0
        good = outcome in ("match", "rows only")
        bad += not good
        print(f"{'ok  ' if good else 'BAD '} {name:32s} {seconds:6.2f}s {rows:8d} {'' if outcome == 'match' else outcome}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
