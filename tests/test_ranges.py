"""Ranges of database tables: disjoint, complete, even."""

import datetime as dt
import decimal
import random
import re

import duckdb
import pytest
from pyspark.sql import types as T

from tablesync.sources import ranges

KINDS = {
    "bigint": (T.LongType(), lambda r: r.randrange(-5, 20)),
    "decimal(20,3)": (T.DecimalType(20, 3), lambda r: decimal.Decimal(r.randrange(-9000, 9000)) / 1000),
    "date": (T.DateType(), lambda r: dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(40))),
    "timestamp": (T.TimestampNTZType(), lambda r: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=r.randrange(10**13))),
    "varchar": (T.StringType(), lambda r: r.choice(["", "a", "it's", 'q"', "Z", "ä", "b b"]) + str(r.randrange(9))),
    "double": (T.DoubleType(), lambda r: r.uniform(-1, 1)),
}


def filled(kind, seed, n=400):
    rng, db = random.Random(seed), duckdb.connect()
    db.execute(f'CREATE TABLE t (i bigint, "a ""c" {kind}, k bigint)')
    make = KINDS[kind][1]
    rows = [(i, None if rng.random() < 0.1 else make(rng), None if rng.random() < 0.1 else rng.randrange(30)) for i in range(n)]
    db.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    return rng, db, rows


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("seed", range(4))
def test_every_row_lies_in_one_range(kind, seed):
    rng, db, rows = filled(kind, seed)
    spark_kind = KINDS[kind][0]
    values = sorted({r[1] for r in rows if r[1] is not None})
    low, high = rng.choice([None, str(values[2])]), rng.choice([None, str(values[-2])])
    nulls = False if low is not None else rng.choice([None, True, False])
    names = [('a "c', spark_kind), ("k", T.LongType())][: rng.choice([1, 2])]
    inner = [v for v in values if (low is None or v > values[2]) and (high is None or v < values[-2])]
    places = sorted({(v, rng.randrange(30)) for v in rng.choices(inner, k=8)})
    cuts = [tuple(map(str, p[: len(names)])) for p in places]
    found = ranges.conditions(names, low, high, cuts, "postgresql", nulls)
    got = [i for c in found for (i,) in db.execute(f"SELECT i FROM t WHERE {c}").fetchall()]
    want = [r[0] for r in rows if (
        bool(nulls is not False) if r[1] is None else (low is None or r[1] > values[2]) and (high is None or r[1] <= values[-2]))]
    assert sorted(got) == want
    assert len(found) == len(set(cuts)) + 1 + (nulls is True)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("engine", ["postgresql", ""])
def test_cut_points_give_even_ranges(kind, engine):
    _, db, _ = filled(kind, 9, 1000)
    db.execute("UPDATE t SET k = i")  # a key, which cuts values that repeat
    where = ranges.inside('a "c', KINDS[kind][0], None, None)
    count = db.execute(f"SELECT count(*) FROM t WHERE {where}").fetchone()[0]
    sql = ranges.cut_query("t", ['a "c', "k"], where, count, 8, engine)
    sql = re.sub(r"OFFSET (\d+) ROWS FETCH NEXT 1 ROWS ONLY", r"LIMIT 1 OFFSET \1", sql)  # as DuckDB writes it
    cuts = [tuple(map(str, r[:-1])) for r in sorted(db.execute(sql).fetchall(), key=lambda r: r[-1])]
    found = ranges.conditions([('a "c', KINDS[kind][0]), ("k", T.LongType())], None, None, cuts, "", True)
    sizes = [db.execute(f"SELECT count(*) FROM t WHERE {c}").fetchone()[0] for c in found]
    assert sum(sizes) == 1000 and len(sizes) == 9 and max(sizes[:-1]) - min(sizes[:-1]) <= 8


def test_literals_of_the_engines():
    stamp, zoned, day = T.TimestampNTZType(), T.TimestampType(), T.DateType()
    assert ranges.literal("2024-01-02", day, "oracle") == "DATE '2024-01-02'"
    assert ranges.literal("2024-01-02", day, "db2") == "CAST('2024-01-02' AS DATE)"
    assert ranges.literal("2024-01-02 03:04:05.6", stamp, "Oracle") == "TIMESTAMP '2024-01-02 03:04:05.6'"
    assert ranges.literal("2024-01-02T03:04:05", stamp, "sqlserver") == "CAST('2024-01-02T03:04:05' AS DATETIME2)"
    assert ranges.literal("2024-01-02T03:04:05+00:00", zoned, "postgresql") == "CAST('2024-01-02T03:04:05+00:00' AS TIMESTAMP WITH TIME ZONE)"
    assert ranges.literal("2024-01-02T03:04:05+00:00", zoned, "sqlserver") == "CAST('2024-01-02T03:04:05+00:00' AS DATETIMEOFFSET)"
    assert ranges.literal("it's", T.StringType()) == "'it''s'" and ranges.literal("-1.50", T.DecimalType(9, 2)) == "-1.50"
    assert not ranges.can_cut(T.BinaryType()) and not ranges.can_cut(T.ArrayType(T.LongType()))


def test_nothing_to_cut():
    assert ranges.cut_query("t", ["c"], "1 = 1", 0, 8) is None and ranges.cut_query("t", ["c"], "1 = 1", 5, 1) is None
    assert ranges.cut_query("t", ["c"], "1 = 1", 1, 8) is None
    assert ranges.conditions([("c", T.LongType())]) == ['"c" IS NOT NULL']
    assert ranges.conditions([("c", T.LongType())], nulls=True) == ['"c" IS NOT NULL', '"c" IS NULL']
    assert "% 3 = 0 AND place < 9" in ranges.cut_query("t", ["c"], "1 = 1", 9, 3, "sqlserver")
