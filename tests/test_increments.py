from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.operators.incremental import RankBounds, above, between_marks, highest_text, mark
from tablesync.operators.profile import profile_columns, sequence_gaps, size_estimate
from tablesync.streaming.batches import next_batch, pick_tier, plan_batches


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def test_above_is_strict_and_typed(spark):
    df = ints(spark, [9, 10, 11, None])
    assert [r.k for r in above(df, "k", "9").orderBy("k").collect()] == [10, 11]
    assert above(df, "k", None).count() == 4
    assert above(ints(spark, [-1, 0, 1]), "k", 0).count() == 1
    assert above(spark.createDataFrame([("",), ("a",)], "s string"), "s", "").count() == 1
    assert [r.k for r in between_marks(df, "k", 9, 10).collect()] == [10]


def test_filter_reaches_the_scan(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    plan = above(orders, "o_orderdate", "1998-01-01").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1998-01-01" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_instant_bookmark_survives_a_zone_change(spark):
    df = spark.sql("select timestamp'2024-03-01 10:00:00Z' as at")
    text = df.agg(highest_text(df, "at").alias("m")).first()["m"]
    assert text == "2024-03-01T10:00:00+00:00"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        again = df.agg(highest_text(df, "at").alias("m")).first()["m"]
        assert again == text and above(df, "at", text).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_instants_in_the_hour_a_clock_change_skips(spark):
    df = spark.sql("select timestamp'2024-03-10 02:30:00.25Z' as at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.agg(highest_text(df, "at").alias("m")).first()["m"] == "2024-03-10T02:30:00.25+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def greedy(values, size, low=None):
    left = sorted(v for v in values if v is not None and (low is None or v > low))
    result, start = [], low
    while left:
        high = left[min(size, len(left)) - 1]
        taken = [v for v in left if v <= high]
        result.append((start, high, len(taken)))
        left = left[len(taken):]
        start = high
    return result


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.one_of(st.integers(-50, 50), st.integers(-(2**62), 2**62), st.none()), max_size=60),
    st.integers(1, 20),
)
def test_batches_equal_a_sorted_walk(spark, values, size):
    df = ints(spark, values)
    got = [(b.low, b.high, b.rows) for b in plan_batches(df, "k", size)]
    assert got == greedy(values, size)


def test_batches_of_times_and_a_hot_value(spark):
    df = spark.sql(
        "select if(id % 3 = 0, timestamp_ntz'2024-01-05 00:00:00.000001', "
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int), 0, 0)) as ts from range(3000)"
    )
    values = [r.ts for r in df.collect()]
    got = [(b.low, b.high, b.rows) for b in plan_batches(df, "ts", 500)]
    assert got == greedy(values, 500)
    assert max(rows for _, _, rows in got) >= 1000


def test_batches_of_dates_and_instants(spark):
    days = spark.sql("select date_add(date'2024-01-01', cast(id % 10 as int)) as d from range(100)")
    first = next(plan_batches(days, "d", 15))
    assert (first.high, first.rows) == (date(2024, 1, 2), 20)
    at = spark.sql("select timestamp'2024-01-01 00:00:00Z' + make_dt_interval(0, cast(id as int)) as t from range(50)")
    assert next_batch(at, "t", 7).count() == 7
    with pytest.raises(TypeError):
        RankBounds(spark.createDataFrame([("a",)], "s string"), "s")


def test_tiers():
    assert [pick_tier(n) for n in (0, 9_999_999, 10_000_000, 100_000_000, 100_000_001)] == [
        "direct", "direct", "staging", "staging", "batches"
    ]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.integers(-30, 30), st.integers(-(10**9), 10**9)), max_size=40))
def test_gaps_equal_lag_over_everything(spark, values):
    got = sorted(tuple(r) for r in sequence_gaps(ints(spark, values), "k", group=7).collect())
    seen = sorted(set(values))
    assert got == [(b, a, b - a) for a, b in zip(seen, seen[1:]) if b - a > 1]


def test_profiles(spark):
    df = spark.sql("select id as k, id % 2 as half, if(id < 90, timestamp'2024-01-01', null) as t from range(100)")
    got = {r["column"]: r for r in profile_columns(df, ["t"], ["k", "half"]).collect()}
    assert got["k"]["is_valid"] and not got["half"]["is_valid"] and not got["t"]["is_valid"]
    assert got["k"]["low"] == "0" and got["half"]["usable"] == 2
    empty = profile_columns(df.limit(0), ["t"], ["k"]).collect()
    assert all(r["is_valid"] for r in empty)


def test_size_estimate(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    row = size_estimate(df, fraction=1.0).first()
    assert row["estimated_bytes"] == len('{"id":1,"s":"a"}') + len('{"id":2,"s":null}')
    assert size_estimate(df.limit(0)).first()["estimated_bytes"] == 0
    assert size_estimate(df.limit(2), fraction=0.000001).first()["sampled"] == 2


def test_mark_is_a_literal_of_the_column_type(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert df.select(mark(df, "t", "2024-01-01")).schema[0].dataType.simpleString() == "timestamp_ntz"


def counted_rows(spark, df, column):
    """The rows, and an accumulator of how often one was read."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def look(_):
        seen.add(1)
        return True

    return df.filter(look(F.col(column)).cast("boolean")), seen


@pytest.mark.parametrize("size", [500, 100, 10])
def test_bounds_of_any_number_of_batches_take_one_read(spark, size):
    df = spark.range(5000).selectExpr("id div 3 as k", "id")
    rows, seen = counted_rows(spark, df, "k")
    assert len(list(plan_batches(rows, "k", size))) >= 4900 // (size + 2)
    assert seen.value == 5000


def test_bounds_where_some_values_repeat_far_more(spark):
    values = [v for i in range(400) for v in [i] * (900 if i % 97 == 5 else 1 + i % 4)]
    df = ints(spark, values)
    for size in (7, 64, 300, 5000):
        assert [(b.low, b.high, b.rows) for b in plan_batches(df, "k", size)] == greedy(values, size)
    assert list(plan_batches(df.limit(0), "k", 5)) == []
