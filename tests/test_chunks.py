"""Windows in chunks against windows over everything."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablesync.operators import chunks, runlog


def periods(spark, seed, n=300, gaps=True):
    rng = random.Random(seed)
    at = sorted(rng.sample(range(-2 * n, 2 * n), n)) if gaps else range(n)
    rows = [(g, i, None if rng.random() < 0.05 else float(rng.randrange(10))) for g in ("a", None, "c") for i in at if rng.random() < 0.8 or not gaps]
    return spark.createDataFrame(rows, "g string, period bigint, value double")


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_earlier_averages(spark, by, span):
    df = periods(spark, 1)
    df = df if by else df.filter("g = 'a'")
    whole = Window.partitionBy(*by).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    want = {(r.g, r.period): r.m for r in df.withColumn("m", F.avg("value").over(whole)).collect()}
    got = {(r.g, r.period): r.m for r in chunks.earlier_averages(df, {"m": "value"}, "period", by, span).collect()}
    assert got.keys() == want.keys() and all((got[k] is None) == (want[k] is None) and abs((got[k] or 0) - (want[k] or 0)) < 1e-9 for k in want)


@pytest.mark.parametrize("step", [None, 1])
@pytest.mark.parametrize("span", [1, 5, 64])
def test_streaks(spark, step, span):
    df = periods(spark, 2)
    got = {(r.g, r.period): r.streak for r in chunks.streaks(df, F.col("value") > 3, "period", ["g"], step, span).collect()}
    rows = sorted(df.collect(), key=lambda r: (r.g or "", r.period))
    run, last = 0, None
    for r in rows:
        near = last is not None and last[0] == r.g and (step is None or r.period - last[1] == step)
        run = 0 if not (r.value or 0) > 3 else run + 1 if near else 1
        assert got[r.g, r.period] == run
        last = (r.g, r.period)


@pytest.mark.parametrize("consecutive, seconds", [(1, None), (3, None), (2, 3600), (3, 3600), (1, 3600)])
def test_alarms_equal_windows_over_everything(spark, consecutive, seconds):
    hours = periods(spark, 3).select("g", F.timestamp_seconds(F.col("period") * 3600).alias("period"), "value")
    group = Window.partitionBy("g")
    frame = group.orderBy("period").rowsBetween(-(consecutive - 1), 0)
    if seconds:
        frame = group.orderBy(F.unix_micros("period")).rangeBetween(-(consecutive - 1) * seconds * 1_000_000, 0)
    breach = F.coalesce(F.col("value") > 4, F.lit(False))
    want = hours.withColumn("alarm", F.min(breach).over(frame) & (F.count(F.lit(1)).over(frame) == consecutive))
    key = lambda df: {(r.g, r.period): r.alarm for r in df.collect()}
    assert key(runlog.alarms(hours, 4, consecutive, ["g"], seconds=seconds)) == key(want)


def test_empty_tables_and_text_periods(spark):
    df = periods(spark, 4)
    assert runlog.trend(df.limit(0), ["g"]).count() == 0 and runlog.alarms(df.limit(0), 1, 2).count() == 0
    text = df.filter("g = 'a'").withColumn("period", F.lpad((F.col("period") + 1000).cast("string"), 5, "0"))
    assert runlog.trend(text).count() == text.count()
    assert runlog.alarms(text, 4, 2).count() == text.count()


def test_no_window_over_the_rows_of_a_whole_group(spark):
    df = periods(spark, 5).filter("g = 'a'").withColumns({"seconds": F.col("value"), "throughput": F.col("value"), "error_rate": F.lit(0.0)})
    for found in (runlog.trend(df), runlog.alarms(df, 4, 3), runlog.baseline_alerts(df)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        # A window is inside a chunk, or runs over the chunks: then an aggregate below it has made one row of each.
        over = [line for line in windows if not re.search(r"windowspecdefinition\((g#\d+, )?_chunk#\d+L, ", line)]
        assert windows and all(re.search(r"_chunk#\d+L ASC", line) for line in over)
        assert all("Aggregate" in plan.split(line)[1] for line in over)
