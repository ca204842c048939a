"""Bounded increments: the next N rows above the bookmark, the bookmark moved after each.

The upper end of a batch is a value, so rows that share it come in one batch together.
"""

from __future__ import annotations

import bisect
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.bookmarks import Bookmark
from tablesync.operators.chunks import in_chunks, running_sum
from tablesync.operators.incremental import RankBounds, above, between_marks, from_position, has_position, mark_text, position
from tablesync.plans.loads import (
    Job,
    TableResult,
    TableSpec,
    incremental_load,
    lake_delta,
    load,
    next_bookmark,
    source_rows,
    verify_appended,
)
from tablesync.session import remove, workspace
from tablesync.sources import endpoints, lake
from tablesync.sources.lake import Lake

# Row counts at which another way of loading is taken, and rows per batch.
DIRECT_BELOW = 10_000_000
STAGING_UP_TO = 100_000_000
BATCH_ROWS = 1_000_000
# Batches that one read of the delta writes, and values that one job brings to the driver to find bounds.
TOGETHER = 256
FETCHED = 100_000


@dataclass(frozen=True)
class Batch:
    """One bounded increment: rows with low < column <= high."""

    number: int
    low: object | None
    high: object
    rows: int


def plan_batches(df: DataFrame, column: str, size: int, low: object | None = None) -> Iterator[Batch]:
    """Bounds of consecutive batches of `size` rows, longer where the last value repeats.

    The table is read once, for the rows of each distinct value; their running sum is written aside in the order of
    the values, and all bounds come from there. No value and no rank puts its rows into one task.
    """
    kind = df.schema[column].dataType
    place = position(df, column) if has_position(kind) else mark_text(F.col(column), kind)
    counts = above(df, column, low).filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"), place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    spark, chunks, path = df.sparkSession, None, workspace(df.sparkSession, "ranks")
    try:
        chunks, folder = in_chunks(counts, ["value"])
        reached = running_sum(chunks, "n", ["value"], "reached").select("place", "n", "reached")
        seen = Observation()
        measures = [F.max("reached").alias("total"), F.max("n").alias("most")]
        reached.observe(seen, *measures).write.parquet(path)
        ranks = spark.read.schema(reached.schema).parquet(path)
        start = low
        for number, (found, rows) in enumerate(_bounds(ranks, size, **seen.get), 1):
            high = from_position(kind, found) if has_position(kind) else found
            yield Batch(number, start, high, rows)
            start = high
    finally:
        remove(spark, path)
        if chunks is not None:
            remove(spark, folder)


def _bounds(ranks: DataFrame, size: int, total: int | None, most: int | None) -> Iterator[tuple[object, int]]:
    """(last value, rows) of each batch, from the running sums of the distinct values.

    Where no value repeats, batch k ends at rank k * size. Where values do, each batch may pass its rank by up to
    `most` - 1 rows, and shifts the later ones by as much. So one job fetches the values in a stretch behind each
    rank that grows with k, and the driver walks along them; the walk starts anew where the stretches end, or where
    values that repeat far more than usual carried it beyond them.
    """
    done, slack = 0, min((most or 1) - 1, max(1, size // 64))
    while done < (total or 0):
        # The stretches of all batches of one job hold at most about FETCHED values.
        ahead = max(1, min(-(-(total - done) // size), FETCHED, math.isqrt(2 * FETCHED // slack) if slack else FETCHED))
        k = F.least(F.floor((F.col("reached") - done) / size) - 1, F.lit(ahead - 1))
        start = done + (k + 1) * size
        near = (F.col("reached") >= done + size) & (F.col("reached") - F.col("n") < start + (k + 1) * slack + 1)
        rows = sorted(ranks.filter(near | (F.col("reached") == total)).collect(), key=lambda r: r["reached"])
        ends, known = [r["reached"] for r in rows], done
        while done < total:
            i = bisect.bisect_left(ends, min(done + size, total))
            # The value at this rank was fetched if its rows cover the rank.
            if i == len(ends) or ends[i] - rows[i]["n"] >= min(done + size, total):
                break
            yield rows[i]["place"], ends[i] - done
            done = ends[i]
        if done == known:
            raise RuntimeError("no bound found; the table changed while it was read")


def next_batch(df: DataFrame, column: str, size: int, low: object | None = None) -> DataFrame:
    """The next bounded increment above a bookmark."""
    if has_position(df.schema[column].dataType):
        found = RankBounds(df, column, low).bound(size)
        high = found and found[0]
    else:
        batch = next(plan_batches(df, column, size, low), None)
        high = batch and batch.high
    return df.limit(0) if high is None else between_marks(df, column, low, high)


def load_in_batches(
    spark: SparkSession, job: Job, spec: TableSpec, before: Bookmark, size: int = BATCH_ROWS, together: int = TOGETHER
) -> TableResult:
    """Load what lies above the bookmark batch by batch; the bookmark moves after each.

    Up to `together` batches are read and written at once, each into a place of its own, and then published one
    after the other. So the source is read once per `together` batches, and a failure keeps what is published.
    """
    started = time.monotonic()
    rows = lake_delta(spark, job, spec, before.value) if isinstance(job.source, Lake) else source_rows(spark, job, spec)
    plan = list(plan_batches(rows, spec.column, size, before.value))
    publish = _publish_to_lake if isinstance(job.target, Lake) else _publish_to_database
    total, value = 0, before.value
    for i in range(0, len(plan), together):
        group = plan[i : i + together]
        part = between_marks(rows, spec.column, value, str(group[-1].high))
        for high, count in publish(spark, job, spec, part, [b.high for b in group], value):
            value, total = high, total + count
            job.store.put(spark, job.name, [next_bookmark(spec, before, value, count)])
    return TableResult(job.name, spec.table, "batches", "completed", total, value, time.monotonic() - started)


def _publish_to_lake(spark: SparkSession, job: Job, spec: TableSpec, part: DataFrame, highs: list, low: str | None) -> Iterator[tuple[str, int]]:
    """(bookmark, rows) after each slice that became visible."""
    if not lake.exists(spark, job.target, spec.target):
        lake.clone_empty(part, job.target, spec.target)
    for segment in lake.write_slices(part, job.target, spec.target, spec.column, highs, **spec.sink_options):
        lake.append_segment(spark, job.target, spec.target, segment, spec.column)
        yield segment.high, segment.rows


def _publish_to_database(spark: SparkSession, job: Job, spec: TableSpec, part: DataFrame, highs: list, low: str | None) -> Iterator[tuple[str, int]]:
    """(bookmark, rows) after each slice that was appended, from copies written side by side."""
    path = workspace(spark, "slices")
    try:
        named = part.withColumn("_slice", lake.slice_of(part, spec.column, highs, list(range(len(highs)))))
        named.hint("rebalance", F.col("_slice")).write.partitionBy("_slice").parquet(path)
        found = spark.read.schema(named.schema).parquet(path)
        for i in range(len(highs)):
            done = endpoints.sink(found.filter(F.col("_slice") == i).drop("_slice"), job.target, spec.target, "append", spec.column, **spec.sink_options)
            if done.rows:
                verify_appended(spark, job, spec, low, done.high, done.rows)
                low = done.high
                yield done.high, done.rows
    finally:
        remove(spark, path)


def pick_tier(rows: int, direct_below: int = DIRECT_BELOW, staging_up_to: int = STAGING_UP_TO) -> str:
    if rows < direct_below:
        return "direct"
    return "staging" if rows <= staging_up_to else "batches"


def tier_of(rows, direct_below: int = DIRECT_BELOW, staging_up_to: int = STAGING_UP_TO):
    """`pick_tier` as a column function, for many tables at once."""
    return F.when(rows < direct_below, "direct").when(rows <= staging_up_to, "staging").otherwise("batches")


def tiered_load(
    spark: SparkSession,
    job: Job,
    spec: TableSpec,
    before: Bookmark | None,
    direct_below: int = DIRECT_BELOW,
    staging_up_to: int = STAGING_UP_TO,
    batch_rows: int = BATCH_ROWS,
) -> tuple[str, TableResult]:
    """Choose by the size of the delta: direct, staged with a count check, or in batches."""
    if before is None or before.first_run or before.value is None or not spec.column:
        return "direct", load(spark, job, spec, before)
    delta = above(source_rows(spark, job, spec).select(spec.column), spec.column, before.value).count()
    tier = pick_tier(delta, direct_below, staging_up_to)
    if tier == "batches":
        return tier, load_in_batches(spark, job, spec, before, batch_rows)
    if tier == "staging" and isinstance(job.target, Lake):
        staged = TableSpec(**{**spec.__dict__, "sink_options": {**spec.sink_options, "verify": True}})
        return tier, incremental_load(spark, job, staged, before)
    return tier, incremental_load(spark, job, spec, before)

