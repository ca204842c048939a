"""Full, incremental and hash-checked loads of one table."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.bookmarks import Bookmark, BookmarkStore
from tablesync.operators.fingerprint import checkpoint_text, lane_sums, row_hash
from tablesync.operators.incremental import above, between_marks, mark
from tablesync.operators.schemas import cast_for_target
from tablesync.sources import endpoints, lake
from tablesync.sources.endpoints import Endpoint
from tablesync.sources.jdbc import Jdbc
from tablesync.sources.lake import Lake


@dataclass(frozen=True)
class Job:
    """Where tables come from, where they go, and where bookmarks are kept."""

    name: str
    source: Endpoint
    target: Endpoint
    store: BookmarkStore
    source_engine: str = ""
    target_engine: str = ""


@dataclass(frozen=True)
class TableSpec:
    """How one table is tracked. `source_types` are database type names per column."""

    table: str
    strategy: str = "full_load"
    column: str | None = None
    target_table: str | None = None
    manual: bool = False
    manual_type: str | None = None
    source_types: Mapping[str, str] = field(default_factory=dict)
    scan_options: Mapping[str, object] = field(default_factory=dict)
    sink_options: Mapping[str, object] = field(default_factory=dict)

    @property
    def target(self) -> str:
        return self.target_table or self.table


@dataclass(frozen=True)
class TableResult:
    """One line of the run log."""

    job: str
    table: str
    mode: str
    status: str
    rows: int = 0
    watermark: str | None = None
    seconds: float = 0.0
    error: str | None = None
    total_rows: int = 0
    bytes: int = 0


def source_rows(spark: SparkSession, job: Job, spec: TableSpec, **options) -> DataFrame:
    """The source table, cast for the target engine."""
    rows = endpoints.scan(spark, job.source, spec.table, **{**spec.scan_options, **options})
    return cast_for_target(rows, job.source_engine, job.target_engine, spec.source_types)


def lake_delta(spark: SparkSession, job: Job, spec: TableSpec, low: str | None) -> DataFrame:
    """Rows of a lake table above a bookmark, without segments and partition folders that hold none.

    Where the casts for the target change the tracking column, the bookmark is a value of the target's
    type, and the filter has to follow the cast.
    """
    everything = source_rows(spark, job, spec)
    found = endpoints.schema_of(spark, job.source, spec.table)
    kinds = {f.name.lower(): f.dataType for f in found.fields}
    if spec.scan_options or everything.schema[spec.column].dataType != kinds[spec.column.lower()]:
        return above(everything, spec.column, low)
    rows = lake.read_increment(spark, job.source, spec.table, spec.column, low)
    return cast_for_target(rows, job.source_engine, job.target_engine, spec.source_types)


def database_delta(spark: SparkSession, job: Job, spec: TableSpec, low: str | None) -> DataFrame:
    """Rows of a database table above a bookmark and up to its present end.

    Where the table is read in parallel, the ranges are cut evenly between those two values.
    """
    high, options = endpoints.highest(spark, job.source, spec.table, spec.column), {}
    if high is not None and spec.scan_options.get("partitions", 1) > 1:
        options = {"partition_column": spec.column, "low": low, "high": high}
    rows = source_rows(spark, job, spec, **options)
    return rows.limit(0) if high is None else between_marks(rows, spec.column, low, high)


def next_bookmark(spec: TableSpec, before: Bookmark | None, value: str | None, rows: int, checkpoint=None) -> Bookmark:
    return Bookmark(
        spec.table, spec.strategy, spec.column, value, checkpoint, False, spec.manual,
        spec.manual_type, rows, before.created if before else None,
    )


def full_load(spark: SparkSession, job: Job, spec: TableSpec, before: Bookmark | None = None) -> TableResult:
    """Replace the target with the source. The bookmark is the highest value in the target.

    A lake target reports it from the write itself; a database is asked for it. A database source
    may change under the read, so its upper end is fixed first; what comes later waits for the next run.
    """
    started = time.monotonic()
    rows = source_rows(spark, job, spec)
    if isinstance(job.source, Jdbc) and spec.column:
        rows = up_to(rows, spec.column, endpoints.highest(spark, job.source, spec.table, spec.column))
    options = dict(spec.sink_options)
    if spec.strategy == "hash":
        options["measures"] = lane_sums(row_hash(rows), "_s")
    done = endpoints.sink(rows, job.target, spec.target, "overwrite", spec.column, **options)
    value, checkpoint = done.high, None
    if spec.column and isinstance(job.target, Jdbc):
        value = endpoints.highest(spark, job.target, spec.target, spec.column)
    if spec.strategy == "hash":
        checkpoint = _observed_checkpoint(done)
    job.store.put(spark, job.name, [next_bookmark(spec, before, value, done.rows, checkpoint)])
    return TableResult(
        job.name, spec.table, "full", "completed", done.rows, value, time.monotonic() - started,
        total_rows=done.rows, bytes=done.observed.get("bytes") or 0,
    )


def up_to(rows: DataFrame, column: str, high: str | None) -> DataFrame:
    """Rows at or below a value, and those without one; all rows where there is no value."""
    return rows if high is None else rows.filter(F.col(column).isNull() | (F.col(column) <= mark(rows, column, high)))


def _observed_checkpoint(done: endpoints.Written) -> str:
    """The fingerprint of exactly the rows a write saw, in the form `checkpoint_text` gives."""
    total = sum((done.observed[f"_s{i}"] or 0) << (20 * i) for i in range(3))
    return f"{done.rows}:{total}"


def incremental_load(spark: SparkSession, job: Job, spec: TableSpec, before: Bookmark) -> TableResult:
    """Append rows above the bookmark in one pass over them.

    A lake snapshot cannot change under the read. A database can, so there the upper
    end is fixed first and rows arriving later wait for the next run. Count and new
    bookmark come from the write, and the bookmark is stored after it.
    """
    started = time.monotonic()
    if isinstance(job.source, Jdbc):
        delta = database_delta(spark, job, spec, before.value)
    elif isinstance(job.source, Lake):
        delta = lake_delta(spark, job, spec, before.value)
    else:
        delta = above(source_rows(spark, job, spec), spec.column, before.value)
    options = dict(spec.sink_options)
    if isinstance(job.target, Lake):
        options["skip_empty"] = True
    done = endpoints.sink(delta, job.target, spec.target, "append", spec.column, **options)
    value = before.value
    if done.rows:
        value = done.high if done.high is not None else before.value
        if isinstance(job.target, Jdbc):
            verify_appended(spark, job, spec, before.value, value, done.rows)
        job.store.put(spark, job.name, [next_bookmark(spec, before, value, done.rows)])
    return TableResult(
        job.name, spec.table, "incremental", "completed", done.rows, value, time.monotonic() - started,
        total_rows=done.rows, bytes=(done.observed.get("bytes") or 0) if done.rows else 0,
    )


def verify_appended(spark, job: Job, spec: TableSpec, low, high, rows: int) -> None:
    """A database commits task by task, so a repeated task may have added rows twice.

    The bookmark moves only when the target holds exactly the rows that were sent.
    """
    target = endpoints.scan(spark, job.target, spec.target).select(spec.column)
    found = between_marks(target, spec.column, low, high).count()
    if found != rows:
        raise RuntimeError(
            f"{spec.target}: {found} rows above {low} where {rows} were sent; recover the table before the next load"
        )


def hash_load(spark: SparkSession, job: Job, spec: TableSpec, before: Bookmark) -> TableResult:
    """Skip a table whose fingerprint is the stored one, else reload it."""
    started = time.monotonic()
    if before.checkpoint is not None and checkpoint_text(source_rows(spark, job, spec)) == before.checkpoint:
        return TableResult(
            job.name, spec.table, "hash", "skipped", 0, None, time.monotonic() - started
        )
    return replace(full_load(spark, job, spec, before), mode="hash")


def load(spark: SparkSession, job: Job, spec: TableSpec, before: Bookmark | None) -> TableResult:
    """First run, reset or lost bookmark: everything. Otherwise what the strategy says."""
    if before is None or before.first_run or spec.strategy == "full_load":
        return full_load(spark, job, spec, before)
    if isinstance(job.target, Lake) and not lake.exists(spark, job.target, spec.target):
        # A bookmark without its table says nothing about what has to be loaded.
        return full_load(spark, job, spec, before)
    if spec.strategy == "hash":
        return hash_load(spark, job, spec, before)
    if before.column != spec.column or before.value is None:
        return full_load(spark, job, spec, before)
    return incremental_load(spark, job, spec, before)
