"""Bookmark rows: an append-only table, its newest state per table, and its checks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.structs import local_rows, struct
from tablesync.functions.text import format_iso, parse_iso
from tablesync.session import remove

# Fixed values.
STRATEGIES = ["timestamp", "primary_key", "hash", "full_load"]
COLUMN_STRATEGIES = ["timestamp", "primary_key"]
MAX_TEXT = 10_000
TIME_FIELDS = ["last_update_timestamp", "created_timestamp", "updated_timestamp"]
BUCKETS = 64  # folders of a bookmark store's write, by hash of job and table
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"

BOOKMARK_SCHEMA = struct(
    job_name="string", table_name="string", incremental_strategy="string",
    incremental_column="string", last_processed_value="string",
    last_update_timestamp="string", row_hash_checkpoint="string", is_first_run="boolean",
    created_timestamp="string", updated_timestamp="string", version="string", s3_key="string",
    is_manually_configured="boolean", manual_column_data_type="string",
    processed_rows="bigint", write_no="bigint",
)


@dataclass(frozen=True)
class Bookmark:
    """The state of one table in one job."""

    table: str
    strategy: str
    column: str | None = None
    value: str | None = None
    checkpoint: str | None = None
    first_run: bool = True
    manual: bool = False
    manual_type: str | None = None
    rows: int = 0
    created: str | None = None


# --------------------------------------------------------------------------
# checks


def _blank(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column)), F.lit("")) == ""


def _reason(test: Column, code: str) -> Column:
    return F.when(test, F.lit(code))


def _codes(tests: Sequence[Column]) -> Column:
    """The codes that apply, as text; built from functions that all take part in code generation."""
    return F.concat_ws(",", *tests)


def structural_reasons(df: DataFrame) -> Column:
    """Codes of everything wrong with the form of a bookmark row, as text; empty means valid."""
    strategy = F.col("incremental_strategy")
    known = strategy.isin(STRATEGIES)
    tests = [
        _reason(_blank("table_name"), "table_name_missing"),
        _reason(_blank("incremental_strategy"), "strategy_missing"),
        _reason(~_blank("incremental_strategy") & ~known, "strategy_unknown"),
        _reason(
            strategy.isin(COLUMN_STRATEGIES) & (F.coalesce(F.length("incremental_column"), F.lit(0)) == 0),
            "column_missing",
        ),
        _reason(
            F.col("manual_column_data_type").isNotNull() & _blank("manual_column_data_type"),
            "manual_type_blank",
        ),
    ]
    for flag in ("is_first_run", "is_manually_configured"):
        # Typed rows are booleans by construction; text rows must spell one.
        if isinstance(df.schema[flag].dataType, T.StringType):
            spelled = F.lower(F.col(flag)).isin("true", "false")
            tests.append(_reason(F.col(flag).isNotNull() & ~spelled, f"{flag}_not_boolean"))
    for name in TIME_FIELDS:
        tests.append(_reason(F.length(name) < 10, f"{name}_too_short"))
    return _codes(tests)


def consistency_reasons(
    df: DataFrame, expected_table: Column | None = None, now: Column | None = None
) -> Column:
    """Codes for signs of corruption. Expects each time as an instant in `_at_<name>`, parsed once."""
    limit = (now if now is not None else F.current_timestamp()) + F.expr("interval 1 hour")
    at = {name: F.col(f"_at_{name}") for name in TIME_FIELDS}
    tests = []
    if expected_table is not None:
        tests.append(_reason(~F.col("table_name").eqNullSafe(expected_table), "other_table"))
    for name in TIME_FIELDS:
        given = F.length(name) > 0
        tests.append(_reason(given & at[name].isNull(), f"{name}_unreadable"))
        tests.append(_reason(at[name] > limit, f"{name}_in_future"))
    tests.append(_reason(at["created_timestamp"] > at["updated_timestamp"], "created_after_updated"))
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tests.append(_reason(F.greatest(*[F.length(t) for t in texts]) > MAX_TEXT, "text_too_long"))
    tests.append(_reason(F.concat_ws("", *texts).rlike(CONTROL_CHARACTERS), "control_characters"))
    return _codes(tests)


def check(df: DataFrame, expected_table: Column | None = None, now: Column | None = None) -> DataFrame:
    """Add `reasons` and `is_valid` to bookmark rows."""
    # Columns of their own, not a struct: the optimizer would put the parsing back into every use.
    timed = df.withColumns({f"_at_{n}": parse_iso(F.col(n)) for n in TIME_FIELDS})
    codes = (structural_reasons(df), consistency_reasons(df, expected_table, now))
    both = timed.withColumn("_codes", F.concat_ws(",", *[F.nullif(c, F.lit("")) for c in codes]))
    none = F.col("_codes") == ""
    reasons = F.when(none, F.array().cast("array<string>")).otherwise(F.split("_codes", ","))
    return both.withColumn("reasons", reasons).withColumn("is_valid", none).drop("_codes", *[f"_at_{n}" for n in TIME_FIELDS])


# --------------------------------------------------------------------------
# state


def latest(df: DataFrame, keys: Sequence[str] = ("job_name", "table_name")) -> DataFrame:
    """The newest row per key. A partial aggregate, so a job that writes most rows is no hot task."""
    instant = parse_iso(F.col("updated_timestamp"))
    order = F.struct(instant, F.col("write_no"))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def lookup(tables: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Bookmark columns per wanted table; a table without one is on its first run."""
    found = bookmarks.withColumnRenamed("is_first_run", "_first")
    return (
        tables.join(found, "table_name", "left")
        .withColumn("is_first_run", F.coalesce("_first", F.lit(True)))
        .drop("_first")
    )


def with_override(detected: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual column per table over the detected one."""
    picked = manual.select("table_name", F.col("column_name").alias("_manual"))
    return (
        detected.join(picked, "table_name", "left")
        .withColumn("column", F.coalesce("_manual", "column"))
        .withColumn("is_manual", F.col("_manual").isNotNull())
        .drop("_manual")
    )


def statistics(df: DataFrame) -> DataFrame:
    """Per job: tables, first runs, manual ones, rows, newest update, rows by strategy."""
    current = latest(df)
    return current.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if("is_first_run").alias("first_runs"),
        F.count_if("is_manually_configured").alias("manual"),
        F.sum("processed_rows").alias("processed_rows"),
        F.max("updated_timestamp").alias("last_update"),
        *[F.count_if(F.col("incremental_strategy") == s).alias(s) for s in STRATEGIES],
    )


def to_json(df: DataFrame) -> Column:
    """A bookmark row as JSON, with its NULL fields kept."""
    return F.to_json(F.struct(*[c for c in df.columns]), {"ignoreNullFields": "false"})


def from_json(text: Column) -> Column:
    """JSON back to a bookmark struct, with unreadable text as NULL."""
    return F.from_json(text, BOOKMARK_SCHEMA, {"mode": "PERMISSIVE"})


# --------------------------------------------------------------------------
# store


def bucket_of(job: Column, table: Column) -> Column:
    """The folder of a table's bookmarks."""
    return F.pmod(F.xxhash64(job, table), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class BookmarkStore:
    """Bookmarks as an append-only parquet folder; the newest valid row counts.

    Rows lie in `gen=<n>/put=<write>/bucket=<hash of job and table>`. Every write gets a folder of its own, so
    tables that finish at the same time never share a commit, and who asks for a few tables reads their buckets
    only. `fold` starts a new generation with the newest rows, one or few files per bucket.
    """

    path: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).select(*BOOKMARK_SCHEMA.names)

    def _stored(self, spark: SparkSession) -> DataFrame:
        layout = T.StructType([*BOOKMARK_SCHEMA.fields, *struct(gen="bigint", put="string", bucket="int").fields])
        try:
            return spark.read.schema(layout).parquet(self.path)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            return local_rows(spark, [], layout)

    def current(self, spark: SparkSession, job: str) -> DataFrame:
        """Newest row per table of a job. A corrupt row counts as no bookmark: full load."""
        newest = latest(self.rows(spark).filter(F.col("job_name") == job))
        return check(newest).filter("is_valid").drop("reasons", "is_valid")

    def get(self, spark: SparkSession, job: str, tables: Sequence[str]) -> dict[str, Bookmark]:
        """Bookmarks of the asked tables, read in one job."""
        # Buckets are literals once the plan is made, so the folders of other tables are not read.
        buckets = [bucket_of(F.lit(job), F.lit(t)) for t in tables] or [F.lit(None)]
        stored = self._stored(spark).filter(F.col("bucket").isin(buckets))
        of_job = stored.filter((F.col("job_name") == job) & F.col("table_name").isin(list(tables))).select(*BOOKMARK_SCHEMA.names)
        # The verdict is read as a column: as a filter, the optimizer would take the long
        # expression apart for every row-group test.
        wanted = check(latest(of_job))
        return {
            r.table_name: Bookmark(
                r.table_name, r.incremental_strategy, r.incremental_column, r.last_processed_value,
                r.row_hash_checkpoint, bool(r.is_first_run), bool(r.is_manually_configured),
                r.manual_column_data_type, r.processed_rows or 0, r.created_timestamp,
            )
            for r in wanted.collect()  # one row per asked table
            if r.is_valid
        }

    def put(self, spark: SparkSession, job: str, bookmarks: Sequence[Bookmark]) -> None:
        """Append the new state of one or many tables in one write."""
        now = datetime.now(timezone.utc).isoformat()
        number = time.time_ns()
        rows = [
            (job, b.table, b.strategy, b.column, b.value, now, b.checkpoint, b.first_run,
             b.created or now, now, "1.0", None, b.manual, b.manual_type, b.rows, number + i)
            for i, b in enumerate(bookmarks)
        ]
        self._write(local_rows(spark, rows, BOOKMARK_SCHEMA), len(rows) > 1)

    def append(self, rows: DataFrame) -> None:
        """Append many bookmark rows held in a DataFrame."""
        self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in BOOKMARK_SCHEMA.fields]))

    def _write(self, rows: DataFrame, spread: bool = True, generation: int | None = None) -> None:
        """One write in a folder of its own; a bucket goes to one task, or several if it is large."""
        if generation is None:
            generation = max(self._generations(rows.sparkSession), default=0)
        rows = rows.withColumn("bucket", bucket_of(F.col("job_name"), F.col("table_name")))
        if spread:
            rows = rows.hint("rebalance", "bucket")
        folder = f"{self.path}/gen={generation}/put={time.time_ns()}-{uuid.uuid4().hex[:8]}"
        rows.write.mode("errorifexists").partitionBy("bucket").parquet(folder)

    def _generations(self, spark: SparkSession) -> list[int]:
        """Generations in the store: one, or two after a fold that was broken off."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        names = [f.getPath().getName() for f in files.listStatus(place)]
        return sorted(int(n[4:]) for n in names if n.startswith("gen="))

    def writes(self, spark: SparkSession) -> int:
        """Number of writes whose rows are in the store."""
        return self._stored(spark).agg(F.count_distinct("put")).first()[0]

    def fold(self, spark: SparkSession) -> int:
        """Keep only the newest row per job and table; returns the number of writes that went.

        Run it when no load is going on. The newest rows are written as the next generation before the
        earlier ones go, each as one folder; a fold that breaks off in between leaves rows twice, which
        changes no bookmark, and the next one ends it.
        """
        old = self._generations(spark)
        if not old:
            return 0
        gone = self.writes(spark)
        self._write(latest(self.rows(spark)), generation=old[-1] + 1)
        for number in old:
            remove(spark, f"{self.path}/gen={number}")
        return gone

    def reset(self, spark: SparkSession, job: str, tables: Sequence[str]) -> None:
        """Make the next run of these tables a full load."""
        known = self.get(spark, job, tables)
        self.put(
            spark, job,
            [Bookmark(b.table, b.strategy, b.column, manual=b.manual, manual_type=b.manual_type,
                      created=b.created) for b in known.values()],
        )


def advance(df: DataFrame, value: Column, rows: Column, at: Column, number: Column) -> DataFrame:
    """Bookmark rows after a successful load, for many tables at once."""
    return (
        df.withColumn("last_processed_value", value)
        .withColumn("processed_rows", rows)
        .withColumn("is_first_run", F.lit(False))
        .withColumn("updated_timestamp", format_iso(at))
        .withColumn("last_update_timestamp", format_iso(at))
        .withColumn("write_no", number)
    )
