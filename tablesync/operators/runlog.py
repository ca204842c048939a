"""Reports over log lines, errors, metrics and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import percent_change
from tablesync.functions.types import lookup
from tablesync.operators.chunks import earlier_averages, streaks

# --------------------------------------------------------------------------
# log lines


def parse_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Split `message | k=v | k=v` into `message` and a map `fields`; a repeated key keeps its last value.

    The pairs are sorted by key and place, and one stays if the next has another key: no step looks at all pairs
    for each pair, so lines may have any number of fields.
    """
    parts = F.split(F.col(line), r"\s\|\s")
    pairs = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.contains("="))
    entry = lambda p, i: F.struct(
        F.trim(F.substring_index(p, "=", 1)).alias("key"), i.alias("place"), F.regexp_replace(p, "^[^=]*=", "").alias("value"))
    last = F.filter("_sorted", lambda e, i: ~e["key"].eqNullSafe(F.get("_sorted", i + 1)["key"]))
    in_line = F.array_sort(F.transform("_last", lambda e: F.struct(e["place"], e["key"], e["value"])))
    return (
        df.withColumn("message", F.trim(F.get(parts, F.lit(0))))
        .withColumn("_sorted", F.array_sort(F.transform(pairs, entry)))
        .withColumn("_last", last)
        .withColumn("fields", F.map_from_entries(F.transform(in_line, lambda e: F.struct(e["key"], e["value"]))))
        .drop("_sorted", "_last")
    )


def format_line(message: Column, fields: dict[str, Column]) -> Column:
    """`message | k=v | k=v`; a NULL value is written as None."""
    parts = [F.concat(F.lit(k + "="), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in fields.items()]
    return F.concat_ws(" | ", message, *parts)


def has_any(text: Column, words: Sequence[str]) -> Column:
    result = F.lit(False)
    for w in words:
        result = result | text.contains(w)
    return result


def has_all(text: Column, words: Sequence[str]) -> Column:
    result = F.lit(True)
    for w in words:
        result = result & text.contains(w)
    return result


def number_between(text: Column, before: str, after: str) -> Column:
    """The whole number between two words, as in `processed * records`; NULL without one."""
    # Java quotes with \Q..\E, which keeps regex signs in the words literal.
    pattern = rf"\Q{before}\E\s*(\d+)\s*\Q{after}\E"
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found.cast("bigint"))


def newest(df: DataFrame, by: str | Sequence[str], k: int) -> DataFrame:
    """The newest k rows; each task keeps k rows and only those are merged."""
    order = [by] if isinstance(by, str) else list(by)
    return df.orderBy(*[F.desc(c) for c in order]).limit(k)


def per_bin(df: DataFrame, ts: str, width: str, *measures: Column, by: Sequence[str] = ()) -> DataFrame:
    """Counts and other aggregates per tumbling time bin."""
    return (
        df.groupBy(F.window(ts, width).alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), *measures)
        .withColumn("bin", F.col("_w.start"))
        .drop("_w")
    )


# --------------------------------------------------------------------------
# errors. Word lists in order of precedence, the first list that matches wins.

ERROR_WORDS = {
    "connection": [
        "connection refused", "connection timed out", "connection reset", "no route to host",
        "network unreachable", "connection failed", "could not connect", "unable to connect",
        "connection error",
    ],
    "authentication": [
        "authentication failed", "login failed", "invalid credentials", "access denied",
        "unauthorized", "invalid username or password", "authentication error", "login incorrect",
    ],
    "network": [
        "network error", "socket timeout", "read timeout", "write timeout",
        "network is unreachable", "host unreachable", "dns resolution failed",
        "connection timeout", "socket error",
    ],
    "data_processing": [
        "data type mismatch", "conversion error", "parsing error", "invalid data format",
        "constraint violation", "data truncation", "null value", "duplicate key",
    ],
    "schema_mismatch": [
        "column not found", "table not found", "schema mismatch", "invalid column name",
        "missing column", "unknown column", "table does not exist", "column does not exist",
    ],
    "permission": [
        "permission denied", "access forbidden", "insufficient privileges", "not authorized",
        "privilege error", "access violation", "security error", "forbidden",
    ],
    "resource": [
        "out of memory", "disk full", "resource exhausted", "too many connections",
        "connection pool exhausted", "memory error", "resource unavailable",
    ],
    "timeout": [
        "timeout", "timed out", "operation timeout", "query timeout", "connection timeout",
        "read timeout", "write timeout",
    ],
}
RECOVERY = {
    "connection": "retry_with_backoff", "authentication": "fail_immediately",
    "network": "retry_with_backoff", "data_processing": "log_and_continue",
    "schema_mismatch": "fail_immediately", "permission": "fail_immediately",
    "resource": "retry_with_longer_delay", "timeout": "retry_with_backoff",
    "unknown": "retry_with_backoff",
}
RETRYABLE = ["connection", "network", "timeout", "resource"]
CRITICAL = ["authentication", "permission", "schema_mismatch"]


def error_category(message: Column) -> Column:
    """Category of an error text by the first word list with a hit, else `unknown`."""
    text = F.lower(F.coalesce(message, F.lit("")))
    result = None
    for category, words in ERROR_WORDS.items():
        test = text.rlike("|".join(words))
        result = F.when(test, category) if result is None else result.when(test, category)
    return result.otherwise("unknown")


def classify_errors(df: DataFrame, message: str = "message") -> DataFrame:
    """Add category, retryable, recovery and critical to error rows."""
    return (
        df.withColumn("category", error_category(F.col(message)))
        .withColumn("retryable", F.col("category").isin(RETRYABLE))
        .withColumn("recovery", lookup(F.col("category"), RECOVERY))
        .withColumn("critical", F.col("category").isin(CRITICAL))
    )


def error_summary(classified: DataFrame) -> DataFrame:
    """Errors and critical errors per category."""
    return classified.groupBy("category").agg(
        F.count(F.lit(1)).alias("errors"), F.count_if("critical").alias("critical_errors")
    )


def latest_errors(classified: DataFrame, by: str | Sequence[str], k: int = 5) -> DataFrame:
    return newest(classified, by, k)


def operation_metrics(df: DataFrame) -> DataFrame:
    """Per operation (operation, ts, ok, duration, message): attempts, results, average, last error.

    The last error is a partial aggregate, so one busy operation is no hot task.
    """
    failed = ~F.col("ok")
    return df.groupBy("operation").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("ok").alias("successes"),
        F.count_if(failed).alias("failures"),
        F.avg("duration").alias("average_duration"),
        F.max_by(F.when(failed, F.col("message")), F.when(failed, F.col("ts"))).alias("last_error"),
    )


# --------------------------------------------------------------------------
# run logs


def _per(part: Column, whole: Column, digits: int | None = 2) -> Column:
    value = F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def job_summary(log: DataFrame) -> DataFrame:
    """Per job (job_name, status, rows, bytes, seconds): tables, results, rates.

    A table skipped because nothing changed is a success. Rows and bytes count completed tables only. Seconds are those of the tables; a
    caller that has the job's own time divides by that instead.
    """
    done, good = F.col("status") == "completed", F.col("status").isin("completed", "skipped")
    return (
        log.groupBy("job_name")
        .agg(
            F.count(F.lit(1)).alias("tables"),
            F.count_if(good).alias("succeeded"),
            F.count_if(~good).alias("failed"),
            F.sum(F.when(done, F.col("rows")).otherwise(0)).alias("rows"),
            F.sum(F.when(done, F.col("bytes")).otherwise(0)).alias("bytes"),
            F.sum("seconds").alias("seconds"),
        )
        .withColumn("success_percent", _per(F.col("succeeded") * 100, F.col("tables")))
        .withColumn("rows_per_second", _per(F.col("rows"), F.col("seconds")))
    )


def table_rates(log: DataFrame) -> DataFrame:
    """Per run-log row (mode, status, rows, total_rows, bytes, seconds): rows/s, MB/s, progress.

    Nothing to do is 0 % of a full load, and 100 % of a completed increment.
    """
    nothing = F.when((F.col("mode") != "full") & (F.col("status") == "completed"), 100.0).otherwise(0.0)
    return (
        log.withColumn("rows_per_second", _per(F.col("rows"), F.col("seconds")))
        .withColumn("mb_per_second", _per(F.col("bytes") / 1048576, F.col("seconds")))
        .withColumn(
            "progress_percent",
            F.when(F.col("total_rows") == 0, nothing).otherwise(
                F.round(F.col("rows") * 100 / F.when(F.col("total_rows") != 0, F.col("total_rows")), 2)
            ),
        )
    )


def storage_summary(df: DataFrame) -> DataFrame:
    """Per storage operation (operation, ok, duration_ms, bytes): success, averages and rates."""
    seconds = F.col("total_ms") / 1000
    return (
        df.groupBy("operation")
        .agg(
            F.count(F.lit(1)).alias("operations"),
            F.count_if("ok").alias("succeeded"),
            F.sum("duration_ms").alias("total_ms"),
            F.sum("bytes").alias("bytes"),
        )
        .withColumn("success_percent", _per(F.col("succeeded") * 100, F.col("operations")))
        .withColumn("average_ms", _per(F.col("total_ms"), F.col("operations")))
        .withColumn("mb_per_second", _per(F.col("bytes") / 1048576, seconds))
        .withColumn("operations_per_second", _per(F.col("operations"), seconds))
    )


def connection_summary(df: DataFrame) -> DataFrame:
    """Connection attempts (side, engine, ok, seconds) per side and engine."""
    return (
        df.groupBy("side", "engine")
        .agg(
            F.count(F.lit(1)).alias("attempts"), F.count_if("ok").alias("succeeded"),
            F.sum("seconds").alias("seconds"),
        )
        .withColumn("average_seconds", _per(F.col("seconds"), F.col("attempts"), None))
    )


# --------------------------------------------------------------------------
# metrics over time


def metric_periods(df: DataFrame, ts: str, width: str, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """A metric reduced to one row per period and group, whatever the number of data points."""
    return (
        df.groupBy(F.window(ts, width).alias("_w"), *by)
        .agg(value.alias("value"))
        .withColumn("period", F.col("_w.start"))
        .drop("_w")
    )


def alarms(
    periods: DataFrame,
    threshold: float,
    consecutive: int,
    by: Sequence[str] = (),
    at_least: bool = False,
    seconds: int | None = None,
) -> DataFrame:
    """Alarm state per period: the metric breached the threshold in the last N periods.

    With the length of a period in `seconds`, one that has no data counts as no breach;
    otherwise the last N rows count. Expects one row per group and period. An alarm is a run of
    breaches, counted in chunks of time, so no task holds a group's whole history.
    """
    breach = F.coalesce(F.col("value") >= threshold if at_least else F.col("value") > threshold, F.lit(False))
    step = None if seconds is None else seconds * 1_000_000
    found = streaks(periods.withColumn("breach", breach), F.col("breach"), "period", by, step, name="_streak")
    return found.withColumn("alarm", F.col("_streak") >= consecutive).drop("_streak")


# Alarms of a load job. Statistic, threshold, whether reaching it is enough,
# and how many periods of five minutes in a row.
JOB_ALARMS = {
    "failed_tasks": ("sum", 1, True, 1),
    "heap_usage": ("avg", 0.85, False, 2),
    "elapsed_ms": ("max", 3_600_000, False, 1),
}
PERIOD_SECONDS = 300


def job_alarms(points: DataFrame, ts: str = "ts") -> DataFrame:
    """Alarm state per metric and period from raw data points (metric, ts, value)."""
    parts = []
    for metric, (statistic, threshold, at_least, consecutive) in JOB_ALARMS.items():
        of_metric = points.filter(F.col("metric") == metric)
        periods = metric_periods(of_metric, ts, f"{PERIOD_SECONDS} seconds", getattr(F, statistic)("value"), ["metric"])
        parts.append(alarms(periods, threshold, consecutive, ["metric"], at_least, PERIOD_SECONDS))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def trend(periods: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each period against the average of all earlier ones: change in percent and a verdict.

    Expects one row per group and period, as `metric_periods` makes them.
    """
    return (
        earlier_averages(periods, {"baseline": "value"}, "period", by)
        .withColumn("change_percent", F.coalesce(percent_change(F.col("value"), F.col("baseline")), F.lit(0.0)))
        .withColumn(
            "verdict",
            F.when(F.col("change_percent") < -5, "improving")
            .when(F.col("change_percent") > 5, "degrading")
            .otherwise("stable"),
        )
    )


def baseline_alerts(periods: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Alerts against the earlier average: time over twice, throughput under half, errors over 1 %."""
    return (
        earlier_averages(periods, {"_seconds": "seconds", "_throughput": "throughput"}, "period", by)
        .withColumn("slow", F.coalesce(F.col("seconds") > 2 * F.col("_seconds"), F.lit(False)))
        .withColumn("low_throughput", F.coalesce(F.col("throughput") < 0.5 * F.col("_throughput"), F.lit(False)))
        .drop("_seconds", "_throughput")
        .withColumn("many_errors", F.col("error_rate") > 0.01)
    )
