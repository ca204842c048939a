"""Log search, error classes, run summaries, alarms and trends over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import pick, query, sql_pick, table
from tablesync.functions import text
from tablesync.operators import runlog
from tablesync.session import workspace
from tablesync.sources.logs import read_log
from tablesync.streaming.batches import tier_of

MESSAGES = [
    "Connection refused by host", "ORA-01017: invalid username or password", "Access denied for user",
    "connection timed out after 30 s", "Socket timeout", "Network is unreachable", "duplicate key value",
    "Column not found: x", "permission denied for relation", "Not authorized to read", "java.lang: Out Of Memory",
    "too many connections", "query timeout", "operation timed out", "something else", "Parsing error near line 3",
    "forbidden", "Table does not exist", "connection timeout", "Disk full", None,
]
CATEGORIES = [
    "connection", "authentication", "authentication", "connection", "network", "network", "data_processing",
    "schema_mismatch", "permission", "permission", "resource", "resource", "timeout", "timeout", "unknown",
    "data_processing", "permission", "schema_mismatch", "network", "resource", "unknown",
]
CLASS_RULES = """
    ('connection', true, 'retry_with_backoff', false), ('authentication', false, 'fail_immediately', true),
    ('network', true, 'retry_with_backoff', false), ('data_processing', false, 'log_and_continue', false),
    ('schema_mismatch', false, 'fail_immediately', true), ('permission', false, 'fail_immediately', true),
    ('resource', true, 'retry_with_longer_delay', false), ('timeout', true, 'retry_with_backoff', false),
    ('unknown', false, 'retry_with_backoff', false)
"""
N = len(MESSAGES)
KEY = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def events_with_key(spark, sf):
    """Events with the number inside `props`."""
    return table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def messages(spark, sf):
    m = pick(MESSAGES, F.col("event_id") % N)
    return table(spark, sf, "events").select(
        "event_id", "ts", "event_type", F.concat(F.lit("task "), F.col("event_id").cast("string"), F.lit(": "), m).alias("message")
    )


CLASSIFIED = f"""
    classified AS (
      SELECT event_id, ts, event_type, category, retryable, recovery, critical
      FROM (SELECT *, {sql_pick(CATEGORIES, f'event_id % {N}')} AS category FROM events)
      JOIN (VALUES {CLASS_RULES}) AS r(category, retryable, recovery, critical) USING (category)
    )"""


@query("error_classes", f"WITH {CLASSIFIED} SELECT event_id, category, retryable, recovery, critical FROM classified")
def error_classes(spark, sf):
    """A message per event, classified by the first word list it hits."""
    return runlog.classify_errors(messages(spark, sf)).select("event_id", "category", "retryable", "recovery", "critical")


@query(
    "error_summary",
    f"WITH {CLASSIFIED} SELECT category, count(*) AS errors, count(*) FILTER (critical) AS critical_errors FROM classified GROUP BY 1",
)
def error_summary(spark, sf):
    return runlog.error_summary(runlog.classify_errors(messages(spark, sf)))


@query(
    "latest_errors",
    f"WITH {CLASSIFIED} SELECT event_id, category FROM classified WHERE critical ORDER BY ts DESC, event_id DESC LIMIT 5",
)
def latest_errors(spark, sf):
    """The five newest critical errors."""
    found = runlog.classify_errors(messages(spark, sf)).filter("critical")
    return runlog.latest_errors(found, ["ts", "event_id"]).select("event_id", "category")


@query(
    "operation_metrics",
    """
    SELECT user_id AS operation, count(*) AS attempts, count(*) FILTER (event_type <> 'error') AS successes,
      count(*) FILTER (event_type = 'error') AS failures,
      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) // count(*) AS average_cents,
      arg_max(event_id, ts) FILTER (event_type = 'error') AS last_error
    FROM events GROUP BY user_id
    """,
)
def operation_metrics(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("operation"), "ts", (F.col("event_type") != "error").alias("ok"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration"), F.col("event_id").alias("message"),
    )
    return runlog.operation_metrics(rows).select(
        "operation", "attempts", "successes", "failures",
        F.floor("average_duration").alias("average_cents"), "last_error",
    )


# --------------------------------------------------------------------------
# run logs


def job_log(spark, sf):
    """A run-log row per event: job = user, rows = k, seconds = k % 7 + 1."""
    k = F.col("k")
    return events_with_key(spark, sf).select(
        F.concat(F.lit("job"), "user_id").alias("job_name"),
        F.when(F.col("event_type") == "error", "failed").when(k % 5 == 0, "skipped").otherwise("completed").alias("status"),
        F.when(F.col("event_type") == "view", "full").otherwise("incremental").alias("mode"),
        k.alias("rows"), (k + F.when(F.col("event_type") == "click", 10).otherwise(0)).alias("total_rows"),
        (k * 1_000_000).alias("bytes"), (k % 7).alias("seconds"), "event_id", "ts",
    )


LOG_SQL = f"""
    log AS (
      SELECT 'job' || user_id AS job_name, if(event_type = 'error', 'failed', if({KEY} % 5 = 0, 'skipped', 'completed')) AS status,
        if(event_type = 'view', 'full', 'incremental') AS mode, {KEY} AS rows,
        {KEY} + if(event_type = 'click', 10, 0) AS total_rows, {KEY} * 1000000 AS bytes, {KEY} % 7 AS seconds, event_id, ts
      FROM events
    )"""


@query(
    "job_summary",
    f"""
    WITH {LOG_SQL}, s AS (
      SELECT job_name, count(*) AS tables, count(*) FILTER (status <> 'failed') AS succeeded,
        count(*) FILTER (status = 'failed') AS failed,
        CAST(coalesce(sum(rows) FILTER (status = 'completed'), 0) AS BIGINT) AS rows,
        CAST(coalesce(sum(bytes) FILTER (status = 'completed'), 0) AS BIGINT) AS bytes, CAST(sum(seconds) AS BIGINT) AS seconds
      FROM log GROUP BY 1
    )
    SELECT *, CASE WHEN tables > 0 THEN round(succeeded * 100 / tables, 2) ELSE 0 END AS success_percent,
      CASE WHEN seconds > 0 THEN round(rows / seconds, 2) ELSE 0 END AS rows_per_second FROM s
    """,
)
def job_summary(spark, sf):
    return runlog.job_summary(job_log(spark, sf))


@query(
    "table_rates",
    f"""
    WITH {LOG_SQL}
    SELECT event_id, CASE WHEN seconds > 0 THEN round(rows / seconds, 2) ELSE 0 END AS rows_per_second,
      CASE WHEN seconds > 0 THEN round(bytes / 1048576 / seconds, 2) ELSE 0 END AS mb_per_second,
      CASE WHEN total_rows = 0 THEN if(mode <> 'full' AND status = 'completed', 100, 0)
           ELSE round(rows * 100 / total_rows, 2) END AS progress_percent
    FROM log
    """,
)
def table_rates(spark, sf):
    return runlog.table_rates(job_log(spark, sf)).select("event_id", "rows_per_second", "mb_per_second", "progress_percent")


@query(
    "storage_summary",
    f"""
    WITH s AS (
      SELECT event_type AS operation, count(*) AS operations, count(*) FILTER ({KEY} % 10 <> 0) AS succeeded,
        CAST(sum({KEY}) AS BIGINT) AS total_ms, CAST(sum({KEY} * 1024) AS BIGINT) AS bytes FROM events GROUP BY 1
    )
    SELECT *, round(succeeded * 100 / operations, 2) AS success_percent, round(total_ms / operations, 2) AS average_ms,
      round(bytes / 1048576 / (total_ms / 1000), 2) AS mb_per_second, round(operations / (total_ms / 1000), 2) AS operations_per_second
    FROM s
    """,
)
def storage_summary(spark, sf):
    rows = events_with_key(spark, sf).select(
        F.col("event_type").alias("operation"), (F.col("k") % 10 != 0).alias("ok"),
        F.col("k").alias("duration_ms"), (F.col("k") * 1024).alias("bytes"),
    )
    return runlog.storage_summary(rows)


@query(
    "connection_summary",
    f"""
    SELECT if(user_id % 2 = 0, 'source', 'target') AS side, event_type AS engine, count(*) AS attempts,
      count(*) FILTER ({KEY} <> 0) AS succeeded, CAST(sum({KEY}) AS BIGINT) AS seconds, sum({KEY}) / count(*) AS average_seconds
    FROM events GROUP BY 1, 2
    """,
)
def connection_summary(spark, sf):
    rows = events_with_key(spark, sf).select(
        F.when(F.col("user_id") % 2 == 0, "source").otherwise("target").alias("side"),
        F.col("event_type").alias("engine"), (F.col("k") != 0).alias("ok"), F.col("k").alias("seconds"),
    )
    return runlog.connection_summary(rows)


@query(
    "load_tiers",
    f"""
    SELECT 'job' || user_id AS job_name, CASE WHEN sum({KEY}) < 3000 THEN 'direct' WHEN sum({KEY}) <= 3500 THEN 'staging' ELSE 'batches' END AS tier
    FROM events GROUP BY 1
    """,
)
def load_tiers(spark, sf):
    """The way each job's rows would be loaded, with small thresholds."""
    rows = job_log(spark, sf).groupBy("job_name").agg(F.sum("rows").alias("n"))
    return rows.select("job_name", tier_of(F.col("n"), 3000, 3500).alias("tier"))


# --------------------------------------------------------------------------
# log lines


def lines(spark, sf):
    """A log line per event, in the form the toolkit logs."""
    e = events_with_key(spark, sf)
    message = F.concat(
        pick(["Starting load", "processed", "Completed load", "ERROR in load", "Failed: Exception"], F.col("event_id") % 5),
        F.when(F.col("event_id") % 5 == 1, F.concat(F.lit(" "), F.col("k").cast("string"), F.lit(" records"))).otherwise(F.lit("")),
    )
    fields = {"job_name": F.concat(F.lit("job"), "user_id"), "event_id": F.col("event_id"), "rows": F.col("k"),
              "note": F.when(F.col("event_type") == "click", "a=b")}
    return e.select("event_id", "ts", "k", runlog.format_line(message, fields).alias("line"))


MESSAGE_SQL = f"""
    {sql_pick(["Starting load", "processed", "Completed load", "ERROR in load", "Failed: Exception"], 'event_id % 5')}
    || CASE WHEN event_id % 5 = 1 THEN ' ' || {KEY} || ' records' ELSE '' END
"""


@query(
    "log_lines",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, {MESSAGE_SQL} AS message, 'job' || user_id AS job_name,
      CAST({KEY} AS VARCHAR) AS rows, if(event_type = 'click', 'a=b', 'None') AS note FROM events
    """,
)
def log_lines(spark, sf):
    """Log lines written as text, read back and split into their fields."""
    path = workspace(spark, "logs")
    lines(spark, sf).select("line").write.text(path)
    field = lambda k: F.col("fields")[k].alias(k)
    return read_log(spark, path).select(field("event_id"), "message", field("job_name"), field("rows"), field("note"))


@query(
    "log_search",
    """
    SELECT event_id, event_id % 5 IN (3, 4) AS has_any, event_id % 5 = 4 AS has_all FROM events
    """,
)
def log_search(spark, sf):
    """Any of several words, and all of several words, in every line."""
    return lines(spark, sf).select(
        "event_id", runlog.has_any(F.col("line"), ["ERROR", "Exception", "Failed"]).alias("has_any"),
        runlog.has_all(F.col("line"), ["Failed", "Exception"]).alias("has_all"),
    )


@query(
    "log_topk",
    "SELECT event_id, ts FROM events WHERE event_id % 5 IN (3, 4) ORDER BY ts DESC, event_id DESC LIMIT 100",
)
def log_topk(spark, sf):
    """The newest hundred error lines."""
    found = lines(spark, sf).filter(runlog.has_any(F.col("line"), ["ERROR", "Exception", "Failed"]))
    return runlog.newest(found, ["ts", "event_id"], 100).select("event_id", "ts")


@query(
    "log_bins",
    "SELECT time_bucket(INTERVAL '5 minutes', ts) AS bin, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def log_bins(spark, sf):
    return runlog.per_bin(table(spark, sf, "events"), "ts", "5 minutes", by=["event_type"])


@query(
    "log_volume",
    f"""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS bin, count(*) AS n,
      CAST(sum(CASE WHEN event_id % 5 = 1 THEN {KEY} END) AS BIGINT) AS records FROM events GROUP BY 1
    """,
)
def log_volume(spark, sf):
    """Numbers taken out of the lines, added up per hour."""
    number = runlog.number_between(F.col("line"), "processed", "records")
    return runlog.per_bin(lines(spark, sf), "ts", "1 hour", F.sum(number).alias("records"))


# --------------------------------------------------------------------------
# metrics over time


@query(
    "alarm_consecutive",
    """
    WITH p AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS period, event_type, CAST(count(*) AS BIGINT) AS value FROM events GROUP BY 1, 2
    )
    SELECT period, event_type, value, value > 3 AS breach,
      min(CASE WHEN value > 3 THEN 1 ELSE 0 END) OVER w = 1 AND count(*) OVER w = 2 AS alarm
    FROM p WINDOW w AS (PARTITION BY event_type ORDER BY period ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
    """,
)
def alarm_consecutive(spark, sf):
    """More than three events of a type in two periods running."""
    periods = runlog.metric_periods(table(spark, sf, "events"), "ts", "1 hour", F.count(F.lit(1)), ["event_type"])
    return runlog.alarms(periods, 3, 2, ["event_type"])


@query(
    "job_alarms",
    f"""
    WITH points AS (
      SELECT ts, CASE event_type WHEN 'error' THEN 'failed_tasks' WHEN 'click' THEN 'heap_usage' ELSE 'elapsed_ms' END AS metric,
        CASE event_type WHEN 'error' THEN {KEY} % 2 WHEN 'click' THEN CASE WHEN {KEY} < 25 THEN 0.5 ELSE 0.9375 END ELSE {KEY} * 50000 END AS value
      FROM events
    ), p AS (
      SELECT time_bucket(INTERVAL '5 minutes', ts) AS period, metric, CASE metric WHEN 'failed_tasks' THEN sum(value) >= 1
        WHEN 'heap_usage' THEN avg(value) > 0.85 ELSE max(value) > 3600000 END AS breach FROM points GROUP BY 1, 2
    )
    SELECT p.period, p.metric, p.breach, p.breach AND (p.metric <> 'heap_usage' OR coalesce(q.breach, false)) AS alarm
    FROM p LEFT JOIN p q ON q.metric = p.metric AND q.period = p.period - INTERVAL 5 MINUTE
    """,
)
def job_alarms(spark, sf):
    """The three alarms of a load job; a period without data breaks a row of breaches.

    Heap values are binary fractions, so that sums are exact and an average equal to the
    threshold is equal in every engine.
    """
    k, kind = F.col("k"), F.col("event_type")
    points = events_with_key(spark, sf).select(
        "ts",
        F.when(kind == "error", "failed_tasks").when(kind == "click", "heap_usage").otherwise("elapsed_ms").alias("metric"),
        F.when(kind == "error", k % 2).when(kind == "click", F.when(k < 25, 0.5).otherwise(0.9375)).otherwise(k * 50_000).cast("double").alias("value"),
    )
    return runlog.job_alarms(points).select("period", "metric", "breach", "alarm")


@query(
    "trend",
    """
    WITH p AS (
      SELECT time_bucket(INTERVAL '1 day', ts) AS period, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value
      FROM events GROUP BY 1, 2
    ), b AS (
      SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline FROM p
    ), c AS (SELECT *, CASE WHEN baseline > 0 THEN (value - baseline) / baseline * 100 ELSE 0 END AS change FROM b)
    SELECT period, event_type, value, CASE WHEN change < -5 THEN 'improving' WHEN change > 5 THEN 'degrading' ELSE 'stable' END AS verdict
    FROM c
    """,
)
def trend(spark, sf):
    """Each day's value against the average of all days before it."""
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    periods = runlog.metric_periods(table(spark, sf, "events"), "ts", "1 day", cents, ["event_type"])
    return runlog.trend(periods, ["event_type"]).select("period", "event_type", "value", "verdict")


@query(
    "baseline_alerts",
    f"""
    WITH p AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS period, CAST(sum({KEY}) AS BIGINT) AS seconds, count(*) AS throughput,
        count(*) FILTER (event_type = 'error') / count(*) AS error_rate FROM events GROUP BY 1
    )
    SELECT period, coalesce(seconds > 2 * avg(seconds) OVER w, false) AS slow,
      coalesce(throughput < 0.5 * avg(throughput) OVER w, false) AS low_throughput, error_rate > 0.01 AS many_errors
    FROM p WINDOW w AS (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """,
)
def baseline_alerts(spark, sf):
    """Hours slower than twice, or with less than half of, what was usual before."""
    error_share = F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))
    periods = (
        events_with_key(spark, sf).groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.sum("k").alias("seconds"), F.count(F.lit(1)).alias("throughput"), error_share.alias("error_rate"))
        .withColumn("period", F.col("w.start"))
    )
    return runlog.baseline_alerts(periods).select("period", "slow", "low_throughput", "many_errors")


# --------------------------------------------------------------------------
# text


@query(
    "redact_credentials",
    r"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(
      text || ' user=x;Password=p' || doc_id || ';PWD=''q r''; jdbc:db://me:secret@host/' || source || ' see http://a/b: write to c@d',
      '\bpassword=("[^"]*"|''[^'']*''|[^\s;&"'']+)', 'password=***', 'gi'), '\bpwd=("[^"]*"|''[^'']*''|[^\s;&"'']+)', 'pwd=***', 'gi'),
      '://[^\s/:@]+:[^\s/@]+@', '://***:***@', 'g')) AS redacted,
      TRUE AS hidden, TRUE AS prose_kept
    FROM documents
    """,
)
def redact_credentials(spark, sf):
    """Whole document texts, each followed by a connection text and by prose with an address."""
    documents = table(spark, sf, "documents")
    prose = F.lit(" see http://a/b: write to c@d")
    tail = F.concat(F.lit(" user=x;Password=p"), "doc_id", F.lit(";PWD='q r'; jdbc:db://me:secret@host/"), "source", prose)
    found = documents.select("doc_id", text.redact(F.concat("text", tail)).alias("t"))
    return found.select(
        "doc_id", F.md5("t").alias("redacted"), (~F.col("t").contains("secret") & ~F.col("t").contains("q r")).alias("hidden"),
        F.col("t").endswith(prose).alias("prose_kept"))


@query(
    "key_parts",
    r"""
    SELECT page_id, 'bookmarks/' || trim(regexp_replace(regexp_replace(trim(url), '[^a-zA-Z0-9._-]', '-', 'g'), '-+', '-', 'g'), '-')
      || '/' || page_id || '.json' AS key FROM pages
    """,
)
def key_parts(spark, sf):
    """Store keys from page addresses as job names."""
    return table(spark, sf, "pages").select("page_id", text.bookmark_key(F.col("url"), F.col("page_id").cast("string")).alias("key"))


@query(
    "pick_bucket",
    r"""
    WITH b AS (
      SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, page_id % 4 AS v FROM pages
    ), n AS (
      SELECT page_id, CASE v WHEN 0 THEN host WHEN 1 THEN 'Bad_' || host WHEN 2 THEN NULL ELSE host END AS s,
        CASE v WHEN 3 THEN '-x' ELSE 'target.' || host END AS t FROM b
    )
    SELECT page_id, coalesce(CASE WHEN regexp_full_match(s, '[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]') THEN s END,
                             CASE WHEN regexp_full_match(t, '[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]') THEN t END) AS bucket FROM n
    """,
)
def pick_bucket(spark, sf):
    """Bucket of the source path, else of the target path, with hosts as bucket names."""
    host, v = F.regexp_extract("url", "^https?://([^/]+)", 1), F.col("page_id") % 4
    source = F.when(v == 1, F.concat(F.lit("s3://Bad_"), host, F.lit("/x.jar"))).when(v == 2, F.lit("/local/x.jar")).otherwise(
        F.concat(F.lit("s3://"), host, F.lit("/drivers/x.jar")))
    target = F.when(v == 3, F.lit("s3://-x/y.jar")).otherwise(F.concat(F.lit("s3://target."), host, F.lit("/y.jar")))
    return table(spark, sf, "pages").select("page_id", text.pick_bucket(source, target).alias("bucket"))


@query(
    "parse_iso",
    """
    SELECT event_id, CASE event_id % 6 WHEN 3 THEN ts - INTERVAL 2 HOUR WHEN 4 THEN date_trunc('day', ts)
      WHEN 5 THEN NULL ELSE ts END AS instant FROM events
    """,
)
def parse_iso(spark, sf):
    """ISO texts with Z, an offset, none, a date alone, or rubbish."""
    e, ts = F.col("event_id") % 6, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    shown = (
        F.when(e == 0, F.concat(ts, F.lit("Z"))).when(e == 1, F.concat(ts, F.lit("+00:00"))).when(e == 2, ts)
        .when(e == 3, F.concat(ts, F.lit("+02:00"))).when(e == 4, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.lit("2024-13-45"))
    )
    return table(spark, sf, "events").select("event_id", F.to_utc_timestamp(text.parse_iso(shown), F.current_timezone()).cast("timestamp_ntz").alias("instant"))
