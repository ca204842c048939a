"""Strategy detection, overrides and type rules over catalogs derived from event rows.

Every event stands for a declared column, so the catalogs grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.base import TABLES, pick, query, sql_pick, table
from tablesync.functions import types as names
from tablesync.operators import bookmarks, detect, profile
from tablesync.operators.catalog import catalog
from tablesync.sources import endpoints
from tablesync.sources.files import Files

COLUMN_NAMES = [
    "id", "user_id", "name", "created_at", "updated_on", "modified_date", "amount", "order_key",
    "seq", "ts", "last_change", "paid_at", "customer_pk", "flag", "event_date", "Updated_At",
    "valid_from", "row_id", "note", "load_time",
]
SPARK_TYPES = ["bigint", "string", "timestamp", "int", "date", "timestamp_ntz", "double"]
DATABASE_TYPES = ["BIGINT", "VARCHAR", "TIMESTAMP", "INTEGER", "DATE", "datetime2", "NUMBER", "SERIAL"]


def declared(spark, sf, types=SPARK_TYPES):
    """A catalog: one table per user and day, one column per distinct name among its events."""
    events = table(spark, sf, "events")
    e = F.col("event_id")
    rows = events.select(
        F.concat(F.lit("t"), "user_id", F.lit("_"), F.date_format("ts", "MMdd")).alias("table_name"),
        pick(COLUMN_NAMES, e % 20).alias("column_name"),
        F.struct(
            e.alias("event_id"),
            pick(types, (F.floor(e / 3) + F.col("user_id")) % len(types)).alias("type"),
            "event_type",
        ).alias("first"),
    )
    position = Window.partitionBy("table_name").orderBy("first.event_id")
    return (
        rows.groupBy("table_name", "column_name").agg(F.min("first").alias("first"))
        .withColumn("ordinal", (F.row_number().over(position) - 1).cast("int"))
        .select(
            "table_name", "ordinal", "column_name", "first.type", F.lit(True).alias("nullable"),
            (F.col("first.event_id") % 11 == 0).alias("is_pk"), "first.event_id", "first.event_type",
        )
    )


def declared_sql(types=SPARK_TYPES) -> str:
    index = f"(event_id // 3 + user_id) % {len(types)}"
    return f"""
    named AS (
      SELECT 't' || user_id || '_' || strftime(ts, '%m%d') AS table_name, event_id, event_type,
             {sql_pick(COLUMN_NAMES, 'event_id % 20')} AS column_name, {sql_pick(types, index)} AS type
      FROM events
    ), first_named AS (
      SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY event_id) AS n FROM named
    ), declared AS (
      SELECT table_name, column_name, lower(column_name) AS lname, type, event_id, event_type,
             event_id % 11 = 0 AS is_pk,
             row_number() OVER (PARTITION BY table_name ORDER BY event_id) - 1 AS ordinal
      FROM first_named WHERE n = 1
    )"""


TIME_WORDS = (
    "updated_at|modified_at|last_modified|last_updated|created_at|insert_date|update_date|modified_date"
    "|timestamp|last_change|change_date|mod_time"
)
KEY_WORDS = "id|pk|primary_key|key|seq|sequence|row_id|record_id|unique_id"


def score_sql(times: str) -> str:
    return f"""
    scored AS (
      SELECT *, type IN ({times}) AS is_time,
        CASE WHEN type IN ({times})
          THEN 5 + 3 * regexp_matches(lname, '{TIME_WORDS}')::INT + 2 * regexp_matches(lname, 'updated|modified')::INT
          ELSE 3 + 4 * regexp_matches(lname, '(^|_)({KEY_WORDS})$')::INT + 2 * regexp_matches(lname, '(^|_)id$')::INT
        END AS score
      FROM declared WHERE type IN ({times}, 'int', 'bigint')
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY score DESC, is_time DESC, ordinal) AS n FROM scored
    )
    SELECT t.table_name, CASE WHEN r.table_name IS NULL THEN 'hash' WHEN r.is_time THEN 'timestamp' ELSE 'primary_key' END AS strategy,
           r.lname AS "column", CAST(coalesce(r.score, 0) AS INT) AS confidence_tenths
    FROM (SELECT DISTINCT table_name FROM declared) t LEFT JOIN ranked r ON r.table_name = t.table_name AND r.n = 1
    """


@query("detect_declared", f"WITH {declared_sql()}, {score_sql(chr(39) + 'timestamp' + chr(39) + ',' + chr(39) + 'date' + chr(39) + ',' + chr(39) + 'timestamp_ntz' + chr(39))}")
def detect_declared(spark, sf):
    return detect.detect_strategies(declared(spark, sf))


@query("detect_declared_strict", f"WITH {declared_sql()}, {score_sql(chr(39) + 'timestamp' + chr(39) + ',' + chr(39) + 'date' + chr(39))}")
def detect_declared_strict(spark, sf):
    """A timestamp without a zone does not count as a time."""
    return detect.detect_strategies(declared(spark, sf), strict=True)


DETECTED = {
    "region": ("primary_key", "r_regionkey", 3), "nation": ("primary_key", "n_nationkey", 3),
    "customer": ("primary_key", "c_custkey", 3), "supplier": ("primary_key", "s_suppkey", 3),
    "part": ("primary_key", "p_partkey", 3), "orders": ("timestamp", "o_orderdate", 5),
    "lineitem": ("timestamp", "l_shipdate", 5), "events": ("primary_key", "event_id", 9),
    "documents": ("primary_key", "doc_id", 9), "embeddings": ("primary_key", "vec_id", 9),
    "pages": ("primary_key", "page_id", 9), "benchmark": ("primary_key", "item_id", 9),
    "labels": ("primary_key", "doc_id", 9), "conversations": ("primary_key", "conv_id", 9),
}


def _detected_sql(t: str) -> str:
    strategy, column, score = DETECTED[t]
    usable = f"count({column})" if strategy == "timestamp" else f"count(DISTINCT {column})"
    return (
        f"SELECT '{t}' AS table_name, '{strategy}' AS strategy, '{column}' AS \"column\", {score} AS confidence_tenths,"
        f" count(*) AS total, {usable} AS usable, {usable} * 100 >= count(*) * 95 AS is_valid FROM {t}"
    )


@query("detect_strategy", " UNION ALL ".join(_detected_sql(t) for t in TABLES))
def detect_strategy(spark, sf):
    """All given tables: the detected column, and whether its values are fit for tracking."""
    source = Files(sf)
    frames = {t: endpoints.scan(spark, source, t) for t in TABLES}
    found = detect.detect_strategies(catalog(spark, {t: df.schema for t, df in frames.items()}))
    parts = []
    for row in found.collect():  # one row per table
        column = {row["strategy"] + "s": [row["column"]]}
        candidates = {"timestamps": column.get("timestamps", ()), "keys": column.get("primary_keys", ())}
        shown = profile.profile_columns(frames[row["table_name"]], **candidates)
        parts.append(shown.select(F.lit(row["table_name"]).alias("table_name"), "total", "usable", "is_valid"))
    profiles = parts[0]
    for part in parts[1:]:
        profiles = profiles.unionByName(part)
    return found.join(profiles, "table_name")


METADATA_SQL = f"""
    leveled AS (
      SELECT *,
        CASE WHEN regexp_matches(upper(type), 'TIMESTAMP|DATE|TIME') AND regexp_matches(lname, '{TIME_WORDS}|date|time') THEN 1
             WHEN is_pk THEN 2
             WHEN regexp_matches(upper(type), 'INT|SERIAL') AND regexp_matches(lname, '(^|_)({KEY_WORDS})$') THEN 3
        END AS level,
        CASE WHEN lname LIKE '%updated_at%' THEN 0 WHEN lname LIKE '%last_updated%' THEN 1
             WHEN lname LIKE '%modified_at%' THEN 2 WHEN lname LIKE '%last_modified%' THEN 3
             WHEN lname LIKE '%update_date%' THEN 4 WHEN lname LIKE '%modified_date%' THEN 5
             WHEN lname LIKE '%last_change%' THEN 6 WHEN lname LIKE '%change_date%' THEN 7 ELSE 99 END AS time_rank,
        CASE WHEN lname = 'id' THEN 0 WHEN lname = 'pk' THEN 1 WHEN lname = 'primary_key' THEN 2 WHEN lname = 'key' THEN 3
             WHEN ends_with(lname, '_id') THEN 4 WHEN ends_with(lname, '_pk') THEN 5
             WHEN ends_with(lname, '_primary_key') THEN 6 WHEN ends_with(lname, '_key') THEN 7 ELSE 99 END AS key_rank
      FROM declared
    ), best AS (
      SELECT *, row_number() OVER (
        PARTITION BY table_name ORDER BY level, CASE WHEN level = 1 THEN time_rank ELSE key_rank END, ordinal) AS n
      FROM leveled WHERE level IS NOT NULL
    ), detected AS (
      SELECT t.table_name, CASE WHEN b.level = 1 THEN 'timestamp' WHEN b.level IS NOT NULL THEN 'primary_key' ELSE 'hash' END AS strategy,
             b.lname AS "column"
      FROM (SELECT DISTINCT table_name FROM declared) t LEFT JOIN best b ON b.table_name = t.table_name AND b.n = 1
    )"""


@query("detect_from_metadata", f"WITH {declared_sql(DATABASE_TYPES)}, {METADATA_SQL} SELECT * FROM detected")
def detect_from_metadata(spark, sf):
    return detect.detect_from_metadata(declared(spark, sf, DATABASE_TYPES))


def manual_rows(columns):
    """The newest column of a table decides: purchase names it, signup names one that is not there."""
    newest = columns.groupBy("table_name").agg(
        F.max_by(F.struct("event_type", "column_name"), "event_id").alias("n")
    )
    return newest.filter("n.event_type in ('purchase', 'signup')").select(
        "table_name",
        F.when(F.col("n.event_type") == "purchase", F.upper("n.column_name")).otherwise("no_such_column").alias("column_name"),
    )


RESOLVED_SQL = f"""
    {METADATA_SQL}, newest AS (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY event_id DESC) AS r FROM declared
    ), manual AS (
      SELECT table_name, column_name AS manual_column, CASE
          WHEN regexp_matches(upper(type), 'TIMESTAMP|DATE|TIME') THEN 'timestamp'
          WHEN upper(type) = 'NUMBER' THEN 'hash'
          WHEN regexp_matches(upper(type), 'INT|SERIAL') THEN 'primary_key' ELSE 'hash' END AS manual_strategy
      FROM newest WHERE r = 1 AND event_type = 'purchase'
    ), resolved AS (
      SELECT d.table_name, coalesce(manual_strategy, strategy) AS strategy, coalesce(manual_column, "column") AS "column",
             manual_column IS NOT NULL AS is_manual
      FROM detected d LEFT JOIN manual USING (table_name)
    )"""


@query("resolve_strategy", f"WITH {declared_sql(DATABASE_TYPES)}, {RESOLVED_SQL} SELECT * FROM resolved")
def resolve_strategy(spark, sf):
    columns = declared(spark, sf, DATABASE_TYPES)
    return detect.resolve(columns, manual_rows(columns))


@query(
    "detection_summary",
    f"""
    WITH {declared_sql(DATABASE_TYPES)}, {RESOLVED_SQL}
    SELECT count(*) AS tables, count(*) FILTER (is_manual) AS manual, count(*) FILTER (NOT is_manual) AS automatic,
           count(*) FILTER (strategy = 'timestamp') AS timestamp, count(*) FILTER (strategy = 'primary_key') AS primary_key,
           count(*) FILTER (strategy = 'hash') AS hash,
           round(count(*) FILTER (is_manual) * 100 / count(*), 2) AS manual_percent,
           round(count(*) FILTER (NOT is_manual) * 100 / count(*), 2) AS automatic_percent
    FROM resolved
    """,
)
def detection_summary(spark, sf):
    columns = declared(spark, sf, DATABASE_TYPES)
    return detect.detection_summary(detect.resolve(columns, manual_rows(columns)))


@query(
    "manual_override",
    f"""
    WITH {declared_sql()}, detected AS ({'WITH ' + score_sql("'timestamp','date','timestamp_ntz'").strip()}),
    newest AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY event_id DESC) AS r FROM declared)
    SELECT d.table_name, d.strategy, d.confidence_tenths,
           CASE WHEN n.event_type = 'purchase' THEN upper(n.column_name) WHEN n.event_type = 'signup' THEN 'no_such_column'
                ELSE d."column" END AS "column",
           n.event_type IN ('purchase', 'signup') AS is_manual
    FROM detected d JOIN newest n ON n.table_name = d.table_name AND n.r = 1
    """,
)
def manual_override(spark, sf):
    """The manual column per table over the detected one, unchecked."""
    columns = declared(spark, sf)
    return bookmarks.with_override(detect.detect_strategies(columns), manual_rows(columns))


@query(
    "lake_fallback",
    f"""
    WITH {declared_sql()}, leveled AS (
      SELECT *,
        list_position(list_transform(
          ['updated_at','update_time','last_updated','modified_at','mod_time','created_at','create_time','insert_time',
           'timestamp','last_modified','updated_date','modified_date','created_date','date_updated','date_modified'],
          lambda w: contains(lname, w)), true) AS time_rank,
        list_position(list_transform(
          ['id','primary_key','pk','key','row_id','record_id','sequence_id','seq_id','auto_id','identity'],
          lambda w: lname = w OR ends_with(lname, '_' || w)), true) AS key_rank
      FROM declared
    ), placed AS (
      SELECT *, CASE WHEN type IN ('timestamp','timestamp_ntz','date') AND coalesce(time_rank, 0) > 0 THEN 1
                     WHEN type IN ('int','bigint') AND coalesce(key_rank, 0) > 0 THEN 2
                     WHEN type IN ('timestamp','timestamp_ntz') THEN 3
                     WHEN type IN ('int','bigint') THEN 4 END AS level FROM leveled
    ), best AS (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY level,
        CASE level WHEN 1 THEN time_rank WHEN 2 THEN key_rank ELSE 0 END, ordinal) AS n
      FROM placed WHERE level IS NOT NULL
    )
    SELECT t.table_name, b.column_name AS "column", CAST(b.level AS INT) AS level
    FROM (SELECT DISTINCT table_name FROM declared) t LEFT JOIN best b ON b.table_name = t.table_name AND n = 1
    """,
)
def lake_fallback(spark, sf):
    return detect.lake_fallback(declared(spark, sf))


@query(
    "identifier_column",
    f"""
    WITH {declared_sql()}, ids AS (
      SELECT table_name, CAST(max(event_id) % 5 + 1 AS INT) AS id FROM declared GROUP BY 1
    )
    SELECT i.table_name, i.id, d.column_name AS "column"
    FROM ids i LEFT JOIN declared d ON d.table_name = i.table_name AND d.ordinal + 1 = i.id
    """,
)
def identifier_column(spark, sf):
    """First number of an id list to the column at that place."""
    columns = declared(spark, sf)
    text = F.concat(F.lit("x, "), (F.max("event_id") % 5 + 1).cast("string"), F.lit(" ,2,1"))
    return detect.identifier_columns(
        columns.groupBy("table_name").agg(text.alias("identifier_field_ids")), columns
    )


MANUAL_TEXTS = [
    '{"T": "updated_at"}',
    '{"T": {"table_name": "T", "column_name": "ts"}}',
    "",
    "not json",
    "null",
    "[1, 2]",
    "{}",
    '{"T": 5}',
    '{"9T": "id"}',
    '{"T": "bad-name"}',
    '{"a": {"table_name": "T", "column_name": "id"}, "b": {"table_name": "T", "column_name": "ts"}}',
    ' {"T": " padded "} ',
    '{"T": {"column_name": "id"}}',
]
MANUAL_EXPECTED = """
    (0, 'T', 'T', 'updated_at', NULL), (1, 'T', 'T', 'ts', NULL), (2, NULL, NULL, NULL, 'empty'),
    (3, NULL, NULL, NULL, 'not_json'), (4, NULL, NULL, NULL, 'null'), (5, NULL, NULL, NULL, 'not_an_object'),
    (6, NULL, NULL, NULL, 'no_entries'), (7, 'T', NULL, NULL, 'value_not_text_or_object'),
    (8, '9T', '9T', 'id', 'table_name_invalid'), (9, 'T', 'T', 'bad-name', 'column_name_invalid'),
    (10, 'a', 'T', 'id', 'table_repeated'), (10, 'b', 'T', 'ts', 'table_repeated'),
    (11, 'T', 'T', 'padded', NULL), (12, 'T', NULL, 'id', 'table_name_missing')
"""


@query(
    "parse_manual",
    f"""
    SELECT event_id, replace(table_key, 'T', 't' || user_id) AS table_key, replace(table_name, 'T', 't' || user_id) AS table_name,
           column_name, reason
    FROM events JOIN (VALUES {MANUAL_EXPECTED}) AS x(variant, table_key, table_name, column_name, reason)
      ON variant = event_id % {len(MANUAL_TEXTS)}
    """,
)
def parse_manual(spark, sf):
    """One configuration text per event, in every right and wrong form."""
    text = F.replace(pick(MANUAL_TEXTS, F.col("event_id") % len(MANUAL_TEXTS)), F.lit("T"), F.concat(F.lit("t"), "user_id"))
    texts = table(spark, sf, "events").select("event_id", text.alias("text"))
    return detect.parse_manual(texts, "event_id", "text")


# --------------------------------------------------------------------------
# type rules

STRATEGY_TYPES = [
    "TIMESTAMP", " timestamptz ", "DATE", "SMALLDATETIME", "TIME", "YEAR", "INTEGER", "int8", "BIGSERIAL",
    "IDENTITY", "COUNTER", "VARCHAR2", "NUMBER", "TINYINT(1)", "MONEY", "INTERVAL", "POINT", "JSONB",
    "MEDIUMINT", "NUMBER(10,2)", "TIMESTAMP(6) WITH TIME ZONE", None,
]
TIMES = "'TIMESTAMP','TIMESTAMPTZ','DATE','SMALLDATETIME','TIME','YEAR','TIMESTAMP(6) WITH TIME ZONE'"
INTEGERS = "'INTEGER','INT8','BIGSERIAL','IDENTITY','COUNTER','MEDIUMINT'"


@query(
    "strategy_of_type",
    f"""
    WITH t AS (SELECT event_id, {sql_pick(STRATEGY_TYPES, f'event_id % {len(STRATEGY_TYPES)}')} AS type,
               CAST((event_id // 100) % 2 AS INT) AS scale FROM events)
    SELECT event_id, CASE WHEN upper(trim(type)) IN ({TIMES}) THEN 'timestamp'
      WHEN upper(trim(type)) IN ({INTEGERS}) OR (type = 'NUMBER' AND scale = 0) THEN 'primary_key' ELSE 'hash' END AS strategy
    FROM t
    """,
)
def strategy_of_type(spark, sf):
    e = F.col("event_id")
    kind = pick(STRATEGY_TYPES, e % len(STRATEGY_TYPES))
    scale = (F.floor(e / 100) % 2).cast("int")
    return table(spark, sf, "events").select("event_id", names.strategy_of_type(kind, scale).alias("strategy"))


@query(
    "strategy_of_name",
    f"""
    SELECT event_id, CASE WHEN contains(lower(c), 'id') THEN 'primary_key'
      WHEN regexp_matches(lower(c), 'date|time|created|updated|modified') THEN 'timestamp' ELSE 'hash' END AS strategy
    FROM (SELECT event_id, {sql_pick(COLUMN_NAMES, 'event_id % 20')} AS c FROM events)
    """,
)
def strategy_of_name(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", names.strategy_of_name(pick(COLUMN_NAMES, F.col("event_id") % 20)).alias("strategy")
    )
