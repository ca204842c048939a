"""Which column of a table tells new rows: scoring, overrides and fallbacks.

All operators take the catalog of every table at once and reduce it with partial
aggregates, so thousands of tables are one Spark job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.types import strategy_of_name, strategy_of_type

# Column names that suggest a time or a key.
TIME_NAMES = [
    "updated_at", "modified_at", "last_modified", "last_updated", "created_at", "insert_date",
    "update_date", "modified_date", "timestamp", "last_change", "change_date", "mod_time",
]
FRESH_NAMES = ["updated", "modified", "last_modified"]
KEY_NAMES = ["id", "pk", "primary_key", "key", "seq", "sequence", "row_id", "record_id", "unique_id"]
PREFERRED_TIMES = [
    "updated_at", "last_updated", "modified_at", "last_modified", "update_date",
    "modified_date", "last_change", "change_date",
]
PREFERRED_KEYS = ["id", "pk", "primary_key", "key"]
LAKE_TIMES = [
    "updated_at", "update_time", "last_updated", "modified_at", "mod_time", "created_at",
    "create_time", "insert_time", "timestamp", "last_modified", "updated_date", "modified_date",
    "created_date", "date_updated", "date_modified",
]
LAKE_KEYS = [
    "id", "primary_key", "pk", "key", "row_id", "record_id", "sequence_id", "seq_id", "auto_id",
    "identity",
]


def _any(tests: Sequence[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def _contains(name: Column, words: Sequence[str]) -> Column:
    return _any([name.contains(w) for w in words])


def _is_or_ends(name: Column, words: Sequence[str]) -> Column:
    return _any([(name == w) | name.endswith("_" + w) for w in words])


def _first_index(tests: Sequence[Column], otherwise: int) -> Column:
    """Number of the first test that holds."""
    result = F.when(tests[0], 0)
    for i, test in enumerate(tests[1:], 1):
        result = result.when(test, i)
    return result.otherwise(otherwise)


def score_columns(catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Candidate columns with a strategy and a score in tenths.

    `strict` accepts zoned timestamps and dates only; by default a timestamp without
    a zone counts as well.
    """
    name, kind = F.lower("column_name"), F.col("type")
    times = ["timestamp", "date"] + ([] if strict else ["timestamp_ntz"])
    is_time, is_key = kind.isin(times), kind.isin("int", "bigint")
    points = lambda test, n: F.when(test, n).otherwise(0)
    time_score = 5 + points(_contains(name, TIME_NAMES), 3) + points(_contains(name, FRESH_NAMES), 2)
    key_score = (
        3 + points(_is_or_ends(name, KEY_NAMES), 4)
        + points((name == "id") | name.endswith("_id"), 2)
    )
    return (
        catalog.filter(is_time | is_key)
        .withColumn("strategy", F.when(is_time, "timestamp").otherwise("primary_key"))
        .withColumn("score", F.when(is_time, time_score).otherwise(key_score))
    )


def detect_strategies(catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Best column per table: highest score, a timestamp before a key on equal scores,
    then the first column. A table without a candidate falls back to `hash`."""
    order = F.struct(F.col("score"), F.col("strategy") == "timestamp", -F.col("ordinal"))
    best = (
        score_columns(catalog, strict)
        .groupBy("table_name")
        .agg(F.max_by(F.struct("strategy", "column_name", "score"), order).alias("b"))
    )
    return (
        catalog.select("table_name").distinct()
        .join(best, "table_name", "left")
        .select(
            "table_name",
            F.coalesce("b.strategy", F.lit("hash")).alias("strategy"),
            F.lower("b.column_name").alias("column"),
            F.coalesce("b.score", F.lit(0)).alias("confidence_tenths"),
        )
    )


def detect_from_metadata(catalog: DataFrame) -> DataFrame:
    """Best column per table from database metadata (type names as the database gives them):
    a time-typed column with a time-like name, else a declared key, else a key-like integer."""
    name, kind = F.lower("column_name"), F.upper("type")
    is_time = kind.rlike("TIMESTAMP|DATE|TIME") & (
        _contains(name, TIME_NAMES) | name.contains("date") | name.contains("time")
    )
    is_key_like = kind.rlike("INT|SERIAL") & _is_or_ends(name, KEY_NAMES)
    level = F.when(is_time, 1).when(F.col("is_pk"), 2).when(is_key_like, 3)
    time_rank = _first_index([name.contains(w) for w in PREFERRED_TIMES], 99)
    key_rank = _first_index(
        [name == w for w in PREFERRED_KEYS] + [name.endswith("_" + w) for w in PREFERRED_KEYS], 99
    )
    rank = F.when(level == 1, time_rank).otherwise(key_rank)
    best = (
        catalog.withColumn("level", level)
        .filter("level is not null")
        .groupBy("table_name")
        .agg(F.min_by(F.struct("level", name.alias("name")), F.struct("level", rank, "ordinal")).alias("b"))
    )
    return (
        catalog.select("table_name").distinct()
        .join(best, "table_name", "left")
        .select(
            "table_name",
            F.when(F.col("b.level") == 1, "timestamp")
            .when(F.col("b.level").isNotNull(), "primary_key")
            .otherwise("hash")
            .alias("strategy"),
            F.col("b.name").alias("column"),
        )
    )


def typed_strategy(kind: Column) -> Column:
    """The strategy of a column of a type such as `bigint` or `decimal(38,0)`: decimals of scale 0 are keys."""
    decimal = r"(?i)^(?:decimal|numeric|number)\s*\(\s*\d+\s*(?:,\s*(-?\d+)\s*)?\)$"
    digits = F.regexp_extract(kind, decimal, 1)
    scale = F.when(digits == "", F.lit(0)).otherwise(digits.cast("int"))
    is_decimal = kind.rlike(decimal)
    return strategy_of_type(F.when(is_decimal, "NUMBER").otherwise(kind), F.when(is_decimal, scale))


def resolve(catalog: DataFrame, manual: DataFrame, by_name: bool = False, detected: DataFrame | None = None) -> DataFrame:
    """Manual column where it exists in the table, else the detected one (by default from metadata).

    The strategy of a manual column follows its type, or its name with `by_name`.
    """
    columns = catalog.select(
        "table_name", F.lower("column_name").alias("_key"), F.col("column_name").alias("_found"),
        F.col("type").alias("_type"),
    )
    rule = strategy_of_name(F.col("_found")) if by_name else typed_strategy(F.col("_type"))
    valid = (
        manual.withColumn("_key", F.lower("column_name"))
        .join(columns, ["table_name", "_key"])
        .select("table_name", F.col("_found").alias("_manual"), rule.alias("_strategy"))
    )
    return (
        (detect_from_metadata(catalog) if detected is None else detected)
        .join(valid, "table_name", "left")
        .select(
            "table_name",
            F.coalesce("_strategy", "strategy").alias("strategy"),
            F.coalesce("_manual", "column").alias("column"),
            F.col("_manual").isNotNull().alias("is_manual"),
        )
    )


def lake_fallback(catalog: DataFrame) -> DataFrame:
    """Tracking column of a lake table without identifiers: named time, named key, any
    timestamp, any integer. The order of the names counts before the order of columns."""
    name, kind = F.lower("column_name"), F.col("type")
    is_stamp, is_int = kind.isin("timestamp", "timestamp_ntz"), kind.isin("int", "bigint")
    is_time = is_stamp | (kind == "date")
    time_rank = _first_index([name.contains(w) for w in LAKE_TIMES], 99)
    key_rank = _first_index([(name == w) | name.endswith("_" + w) for w in LAKE_KEYS], 99)
    level = (
        F.when(is_time & (time_rank < 99), 1)
        .when(is_int & (key_rank < 99), 2)
        .when(is_stamp, 3)
        .when(is_int, 4)
    )
    rank = F.when(level == 1, time_rank).when(level == 2, key_rank).otherwise(0)
    best = (
        catalog.withColumn("level", level)
        .filter("level is not null")
        .groupBy("table_name")
        .agg(F.min_by(F.struct("level", "column_name"), F.struct("level", rank, "ordinal")).alias("b"))
    )
    return (
        catalog.select("table_name").distinct()
        .join(best, "table_name", "left")
        .select("table_name", F.col("b.column_name").alias("column"), F.col("b.level").alias("level"))
    )


def detect_lake(catalog: DataFrame, tables: DataFrame) -> DataFrame:
    """Strategy and column of lake tables: their identifier columns first, then names and types.

    `tables` has (table_name, identifier_field_ids). The strategy follows the type of the column.
    """
    named = identifier_columns(tables, catalog).select("table_name", F.col("column").alias("_identifier"))
    guessed = lake_fallback(catalog).select("table_name", F.col("column").alias("_guess"))
    picked = guessed.join(named, "table_name", "left").select("table_name", F.coalesce("_identifier", "_guess").alias("column"))
    kinds = catalog.select("table_name", F.col("column_name").alias("column"), typed_strategy(F.col("type")).alias("_strategy"))
    return picked.join(kinds, ["table_name", "column"], "left").select(
        "table_name", F.coalesce("_strategy", F.lit("hash")).alias("strategy"), "column")


def first_identifier(text: Column) -> Column:
    """First number in a comma-separated id list; parts that are no number are skipped."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    numbers = F.filter(parts, lambda p: p.rlike(r"^\d+$"))
    return F.get(numbers, F.lit(0)).cast("int")


def identifier_columns(tables: DataFrame, catalog: DataFrame) -> DataFrame:
    """Bookmark column of lake tables from their id list: id = position + 1, first id wins."""
    ids = tables.withColumn("id", first_identifier(F.col("identifier_field_ids")))
    places = catalog.select("table_name", (F.col("ordinal") + 1).alias("id"), "column_name")
    return ids.join(places, ["table_name", "id"], "left").select(
        "table_name", "id", F.col("column_name").alias("column")
    )


# --------------------------------------------------------------------------
# manual configuration

NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"


def parse_manual(configs: DataFrame, key: str, text: str) -> DataFrame:
    """Manual settings from JSON texts, one row per table entry, with what is wrong with it.

    Both forms are read: `{"t": "column"}` and `{"t": {"table_name": .., "column_name": ..}}`.
    A text that is no JSON object with entries gives one row with a NULL table.
    """
    spark = configs.sparkSession
    parsed = configs.select(
        key, F.col(text).alias("_text"), F.try_parse_json(F.trim(text)).alias("_v")
    ).withColumn("_kind", F.schema_of_variant("_v"))
    whole = (
        F.when(F.coalesce(F.length(F.trim("_text")), F.lit(0)) == 0, "empty")
        .when(F.col("_v").isNull(), "not_json")
        .when(F.col("_kind") == "VOID", "null")
        .when(~F.col("_kind").startswith("OBJECT"), "not_an_object")
        .when(F.col("_kind") == "OBJECT<>", "no_entries")
    )
    parsed = parsed.withColumn("_whole", whole)
    usable = F.when(F.col("_whole").isNull(), F.col("_v"))
    exploded = spark.tvf.variant_explode_outer(F.col("_entry_source").outer())
    entries = (
        parsed.withColumn("_entry_source", usable)
        .lateralJoin(exploded, how="left")
        .withColumnRenamed("key", "table_key")
    )
    kind = F.schema_of_variant("value")
    part = lambda f: F.try_variant_get("value", f"$.{f}", "string")
    is_text, is_object = kind == "STRING", kind.startswith("OBJECT")
    table = F.trim(F.when(is_text, F.col("table_key")).when(is_object, part("table_name")))
    column = F.trim(F.when(is_text, F.try_variant_get("value", "$", "string")).when(is_object, part("column_name")))
    rows = entries.select(
        key, "table_key", table.alias("table_name"), column.alias("column_name"),
        F.when(F.col("_whole").isNotNull(), F.col("_whole"))
        .when(~(is_text | is_object), "value_not_text_or_object")
        .when(F.coalesce(F.length(table), F.lit(0)) == 0, "table_name_missing")
        .when(F.coalesce(F.length(column), F.lit(0)) == 0, "column_name_missing")
        .when(~table.rlike(NAME), "table_name_invalid")
        .when(~column.rlike(NAME), "column_name_invalid")
        .alias("_reason"),
    )
    repeats = (
        rows.filter("_reason is null").groupBy(key, "table_name").agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        rows.join(repeats, [key, "table_name"], "left")
        .withColumn("reason", F.coalesce("_reason", F.when(F.col("_n") > 1, "table_repeated")))
        .select(key, "table_key", "table_name", "column_name", "reason")
    )


def manual_settings(parsed: DataFrame, key: str) -> DataFrame:
    """Entries of the texts that have no fault at all; one bad entry rejects its text."""
    faulty = parsed.filter("reason is not null").select(key).distinct()
    return parsed.join(faulty, key, "left_anti").select(key, "table_name", "column_name")


def detection_summary(resolved: DataFrame) -> DataFrame:
    """Counts and shares of manual and automatic tables, and the spread of strategies."""
    share = lambda n: F.when(F.col("tables") > 0, F.round(F.col(n) * 100 / F.col("tables"), 2)).otherwise(0.0)
    return (
        resolved.agg(
            F.count(F.lit(1)).alias("tables"),
            F.count_if("is_manual").alias("manual"),
            F.count_if(~F.col("is_manual")).alias("automatic"),
            *[F.count_if(F.col("strategy") == s).alias(s) for s in ("timestamp", "primary_key", "hash")],
        )
        .withColumn("manual_percent", share("manual"))
        .withColumn("automatic_percent", share("automatic"))
    )
