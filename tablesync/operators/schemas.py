"""Schema comparison, type mapping and schema validity over catalogs of many tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import types as names


def map_types(columns: DataFrame, engine_map: DataFrame) -> DataFrame:
    """Target type per row of (source_engine, target_engine, type); an unmapped name stays.

    The map holds at most a few hundred fixed rows, so broadcasting it is always safe.
    """
    keyed = columns.withColumn("source_type", F.upper(F.trim("type")))
    return (
        keyed.join(F.broadcast(engine_map), ["source_engine", "target_engine", "source_type"], "left")
        .withColumn("mapped_type", F.coalesce("target_type", "type"))
        .drop("target_type", "source_type")
    )


def cast_for_target(
    df: DataFrame, source_engine: str, target_engine: str, source_types: Mapping[str, str]
) -> DataFrame:
    """Cast columns as the engine pair needs it, by the source's own type names.

    `source_types` maps a column to its database type; other columns stay as read.
    """
    casts = names.PAIR_CASTS.get((source_engine.lower(), target_engine.lower()), {})
    if source_engine.lower() == target_engine.lower() or not casts:
        return df
    kinds = {c.lower(): t.upper().split("(")[0].strip() for c, t in source_types.items()}
    return df.select(
        *[
            F.col(f"`{c}`").cast(casts[kinds[c.lower()]]).alias(c)
            if kinds.get(c.lower()) in casts
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def match_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Full outer match of two catalogs on lower-cased names: matched, missing, extra."""
    def side(catalog: DataFrame, prefix: str) -> DataFrame:
        return catalog.select(
            "table_name", F.lower("column_name").alias("column"),
            F.col("type").alias(f"{prefix}_spark_type"), F.col("ordinal").alias(f"{prefix}_ordinal"),
        )

    status = (
        F.when(F.col("target_spark_type").isNull(), "missing")
        .when(F.col("source_spark_type").isNull(), "extra")
        .otherwise("matched")
    )
    return (
        side(source, "source").join(side(target, "target"), ["table_name", "column"], "full_outer")
        .withColumn("status", status)
    )


def column_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that only one of two catalogs has, by set difference both ways."""
    keys = lambda c: c.select("table_name", F.lower("column_name").alias("column"))
    only_source = keys(source).exceptAll(keys(target)).withColumn("side", F.lit("source"))
    return only_source.unionByName(
        keys(target).exceptAll(keys(source)).withColumn("side", F.lit("target"))
    )


def compare_schemas(
    source: DataFrame, target: DataFrame, source_engine: str, target_engine: str, engine_map: DataFrame
) -> DataFrame:
    """Per column: generic source and target type, expected type, and a verdict.

    A column missing in the target and a type that does not fit are errors, a column
    only the target has is a warning.
    """
    matched = match_columns(source, target)
    typed = (
        matched.withColumn("type", names.generic_name(F.col("source_spark_type")))
        .withColumn("target_type_name", names.generic_name(F.col("target_spark_type")))
        .withColumn("source_engine", F.lit(source_engine.lower()))
        .withColumn("target_engine", F.lit(target_engine.lower()))
    )
    mapped = map_types(typed, engine_map)
    fits = names.compatible(F.col("target_type_name"), F.col("mapped_type"))
    verdict = (
        F.when(F.col("status") == "missing", "error")
        .when(F.col("status") == "extra", "warning")
        .when(~fits, "error")
        .otherwise("ok")
    )
    problem = (
        F.when(F.col("status") == "missing", "missing_in_target")
        .when(F.col("status") == "extra", "extra_in_target")
        .when(~fits, "type_mismatch")
    )
    return mapped.select(
        "table_name", "column", F.col("type").alias("source_type"),
        F.col("target_type_name").alias("target_type"),
        F.when(F.col("status") == "matched", F.col("mapped_type")).alias("expected_type"),
        verdict.alias("verdict"), problem.alias("problem"),
    )


def schema_report(compared: DataFrame) -> DataFrame:
    """One row per table: compatible or not, counts, and a text with one line per problem."""
    line = (
        F.when(F.col("problem") == "missing_in_target",
               F.concat(F.lit("ERROR "), "column", F.lit(": missing in target")))
        .when(F.col("problem") == "extra_in_target",
              F.concat(F.lit("WARNING "), "column", F.lit(": only in target")))
        .when(F.col("problem") == "type_mismatch",
              F.concat(F.lit("ERROR "), "column", F.lit(": expected "), "expected_type",
                       F.lit(", found "), "target_type"))
    )
    return compared.groupBy("table_name").agg(
        (F.count_if(F.col("verdict") == "error") == 0).alias("is_compatible"),
        F.count_if(F.col("verdict") == "error").alias("errors"),
        F.count_if(F.col("verdict") == "warning").alias("warnings"),
        F.count_if(F.col("verdict") == "ok").alias("matched"),
        F.concat_ws("\n", F.array_sort(F.collect_list(line))).alias("report"),
    )


def pair_supported(source_engine: str, target_engine: str) -> bool:
    """Whether type rules exist for a pair of engines."""
    a, b = source_engine.lower(), target_engine.lower()
    return a != b and a in names.ENGINES and b in names.ENGINES


def pair_check(pairs: DataFrame) -> DataFrame:
    """Precheck of engine pairs: cross-engine or not, and whether rules exist."""
    a, b = F.lower("source_engine"), F.lower("target_engine")
    return pairs.withColumn("is_cross_engine", a != b).withColumn(
        "is_supported", (a != b) & a.isin(names.ENGINES) & b.isin(names.ENGINES)
    )


# --------------------------------------------------------------------------
# lake schemas


def lake_fields(columns: DataFrame, bookmark_columns: DataFrame | None = None) -> DataFrame:
    """Lake fields from database columns (type, precision, scale, nullable, engine).

    Ids count from 1 in column order; the bookmark column becomes the identifier.
    """
    fields = columns.select(
        "table_name",
        (F.col("ordinal") + 1).alias("id"),
        F.col("column_name").alias("name"),
        names.lake_type(F.col("type"), F.col("precision"), F.col("scale"), F.col("engine")).alias("type"),
        (~F.col("nullable")).alias("required"),
    )
    if bookmark_columns is None:
        return fields.withColumn("is_identifier", F.lit(False))
    marks = bookmark_columns.select("table_name", F.lower("column").alias("_mark"))
    return (
        fields.join(marks, "table_name", "left")
        .withColumn("is_identifier", F.coalesce(F.lower("name") == F.col("_mark"), F.lit(False)))
        .drop("_mark")
    )


def field_problems(fields: DataFrame, identifiers: DataFrame | None = None) -> DataFrame:
    """Faults of lake schemas: (table_name, severity, problem, detail) rows.

    `fields` has (table_name, id, name, type); `identifiers` has (table_name, id).
    """
    blank = lambda c: F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) == 0
    detail = F.coalesce("name", F.col("id").cast("string"), F.lit("?"))
    single = fields.select(
        "table_name",
        F.inline(
            F.filter(
                F.array(
                    *[
                        F.when(test, F.struct(F.lit(sev).alias("severity"), F.lit(code).alias("problem"),
                                              detail.alias("detail")))
                        for test, sev, code in (
                            (F.col("id").isNull(), "error", "id_missing"),
                            (blank("name"), "error", "name_missing"),
                            (blank("type"), "error", "type_missing"),
                            (~blank("type") & ~names.is_lake_type(F.col("type")), "warning", "type_unsupported"),
                        )
                    ]
                ),
                lambda x: x.isNotNull(),
            )
        ),
    )

    def repeated(key, code):
        return (
            fields.filter(key.isNotNull() & (F.length(key.cast("string")) > 0))
            .groupBy("table_name", key.cast("string").alias("detail"))
            .agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .select("table_name", F.lit("error").alias("severity"), F.lit(code).alias("problem"), "detail")
        )

    result = (
        single.unionByName(repeated(F.col("id"), "id_repeated"))
        .unionByName(repeated(F.lower("name"), "name_repeated"))
    )
    if identifiers is not None:
        unknown = (
            identifiers.select("table_name", "id")
            .join(fields.select("table_name", "id"), ["table_name", "id"], "left_anti")
            .select("table_name", F.lit("error").alias("severity"),
                    F.lit("identifier_unknown").alias("problem"), F.col("id").cast("string").alias("detail"))
        )
        result = result.unionByName(unknown)
    return result


def lake_schema(fields: DataFrame, table: str) -> T.StructType:
    """The StructType of one table's lake fields, for creating it."""
    rows = fields.filter(F.col("table_name") == table).orderBy("id").collect()  # one row per column
    unsupported = [r["name"] for r in rows if r["type"] is None]
    if unsupported:
        raise TypeError(f"{table}: no lake type for {unsupported}")
    return names.spark_schema([(r["name"], r["type"], r["required"]) for r in rows])
