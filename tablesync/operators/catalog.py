"""Column catalogs: one row per column of many tables, built from schemas alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.functions.structs import local_rows, struct

CATALOG_SCHEMA = struct(
    table_name="string", ordinal="int", column_name="string", type="string", nullable="boolean", is_pk="boolean"
)


def catalog(
    spark: SparkSession,
    schemas: Mapping[str, T.StructType],
    primary_keys: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Columns of all tables as one DataFrame. No data is read; ordinals start at 0."""
    keys = {t: {c.lower() for c in cols} for t, cols in (primary_keys or {}).items()}
    rows = [
        (table, i, f.name, f.dataType.simpleString(), f.nullable, f.name.lower() in keys.get(table, ()))
        for table, schema in schemas.items()
        for i, f in enumerate(schema.fields)
    ]
    return local_rows(spark, rows, CATALOG_SCHEMA)
