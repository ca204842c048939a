"""One scan, one schema probe and one sink for every kind of endpoint."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.operators.incremental import highest_text
from tablesync.sources import files, jdbc, lake
from tablesync.sources.files import Files
from tablesync.sources.jdbc import Jdbc
from tablesync.sources.lake import Lake

Endpoint = Lake | Files | Jdbc


@dataclass(frozen=True)
class Written:
    """What a write moved."""

    rows: int
    high: str | None
    observed: dict = field(default_factory=dict)


def scan(spark: SparkSession, endpoint: Endpoint, table: str, query: str | None = None, **options) -> DataFrame:
    """A table, or a query where the endpoint is a database."""
    if isinstance(endpoint, Jdbc):
        if query is not None:
            return jdbc.read_query(spark, endpoint, query)
        return jdbc.read_table(spark, endpoint, table, **options)
    if query is not None:
        raise ValueError("only a database runs queries; filter the scan instead")
    if isinstance(endpoint, Files):
        return files.read(spark, endpoint, table)
    return lake.read(spark, endpoint, table, **options)


def schema_of(spark: SparkSession, endpoint: Endpoint, table: str) -> T.StructType:
    """The schema of a table, without a Spark job over its rows."""
    if isinstance(endpoint, Lake):
        return lake.state(spark, endpoint, table).schema
    if isinstance(endpoint, Jdbc):
        return jdbc.schema(spark, endpoint, table)
    return scan(spark, endpoint, table).schema


def sink(
    df: DataFrame, endpoint: Endpoint, table: str, mode: str, watermark: str | None = None, **options
) -> Written:
    """Write to a lake table or a database table."""
    if isinstance(endpoint, Lake):
        done = lake.write(df, endpoint, table, mode, watermark=watermark, **options)
        return Written(done.rows, done.high, done.observed)
    if isinstance(endpoint, Jdbc):
        observed = jdbc.write(df, endpoint, table, mode, watermark, options.get("connections"), options.get("measures", ()))
        return Written(observed["n"], observed.get("high"), observed)
    raise TypeError("plain files are a source only")


def highest(spark: SparkSession, endpoint: Endpoint, table: str, column: str) -> str | None:
    """MAX of a column in a table, as text, pushed to where the table is."""
    if isinstance(endpoint, Jdbc):
        return jdbc.highest(spark, endpoint, table, column)
    rows = scan(spark, endpoint, table)
    return rows.agg(highest_text(rows, column).alias("m")).first()["m"]
