"""Registry of queries with their oracle SQL, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.bookmarks import BookmarkStore
from tablesync.session import workspace
from tablesync.sources.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def keep(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_lake(spark: SparkSession, purpose: str) -> Lake:
    """A lake of its own for one query run, in the folder the executors share."""
    return Lake(workspace(spark, purpose))


def new_store(spark: SparkSession) -> BookmarkStore:
    return BookmarkStore(workspace(spark, "bookmarks"))


def middle(df: DataFrame, column: str):
    """A bookmark in the middle of a key range, as an earlier run would have left it."""
    row = df.agg(F.min(column).alias("a"), F.max(column).alias("z")).first()
    return (row["a"] + row["z"]) // 2


def pick(values: list, index: Column) -> Column:
    """values[index], with the index starting at 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_pick(values: list, index: str) -> str:
    shown = ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"list_extract([{shown}], CAST(({index}) + 1 AS BIGINT))"
