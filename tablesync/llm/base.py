"""Registry of this subpackage's queries, and helpers its operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesync.session import workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL its tests hold it against a brute-force version."""

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


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the folder all executors share, and read from there.

    This cuts lineage: a lost executor costs the tasks that ran on it, not the steps before.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files behind settled tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = spark._jvm.org.apache.hadoop.fs.Path(file)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def own_name(stem: str) -> str:
    """A column name that no input column has."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def file_system(path: str):
    """The file system of a path or URI, and the path in it; for tasks, which have no JVM to ask."""
    from pyarrow import fs

    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)
