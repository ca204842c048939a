"""Log files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.operators.runlog import parse_lines


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of `message | k=v | k=v` with message and fields split out."""
    return parse_lines(spark.read.text(path).withColumnRenamed("value", "line"))
