"""Plain folders of table files, as other tools leave them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tablesync.sources.lake import TableNotFound


@dataclass(frozen=True)
class Files:
    """An endpoint of files `<root>/<table><suffix>` without manifest; read only."""

    root: str
    format: str = "parquet"
    suffix: str = ".parquet"


def read(spark: SparkSession, folder: Files, table: str) -> DataFrame:
    try:
        return spark.read.format(folder.format).load(f"{folder.root}/{table}{folder.suffix}")
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise TableNotFound(table) from None
        raise
