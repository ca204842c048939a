"""Short notation for row types, usable before a session exists."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SIMPLE = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "binary": T.BinaryType(),
    "strings": T.ArrayType(T.StringType()), "texts": T.MapType(T.StringType(), T.StringType()),
}


def struct(**fields: str) -> T.StructType:
    """`struct(id="bigint", tags="strings")`: nullable fields in the given order."""
    return T.StructType([T.StructField(name, SIMPLE[kind]) for name, kind in fields.items()])


def local_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A few driver rows as a DataFrame, handed over as Arrow so that no Python worker starts."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(list(values), type=f.type) for values, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
