"""Exports of a table as CSV, JSON or SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _iso(df: DataFrame, name: str) -> Column:
    """Dates and times as ISO text, fractions only where there are some; others as they are."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.translate(c.cast("string"), " ", "T")
        return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    if isinstance(kind, T.DateType):
        return c.cast("string")
    return c


def to_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, NULL as an empty field and ISO dates."""
    shown = df.select(*[_iso(df, c).alias(c) for c in df.columns])
    shown.write.mode(mode).option("header", "true").option("nullValue", "").option("emptyValue", "").csv(path)


def to_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, NULL fields kept and ISO dates."""
    shown = df.select(*[_iso(df, c).alias(c) for c in df.columns])
    shown.write.mode(mode).option("ignoreNullFields", "false").json(path)


def sql_literal(df: DataFrame, name: str) -> Column:
    """A value as SQL text: NULL, doubled quotes, ISO dates, TRUE or FALSE, or the number."""
    kind, c = df.schema[name].dataType, _iso(df, name)
    if isinstance(kind, T.BooleanType):
        text = F.when(c, "TRUE").otherwise("FALSE")
    elif isinstance(kind, T.NumericType):
        text = c.cast("string")
    else:
        quote = F.lit("'")
        text = F.concat(quote, F.replace(c.cast("string"), quote, F.lit("''")), quote)
    return F.when(F.col(f"`{name}`").isNull(), "NULL").otherwise(text)


def insert_statements(df: DataFrame, table: str) -> DataFrame:
    """One INSERT statement per row, in a column `statement`."""
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("
    values = F.concat_ws(", ", *[sql_literal(df, c) for c in df.columns])
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("statement"))


def to_sql(df: DataFrame, table: str, path: str, mode: str = "errorifexists") -> None:
    insert_statements(df, table).write.mode(mode).text(path)
