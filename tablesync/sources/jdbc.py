"""Tables in databases, read and written through Spark's JDBC source."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.incremental import above, highest_text, mark, mark_text
from tablesync.sources.lake import TableNotFound
from tablesync.sources.ranges import can_cut, conditions, cut_query, inside, quoted

# Rows per round trip. A database time without a zone stays one: read as an instant, it
# would move with the session time zone.
FETCH = {"fetchsize": "10000", "preferTimestampNTZ": "true"}
BATCH = {"batchsize": "10000"}
# Connection settings per engine. Fixed values.
ENGINE_OPTIONS = {
    "oracle": {
        "oracle.jdbc.timezoneAsRegion": "false",
        "oracle.net.CONNECT_TIMEOUT": "30000",
        "oracle.jdbc.ReadTimeout": "60000",
    },
    "sqlserver": {"loginTimeout": "30", "socketTimeout": "60000", "selectMethod": "cursor"},
    "postgresql": {"connectTimeout": "30", "socketTimeout": "60", "tcpKeepAlive": "true"},
    "db2": {"loginTimeout": "30", "blockingReadConnectionTimeout": "60000", "resultSetHoldability": "1"},
}
DRIVERS = {
    "oracle": "oracle.jdbc.OracleDriver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
    "db2": "com.ibm.db2.jcc.DB2Driver",
}


@dataclass(frozen=True)
class Jdbc:
    """A database endpoint. `options` carries user, password and anything driver-specific."""

    url: str
    engine: str = ""
    driver: str | None = None
    schema: str | None = None
    options: dict = field(default_factory=dict)

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def settings(self) -> dict:
        driver = self.driver or DRIVERS.get(self.engine.lower())
        base = {"url": self.url, **({"driver": driver} if driver else {})}
        return {**base, **ENGINE_OPTIONS.get(self.engine.lower(), {}), **self.options}


def read_query(spark: SparkSession, db: Jdbc, sql: str) -> DataFrame:
    """A query that the database runs."""
    return spark.read.format("jdbc").options(**{**FETCH, **db.settings(), "query": sql}).load()


def read_table(
    spark: SparkSession,
    db: Jdbc,
    table: str,
    partition_column: str | None = None,
    partitions: int = 1,
    tie: str | None = None,
    low: str | None = None,
    high: str | None = None,
) -> DataFrame:
    """A whole table; with a partition column, in parallel over ranges of even row counts.

    `low` and `high`, as bookmark text, limit the partition column to low < column <= high. A value that repeats is
    cut by the column `tie`, a key, where one is given. Later filters and column choices on the result are pushed
    into the database.
    """
    options = {**FETCH, **db.settings(), "dbtable": db.name(table)}
    plain = spark.read.format("jdbc").options(**options).load()
    if not partition_column or (partitions < 2 and low is None and high is None):
        return plain
    found = even_ranges(spark, db, table, plain.schema, [partition_column, *([tie] if tie else [])], partitions, low, high)
    if found is None:
        rows = above(plain, partition_column, low)
        return rows if high is None else rows.filter(F.col(partition_column) <= mark(rows, partition_column, high))
    source = {**FETCH, **db.settings()}
    return spark.read.options(**{k: v for k, v in source.items() if k != "url"}).jdbc(db.url, db.name(table), predicates=found)


def even_ranges(
    spark: SparkSession, db: Jdbc, table: str, schema: T.StructType, columns: Sequence[str], partitions: int, low: str | None, high: str | None
) -> list[str] | None:
    """Conditions of about `partitions` ranges with equally many rows; None for types without literals.

    The database counts the rows and finds the cut points; at most a row per range comes back. NULLs of the first
    column belong to a read without a lower end only.
    """
    kinds = {f.name.lower(): (f.name, f.dataType) for f in schema.fields}
    typed = [kinds[c.lower()] for c in columns]
    if not all(can_cut(kind) for _, kind in typed):
        return None
    name, kind = typed[0]
    # The order of the database decides, not that of the text: cut points come with their places.
    span = inside(name, kind, low, high, db.engine)
    empty = f"SUM(CASE WHEN {quoted(name)} IS NULL THEN 1 ELSE 0 END)"
    where = span if low is not None else f"({span} OR {quoted(name)} IS NULL)"
    counted = read_query(spark, db, f"SELECT COUNT({quoted(name)}) AS n, {empty} AS e FROM {db.name(table)} WHERE {where}").first()
    nulls = False if low is not None else bool(counted[1]) or None
    sql = cut_query(db.name(table), [n for n, _ in typed], span, counted[0], partitions, db.engine)
    cuts = []
    if sql is not None:
        rows = read_query(spark, db, sql)
        texts = [mark_text(F.col(f"`{c}`"), kind).alias(f"c{i}") for i, (c, (_, kind)) in enumerate(zip(rows.columns, typed))]
        found = sorted(rows.select(F.col(f"`{rows.columns[-1]}`").alias("place"), *texts).collect(), key=lambda r: r["place"])
        cuts = [tuple(r[1:]) for r in found if None not in tuple(r)]
    return conditions(typed, low, high, cuts, db.engine, nulls)


# Column catalogs of the engines, all tables of a schema in one query. Names differ per
# engine, the result does not: table, place, column, type, nullable, key, precision, scale.
_STANDARD_CATALOG = """
    SELECT c.table_name AS table_name, c.ordinal_position - 1 AS ordinal, c.column_name AS column_name,
           c.data_type AS type, c.is_nullable AS nullable, k.column_name AS key_name,
           c.numeric_precision AS num_precision, c.numeric_scale AS num_scale
    FROM information_schema.columns c LEFT JOIN (
      SELECT u.table_schema, u.table_name, u.column_name
      FROM information_schema.table_constraints t JOIN information_schema.key_column_usage u
        ON u.constraint_name = t.constraint_name AND u.table_schema = t.table_schema AND u.table_name = t.table_name
      WHERE t.constraint_type = 'PRIMARY KEY'
    ) k ON k.table_schema = c.table_schema AND k.table_name = c.table_name AND k.column_name = c.column_name
    WHERE c.table_schema = '{schema}'
"""
CATALOG_SQL = {
    "postgresql": _STANDARD_CATALOG,
    "sqlserver": _STANDARD_CATALOG,
    "oracle": """
    SELECT c.table_name AS table_name, c.column_id - 1 AS ordinal, c.column_name AS column_name,
           c.data_type AS type, c.nullable AS nullable, k.column_name AS key_name,
           c.data_precision AS num_precision, c.data_scale AS num_scale
    FROM all_tab_columns c LEFT JOIN (
      SELECT u.owner, u.table_name, u.column_name FROM all_constraints t
      JOIN all_cons_columns u ON u.owner = t.owner AND u.constraint_name = t.constraint_name
      WHERE t.constraint_type = 'P'
    ) k ON k.owner = c.owner AND k.table_name = c.table_name AND k.column_name = c.column_name
    WHERE c.owner = '{schema}'
""",
    "db2": """
    SELECT tabname AS table_name, colno AS ordinal, colname AS column_name, typename AS type, nulls AS nullable,
           CASE WHEN keyseq IS NOT NULL THEN colname END AS key_name, length AS num_precision, scale AS num_scale
    FROM syscat.columns WHERE tabschema = '{schema}'
""",
}


def column_catalog(spark: SparkSession, db: Jdbc, sql: str | None = None) -> DataFrame:
    """Columns of every table in the schema, with database type names and declared keys, by one query."""
    if sql is None:
        if db.schema is None:
            raise ValueError("a column catalog needs the schema's name")
        owner = db.schema.replace("'", "''")
        sql = CATALOG_SQL[db.engine.lower()].format(schema=owner)
    rows = read_query(spark, db, sql)
    found = {c.lower(): F.col(f"`{c}`") for c in rows.columns}
    return rows.select(
        F.trim(found["table_name"]).alias("table_name"),
        found["ordinal"].cast("int").alias("ordinal"),
        F.trim(found["column_name"]).alias("column_name"),
        F.upper(F.trim(found["type"])).alias("type"),
        F.upper(F.trim(found["nullable"])).isin("YES", "Y").alias("nullable"),
        found["key_name"].isNotNull().alias("is_pk"),
        found["num_precision"].cast("int").alias("precision"),
        found["num_scale"].cast("int").alias("scale"),
    )


def value_range(spark: SparkSession, db: Jdbc, table: str, column: str):
    """Smallest and largest value of a column, computed by the database; None if empty."""
    c = quoted(column)
    sql = f"SELECT MIN({c}) AS low, MAX({c}) AS high FROM {db.name(table)}"
    row = read_query(spark, db, sql).first()
    return None if row is None or row[0] is None else (row[0], row[1])


def highest(spark: SparkSession, db: Jdbc, table: str, column: str) -> str | None:
    """MAX of a column as text, computed by the database."""
    frame = read_query(spark, db, f"SELECT MAX({quoted(column)}) AS m FROM {db.name(table)}")
    found = frame.schema[0]
    return frame.select(mark_text(F.col(found.name), found.dataType).alias("m")).first()["m"]


def schema(spark: SparkSession, db: Jdbc, table: str) -> T.StructType:
    """Column names and types; no row is read. A table that is not there raises `TableNotFound`."""
    try:
        return read_table(spark, db, table).schema
    except Exception as error:
        if says_missing(str(error)):
            raise TableNotFound(table) from error
        raise


# What the engines say of a table that is not there. Codes and words of their messages.
MISSING = ("ORA-00942", "SQLSTATE=42704", "SQLCODE=-204", "Invalid object name", "Table/View '")


def says_missing(message: str) -> bool:
    """Whether a database's error message means that the table does not exist."""
    relation = re.search(r'relation "[^"]*" does not exist|does not exist\.', message)
    return bool(relation) or any(sign in message for sign in MISSING)


def write(
    df: DataFrame, db: Jdbc, table: str, mode: str = "append", watermark: str | None = None,
    connections: int | None = None, measures: Sequence[Column] = (),
) -> dict:
    """Append, or refresh while keeping the target's definition.

    Returns the rows (`n`), the highest watermark (`high`) and `measures`, seen in the same pass. Each
    task is one transaction; `connections` bounds how many run at a time.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported database write mode {mode!r}")
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("n"), *measures]
    if watermark:
        wanted.append(highest_text(df, watermark).alias("high"))
    options = {**BATCH, **db.settings(), "dbtable": db.name(table)}
    if connections:
        options["numPartitions"] = str(connections)
    writer = df.observe(seen, *wanted).write.format("jdbc").options(**options)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()
    return {"n": 0, **seen.get}


def delete(spark: SparkSession, db: Jdbc, table: str, conditions: Sequence[str]) -> int:
    """Delete the rows that meet one of the conditions, in one transaction of the database; how many they were."""
    jvm = spark._jvm
    settings = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({str(k): str(v) for k, v in db.settings().items()})
    options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(db.url, db.name(table), settings)
    connection = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(db.url).createConnectionFactory(options).apply(-1)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        gone = sum(statement.executeUpdate(f"DELETE FROM {db.name(table)} WHERE {c}") for c in conditions)
        connection.commit()
        return gone
    finally:
        connection.close()
