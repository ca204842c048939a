"""Type names of database engines and the lake, and the rules between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.structs import SIMPLE, local_rows, struct

ENGINES = ["oracle", "sqlserver", "postgresql", "db2"]

# --------------------------------------------------------------------------
# Engine to engine. Each source name stands for a kind of value, each engine has one
# name per kind; a mapping is the way through the kind. Fixed values.

KIND_NAMES = {
    #            oracle            sqlserver           postgresql          db2
    "int":       ("NUMBER",        "INT",              "INTEGER",          "INTEGER"),
    "bigint":    ("NUMBER",        "BIGINT",           "BIGINT",           "BIGINT"),
    "smallint":  ("NUMBER",        "SMALLINT",         "SMALLINT",         "SMALLINT"),
    "decimal":   ("NUMBER",        "DECIMAL",          "NUMERIC",          "DECIMAL"),
    "numeric":   ("NUMBER",        "NUMERIC",          "NUMERIC",          "DECIMAL"),
    "real":      ("BINARY_FLOAT",  "REAL",             "REAL",             "REAL"),
    "double":    ("BINARY_DOUBLE", "FLOAT",            "DOUBLE PRECISION", "DOUBLE"),
    "varchar":   ("VARCHAR2",      "NVARCHAR",         "VARCHAR",          "VARCHAR"),
    "nvarchar":  ("NVARCHAR2",     "NVARCHAR",         "VARCHAR",          "VARCHAR"),
    "char":      ("CHAR",          "CHAR",             "CHAR",             "CHAR"),
    "nchar":     ("NCHAR",         "NCHAR",            "CHAR",             "CHAR"),
    "text":      ("CLOB",          "NTEXT",            "TEXT",             "CLOB"),
    "ntext":     ("NCLOB",         "NTEXT",            "TEXT",             "CLOB"),
    "date":      ("DATE",          "DATE",             "DATE",             "DATE"),
    "time":      ("TIMESTAMP",     "TIME",             "TIME",             "TIME"),
    "timestamp": ("TIMESTAMP",     "DATETIME2",        "TIMESTAMP",        "TIMESTAMP"),
    "boolean":   ("NUMBER",        "BIT",              "BOOLEAN",          "SMALLINT"),
    "blob":      ("BLOB",          "VARBINARY",        "BYTEA",            "BLOB"),
    "varbinary": ("RAW",           "VARBINARY",        "BYTEA",            "VARBINARY"),
    "uuid":      ("RAW",           "UNIQUEIDENTIFIER", "UUID",             "CHAR"),
}

SOURCE_KINDS = {
    "oracle": {
        "NUMBER": "numeric", "VARCHAR2": "varchar", "NVARCHAR2": "nvarchar", "CHAR": "char",
        "NCHAR": "nchar", "DATE": "timestamp", "TIMESTAMP": "timestamp", "CLOB": "text",
        "NCLOB": "ntext", "BLOB": "blob", "RAW": "varbinary", "LONG": "text",
        "LONG RAW": "blob", "BINARY_FLOAT": "real", "BINARY_DOUBLE": "double",
    },
    "sqlserver": {
        "INT": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "TINYINT": "smallint",
        "DECIMAL": "decimal", "NUMERIC": "numeric", "FLOAT": "double", "REAL": "real",
        "VARCHAR": "varchar", "NVARCHAR": "nvarchar", "CHAR": "char", "NCHAR": "nchar",
        "TEXT": "text", "NTEXT": "ntext", "DATETIME": "timestamp", "DATETIME2": "timestamp",
        "DATE": "date", "TIME": "time", "BIT": "boolean", "VARBINARY": "varbinary",
        "IMAGE": "blob", "MONEY": "decimal", "SMALLMONEY": "decimal", "UNIQUEIDENTIFIER": "uuid",
    },
    "postgresql": {
        "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "NUMERIC": "numeric",
        "DECIMAL": "decimal", "REAL": "real", "DOUBLE PRECISION": "double", "VARCHAR": "varchar",
        "CHAR": "char", "TEXT": "text", "DATE": "date", "TIME": "time", "TIMESTAMP": "timestamp",
        "BOOLEAN": "boolean", "BYTEA": "blob", "UUID": "uuid", "JSON": "text", "JSONB": "text",
    },
    "db2": {
        "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "DECIMAL": "decimal",
        "NUMERIC": "numeric", "REAL": "real", "DOUBLE": "double", "VARCHAR": "varchar",
        "CHAR": "char", "CLOB": "text", "DATE": "date", "TIME": "time", "TIMESTAMP": "timestamp",
        "BLOB": "blob", "VARBINARY": "varbinary", "GRAPHIC": "nvarchar", "VARGRAPHIC": "nvarchar",
    },
}

# Where a pair keeps a name the kind would change.
KEPT_NAMES = {("sqlserver", "db2", "NUMERIC"): "NUMERIC"}


def engine_type_map(spark: SparkSession) -> DataFrame:
    """(source_engine, target_engine, source_type, target_type) for all twelve pairs."""
    rows = []
    for source, kinds in SOURCE_KINDS.items():
        for target in ENGINES:
            if target == source:
                continue
            for name, kind in kinds.items():
                mapped = KIND_NAMES[kind][ENGINES.index(target)]
                rows.append((source, target, name, KEPT_NAMES.get((source, target, name), mapped)))
    columns = struct(source_engine="string", target_engine="string", source_type="string", target_type="string")
    return local_rows(spark, rows, columns)


# --------------------------------------------------------------------------
# Casts a pair needs, by the source's type name. Fixed values.

PAIR_CASTS = {
    ("oracle", "postgresql"): {"DATE": "timestamp", "NUMBER": "decimal(38,10)", "CLOB": "string"},
    ("sqlserver", "postgresql"): {"BIT": "boolean", "DATETIME": "timestamp", "UNIQUEIDENTIFIER": "string"},
    ("postgresql", "oracle"): {"BOOLEAN": "int", "UUID": "string", "JSON": "string", "JSONB": "string"},
    ("postgresql", "sqlserver"): {"UUID": "string", "JSON": "string", "JSONB": "string"},
}

# --------------------------------------------------------------------------
# JDBC names to lake names. Fixed values.

LAKE_NAMES = {
    "string": ["VARCHAR", "CHAR", "TEXT", "CLOB", "NVARCHAR", "NCHAR", "NTEXT", "NCLOB"],
    "int": ["TINYINT", "SMALLINT", "INTEGER", "INT"],
    "long": ["BIGINT"],
    "decimal": ["DECIMAL", "NUMERIC", "NUMBER"],
    "float": ["FLOAT", "REAL"],
    "double": ["DOUBLE", "DOUBLE PRECISION"],
    "boolean": ["BOOLEAN", "BIT"],
    "date": ["DATE"],
    "timestamp": ["TIMESTAMP", "TIMESTAMP WITHOUT TIME ZONE"],
    "timestamptz": ["TIMESTAMP WITH TIME ZONE"],
    "time": ["TIME", "TIME WITH TIME ZONE", "TIME WITHOUT TIME ZONE"],
    "binary": ["BINARY", "VARBINARY", "BLOB", "LONGVARBINARY"],
    "uuid": ["UUID"],
}
DEFAULT_DECIMAL = {"oracle": (38, 0), "sqlserver": (18, 0), "postgresql": (28, 6), "db2": (31, 0)}


def lookup(value: Column, table: dict[str, object], default: Column | None = None) -> Column:
    """A small fixed table as a map expression; unknown keys give the default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, default)


def lake_type(jdbc_type: Column, precision: Column, scale: Column, engine: Column) -> Column:
    """JDBC type name to lake type; NULL for a type the lake cannot hold.

    Precision and scale are filled from the engine when one of them is NULL; then a
    zero counts as missing too. Given both, they stay as they are.
    """
    name = F.upper(F.trim(jdbc_type))
    flat = {j: lake for lake, names in LAKE_NAMES.items() for j in names}
    found = lookup(name, flat)
    fallback = DEFAULT_DECIMAL["postgresql"]
    missing = precision.isNull() | scale.isNull()
    numbers = []
    for i, given in enumerate((precision, scale)):
        engine_value = lookup(engine, {e: v[i] for e, v in DEFAULT_DECIMAL.items()}, F.lit(fallback[i]))
        usable = F.when(given.isNull() | (given == 0), engine_value).otherwise(given)
        numbers.append(F.when(missing, usable).otherwise(given).cast("string"))
    decimal = F.concat(F.lit("decimal("), numbers[0], F.lit(","), numbers[1], F.lit(")"))
    return F.when(found == "decimal", decimal).otherwise(found)


LAKE_TO_SPARK = {
    "boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double",
    "string": "string", "binary": "binary", "date": "date", "timestamp": "timestamp",
    "timestamptz": "timestamp", "time": "string", "uuid": "string",
}


def spark_type_name(lake: Column) -> Column:
    """Lake type to Spark type name; a broken decimal is decimal(10,0), unknown is string."""
    name = F.lower(F.trim(lake))
    is_decimal = name.startswith("decimal(") & name.endswith(")")
    pattern = r"^decimal\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)$"
    p, s = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    decimal = F.when(
        name.rlike(pattern),
        F.concat(F.lit("decimal("), p, F.lit(","), F.when(s == "", "0").otherwise(s), F.lit(")")),
    ).otherwise(F.lit("decimal(10,0)"))
    return F.when(is_decimal, decimal).otherwise(lookup(name, LAKE_TO_SPARK, F.lit("string")))


def is_lake_type(lake: Column) -> Column:
    name = F.lower(F.trim(lake))
    known = name.isin(list(LAKE_TO_SPARK))
    return F.coalesce(known | name.rlike(r"^decimal\(.*\)$") | name.rlike(r"^fixed\[.*\]$"), F.lit(False))


# --------------------------------------------------------------------------
# Spark names to the generic names used in comparisons. Fixed values.

GENERIC_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BINARY",
}


def generic_name(spark_type: Column) -> Column:
    """`simpleString` of a Spark type to its generic database name."""
    other = F.when(spark_type.startswith("decimal"), F.lit("DECIMAL")).otherwise(F.upper(spark_type))
    return lookup(spark_type, GENERIC_NAMES, other)


# Names of one group are compatible with each other. Fixed values.
COMPATIBLE = [
    ["VARCHAR", "NVARCHAR", "TEXT", "STRING", "CHAR", "NCHAR"],
    ["INTEGER", "INT", "SMALLINT", "BIGINT", "NUMBER"],
    ["DECIMAL", "NUMERIC", "NUMBER"],
    ["FLOAT", "REAL", "DOUBLE", "DOUBLE PRECISION"],
    ["TIMESTAMP", "DATETIME", "DATETIME2"],
    ["BYTEA", "VARBINARY", "BINARY", "BLOB", "RAW"],
    ["BOOLEAN", "BIT"],
    ["DATE"],
    ["TIME"],
    ["UUID", "UNIQUEIDENTIFIER"],
]


def compatible(actual: Column, expected: Column) -> Column:
    """Equal names, names of one group, or both of the VARCHAR, DECIMAL or NUMERIC families."""
    a, e = F.upper(F.trim(actual)), F.upper(F.trim(expected))
    groups: dict[str, list[int]] = {}
    for number, names in enumerate(COMPATIBLE):
        for name in names:
            groups.setdefault(name, []).append(number)
    pairs = [x for k, v in groups.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))]
    of = lambda c: F.try_element_at(F.create_map(*pairs), c)
    result = (a == e) | F.coalesce(F.arrays_overlap(of(a), of(e)), F.lit(False))
    for family in ("VARCHAR", "DECIMAL", "NUMERIC"):
        result = result | (a.contains(family) & e.contains(family))
    return result


# --------------------------------------------------------------------------
# JDBC name to tracking strategy. Names the word rules below would misjudge come first.
# Fixed values.

NAMED_STRATEGIES = {
    "YEAR": "timestamp", "IDENTITY": "primary_key", "COUNTER": "primary_key",
    "NUMBER": "hash", "INTERVAL": "hash", "POINT": "hash", "TINYINT(1)": "hash",
}


def strategy_of_type(jdbc_type: Column, scale: Column | None = None) -> Column:
    """Times track by timestamp, integers by key, all else by hash. NUMBER of scale 0 is an integer."""
    name = F.upper(F.trim(jdbc_type))
    rule = (
        F.when(name.rlike("TIMESTAMP|DATE|TIME"), "timestamp")
        .when(name.contains("NUMBER"), "hash")
        .when(name.rlike("INT|SERIAL"), "primary_key")
        .otherwise("hash")
    )
    found = lookup(name, NAMED_STRATEGIES, rule)
    if scale is not None:
        found = F.when((name == "NUMBER") & (scale == 0), "primary_key").otherwise(found)
    return F.coalesce(found, F.lit("hash"))


def strategy_of_name(column: Column) -> Column:
    """A guess from the column's name alone, for callers that have no type at hand.

    It takes `paid_at` for a key, because the name contains `id`; the type is better.
    """
    c = F.lower(column)
    return (
        F.when(c.contains("id"), "primary_key")
        .when(c.rlike("date|time|created|updated|modified"), "timestamp")
        .otherwise("hash")
    )


def spark_schema(fields: list[tuple[str, str, bool]]) -> T.StructType:
    """A StructType from lake fields (name, lake type, required), for use on the driver."""
    result = []
    for name, kind, required in fields:
        text = kind.lower().strip()
        if text.startswith("decimal(") and text.endswith(")"):
            try:
                numbers = [int(x) for x in text[8:-1].split(",", 1)]
                spark = T.DecimalType(numbers[0], numbers[1] if len(numbers) > 1 else 0)
            except ValueError:
                spark = T.DecimalType(10, 0)
        else:
            spark = SIMPLE[LAKE_TO_SPARK.get(text, "string")]
        result.append(T.StructField(name, spark, not required))
    return T.StructType(result)
