import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import types as names
from tablesync.operators import detect
from tablesync.operators.catalog import catalog


def schema(**columns):
    kinds = {
        "int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "ts": T.TimestampType(),
        "ntz": T.TimestampNTZType(), "date": T.DateType(), "double": T.DoubleType(), "short": T.ShortType(),
    }
    return T.StructType([T.StructField(n, kinds[k]) for n, k in columns.items()])


TABLES = {
    "updated": (schema(id="int", name="string", updated_at="ts", created_at="ts"), ("timestamp", "updated_at", 10)),
    "key": (schema(id="long", name="string", description="string"), ("primary_key", "id", 9)),
    "none": (schema(name="string", description="string", category="string"), ("hash", None, 0)),
    "dates": (schema(id="int", name="string", last_modified_date="date", creation_date="date"), ("timestamp", "last_modified_date", 10)),
    "key_over_created": (schema(id="long", created_at="ts"), ("primary_key", "id", 9)),
    "two_keys": (schema(name="string", b_id="long", a_id="long"), ("primary_key", "b_id", 9)),
    "ntz": (schema(amount="long", ts="ntz"), ("timestamp", "ts", 5)),
    "tie": (schema(order_key="long", created_at="ts"), ("timestamp", "created_at", 8)),
    "short": (schema(id="short"), ("hash", None, 0)),
}


def test_detection(spark):
    got = detect.detect_strategies(catalog(spark, {t: s for t, (s, _) in TABLES.items()}))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {t: e for t, (_, e) in TABLES.items()}


def test_strict_detection_ignores_times_without_zone(spark):
    got = detect.detect_strategies(catalog(spark, {"ntz": TABLES["ntz"][0]}), strict=True).first()
    assert (got["strategy"], got["column"], got["confidence_tenths"]) == ("primary_key", "amount", 3)


def test_metadata_detection_and_overrides(spark):
    rows = [
        ("a", 0, "ID", "BIGINT", True, True), ("a", 1, "created_at", "TIMESTAMP", True, False), ("a", 2, "last_updated", "DATETIME2", True, False),
        ("b", 0, "code", "VARCHAR", False, True), ("b", 1, "row_id", "INT", True, False),
        ("c", 0, "x_seq", "SERIAL", True, False), ("c", 1, "x_id", "INT4", True, False),
        ("d", 0, "note", "TEXT", True, False), ("d", 1, "born", "DATE", True, False),
    ]
    columns = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, type string, nullable boolean, is_pk boolean")
    got = {r[0]: tuple(r)[1:] for r in detect.detect_from_metadata(columns).collect()}
    assert got == {"a": ("timestamp", "last_updated"), "b": ("primary_key", "code"), "c": ("primary_key", "x_id"), "d": ("hash", None)}
    manual = spark.createDataFrame([("a", "id"), ("d", "BORN"), ("c", "gone")], "table_name string, column_name string")
    got = {r[0]: tuple(r)[1:] for r in detect.resolve(columns, manual).collect()}
    assert got["a"] == ("primary_key", "ID", True)
    assert got["d"] == ("timestamp", "born", True)
    assert got["c"] == ("primary_key", "x_id", False)


def test_lake_fallback_order(spark):
    tables = {
        "named": schema(id="long", updated_at="ts", name="string", value="double"),
        "pattern_before_column": schema(created_at="ts", updated_at="ts"),
        "key": schema(ts="ts", order_id="long"),
        "any_time": schema(amount="long", ts="ts"),
        "any_int": schema(name="string", amount="int"),
        "nothing": schema(name="string", born="date"),
    }
    got = {r["table_name"]: r["column"] for r in detect.lake_fallback(catalog(spark, tables)).collect()}
    assert got == {
        "named": "updated_at", "pattern_before_column": "updated_at", "key": "order_id", "any_time": "ts",
        "any_int": "amount", "nothing": None,
    }


def test_identifiers(spark):
    columns = catalog(spark, {"t": schema(id="long", updated_at="ts"), "u": schema(id="long")})
    tables = spark.createDataFrame([("t", "x, 2 ,1"), ("u", "7"), ("v", "")], "table_name string, identifier_field_ids string")
    got = {r["table_name"]: r["column"] for r in detect.identifier_columns(tables, columns).collect()}
    assert got == {"t": "updated_at", "u": None, "v": None}


def test_manual_configuration(spark):
    texts = {
        "short": '{"employees":"updated_at","orders":"order_id"}',
        "long": '{"employees":{"table_name":"employees","column_name":"updated_at"}}',
        "one bad": '{"employees":"updated_at","orders":"1st"}',
        "array": "[]", "null": "null", "empty": "", "broken": "{", "none": "{}",
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    parsed = detect.parse_manual(df, "name", "text")
    reasons = {(r["name"], r["table_key"]): r["reason"] for r in parsed.collect()}
    assert reasons["short", "orders"] is None and reasons["one bad", "orders"] == "column_name_invalid"
    assert reasons["array", None] == "not_an_object" and reasons["broken", None] == "not_json"
    kept = {r["name"] for r in detect.manual_settings(parsed, "name").collect()}
    assert kept == {"short", "long"}


@pytest.mark.parametrize(
    "source, target, name, expected",
    [
        ("postgresql", "oracle", "VARCHAR", "VARCHAR2"), ("postgresql", "oracle", "TIMESTAMP", "TIMESTAMP"),
        ("oracle", "postgresql", "NUMBER", "NUMERIC"), ("oracle", "postgresql", "VARCHAR2", "VARCHAR"),
        ("oracle", "postgresql", "DATE", "TIMESTAMP"), ("sqlserver", "db2", "NUMERIC", "NUMERIC"),
        ("sqlserver", "postgresql", "NUMERIC", "NUMERIC"), ("postgresql", "db2", "NUMERIC", "DECIMAL"),
        ("sqlserver", "oracle", "NTEXT", "NCLOB"), ("db2", "sqlserver", "VARGRAPHIC", "NVARCHAR"),
        ("db2", "oracle", "VARBINARY", "RAW"), ("postgresql", "sqlserver", "JSONB", "NTEXT"),
        ("oracle", "db2", "LONG RAW", "BLOB"), ("sqlserver", "postgresql", "UNIQUEIDENTIFIER", "UUID"),
    ],
)
def test_engine_types(spark, source, target, name, expected):
    found = names.engine_type_map(spark).filter(
        f"source_engine = '{source}' and target_engine = '{target}' and source_type = '{name}'"
    )
    assert [r["target_type"] for r in found.collect()] == [expected]


def test_engine_map_is_complete(spark):
    per = {tuple(r)[:2]: r["count"] for r in names.engine_type_map(spark).groupBy("source_engine", "target_engine").count().collect()}
    assert len(per) == 12
    assert {a: n for (a, _), n in per.items()} == {"oracle": 15, "sqlserver": 24, "postgresql": 18, "db2": 17}


def test_lake_types(spark):
    rows = [
        ("VARCHAR", 255, 0, "oracle", "string"), ("INTEGER", 10, 0, "oracle", "int"), ("BIGINT", 0, 0, "db2", "long"),
        ("DECIMAL", 10, 2, "oracle", "decimal(10,2)"), ("NUMERIC", 18, 4, "oracle", "decimal(18,4)"),
        ("NUMBER", 38, 0, "postgresql", "decimal(38,0)"), ("NUMBER", None, None, "sqlserver", "decimal(18,0)"),
        ("NUMERIC", 10, None, "postgresql", "decimal(10,6)"), ("NUMERIC", 10, 0, "postgresql", "decimal(10,0)"),
        ("DECIMAL", None, None, "unknown", "decimal(28,6)"), ("GEOMETRY", None, None, "oracle", None),
        ("TIMESTAMP WITH TIME ZONE", 0, 0, "oracle", "timestamptz"), ("BIT", 1, 0, "sqlserver", "boolean"),
    ]
    df = spark.createDataFrame(rows, "t string, p int, s int, e string, expected string")
    from pyspark.sql import functions as F

    got = df.select("expected", names.lake_type(F.col("t"), F.col("p"), F.col("s"), F.col("e")).alias("got"))
    assert [r for r in got.collect() if r["expected"] != r["got"]] == []


def test_spark_schema_of_lake_fields():
    got = names.spark_schema([("id", "long", True), ("t", "time", False), ("d", "decimal(12, 3)", False), ("x", "decimal(a)", False), ("w", "what", False)])
    assert [f.dataType.simpleString() for f in got] == ["bigint", "string", "decimal(12,3)", "decimal(10,0)", "string"]
    assert not got["id"].nullable


def test_strategies_of_typed_columns(spark):
    kinds = {
        "decimal(38,0)": "primary_key", "decimal(10)": "primary_key", "decimal(12,2)": "hash", "NUMBER(9,0)": "primary_key",
        "bigint": "primary_key", "date": "timestamp", "string": "hash",
    }
    df = spark.createDataFrame([(k,) for k in kinds], "k string").select("k", detect.typed_strategy(F.col("k")).alias("s"))
    assert {r["k"]: r["s"] for r in df.collect()} == kinds
