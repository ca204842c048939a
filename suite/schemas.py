"""Type mapping, schema comparison and lake schemas over catalogs derived from event rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import new_lake, pick, query, sql_pick, table
from suite.detection import declared, declared_sql
from tablesync.functions import types as names
from tablesync.operators import schemas
from tablesync.operators.catalog import catalog
from tablesync.sources import lake

ENGINES = ["oracle", "sqlserver", "postgresql", "db2"]
PAIRS = [(a, b) for a in ENGINES for b in ENGINES if a != b]
MAPPED_TYPES = ["varchar", "CHAR", "REAL", "NUMERIC", "DECIMAL", "CLOB", "BLOB", "Timestamp", "DATE", "SMALLINT", "NO_SUCH_TYPE"]

# Target name per engine, and the source engines that know the type.
MAPPED_EXPECTED = """
    ('varchar', 'VARCHAR2', 'NVARCHAR', 'VARCHAR', 'VARCHAR', 'sqlserver,postgresql,db2'),
    ('CHAR', 'CHAR', 'CHAR', 'CHAR', 'CHAR', 'oracle,sqlserver,postgresql,db2'),
    ('REAL', 'BINARY_FLOAT', 'REAL', 'REAL', 'REAL', 'sqlserver,postgresql,db2'),
    ('NUMERIC', 'NUMBER', 'NUMERIC', 'NUMERIC', 'DECIMAL', 'sqlserver,postgresql,db2'),
    ('DECIMAL', 'NUMBER', 'DECIMAL', 'NUMERIC', 'DECIMAL', 'sqlserver,postgresql,db2'),
    ('CLOB', 'CLOB', 'NTEXT', 'TEXT', 'CLOB', 'oracle,db2'),
    ('BLOB', 'BLOB', 'VARBINARY', 'BYTEA', 'BLOB', 'oracle,db2'),
    ('Timestamp', 'TIMESTAMP', 'DATETIME2', 'TIMESTAMP', 'TIMESTAMP', 'oracle,postgresql,db2'),
    ('DATE', 'DATE', 'DATE', 'DATE', 'DATE', 'sqlserver,postgresql,db2'),
    ('SMALLINT', 'NUMBER', 'SMALLINT', 'SMALLINT', 'SMALLINT', 'sqlserver,postgresql,db2')
"""
FROM_PAIR = f"{sql_pick([a for a, _ in PAIRS], 'event_id % 12')} AS source_engine, {sql_pick([b for _, b in PAIRS], 'event_id % 12')} AS target_engine"


@query(
    "type_map",
    f"""
    WITH t AS (
      SELECT event_id, {FROM_PAIR}, {sql_pick(MAPPED_TYPES, f'(event_id // 12) % {len(MAPPED_TYPES)}')} AS type FROM events
    )
    SELECT event_id, t.source_engine, t.target_engine, t.type, CASE
      WHEN x.type IS NULL THEN CASE WHEN t.type = 'DATE' AND t.source_engine = 'oracle' THEN if(t.target_engine = 'sqlserver', 'DATETIME2', 'TIMESTAMP') ELSE t.type END
      WHEN t.source_engine = 'sqlserver' AND t.target_engine = 'db2' AND t.type = 'NUMERIC' THEN 'NUMERIC'
      ELSE list_extract([x.oracle, x.sqlserver, x.postgresql, x.db2], list_position(['oracle','sqlserver','postgresql','db2'], t.target_engine)) END AS mapped_type
    FROM t LEFT JOIN (VALUES {MAPPED_EXPECTED}) AS x(type, oracle, sqlserver, postgresql, db2, known)
      ON x.type = t.type AND list_contains(string_split(x.known, ','), t.source_engine)
    """,
)
def type_map(spark, sf):
    """A declared column per event and engine pair, mapped to the target's type names."""
    e = F.col("event_id")
    columns = table(spark, sf, "events").select(
        "event_id", pick([a for a, _ in PAIRS], e % 12).alias("source_engine"),
        pick([b for _, b in PAIRS], e % 12).alias("target_engine"),
        pick(MAPPED_TYPES, F.floor(e / 12) % len(MAPPED_TYPES)).alias("type"),
    )
    return schemas.map_types(columns, names.engine_type_map(spark)).select(
        "event_id", "source_engine", "target_engine", "type", "mapped_type"
    )


@query(
    "pair_check",
    f"""
    SELECT event_id, source_engine, target_engine, source_engine <> target_engine AS is_cross_engine,
      source_engine <> target_engine AND source_engine IN ('oracle','sqlserver','postgresql','db2')
      AND target_engine IN ('oracle','sqlserver','postgresql','db2') AS is_supported
    FROM (SELECT event_id, {sql_pick(ENGINES + ['lake'], 'event_id % 5')} AS source_engine,
                 {sql_pick(ENGINES + ['lake'], '(event_id // 5) % 5')} AS target_engine FROM events)
    """,
)
def pair_check(spark, sf):
    e = F.col("event_id")
    return schemas.pair_check(
        table(spark, sf, "events").select(
            "event_id", pick([*ENGINES, "lake"], e % 5).alias("source_engine"),
            pick([*ENGINES, "lake"], F.floor(e / 5) % 5).alias("target_engine"),
        )
    )


LAKE_INPUTS = ["varchar", "NTEXT", "TINYINT", "BIGINT", "DECIMAL", "NUMBER", " numeric ", "REAL", "DOUBLE PRECISION", "BIT",
               "DATE", "TIMESTAMP WITH TIME ZONE", "TIME", "VARBINARY", "UUID", "XML"]
LAKE_OUTPUTS = ["string", "string", "int", "long", "decimal", "decimal", "decimal", "float", "double", "boolean", "date",
                "timestamptz", "time", "binary", "uuid", None]
SPARK_OUTPUTS = ["string", "string", "int", "bigint", "decimal", "decimal", "decimal", "float", "double", "boolean", "date",
                 "timestamp", "string", "binary", "string", None]


@query(
    "lake_types",
    f"""
    WITH t AS (
      SELECT event_id, {sql_pick(LAKE_OUTPUTS, 'event_id % 16')} AS lake, {sql_pick(SPARK_OUTPUTS, 'event_id % 16')} AS spark,
        CASE WHEN (event_id // 16) % 3 = 0 THEN NULL ELSE 10 END AS p,
        CASE (event_id // 48) % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END AS s,
        (event_id // 144) % 4 AS e FROM events
    ), d AS (
      SELECT *, list_extract([38, 18, 28, 31], e + 1) AS dp, list_extract([0, 0, 6, 0], e + 1) AS ds FROM t
    ), n AS (
      SELECT *, CASE WHEN p IS NOT NULL AND s IS NOT NULL THEN 'decimal(' || p || ',' || s || ')'
        ELSE 'decimal(' || coalesce(nullif(p, 0), dp) || ',' || coalesce(nullif(s, 0), ds) || ')' END AS number FROM d
    )
    SELECT event_id, CASE WHEN lake = 'decimal' THEN number ELSE lake END AS lake_type,
           CASE WHEN spark = 'decimal' THEN number ELSE spark END AS spark_type FROM n
    """,
)
def lake_types(spark, sf):
    """Database type, precision and scale to lake type and on to Spark type."""
    e = F.col("event_id")
    lake_type = names.lake_type(
        pick(LAKE_INPUTS, e % 16), F.when(F.floor(e / 16) % 3 != 0, 10),
        pick([None, 0, 2], F.floor(e / 48) % 3).cast("int"), pick(ENGINES, F.floor(e / 144) % 4),
    )
    return (
        table(spark, sf, "events").select("event_id", lake_type.alias("lake_type"))
        .withColumn("spark_type", F.when(F.col("lake_type").isNotNull(), names.spark_type_name(F.col("lake_type"))))
    )


COMPARED = ["VARCHAR", "nvarchar", "VARCHAR2", "INT", "BIGINT", "NUMBER", "DECIMAL", "NUMERIC", "DECIMAL(10,2)", "REAL",
            "DOUBLE", "DATETIME2", "TIMESTAMP", "DATE", "BIT", "BOOLEAN", "UUID", "RAW", "BLOB"]
GROUPS = """
    ('VARCHAR',1),('NVARCHAR',1),('INT',2),('BIGINT',2),('NUMBER',2),('DECIMAL',3),('NUMERIC',3),('NUMBER',3),('REAL',4),
    ('DOUBLE',4),('TIMESTAMP',5),('DATETIME2',5),('BLOB',6),('RAW',6),('BOOLEAN',7),('BIT',7),('DATE',8),('UUID',10)
"""


@query(
    "type_compatibility",
    f"""
    WITH g(name, n) AS (VALUES {GROUPS}),
    t AS (SELECT event_id, upper({sql_pick(COMPARED, 'event_id % 19')}) AS a, upper({sql_pick(COMPARED, '(event_id // 19) % 19')}) AS b FROM events)
    SELECT event_id, a = b OR EXISTS (SELECT 1 FROM g x, g y WHERE x.name = a AND y.name = b AND x.n = y.n)
      OR (contains(a, 'VARCHAR') AND contains(b, 'VARCHAR')) OR (contains(a, 'DECIMAL') AND contains(b, 'DECIMAL'))
      OR (contains(a, 'NUMERIC') AND contains(b, 'NUMERIC')) AS is_compatible
    FROM t
    """,
)
def type_compatibility(spark, sf):
    e = F.col("event_id")
    fits = names.compatible(pick(COMPARED, e % 19), pick(COMPARED, F.floor(e / 19) % 19))
    return table(spark, sf, "events").select("event_id", fits.alias("is_compatible"))


def versions(spark, sf):
    """A catalog and a later version of it: view columns dropped, click columns retyped, error columns doubled."""
    source = declared(spark, sf)
    kept = source.filter("event_type <> 'view'").withColumn(
        "type", F.when(F.col("event_type") == "click", "string").otherwise(F.col("type"))
    )
    extra = source.filter("event_type = 'error'").withColumn("column_name", F.concat(F.lit("extra_"), "column_name"))
    return source, kept.unionByName(extra)


COMPARE_SQL = f"""
    WITH {declared_sql()}, target AS (
      SELECT table_name, lname AS "column", CASE WHEN event_type = 'click' THEN 'string' ELSE type END AS type FROM declared WHERE event_type <> 'view'
      UNION ALL SELECT table_name, 'extra_' || lname, type FROM declared WHERE event_type = 'error'
    ), names(type, generic, expected) AS (VALUES
      ('bigint','BIGINT','BIGINT'), ('string','VARCHAR','NVARCHAR'), ('timestamp','TIMESTAMP','DATETIME2'), ('int','INTEGER','INT'),
      ('date','DATE','DATE'), ('timestamp_ntz','TIMESTAMP','DATETIME2'), ('double','DOUBLE','DOUBLE')
    ), joined AS (
      SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.lname, t."column") AS "column",
             sn.generic AS source_type, tn.generic AS target_type, sn.expected
      FROM declared s FULL JOIN target t ON s.table_name = t.table_name AND s.lname = t."column"
      LEFT JOIN names sn ON sn.type = s.type LEFT JOIN names tn ON tn.type = t.type
    ), compared AS (
      SELECT table_name, "column", source_type, target_type,
        CASE WHEN source_type IS NOT NULL AND target_type IS NOT NULL THEN expected END AS expected_type,
        CASE WHEN target_type IS NULL THEN 'missing_in_target' WHEN source_type IS NULL THEN 'extra_in_target'
             WHEN NOT (target_type = expected OR (target_type IN ('INTEGER','BIGINT') AND expected IN ('INT','BIGINT'))
               OR (target_type = 'VARCHAR' AND expected = 'NVARCHAR') OR (target_type = 'TIMESTAMP' AND expected = 'DATETIME2'))
             THEN 'type_mismatch' END AS problem
      FROM joined
    )"""


@query(
    "schema_diff",
    f"""{COMPARE_SQL}
    SELECT *, CASE WHEN problem IS NULL THEN 'ok' WHEN problem = 'extra_in_target' THEN 'warning' ELSE 'error' END AS verdict FROM compared
    """,
)
def schema_diff(spark, sf):
    source, target = versions(spark, sf)
    return schemas.compare_schemas(source, target, "postgresql", "sqlserver", names.engine_type_map(spark))


@query(
    "schema_report",
    f"""{COMPARE_SQL}
    SELECT table_name, count(*) FILTER (problem IN ('missing_in_target', 'type_mismatch')) = 0 AS is_compatible,
      count(*) FILTER (problem IN ('missing_in_target', 'type_mismatch')) AS errors,
      count(*) FILTER (problem = 'extra_in_target') AS warnings, count(*) FILTER (problem IS NULL) AS matched,
      coalesce(string_agg(CASE problem WHEN 'missing_in_target' THEN 'ERROR ' || "column" || ': missing in target'
        WHEN 'extra_in_target' THEN 'WARNING ' || "column" || ': only in target'
        WHEN 'type_mismatch' THEN 'ERROR ' || "column" || ': expected ' || expected_type || ', found ' || target_type END, chr(10)
        ORDER BY CASE problem WHEN 'extra_in_target' THEN 'WARNING ' ELSE 'ERROR ' END || "column" || ':') , '') AS report
    FROM compared GROUP BY table_name
    """,
)
def schema_report(spark, sf):
    source, target = versions(spark, sf)
    compared = schemas.compare_schemas(source, target, "postgresql", "sqlserver", names.engine_type_map(spark))
    return schemas.schema_report(compared)


@query(
    "column_difference",
    f"""WITH {declared_sql()}
    SELECT table_name, lname AS "column", 'source' AS side FROM declared WHERE event_type = 'view'
    UNION ALL SELECT table_name, 'extra_' || lname, 'target' FROM declared WHERE event_type = 'error'
    """,
)
def column_difference(spark, sf):
    return schemas.column_difference(*versions(spark, sf))


@query(
    "cast_for_target",
    """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(38,10))::VARCHAR AS price, CAST(o_orderdate AS TIMESTAMP) AS day,
           o_orderstatus, o_custkey, o_orderpriority FROM orders
    """,
)
def cast_for_target(spark, sf):
    """Oracle type names decide the casts: NUMBER to decimal, DATE to timestamp."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.to_date("o_orderdate").alias("day"), "o_orderstatus",
        "o_custkey", "o_orderpriority",
    )
    kinds = {"price": "NUMBER(12,2)", "day": "DATE", "o_orderstatus": "VARCHAR2"}
    cast = schemas.cast_for_target(orders, "oracle", "postgresql", kinds)
    return cast.withColumn("price", F.col("price").cast("string")).withColumn("day", F.col("day").cast("timestamp_ntz"))


FIELD_TYPES = ["long", "string", "timestamp", "decimal(10,2)", "fixed[16]", "geometry", "", None]


@query(
    "lake_schema_problems",
    f"""
    WITH {declared_sql()}, f AS (
      SELECT table_name, CASE event_id % 13 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE ordinal + 1 END AS id,
        CASE WHEN event_id % 17 = 0 THEN '' ELSE column_name END AS name, {sql_pick(FIELD_TYPES, 'event_id % 8')} AS type FROM declared
    ), found AS (
      SELECT table_name, 'error' AS severity, 'id_missing' AS problem, name AS detail FROM f WHERE id IS NULL
      UNION ALL SELECT table_name, 'error', 'name_missing', name FROM f WHERE name = ''
      UNION ALL SELECT table_name, 'error', 'type_missing', name FROM f WHERE coalesce(type, '') = ''
      UNION ALL SELECT table_name, 'warning', 'type_unsupported', name FROM f WHERE type = 'geometry'
      UNION ALL SELECT table_name, 'error', 'id_repeated', CAST(id AS VARCHAR) FROM f WHERE id IS NOT NULL GROUP BY table_name, id HAVING count(*) > 1
      UNION ALL SELECT table_name, 'error', 'name_repeated', lower(name) FROM f WHERE name <> '' GROUP BY table_name, lower(name) HAVING count(*) > 1
      UNION ALL SELECT DISTINCT table_name, 'error', 'identifier_unknown', '2' FROM f WHERE table_name NOT IN (SELECT table_name FROM f WHERE id = 2)
    ) SELECT * FROM found
    """,
)
def lake_schema_problems(spark, sf):
    """Faulty lake schemas: missing and repeated ids and names, unknown types and identifiers."""
    e = F.col("event_id")
    fields = declared(spark, sf).select(
        "table_name",
        F.when(e % 13 == 0, None).when(e % 13 == 1, 1).otherwise(F.col("ordinal") + 1).alias("id"),
        F.when(e % 17 == 0, "").otherwise(F.col("column_name")).alias("name"),
        pick(FIELD_TYPES, e % 8).alias("type"),
    )
    identifiers = fields.select("table_name", F.lit(2).alias("id")).distinct()
    return schemas.field_problems(fields, identifiers)


@query(
    "lake_fields",
    f"""
    WITH {declared_sql(["BIGINT", "VARCHAR", "TIMESTAMP", "INTEGER", "DATE", "NUMBER", "BIT"])}, first_column AS (
      SELECT table_name, column_name AS mark FROM declared WHERE ordinal = 0
    )
    SELECT table_name, CAST(ordinal + 1 AS INT) AS id, column_name AS name, lname = lower(mark) AS is_identifier,
      CASE type WHEN 'BIGINT' THEN 'long' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'INTEGER' THEN 'int'
        WHEN 'DATE' THEN 'date' WHEN 'NUMBER' THEN 'decimal(38,0)' ELSE 'boolean' END AS type, FALSE AS required
    FROM declared JOIN first_column USING (table_name)
    """,
)
def lake_fields(spark, sf):
    """Lake schemas from database columns; the bookmark column becomes the identifier."""
    columns = declared(spark, sf, ["BIGINT", "VARCHAR", "TIMESTAMP", "INTEGER", "DATE", "NUMBER", "BIT"])
    marks = columns.filter("ordinal = 0").select("table_name", F.upper("column_name").alias("column"))
    typed = columns.select(
        "table_name", "ordinal", "column_name", "type", "nullable", F.lit(None).cast("int").alias("precision"),
        F.lit(None).cast("int").alias("scale"), F.lit("oracle").alias("engine"),
    )
    return schemas.lake_fields(typed, marks)


@query("create_from_source_schema", "SELECT * FROM orders")
def create_from_source_schema(spark, sf):
    """The lake schema is built from database column metadata, the table created from it, then filled."""
    orders, home = table(spark, sf, "orders"), new_lake(spark, "ddl")
    columns = catalog(spark, {"orders": orders.schema}).select(
        "table_name", "ordinal", "column_name", names.generic_name(F.col("type")).alias("type"), "nullable",
        F.lit(None).cast("int").alias("precision"), F.lit(None).cast("int").alias("scale"), F.lit("postgresql").alias("engine"),
    )
    schema = schemas.lake_schema(schemas.lake_fields(columns), "orders")
    lake.create_if_missing(spark, home, "orders", schema, identifier_columns=["o_orderkey"])
    lake.write(orders, home, "orders", "append")
    got = lake.read(spark, home, "orders")
    return got.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
