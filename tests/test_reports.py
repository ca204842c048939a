from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.functions import text
from tablesync.operators import bookmarks, runlog, schemas
from tablesync.functions import types as names
from tablesync.operators.catalog import catalog
from tablesync.operators import draw
from tablesync.sources import exports
from tablesync.sources.logs import read_log

NOW = datetime(2024, 6, 1, 12)


def column(spark, values, kind, f):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(f(F.col("v"))).collect()]


def test_error_categories(spark):
    cases = {
        "Connection refused": "connection", "access denied": "authentication", "connection timed out": "connection",
        "query timeout": "timeout", "something else": "unknown", "connection timeout": "network",
        "Access Forbidden": "permission", "duplicate key": "data_processing", "unknown column x": "schema_mismatch",
        "java heap: out of memory": "resource", "unauthorized": "authentication", "read timeout": "network",
    }
    assert column(spark, list(cases), "string", runlog.error_category) == list(cases.values())


def test_every_word_hits_its_list_or_an_earlier_one(spark):
    words = [(w, c) for c, ws in runlog.ERROR_WORDS.items() for w in ws]
    order = list(runlog.ERROR_WORDS)
    got = column(spark, [w for w, _ in words], "string", runlog.error_category)
    assert all(order.index(g) <= order.index(c) for g, (_, c) in zip(got, words))


def test_classes(spark):
    df = spark.createDataFrame([("login failed",), ("disk full",), (None,)], "message string")
    got = [tuple(r)[1:] for r in runlog.classify_errors(df).collect()]
    assert got == [
        ("authentication", False, "fail_immediately", True), ("resource", True, "retry_with_longer_delay", False),
        ("unknown", False, "retry_with_backoff", False),
    ]


def test_log_lines(spark, folder):
    lines = ["Job done | job_name=a | rows=12 | note=x=y", "plain", "twice | k=1 | k=2 | odd", "Processed | processed 77 records"]
    spark.createDataFrame([(s,) for s in lines], "value string").coalesce(1).write.text(f"{folder}/log")
    got = {r["message"]: r["fields"] for r in read_log(spark, f"{folder}/log").collect()}
    assert got["Job done"] == {"job_name": "a", "rows": "12", "note": "x=y"}
    assert got["plain"] == {} and got["twice"] == {"k": "2"}
    number = column(spark, ["processed 77 records", "processed many records", "processed 5 records|"], "string", lambda c: runlog.number_between(c, "processed", "records"))
    assert number == [77, None, 5]


def test_text_helpers(spark):
    assert column(spark, [" my job!! (x) ", "a..b_c"], "string", text.key_part) == ["my-job-x", "a..b_c"]
    assert column(spark, ["s3://my-bucket/x.jar", "s3://Bad/x", "s3://ab/x", "/x", None, "s3://a.b-c"], "string", text.bucket_name) == [
        "my-bucket", None, None, None, None, "a.b-c"
    ]
    assert column(spark, ["a;Password='x y';b", "PWD=1 c", "jdbc://u:p@h/d", "https://a.example/page for notes: a sentence, write to b@c.example"], "string", text.redact) == [
        "a;password=***;b", "pwd=*** c", "jdbc://***:***@h/d", "https://a.example/page for notes: a sentence, write to b@c.example"
    ]
    parsed = column(
        spark, ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05.5", "2024-01-02", "x", "2024-1-2", None],
        "string", lambda c: F.unix_seconds(text.parse_iso(c)),
    )
    noon = 1704164645
    assert parsed == [noon, noon - 7200, noon, 1704153600, None, None, None]
    keys = spark.createDataFrame([("j b", "t"), (" ", "t")], "j string, t string").select(text.bookmark_key(F.col("j"), F.col("t")))
    assert [r[0] for r in keys.collect()] == ["bookmarks/j-b/t.json", None]


def test_rates_and_summary(spark):
    log = spark.createDataFrame(
        [("j", "full", "completed", 0, 0, 0, 0.0), ("j", "incremental", "completed", 0, 0, 0, 1.0),
         ("j", "incremental", "failed", 5, 0, 0, 1.0), ("j", "full", "completed", 30, 40, 3 * 1048576, 2.0)],
        "job_name string, mode string, status string, rows int, total_rows int, bytes int, seconds double",
    )
    rates = [(r["rows_per_second"], r["mb_per_second"], r["progress_percent"]) for r in runlog.table_rates(log).collect()]
    assert rates == [(0, 0, 0), (0, 0, 100), (5, 0, 0), (15, 1.5, 75)]
    row = runlog.job_summary(log).first()
    assert (row["tables"], row["succeeded"], row["failed"], row["rows"], row["success_percent"]) == (4, 3, 1, 30, 75.0)


def test_alarms_and_trend(spark):
    values = [90.0, 80.0, 90.0, 95.0, 99.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "period int, value double")
    got = [r["alarm"] for r in runlog.alarms(df, 85, 2).orderBy("period").collect()]
    assert got == [False, False, False, True, True]
    verdicts = [r["verdict"] for r in runlog.trend(df).orderBy("period").collect()]
    assert verdicts == ["stable", "improving", "degrading", "degrading", "degrading"]


def test_bookmark_checks(spark):
    base = {f.name: None for f in bookmarks.BOOKMARK_SCHEMA.fields}
    good = {**base, "table_name": "t", "incremental_strategy": "timestamp", "incremental_column": "ts",
            "created_timestamp": "2024-01-01T00:00:00", "updated_timestamp": "2024-01-02T00:00:00Z"}
    cases = [
        (good, []), ({**good, "table_name": None}, ["table_name_missing", "other_table"]),
        ({**good, "incremental_strategy": "x"}, ["strategy_unknown"]), ({**good, "incremental_column": None}, ["column_missing"]),
        ({**good, "incremental_strategy": "hash", "incremental_column": None}, []),
        ({**good, "updated_timestamp": "2024"}, ["updated_timestamp_too_short", "updated_timestamp_unreadable"]),
        ({**good, "updated_timestamp": "2024-06-01T12:59:00Z"}, []), ({**good, "updated_timestamp": "2024-06-01T13:01:00Z"}, ["updated_timestamp_in_future"]),
        ({**good, "created_timestamp": "2024-02-01"}, ["created_after_updated"]),
        ({**good, "last_processed_value": "x" * 10001}, ["text_too_long"]), ({**good, "last_processed_value": "x" * 10000}, []),
        ({**good, "s3_key": "a\x00"}, ["control_characters"]), ({**good, "s3_key": "a\tb\n"}, []),
        ({**good, "manual_column_data_type": " "}, ["manual_type_blank"]), ({**good, "table_name": "u"}, ["other_table"]),
    ]
    df = spark.createDataFrame([tuple(c.values()) for c, _ in cases], bookmarks.BOOKMARK_SCHEMA)
    got = bookmarks.check(df, F.lit("t"), F.lit(NOW).cast("timestamp")).collect()
    assert [r["reasons"] for r in got] == [r for _, r in cases]


def test_schema_comparison(spark):
    source = catalog(spark, {"t": spark.createDataFrame([], "Id int, name string, price double, gone date").schema})
    target = catalog(spark, {"t": spark.createDataFrame([], "ID bigint, name binary, price float, more string").schema})
    compared = schemas.compare_schemas(source, target, "sqlserver", "postgresql", names.engine_type_map(spark))
    got = {r["column"]: (r["verdict"], r["problem"]) for r in compared.collect()}
    assert got == {
        "id": ("ok", None), "name": ("error", "type_mismatch"), "price": ("ok", None),
        "gone": ("error", "missing_in_target"), "more": ("warning", "extra_in_target"),
    }
    report = schemas.schema_report(compared).first()
    assert not report["is_compatible"] and (report["errors"], report["warnings"]) == (2, 1)
    assert "ERROR gone: missing in target" in report["report"]
    assert schemas.pair_supported("Oracle", "db2") and not schemas.pair_supported("db2", "db2")


def test_casts_follow_source_types(spark):
    df = spark.sql("select 1 as flag, 'x' as id, 2.5D as n, date'2024-01-02' as d")
    got = schemas.cast_for_target(df, "oracle", "postgresql", {"N": "NUMBER", "d": "DATE", "id": "VARCHAR2"})
    assert [t for _, t in got.dtypes] == ["int", "string", "decimal(38,10)", "timestamp"]
    bits = schemas.cast_for_target(df, "sqlserver", "postgresql", {"flag": "BIT"})
    assert dict(bits.dtypes)["flag"] == "boolean"
    assert schemas.cast_for_target(df, "oracle", "oracle", {"n": "NUMBER"}) is df


def test_lake_schema_building(spark):
    rows = [
        ("t", 0, "id", "INTEGER", False, 10, 0), ("t", 1, "name", "VARCHAR", True, 255, 0), ("t", 2, "created_at", "TIMESTAMP", True, 0, 0),
        ("t", 3, "amount", "DECIMAL", True, 10, 2), ("t", 4, "is_active", "BOOLEAN", True, 0, 0),
    ]
    columns = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, type string, nullable boolean, precision int, scale int").withColumn("engine", F.lit("postgresql"))
    marks = spark.createDataFrame([("t", "ID")], "table_name string, column string")
    fields = schemas.lake_fields(columns, marks)
    got = [(r["id"], r["type"], r["required"], r["is_identifier"]) for r in fields.orderBy("id").collect()]
    assert got == [(1, "int", True, True), (2, "string", False, False), (3, "timestamp", False, False), (4, "decimal(10,2)", False, False), (5, "boolean", False, False)]
    assert [f.dataType.simpleString() for f in schemas.lake_schema(fields, "t")] == ["int", "string", "timestamp", "decimal(10,2)", "boolean"]
    bad = fields.withColumn("type", F.lit(None).cast("string"))
    with pytest.raises(TypeError):
        schemas.lake_schema(bad, "t")
    problems = schemas.field_problems(
        spark.createDataFrame([("t", 1, "a", "long"), ("t", 1, "A", "geo"), ("t", None, "", None)], "table_name string, id int, name string, type string"),
        spark.createDataFrame([("t", 9)], "table_name string, id int"),
    )
    assert sorted((r["severity"], r["problem"]) for r in problems.collect()) == [
        ("error", "id_missing"), ("error", "id_repeated"), ("error", "identifier_unknown"), ("error", "name_missing"),
        ("error", "name_repeated"), ("error", "type_missing"), ("warning", "type_unsupported"),
    ]


# --------------------------------------------------------------------------
# draws and exports


def test_drawn_share(spark):
    df = spark.range(1000).withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1 << 60)))
    taken = draw.drawn_share(df, 0.1, F.col("draw"))
    assert taken.count() == 100 and taken.agg(F.max("draw")).first()[0] == sorted(r["draw"] for r in df.collect())[99]
    assert draw.drawn_share(df.limit(3), 0.1, F.col("draw")).count() == 1


def test_exports(spark, folder):
    df = spark.createDataFrame(
        [(1, "it's", None, True, NOW), (2, None, 1.5, False, None)], "id int, s string, x double, b boolean, t timestamp_ntz"
    )
    got = [r[0] for r in exports.insert_statements(df, "t").collect()]
    assert got == [
        "INSERT INTO t (id, s, x, b, t) VALUES (1, 'it''s', NULL, TRUE, '2024-06-01T12:00:00');",
        "INSERT INTO t (id, s, x, b, t) VALUES (2, NULL, 1.5, FALSE, NULL);",
    ]
    exports.to_csv(df.coalesce(1), f"{folder}/csv")
    assert [r[0] for r in spark.read.text(f"{folder}/csv").collect()] == ["id,s,x,b,t", "1,it's,,true,2024-06-01T12:00:00", "2,,1.5,false,"]
    exports.to_json(df.coalesce(1), f"{folder}/json")
    assert spark.read.text(f"{folder}/json").first()[0] == '{"id":1,"s":"it\'s","x":null,"b":true,"t":"2024-06-01T12:00:00"}'
    exports.to_sql(df, "t", f"{folder}/sql")
    assert spark.read.text(f"{folder}/sql").count() == 2


def test_lines_with_very_many_fields(spark):
    import time

    line = "start" + "".join(f" | k{i % 9000}={i}" for i in range(10_000)) + " | k1=last=1 | no pair"
    df = spark.createDataFrame([(line,), ("only",), (None,), (" | =x | a=",)], "line string")
    started = time.monotonic()
    got = [(r["message"], r["fields"]) for r in runlog.parse_lines(df).collect()]
    assert time.monotonic() - started < 30
    want = {f"k{i % 9000}": str(i) for i in range(10_000)} | {"k1": "last=1"}
    assert got[0] == ("start", want)
    assert runlog.parse_lines(df).select(F.map_keys("fields").alias("k")).first()["k"][-1] == "k1"  # in the order of the line
    assert got[1] == ("only", {}) and got[3] == ("", {"": "x", "a": ""})


def test_passwords_with_slashes_and_signs(spark):
    found = column(spark, ["://u:p/w@h/d", "a://u:p@w@h b@c", "x://h:8080/p@q", "'y://u:p' z@h", "s://u@h:1/2"], "string", text.redact)
    assert found == ["://***:***@h/d", "a://***:***@h b@c", "x://h:8080/p@q", "'y://u:p' z@h", "s://u@h:1/2"]


def test_distinct_counts_of_many_columns(spark):
    from tablesync.operators.profile import distinct_counts, profile_columns

    df = spark.sql("select id % 7 as a, if(id % 3 = 0, null, id) as b, cast(id % 2 as double) * -0.0 as c, array(id % 4) as d, 'x' as e from range(100)")
    got = {r["column"]: r["distinct"] for r in distinct_counts(df, df.columns).collect()}
    assert got == {"a": 7, "b": 66, "c": 1, "d": 4, "e": 1}
    assert {r["column"]: r["distinct"] for r in distinct_counts(df.limit(0), ["a", "b"]).collect()} == {"a": 0, "b": 0}
    plan = profile_columns(df, keys=["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_profiles_of_loads_merge(spark):
    from tablesync.operators import profile

    df = spark.sql("select id as k, cast(id % 7 as string) as s, if(id % 2 = 0, null, timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))) as t from range(9, 2000)")
    parts = [profile.sketched_profile(df.filter(f"k % 3 = {i}"), ["t"], ["k", "s"]) for i in range(3)] + [profile.sketched_profile(df.limit(0), ["t"], ["k", "s"])]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = {r["column"]: r for r in profile.judged_profile(profile.merged_profiles(stored)).collect()}
    want = {r["column"]: r for r in profile.profile_columns(df, ["t"], ["k", "s"]).collect()}
    for c, r in want.items():
        assert (got[c]["total"], got[c]["low"], got[c]["high"], got[c]["is_valid"]) == (r["total"], r["low"], r["high"], r["is_valid"])
        assert abs(got[c]["usable"] - r["usable"]) <= 0.03 * r["usable"]
    # 9 comes before 10 as a number, and a second merge changes nothing.
    assert got["k"]["low"] == "9"
    once = profile.merged_profiles(stored)
    twice = {r["column"]: r for r in profile.judged_profile(profile.merged_profiles(once)).collect()}
    assert twice == got
