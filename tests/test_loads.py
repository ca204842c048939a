from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from suite import stores
from tablesync.operators import repair
from tablesync.operators.bookmarks import Bookmark, BookmarkStore, bucket_of, check, latest
from tablesync.operators.fingerprint import change_split, checkpoint_text, table_fingerprint
from tablesync.plans import loads, runner
from tablesync.plans.loads import Job, TableSpec
from tablesync.sources import endpoints, jdbc, lake
from tablesync.sources.files import Files
from tablesync.sources.jdbc import Jdbc
from tablesync.sources.lake import Lake
from tablesync.streaming import batches

SPEC = TableSpec("t", "primary_key", "id")


def frame(spark, low, high):
    return spark.range(low, high).select("id", F.concat(F.lit("n"), "id").alias("name"))


@pytest.fixture()
def job(folder):
    return Job("j", Lake(f"{folder}/source"), Lake(f"{folder}/target"), BookmarkStore(f"{folder}/bookmarks"))


def target(spark, job):
    return sorted(r["id"] for r in lake.read(spark, job.target, "t").collect())


def one(spark, job, spec=SPEC):
    return runner.run(spark, job, [spec], raise_on_failure=True)[0]


def test_full_then_increments_equal_the_source(spark, job):
    lake.write(frame(spark, 0, 10), job.source, "t", "append")
    assert (one(spark, job).mode, one(spark, job).rows) == ("full", 0)
    for low, high in ((10, 13), (13, 20)):
        lake.write(frame(spark, low, high), job.source, "t", "append")
        done = one(spark, job)
        assert (done.mode, done.rows, done.watermark) == ("incremental", high - low, str(high - 1))
    assert target(spark, job) == list(range(20))
    snapshot = lake.state(spark, job.target, "t").snapshot
    assert one(spark, job).rows == 0
    assert lake.state(spark, job.target, "t").snapshot == snapshot


def test_failed_write_keeps_bookmark_and_target(spark, job):
    lake.write(frame(spark, 0, 5), job.source, "t", "append")
    one(spark, job)
    more = frame(spark, 5, 8).withColumn("extra", F.lit(1))
    lake.add_column(spark, job.source, "t", "extra", "int")
    lake.write(more, job.source, "t", "append")
    result = runner.run(spark, job, [SPEC])[0]
    assert result.status == "failed" and "extra" in result.error
    assert target(spark, job) == [0, 1, 2, 3, 4]
    assert job.store.get(spark, "j", ["t"])["t"].value == "4"
    with pytest.raises(runner.RunFailed):
        one(spark, job)


def test_reset_and_corrupt_bookmarks_load_everything(spark, job):
    lake.write(frame(spark, 0, 5), job.source, "t", "append")
    one(spark, job)
    job.store.reset(spark, "j", ["t"])
    assert one(spark, job).mode == "full"
    job.store.put(spark, "j", [Bookmark("t", "weekly", "id", "2", first_run=False)])
    assert one(spark, job).mode == "full"
    assert target(spark, job) == [0, 1, 2, 3, 4]
    assert job.store.fold(spark) == 5
    assert job.store.get(spark, "j", ["t"])["t"].value == "4"


def test_lost_target_is_loaded_in_full(spark, job):
    lake.write(frame(spark, 0, 4), job.source, "t", "append")
    one(spark, job)
    moved = Job(job.name, job.source, Lake(job.target.root + "-new"), job.store)
    assert one(spark, moved).mode == "full"
    assert target(spark, moved) == [0, 1, 2, 3]


def test_zero_is_a_bookmark(spark, job):
    lake.write(frame(spark, 0, 1), job.source, "t", "append")
    one(spark, job)
    lake.write(frame(spark, 1, 3), job.source, "t", "append")
    done = one(spark, job)
    assert (done.mode, done.rows) == ("incremental", 2)


def test_hash_strategy(spark, job):
    spec = TableSpec("t", "hash")
    lake.write(frame(spark, 0, 5), job.source, "t", "append")
    assert one(spark, job, spec).rows == 5
    stored = job.store.get(spark, "j", ["t"])["t"].checkpoint
    assert stored == checkpoint_text(frame(spark, 0, 5).repartition(3))
    assert one(spark, job, spec).status == "skipped"
    lake.write(frame(spark, 0, 4), job.source, "t", "overwrite")
    assert one(spark, job, spec).rows == 4
    assert target(spark, job) == [0, 1, 2, 3]


def test_batches_and_tiers(spark, job):
    lake.write(frame(spark, 0, 5), job.source, "t", "append")
    one(spark, job)
    lake.write(frame(spark, 5, 30), job.source, "t", "append")
    known = job.store.get(spark, "j", ["t"])["t"]
    tier, done = batches.tiered_load(spark, job, SPEC, known, direct_below=5, staging_up_to=10, batch_rows=10)
    assert (tier, done.rows, done.watermark) == ("batches", 25, "29")
    assert target(spark, job) == list(range(30))
    assert len(lake.state(spark, job.target, "t").segments) == 4


def test_recovery(spark, job):
    lake.write(frame(spark, 0, 10), job.source, "t", "append")
    one(spark, job)
    job.store.put(spark, "j", [Bookmark("t", "primary_key", "id", "4", first_run=False)])
    assert repair.recover(spark, job, SPEC) == "advanced"
    assert job.store.get(spark, "j", ["t"])["t"].value == "9"
    assert repair.recover(spark, job, SPEC) == "consistent"
    lake.write(frame(spark, 10, 12), job.source, "t", "append")
    # The task that wrote row 10 was lost, the one that wrote row 11 was not.
    lake.write(frame(spark, 11, 12), job.target, "t", "append")
    assert repair.recover(spark, job, SPEC) == "trimmed"
    assert one(spark, job).rows == 2
    assert target(spark, job) == list(range(12))


def test_batches_of_every_key_type(spark, folder):
    """Keys without a whole-number order load in the same batches' worth of rows as others."""
    for kind in ("decimal(38,0)", "decimal(12,2)", "string", "bigint"):
        value = "lpad(cast(id as string), 6, '0')" if kind == "string" else f"cast(id as {kind})"
        rows = spark.range(1000).selectExpr(f"{value} AS k", "id AS v").union(spark.createDataFrame([(None, -1)], "k string, v long").selectExpr(f"cast(k as {kind})", "v"))
        found = list(batches.plan_batches(rows, "k", 250))
        assert sum(b.rows for b in found) == 1000 and 3 <= len(found) <= 6 and found[0].low is None, kind
        source, target = Lake(f"{folder}/{kind}/s"), Lake(f"{folder}/{kind}/t")
        lake.write(rows, source, "t", "create")
        job, spec = Job("b", source, target, BookmarkStore(f"{folder}/{kind}/b")), TableSpec("t", "primary_key", "k")
        start = "000099" if kind == "string" else "99"
        lake.write(rows.filter(F.col("v") <= 99), target, "t", "create", watermark="k")
        done = batches.load_in_batches(spark, job, spec, loads.next_bookmark(spec, None, start, 0), 300)
        assert done.rows == 900 and lake.read(spark, target, "t").filter("v >= 0").agg(F.count("*"), F.sum("v")).first()[:] == (1000, 499500), kind
        assert len(lake.state(spark, target, "t").segments) >= 3


def test_upper_end_and_missing_tables_without_a_database(spark):
    rows = spark.createDataFrame([(1,), (5,), (None,)], "k long")
    assert sorted(r["k"] or 0 for r in loads.up_to(rows, "k", "3").collect()) == [0, 1]
    assert loads.up_to(rows, "k", None).count() == 3
    for text in ("ORA-00942: table or view does not exist", 'ERROR: relation "x" does not exist', "Invalid object name 'x'.", "SQLCODE=-204, SQLSTATE=42704"):
        assert jdbc.says_missing(text)
    assert not jdbc.says_missing("Connection refused") and not jdbc.says_missing("FATAL: password authentication failed")


def test_missing_table_fails_alone(spark, job, data):
    files = Job("f", Files(data), job.target, job.store)
    specs = runner.detect_specs(spark, files, ["region", "gone", "orders"], manual={"orders": "O_ORDERKEY"})
    assert [(s.strategy, s.column) for s in specs] == [("primary_key", "r_regionkey"), ("full_load", None), ("primary_key", "o_orderkey")]
    log = runner.run_log(spark, runner.run(spark, files, specs))
    assert {r["table_name"]: r["status"] for r in log.collect()} == {"region": "completed", "gone": "failed", "orders": "completed"}
    assert tuple(runner.run_totals(log).first())[1:4] == (3, 2, 1)


def test_fingerprint_ignores_order_and_tells_null_from_empty(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "y")], "id int, a string, b string")
    b = a.orderBy(F.desc("id")).repartition(3)
    assert table_fingerprint(a).first() == table_fingerprint(b).first()
    c = spark.createDataFrame([(1, "x", ""), (2, "y", None)], "id int, a string, b string")
    assert table_fingerprint(a).first() != table_fingerprint(c).first()
    assert tuple(table_fingerprint(a.limit(0)).first()) == (0, 0)


def test_change_split_counts_repeats(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (4, "e"), (4, "e")], "k int, v string")
    got = {r["k"]: r["change"] for r in change_split(old, new, ["k"]).collect()}
    assert got == {1: "same", 2: "update", 3: "delete", 4: "insert"}


def test_latest_and_checks(spark, folder):
    store = BookmarkStore(f"{folder}/b")
    assert store.get(spark, "j", ["t"]) == {}
    store.put(spark, "j", [Bookmark("t", "timestamp", "ts", "1"), Bookmark("u", "hash")])
    store.put(spark, "j", [Bookmark("t", "timestamp", "ts", "2", first_run=False)])
    assert store.rows(spark).count() == 3
    assert {r["table_name"]: r["last_processed_value"] for r in latest(store.rows(spark)).collect()} == {"t": "2", "u": None}
    assert check(store.rows(spark)).filter("not is_valid").count() == 0


def test_store_folds_into_buckets(spark, folder):
    store = BookmarkStore(f"{folder}/b")
    assert store.fold(spark) == 0
    for n in range(3):
        store.put(spark, "j", [Bookmark(f"t{i}", "timestamp", "ts", str(n)) for i in range(40)])
    store.put(spark, "k", [Bookmark("t1", "hash")])
    before = store.get(spark, "j", ["t1", "t39"])
    assert store.writes(spark) == 4 and store.fold(spark) == 4 and store.writes(spark) == 1
    assert store.rows(spark).count() == 41 and store.get(spark, "j", ["t1", "t39"]) == before
    store.put(spark, "j", [Bookmark("t1", "timestamp", "ts", "9")])
    assert store.get(spark, "j", ["t1"])["t1"].value == "9" and store.get(spark, "k", ["t1"])["t1"].strategy == "hash"
    # A fold that broke off before the earlier generation went.
    store.append(store.rows(spark))
    store._write(latest(store.rows(spark)), generation=2)
    assert store._generations(spark) == [1, 2] and store.get(spark, "j", ["t1"])["t1"].value == "9"
    store.fold(spark)
    assert store._generations(spark) == [3] and store.rows(spark).count() == 41


def test_bookmarks_of_few_tables_read_their_buckets(spark, folder):
    store = BookmarkStore(f"{folder}/b")
    store.put(spark, "j", [Bookmark(f"t{i}", "timestamp", "ts", "1") for i in range(200)])
    stored = store._stored(spark).filter(F.col("bucket").isin([bucket_of(F.lit("j"), F.lit("t7"))]))
    files = stored.select("_metadata.file_path").distinct().count()
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert files == 1 and "PartitionFilters: [isnotnull(bucket" in plan


def test_run_folds_its_store(spark, job):
    for start in (0, 5):
        lake.write(frame(spark, start, start + 5), job.source, "t", "append")
        results = runner.run(spark, job, [SPEC], fold_beyond=1)
    assert results[0].mode == "incremental" and job.store.writes(spark) == 1 and target(spark, job) == list(range(10))


def test_validation_before_loads(spark, job):
    from tablesync.plans.checks import column_is_fit

    lake.write(frame(spark, 0, 10), job.source, "t", "append")
    assert runner.run(spark, job, [SPEC], validate=True)[0].status == "completed"
    lake.write(frame(spark, 0, 20).withColumn("name", F.lit(1.5)), job.source, "t", "overwrite")
    result = runner.run(spark, job, [SPEC], validate=True)[0]
    assert result.status == "failed" and "SchemaMismatch" in result.error
    repeats = spark.sql("select id % 96 as near, id % 90 as low, id as k, if(id > 2, id, null) as t from range(100)")
    assert column_is_fit(repeats, "primary_key", "near") and column_is_fit(repeats, "primary_key", "k")
    assert not column_is_fit(repeats, "primary_key", "low") and column_is_fit(repeats, "timestamp", "t")
    assert column_is_fit(repeats.limit(0), "primary_key", "k")


# --------------------------------------------------------------------------
# databases: an embedded one that lives in this process only


@pytest.fixture()
def db(folder):
    name = folder.replace("/", "_")
    return Jdbc(f"jdbc:derby:memory:{name};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


def test_an_embedded_database_is_for_sessions_of_one_process():
    def found(**conf):
        return stores.database(SimpleNamespace(conf={k.replace("__", "."): v for k, v in conf.items()}))

    for master in ("local", "local[4]", "local[*,2]"):
        assert ":memory:" in found(spark__master=master).url
    for conf in ({}, *({"spark__master": m} for m in ("local-cluster[3,4,10240]", "spark://host:7077", "yarn"))):
        with pytest.raises(RuntimeError, match="spark.tablesync.jdbc.url"):
            found(**conf)
    assert found(spark__master="local-cluster[3,4,10240]", spark__tablesync__jdbc__url="jdbc:x:y").url == "jdbc:x:y"


def test_database_round_trip_and_pushdown(spark, db):
    done = jdbc.write(frame(spark, 0, 100), db, "t", "overwrite", watermark="id")
    assert (done["n"], done["high"]) == (100, "99")
    jdbc.write(frame(spark, 0, 50), db, "t", "overwrite")
    jdbc.write(frame(spark, 50, 60), db, "t", "append")
    assert endpoints.highest(spark, db, "t", "id") == "59"
    part = endpoints.scan(spark, db, "t", partition_column="id", partitions=4)
    assert part.rdd.getNumPartitions() == 4 and part.count() == 60
    plan = part.filter("id > 57")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,57)" in plan or '"id" > 57' in plan
    assert jdbc.schema(spark, db, "t").names == ["id", "name"]
    with pytest.raises(ValueError):
        jdbc.write(frame(spark, 0, 1), db, "t", "merge")


def test_database_source_and_target(spark, db, folder, job):
    jdbc.write(frame(spark, 0, 5), db, "t", "overwrite")
    from_db = Job("j", db, job.target, job.store)
    assert one(spark, from_db).mode == "full"
    assert one(spark, from_db).rows == 0
    jdbc.write(frame(spark, 5, 9), db, "t", "append")
    assert one(spark, from_db).rows == 4
    assert target(spark, job) == list(range(9))
    lake.write(frame(spark, 0, 3), job.source, "u", "append")
    to_db = Job("k", job.source, db, job.store)
    spec = TableSpec("u", "primary_key", "id")
    assert one(spark, to_db, spec).watermark == "2"
    lake.write(frame(spark, 3, 4), job.source, "u", "append")
    assert one(spark, to_db, spec).rows == 1
    assert endpoints.scan(spark, db, "u").count() == 4


def test_repeated_rows_in_a_database_stop_the_bookmark(spark, db, job):
    lake.write(frame(spark, 0, 3), job.source, "t", "append")
    to_db = Job("k", job.source, db, job.store)
    one(spark, to_db)
    lake.write(frame(spark, 3, 5), job.source, "t", "append")
    jdbc.write(frame(spark, 3, 4), db, "t", "append")
    result = runner.run(spark, to_db, [SPEC])[0]
    assert result.status == "failed" and "recover" in result.error
    assert job.store.get(spark, "k", ["t"])["t"].value == "2"


def test_column_catalog_of_a_database(spark, db):
    from tablesync.operators.detect import detect_from_metadata

    columns = spark.createDataFrame(
        [("app", "orders", 1, "code", "varchar", "NO", None, None), ("app", "orders", 2, "n", "numeric", "YES", 10, 2),
         ("app", "visits", 1, "updated_at", "timestamp", "YES", None, None), ("sys", "x", 1, "id", "integer", "NO", 32, 0)],
        "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string, "
        "numeric_precision int, numeric_scale int",
    )
    keys = spark.createDataFrame([("app", "orders", "pk1", "PRIMARY KEY")], "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("app", "orders", "pk1", "code")], "table_schema string, table_name string, constraint_name string, column_name string")
    small = {"column_name": "varchar(50)", "table_name": "varchar(50)", "table_schema": "varchar(50)", "constraint_name": "varchar(50)",
             "constraint_type": "varchar(50)", "data_type": "varchar(50)", "is_nullable": "varchar(3)"}
    for name, df in (("columns", columns), ("table_constraints", keys), ("key_column_usage", usage)):
        types = ", ".join(f"{c} {small[c]}" for c in df.columns if c in small)
        df.toDF(*[c.upper() for c in df.columns]).write.format("jdbc").options(
            **db.settings(), dbtable=f"information_schema.{name}", createTableColumnTypes=types
        ).save()
    app = Jdbc(db.url, engine="postgresql", driver=db.driver, schema="app")
    got = jdbc.column_catalog(spark, app)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("orders", 0, "code", "VARCHAR", False, True, None, None), ("orders", 1, "n", "NUMERIC", True, False, 10, 2),
        ("visits", 0, "updated_at", "TIMESTAMP", True, False, None, None),
    ]
    found = {r[0]: tuple(r)[1:] for r in detect_from_metadata(got).collect()}
    assert found == {"orders": ("primary_key", "code"), "visits": ("timestamp", "updated_at")}
    with pytest.raises(ValueError):
        jdbc.column_catalog(spark, db)


def test_parallel_scan_of_a_detected_table(spark, db, job, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    jdbc.write(orders, db, "orders", "overwrite")
    source = Job("p", db, job.target, job.store)
    specs = runner.detect_specs(spark, source, ["orders"], connections=3)
    assert specs[0].column == "o_orderdate"
    assert specs[0].scan_options == {"partition_column": "o_orderkey", "partitions": 3}
    rows = endpoints.scan(spark, db, "orders", **specs[0].scan_options)
    assert rows.rdd.getNumPartitions() == 3
    assert rows.exceptAll(orders).count() == 0 and rows.count() == orders.count()
    assert runner.run(spark, source, specs, raise_on_failure=True)[0].rows == orders.count()


def spread(rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.mark.parametrize("column, low", [("o_orderkey", "300"), ("o_orderdate", "1994-01-01 00:00:00"), ("o_totalprice", None), ("price", "20000.00")])
def test_database_ranges_are_even_for_every_type(spark, db, data, column, low):
    orders = spark.read.parquet(f"{data}/orders.parquet").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    # Three quarters of the rows crowd at one end, where ranges of equal width would be uneven.
    crowded = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderkey")).otherwise(F.col("o_orderkey") * 1000))
    jdbc.write(crowded, db, "orders", "overwrite")
    high = endpoints.highest(spark, db, "orders", column) if low else None
    rows = endpoints.scan(spark, db, "orders", partition_column=column, partitions=6, low=low, high=high)
    want = crowded if low is None else crowded.filter(F.col(column) > F.lit(low).cast(crowded.schema[column].dataType))
    assert rows.exceptAll(want).count() == 0 and rows.count() == want.count()
    sizes = spread(rows)
    assert len(sizes) == 6 and max(sizes) <= 1.3 * min(sizes)


def test_a_repeated_value_is_cut_by_the_key(spark, db):
    rows = spark.range(600).select("id", F.when(F.col("id") < 500, 7).otherwise(F.col("id")).alias("v"), F.when(F.col("id") == 3, F.lit(None)).otherwise(1).alias("n"))
    jdbc.write(rows, db, "t", "overwrite")
    alone = endpoints.scan(spark, db, "t", partition_column="v", partitions=4)
    tied = endpoints.scan(spark, db, "t", partition_column="v", partitions=4, tie="id")
    assert max(spread(alone)) >= 500 and max(spread(tied)) == 150
    assert tied.exceptAll(rows).count() == 0 and tied.count() == 600
    nulls = endpoints.scan(spark, db, "t", partition_column="n", partitions=4)
    assert sorted(spread(nulls)) == [1, 599]


def test_a_database_delta_is_read_in_even_ranges(spark, db, job):
    jdbc.write(frame(spark, 0, 1000), db, "t", "overwrite")
    spec = TableSpec("t", "primary_key", "id", scan_options={"partition_column": "id", "partitions": 4})
    delta = loads.database_delta(spark, Job("d", db, job.target, job.store), spec, "799")
    assert sorted(spread(delta)) == [50, 50, 50, 50]


def test_detection_by_keys_and_scale_of_a_database(spark, db, job):
    """Look-alike catalog tables: a declared key goes before names, and a NUMBER with digits is no key."""
    columns = spark.createDataFrame(
        [("app", "a", 1, "code", "varchar", "NO", None, None), ("app", "a", 2, "id", "integer", "NO", 32, 0),
         ("app", "b", 1, "amount", "numeric", "YES", 10, 2), ("app", "c", 1, "serial", "numeric", "YES", 10, 0)],
        "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable string, "
        "numeric_precision int, numeric_scale int")
    keys = spark.createDataFrame([("app", "a", "pk", "PRIMARY KEY")], "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("app", "a", "pk", "code")], "table_schema string, table_name string, constraint_name string, column_name string")
    for name, df in (("columns", columns), ("table_constraints", keys), ("key_column_usage", usage)):
        texts = ", ".join(f"{f.name.upper()} varchar(50)" for f in df.schema.fields if f.dataType.simpleString() == "string")
        df.toDF(*[c.upper() for c in df.columns]).write.format("jdbc").options(
            **db.settings(), dbtable=f"information_schema.{name}", createTableColumnTypes=texts).save()
    app = Jdbc(db.url, engine="postgresql", driver=db.driver, schema="app", options={})
    for table, df in (("a", "'x' AS code, 1 AS id"), ("b", "1.25BD AS amount"), ("c", "5BD AS serial")):
        jdbc.write(spark.sql(f"SELECT {df}"), app, table, "overwrite")
    source = Job("k", app, job.target, job.store)
    specs = {s.table: s for s in runner.detect_specs(spark, source, ["a", "b", "c"], manual={"b": "amount", "c": "serial"}, connections=2)}
    assert (specs["a"].strategy, specs["a"].column) == ("primary_key", "code")
    assert (specs["b"].strategy, specs["b"].column) == ("hash", None)
    assert (specs["c"].strategy, specs["c"].column) == ("primary_key", "serial")
    assert specs["a"].source_types == {"code": "VARCHAR", "id": "INTEGER"}


@pytest.mark.parametrize("size", [400, 50])
def test_batches_read_the_source_a_fixed_number_of_times(spark, folder, size, monkeypatch):
    source, target = Lake(f"{folder}/s"), Lake(f"{folder}/t")
    lake.write(spark.range(2000).selectExpr("id", "concat('n', id) as name"), source, "t", "create")
    lake.write(frame(spark, 0, 100), target, "t", "create", watermark="id")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def look(_):
        seen.add(1)
        return True

    monkeypatch.setattr(batches, "lake_delta", lambda *a: loads.lake_delta(*a).filter(look("id")))
    job = Job("b", source, target, BookmarkStore(f"{folder}/b"))
    done = batches.load_in_batches(spark, job, SPEC, loads.next_bookmark(SPEC, None, "99", 0), size)
    assert done.rows == 1900 and seen.value == 2 * 1900
    assert sorted(r.id for r in lake.read(spark, target, "t").collect()) == list(range(2000))
    assert len(lake.state(spark, target, "t").segments) == 1 + -(-1900 // size)
    assert job.store.get(spark, "b", ["t"])["t"].value == "1999"


def test_batches_into_a_partitioned_new_table_and_a_database(spark, db, folder):
    source, target = Lake(f"{folder}/s"), Lake(f"{folder}/t")
    rows = spark.range(300).selectExpr("id", "concat('n', id % 3) as name")
    lake.write(rows, source, "t", "create")
    lake.create_if_missing(spark, target, "t", rows.schema, partition_by=["name"])
    store = BookmarkStore(f"{folder}/b")
    start = loads.next_bookmark(SPEC, None, "49", 0)
    assert batches.load_in_batches(spark, Job("l", source, target, store), SPEC, start, 70, together=2).rows == 250
    assert lake.read(spark, target, "t").count() == 250 and len(lake.state(spark, target, "t").segments) == 4
    assert lake.files(spark, target, "t").filter("partition = '_p_name=n1'").count() == 4
    jdbc.write(frame(spark, 0, 50), db, "t", "overwrite")
    assert batches.load_in_batches(spark, Job("d", source, db, store), SPEC, start, 70).rows == 250
    assert endpoints.scan(spark, db, "t").count() == 300 and store.get(spark, "d", ["t"])["t"].value == "299"


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,2)", "date", "timestamp_ntz"])
def test_ranges_that_differ(spark, kind):
    value = {"bigint": "id * 1000003 - 5000", "decimal(12,2)": "cast(id * 1.25 as decimal(12,2))", "date": "date_add(date'2024-01-01', cast(id as int))",
             "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int), 0, 0.000001)"}[kind]
    rows = spark.range(3000).selectExpr(f"{value} as k", "id as v").unionByName(spark.createDataFrame([(None, -1)], f"k {kind}, v bigint"))
    assert not repair.differing_ranges(rows, rows.orderBy(F.desc("v")), "k", fan=16, least_rows=10)
    other = rows.filter("v <> 100").withColumn("v", F.when(F.col("v") == 2000, 7).otherwise(F.col("v")))
    found = repair.differing_ranges(rows, other, "k", fan=16, least_rows=10)
    assert len(found.spans) == 2 and not found.nulls
    assert rows.filter(found.hold()).filter("v in (100, 2000)").count() == 2 and rows.filter(found.hold()).count() <= 20
    found = repair.differing_ranges(rows, rows.filter("k is not null").unionByName(rows.filter("v = 5")), "k", fan=16, least_rows=10)
    assert found.nulls and len(found.spans) == 1
    # With differences everywhere the answer stays small and covers them all.
    all_off = rows.withColumn("v", F.col("v") + 1)
    found = repair.differing_ranges(rows, all_off, "k", fan=16, least_rows=1, most=8)
    assert len(found.spans) <= 8 and rows.filter(~found.hold()).count() == 0
    assert not repair.differing_ranges(rows.limit(0), rows.limit(0), "k")
    assert len(repair.differing_ranges(rows, rows.limit(0), "k").spans) == 1


def test_recovery_of_ranges_in_a_lake_and_a_database(spark, db, folder):
    store, source = BookmarkStore(f"{folder}/b"), Lake(f"{folder}/s")
    lake.write(frame(spark, 0, 500), source, "t", "create")
    damaged = frame(spark, 0, 480).filter("id not between 100 and 104").withColumn("name", F.when(F.col("id") == 300, "x").otherwise(F.col("name")))
    surplus = damaged.unionByName(frame(spark, 470, 475))
    home = Lake(f"{folder}/t")
    lake.write(surplus, home, "t", "create", partition_by=["bucket(4, id)"], watermark="id")
    jdbc.write(surplus, db, "t", "overwrite")
    for name, target in (("l", home), ("d", db)):
        job = Job(name, source, target, store)
        # The source's rows beyond the bookmark are for the next increment; the target's go.
        store.put(spark, name, [loads.next_bookmark(SPEC, None, "476", 0)])
        done = repair.recover_ranges(spark, job, SPEC, fan=8, least_rows=8)
        assert 3 <= done.ranges <= 5 and done.rows < 80
        got = sorted(tuple(r) for r in endpoints.scan(spark, target, "t").collect())
        assert got == sorted(tuple(r) for r in frame(spark, 0, 477).collect())
        assert repair.recover_ranges(spark, job, SPEC) == repair.Reloaded(0, 0)
        assert runner.run(spark, job, [SPEC], raise_on_failure=True)[0].rows == 23
    # A load that stopped half way leaves other rows in a database: they are loaded again.
    jdbc.write(frame(spark, 600, 602), db, "t", "append")
    assert repair.recover(spark, Job("d", source, db, store), SPEC) == "reloaded"
    assert endpoints.scan(spark, db, "t").count() == 500
