"""Increments, full loads, runs over many tables, and lake writes."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from suite.base import TABLES, middle, new_lake, new_store, query, table
from tablesync.functions.structs import local_rows, struct
from tablesync.operators import detect, repair, runlog, upkeep
from tablesync.operators.bookmarks import Bookmark
from tablesync.operators.catalog import catalog
from tablesync.operators.incremental import above, watermark
from tablesync.plans import loads, runner
from tablesync.plans.loads import Job, TableSpec
from tablesync.session import workspace
from tablesync.sources import lake
from tablesync.sources.files import Files
from tablesync.streaming import batches

MID_ORDER = "(SELECT (min(o_orderkey) + max(o_orderkey)) // 2 FROM orders)"
MID_TS = "(SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)"


@query("inc_filter_pk", f"SELECT * FROM orders WHERE o_orderkey > {MID_ORDER}")
def inc_filter_pk(spark, sf):
    orders = table(spark, sf, "orders")
    return above(orders, "o_orderkey", str(middle(orders, "o_orderkey")))


@query("inc_filter_ts", "SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < (SELECT max(ts) - INTERVAL 15 DAY FROM events))")
def inc_filter_ts(spark, sf):
    """The bookmark is the newest signup that is at least 15 days old."""
    events = table(spark, sf, "events")
    old = F.expr("interval 15 days")
    top = events.agg((F.max("ts") - old).alias("t")).first()["t"]
    mark = events.filter((F.col("event_type") == "signup") & (F.col("ts") < F.lit(top).cast("timestamp_ntz")))
    return above(events, "ts", mark.agg(F.max("ts").cast("string").alias("m")).first()["m"])


@query("inc_zero_bookmark", "SELECT * FROM orders WHERE o_orderkey > 0")
def inc_zero_bookmark(spark, sf):
    """0 is a bookmark, not a missing one."""
    return above(table(spark, sf, "orders"), "o_orderkey", 0)


@query(
    "inc_bounded_ties",
    """
    WITH RECURSIVE v AS (
      SELECT l_orderkey AS k, CAST(sum(count(*)) OVER (ORDER BY l_orderkey) AS BIGINT) AS c
      FROM lineitem GROUP BY l_orderkey
    ), size AS (
      SELECT CAST(count(*) // 5 + 1 AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS total FROM lineitem
    ), b(number, high, reached, rows) AS (
      SELECT CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
      UNION ALL
      SELECT number + 1, nk, nc, nc - reached FROM (
        SELECT b.number, b.reached, min(v.k) AS nk, min(v.c) AS nc
        FROM b, size, v
        WHERE b.reached < size.total AND v.c >= least(b.reached + size.n, size.total)
        GROUP BY b.number, b.reached
      )
    )
    SELECT number, CAST(high AS BIGINT) AS high, rows FROM b WHERE number > 0
    """,
)
def inc_bounded_ties(spark, sf):
    """The whole table in five bounded increments; l_orderkey repeats, and ties stay together."""
    lines = table(spark, sf, "lineitem")
    size = lines.count() // 5 + 1
    plan = [(b.number, b.high, b.rows) for b in batches.plan_batches(lines, "l_orderkey", size)]
    return local_rows(spark, plan, struct(number="bigint", high="bigint", rows="bigint"))


@query("load_in_batches", "SELECT * FROM lineitem")
def load_in_batches(spark, sf):
    """A first slice loaded, the rest of lineitem in bounded batches; the target is the source."""
    target, store = new_lake(spark, "batches"), new_store(spark)
    job = Job("batches", Files(sf), target, store)
    spec = TableSpec("lineitem", "primary_key", "l_orderkey")
    lines = table(spark, sf, "lineitem")
    start = middle(lines, "l_orderkey")
    lake.write(lines.filter(F.col("l_orderkey") <= start), target, "lineitem", "create", watermark="l_orderkey")
    before = loads.next_bookmark(spec, None, str(start), 0)
    batches.load_in_batches(spark, job, spec, before, lines.count() // 5 + 1)
    return lake.read(spark, target, "lineitem")


@query("full_then_incremental", "SELECT * FROM orders")
def full_then_incremental(spark, sf):
    """A full load of the older half, then one increment from the whole table."""
    early, target, store = new_lake(spark, "early"), new_lake(spark, "target"), new_store(spark)
    orders = table(spark, sf, "orders")
    lake.write(orders.filter(F.col("o_orderkey") <= middle(orders, "o_orderkey")), early, "orders", "create")
    spec = TableSpec("orders", "primary_key", "o_orderkey")
    first = Job("orders-copy", early, target, store)
    runner.run(spark, first, [spec], raise_on_failure=True)
    runner.run(spark, Job("orders-copy", Files(sf), target, store), [spec], raise_on_failure=True)
    return lake.read(spark, target, "orders")


@query(
    "incremental_run_log",
    f"""
    SELECT 1 AS run, 'full' AS mode, CAST(count(*) AS BIGINT) AS rows, CAST(max(o_orderkey) AS VARCHAR) AS watermark
    FROM orders WHERE o_orderkey <= {MID_ORDER}
    UNION ALL
    SELECT 2, 'incremental', CAST(count(*) AS BIGINT), CAST(max(o_orderkey) AS VARCHAR)
    FROM orders WHERE o_orderkey > {MID_ORDER}
    UNION ALL
    SELECT 3, 'incremental', 0, CAST(max(o_orderkey) AS VARCHAR) FROM orders
    """,
)
def incremental_run_log(spark, sf):
    """Full load, increment, and a rerun that finds nothing, as run-log rows."""
    early, target, store = new_lake(spark, "early"), new_lake(spark, "target"), new_store(spark)
    orders = table(spark, sf, "orders")
    lake.write(orders.filter(F.col("o_orderkey") <= middle(orders, "o_orderkey")), early, "orders", "create")
    spec = TableSpec("orders", "primary_key", "o_orderkey")
    log = []
    for i, source in enumerate((early, Files(sf), Files(sf)), 1):
        done = runner.run(spark, Job("copy", source, target, store), [spec], raise_on_failure=True)
        log += [(i, r.mode, r.rows, r.watermark) for r in done]
    return local_rows(spark, log, struct(run="int", mode="string", rows="bigint", watermark="string"))


KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


@query(
    "watermark_summary",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(max({c}) AS VARCHAR) AS watermark, count(*) AS rows FROM {t}" for t, c in KEYS.items()),
)
def watermark_summary(spark, sf):
    """Highest key and rows of every table."""
    parts = [watermark(table(spark, sf, t), c).select(F.lit(t).alias("table_name"), "watermark", "rows") for t, c in KEYS.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "multi_table_run",
    """
    SELECT 'region' AS table_name, 'completed' AS status, count(*) AS rows FROM region
    UNION ALL SELECT 'nation', 'completed', count(*) FROM nation
    UNION ALL SELECT 'customer', 'completed', count(*) FROM customer
    UNION ALL SELECT 'orders', 'completed', count(*) FROM orders
    UNION ALL SELECT 'embeddings', 'completed', count(*) FROM embeddings
    UNION ALL SELECT 'no_such_table', 'failed', 0
    """,
)
def multi_table_run(spark, sf):
    """Side-by-side loads; the missing table fails alone."""
    job = Job("many", Files(sf), new_lake(spark, "many"), new_store(spark))
    wanted = ["region", "nation", "customer", "orders", "embeddings", "no_such_table"]
    results = runner.run(spark, job, runner.detect_specs(spark, job, wanted))
    return runner.run_log(spark, results).select("table_name", "status", "rows")


@query(
    "replicate_all_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES),
)
def replicate_all_tables(spark, sf):
    """Every given table, arrays included, copied into a lake; rows are counted in the copies."""
    target = new_lake(spark, "all")
    job = Job("all", Files(sf), target, new_store(spark))
    runner.run(spark, job, runner.detect_specs(spark, job, TABLES), raise_on_failure=True)
    parts = [
        lake.read(spark, target, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in TABLES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "run_report",
    "WITH t AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES) + """)
    SELECT table_name, 'full' AS mode, 'completed' AS status, rows, rows AS total_rows, if(rows > 0, 100.0, 0.0) AS progress_percent, TRUE AS has_bytes,
      CAST(14 AS BIGINT) AS tables, CAST(14 AS BIGINT) AS succeeded, CAST(0 AS BIGINT) AS failed, CAST((SELECT sum(rows) FROM t) AS BIGINT) AS all_rows
    FROM t
    """,
)
def run_report(spark, sf):
    """Rates per table and the summary of the job, from the log of a real run over all tables."""
    job = Job("report", Files(sf), new_lake(spark, "report"), new_store(spark))
    log = runner.run_log(spark, runner.run(spark, job, runner.detect_specs(spark, job, TABLES), raise_on_failure=True))
    summary = runlog.job_summary(log).select("job_name", "tables", "succeeded", "failed", F.col("rows").alias("all_rows"))
    return runlog.table_rates(log).join(summary, "job_name").select(
        "table_name", "mode", "status", "rows", "total_rows", "progress_percent", (F.col("bytes") > 0).alias("has_bytes"),
        "tables", "succeeded", "failed", "all_rows")


@query(
    "hash_strategy_skip",
    """
    SELECT 1 AS run, 'completed' AS status, count(*) AS rows FROM customer
    UNION ALL SELECT 2, 'skipped', 0
    UNION ALL SELECT 3, 'completed', count(*) FROM customer
    """,
)
def hash_strategy_skip(spark, sf):
    """An unchanged table is skipped, a changed one reloaded."""
    source, target, store = new_lake(spark, "source"), new_lake(spark, "target"), new_store(spark)
    customer = table(spark, sf, "customer")
    lake.write(customer, source, "customer", "create")
    job, spec = Job("hash", source, target, store), TableSpec("customer", "hash")
    log = []
    for run in (1, 2, 3):
        if run == 3:
            changed = customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
            lake.write(changed, source, "customer", "overwrite")
        done = runner.run(spark, job, [spec], raise_on_failure=True)[0]
        log.append((run, done.status, done.rows))
    return local_rows(spark, log, struct(run="int", status="string", rows="bigint"))


@query(
    "tiered_load",
    f"""
    SELECT o.*, t.tier FROM orders o, (
      SELECT CASE WHEN count(*) < 100 THEN 'direct' WHEN count(*) <= 100000000 THEN 'staging' ELSE 'batches' END AS tier
      FROM orders WHERE o_orderkey > {MID_ORDER}
    ) t
    """,
)
def tiered_load(spark, sf):
    """The delta is counted, and loaded the way its size asks for."""
    target, store = new_lake(spark, "tiers"), new_store(spark)
    orders = table(spark, sf, "orders")
    start = middle(orders, "o_orderkey")
    spec = TableSpec("orders", "primary_key", "o_orderkey")
    lake.write(orders.filter(F.col("o_orderkey") <= start), target, "orders", "create", watermark="o_orderkey")
    before = loads.next_bookmark(spec, None, str(start), 0)
    tier, _ = batches.tiered_load(spark, Job("t", Files(sf), target, store), spec, before, direct_below=100)
    return lake.read(spark, target, "orders").withColumn("tier", F.lit(tier))


def in_batches(spark, sf, key):
    """Orders under another key type, the upper half loaded in batches of a fifth of them."""
    target, source = new_lake(spark, "batched"), new_lake(spark, "keyed")
    orders = table(spark, sf, "orders").withColumn("k", F.expr(key))
    lake.write(orders, source, "orders", "create")
    start = middle(orders, "o_orderkey")
    low = orders.filter(F.col("o_orderkey") <= start)
    lake.write(low, target, "orders", "create", watermark="k")
    spec = TableSpec("orders", "primary_key", "k")
    before = loads.next_bookmark(spec, None, low.agg(F.max("k").cast("string").alias("m")).first()["m"], 0)
    batches.load_in_batches(spark, Job("b", source, target, new_store(spark)), spec, before, max(1, orders.count() // 10))
    several = len(lake.state(spark, target, "orders").segments) > 4
    return lake.read(spark, target, "orders").withColumn("k", F.col("k").cast("string")).withColumn("several", F.lit(several))


@query("batches_decimal_key", "SELECT *, CAST(o_orderkey AS VARCHAR) AS k, TRUE AS several FROM orders")
def batches_decimal_key(spark, sf):
    return in_batches(spark, sf, "cast(o_orderkey as decimal(38,0))")


@query("batches_text_key", "SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS k, TRUE AS several FROM orders")
def batches_text_key(spark, sf):
    return in_batches(spark, sf, "lpad(cast(o_orderkey as string), 12, '0')")


RESOLVED = {
    "region": ("primary_key", "r_regionkey"), "nation": ("primary_key", "n_nationkey"), "customer": ("primary_key", "c_custkey"),
    "supplier": ("primary_key", "s_suppkey"), "part": ("primary_key", "p_partkey"), "orders": ("primary_key", "o_orderkey"),
    "lineitem": ("timestamp", "l_shipdate"), "events": ("primary_key", "event_id"), "documents": ("primary_key", "doc_id"),
    "embeddings": ("primary_key", "vec_id"), "pages": ("primary_key", "page_id"), "benchmark": ("primary_key", "item_id"),
    "labels": ("primary_key", "doc_id"), "conversations": ("primary_key", "conv_id"),
}


@query(
    "resolved_run",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{s}' AS strategy, '{c}' AS \"column\", {t in ('orders', 'customer')} AS is_manual, 'completed' AS status, count(*) AS rows FROM {t}"
        for t, (s, c) in RESOLVED.items()),
)
def resolved_run(spark, sf):
    """All tables of a lake: a manual decimal key in JSON, identifier columns, and names and types for the rest."""
    source = new_lake(spark, "resolved")
    for name in TABLES:
        rows = table(spark, sf, name)
        if name == "orders":
            rows = rows.withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(38,0)"))
        lake.write(rows, source, name, "create")
    lake.set_identifiers(spark, source, "part", ["p_partkey"])
    lake.set_identifiers(spark, source, "lineitem", ["l_shipdate"])
    job = Job("resolved", source, new_lake(spark, "copies"), new_store(spark))
    manual = '{"orders": "o_orderkey", "customer": {"table_name": "customer", "column_name": "C_CUSTKEY"}}'
    specs = runner.detect_specs(spark, job, TABLES, manual)
    log = runner.run_log(spark, runner.run(spark, job, specs))
    found = local_rows(spark, [(s.table, s.strategy, s.column, s.manual) for s in specs], struct(table_name="string", strategy="string", column="string", is_manual="boolean"))
    return found.join(log.select("table_name", "status", "rows"), "table_name")


@query(
    "validated_run",
    """
    SELECT 1 AS run, 'orders' AS table_name, 'full' AS mode, 'completed' AS status, count(*) AS rows FROM orders
    UNION ALL SELECT 1, 'lineitem', 'full', 'completed', count(*) FROM lineitem
    UNION ALL SELECT 2, 'orders', 'incremental', 'completed', 0
    UNION ALL SELECT 2, 'lineitem', 'hash', 'skipped', 0
    """,
)
def validated_run(spark, sf):
    """l_orderkey repeats too often for a key, so lineitem is tracked by its fingerprint instead."""
    job = Job("checked", Files(sf), new_lake(spark, "checked"), new_store(spark))
    specs = [TableSpec("orders", "primary_key", "o_orderkey"), TableSpec("lineitem", "primary_key", "l_orderkey")]
    log = []
    for run in (1, 2):
        done = runner.run(spark, job, specs, raise_on_failure=True, validate=True)
        log += [(run, r.table, r.mode, r.status, r.rows) for r in done]
    return local_rows(spark, log, struct(run="int", table_name="string", mode="string", status="string", rows="bigint"))


@query(
    "bookmark_life_cycle",
    """
    SELECT step, mode, CASE WHEN mode = 'incremental' THEN 0 ELSE n END AS rows
    FROM (VALUES (1, 'full'), (2, 'incremental'), (3, 'full'), (4, 'incremental'), (5, 'full')) AS s(step, mode),
         (SELECT count(*) AS n FROM customer)
    """,
)
def bookmark_life_cycle(spark, sf):
    """First run, nothing new, reset, nothing new, corrupt bookmark."""
    job = Job("life", Files(sf), new_lake(spark, "life"), new_store(spark))
    spec, log = TableSpec("customer", "primary_key", "c_custkey"), []
    for step in range(1, 6):
        if step == 3:
            job.store.reset(spark, job.name, ["customer"])
        if step == 5:
            job.store.put(spark, job.name, [Bookmark("customer", "no such strategy", "c_custkey", "5", first_run=False)])
        done = runner.run(spark, job, [spec], raise_on_failure=True)[0]
        log.append((step, done.mode, done.rows))
    return local_rows(spark, log, struct(step="int", mode="string", rows="bigint"))


@query(
    "load_with_casts",
    """
    SELECT * REPLACE (CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(38,10))::VARCHAR AS o_totalprice) FROM orders
    """,
)
def load_with_casts(spark, sf):
    """A full load whose columns are cast for the engine pair, by the source's type names."""
    source, target = new_lake(spark, "oracle"), new_lake(spark, "postgresql")
    orders = table(spark, sf, "orders")
    lake.write(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")), source, "orders", "create")
    job = Job("casts", source, target, new_store(spark), "oracle", "postgresql")
    spec = TableSpec("orders", source_types={"o_totalprice": "NUMBER(12,2)", "o_orderstatus": "VARCHAR2(1)"})
    runner.run(spark, job, [spec], raise_on_failure=True)
    got = lake.read(spark, target, "orders")
    return got.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


# --------------------------------------------------------------------------
# lake


@query("lake_increment", f"SELECT * FROM events WHERE ts > {MID_TS}")
def lake_increment(spark, sf):
    """Increment of a lake table in order of its column."""
    home, events = new_lake(spark, "inc"), table(spark, sf, "events")
    lake.write(events, home, "events", "create", watermark="ts")
    row = events.agg(F.min("ts").alias("a"), F.max("ts").alias("z")).first()
    return lake.read_increment(spark, home, "events", "ts", str(row["a"] + (row["z"] - row["a"]) / 2), ordered=True)


@query("lake_increment_nothing_new", """
    SELECT kind, CAST(n AS BIGINT) AS n FROM (
      SELECT 'above the highest' AS kind, 0 AS n UNION ALL SELECT 'of an empty table', 0
      UNION ALL SELECT 'loaded by the second run', 0 UNION ALL SELECT 'loaded by the third run', (SELECT count(*) FROM events WHERE ts > (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events))
      UNION ALL SELECT 'in the target', (SELECT count(*) FROM events))""")
def lake_increment_nothing_new(spark, sf):
    """Increments of a table partitioned by day: with nothing new, of an empty table, and with half the rows new."""
    events, home, target = table(spark, sf, "events"), new_lake(spark, "nothing"), new_lake(spark, "nothing-target")
    top = events.agg(F.max("ts").cast("string").alias("t"), (F.min("ts") + (F.max("ts") - F.min("ts")) / 2).cast("string").alias("m")).first()
    lake.create_if_missing(spark, home, "empty", events.schema, partition_by=["days(ts)"])
    early = events.filter(F.col("ts") <= F.lit(top["m"]).cast("timestamp_ntz"))
    lake.write(early, home, "events", "create", partition_by=["days(ts)"], watermark="ts")
    above_all = lake.read_increment(spark, home, "events", "ts", top["t"]).count()
    of_empty = lake.read_increment(spark, home, "empty", "ts", top["t"]).count()
    job = Job("nothing", home, target, new_store(spark))
    spec = [TableSpec("events", "timestamp", "ts")]
    runner.run(spark, job, spec)
    second = runner.run(spark, job, spec)[0]
    lake.write(events.filter(F.col("ts") > F.lit(top["m"]).cast("timestamp_ntz")), home, "events", "append")
    third = runner.run(spark, job, spec)[0]
    found = [
        ("above the highest", above_all), ("of an empty table", of_empty), ("loaded by the second run", second.rows),
        ("loaded by the third run", third.rows), ("in the target", lake.read(spark, target, "events").count()),
    ]
    return local_rows(spark, found, struct(kind="string", n="bigint"))


@query("create_then_append", "SELECT * FROM supplier")
def create_then_append(spark, sf):
    """An empty clone of a schema, then an append matched by column name."""
    home, supplier = new_lake(spark, "clone"), table(spark, sf, "supplier")
    lake.clone_empty(supplier, home, "supplier", identifier_columns=["s_suppkey"])
    lake.write(supplier.select(*reversed(supplier.columns)), home, "supplier", "append")
    return lake.read(spark, home, "supplier")


@query("staged_write", "SELECT * FROM part")
def staged_write(spark, sf):
    home = new_lake(spark, "staged")
    repair.staged_write(table(spark, sf, "part"), home, "part")
    return lake.read(spark, home, "part")


@query(
    "time_travel",
    f"""
    SELECT 'before' AS version, * FROM orders WHERE o_orderkey <= {MID_ORDER}
    UNION ALL SELECT 'after', * FROM orders
    """,
)
def time_travel(spark, sf):
    home, orders = new_lake(spark, "travel"), table(spark, sf, "orders")
    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    low = orders.filter(F.col("o_orderkey") <= middle(orders, "o_orderkey"))
    lake.write(low, home, "orders", "create", committed_at=at(1))
    lake.write(orders, home, "orders", "overwrite", committed_at=at(3))
    before = lake.read(spark, home, "orders", as_of=at(2)).withColumn("version", F.lit("before"))
    return before.unionByName(lake.read(spark, home, "orders").withColumn("version", F.lit("after")))


@query(
    "evolve_schema",
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice, o_orderdate,
           CASE WHEN o_orderkey > {MID_ORDER} THEN o_orderpriority END AS priority
    FROM orders
    """,
)
def evolve_schema(spark, sf):
    """A renamed and an added column; files written before are not touched."""
    home, orders = new_lake(spark, "evolve"), table(spark, sf, "orders")
    start = middle(orders, "o_orderkey")
    base = orders.drop("o_orderpriority")
    lake.write(base.filter(F.col("o_orderkey") <= start), home, "orders", "create")
    lake.rename_column(spark, home, "orders", "o_orderstatus", "status")
    lake.add_column(spark, home, "orders", "priority", "string")
    later = orders.filter(F.col("o_orderkey") > start).withColumnsRenamed({"o_orderstatus": "status", "o_orderpriority": "priority"})
    lake.write(later, home, "orders", "append")
    return lake.read(spark, home, "orders")


DESCRIBED = {
    "region": (2, "r_regionkey"), "nation": (3, "n_nationkey"), "customer": (5, "c_custkey"), "supplier": (4, "s_suppkey"), "part": (6, "p_partkey"),
    "orders": (6, "o_orderkey"), "lineitem": (11, "l_orderkey"), "events": (6, "event_id"), "documents": (5, "doc_id"), "embeddings": (3, "vec_id"),
    "pages": (3, "page_id"), "benchmark": (2, "item_id"), "labels": (3, "doc_id"), "conversations": (4, "conv_id"),
}


@query(
    "describe_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, TRUE AS table_exists, {n} AS columns, '{c}' AS identifier, count(*) AS rows FROM {t}"
        for t, (n, c) in DESCRIBED.items()
    )
    + " UNION ALL SELECT 'no_such_table', FALSE, NULL, NULL, NULL",
)
def describe_tables(spark, sf):
    home = new_lake(spark, "describe")
    for name, (_, key) in DESCRIBED.items():
        lake.write(table(spark, sf, name), home, name, "create", identifier_columns=[key])
    return lake.describe(spark, home, [*DESCRIBED, "no_such_table"]).select(
        "table_name", "table_exists", F.when(F.col("table_exists"), F.size("columns")).alias("columns"),
        F.get("identifier_columns", F.lit(0)).alias("identifier"), "rows",
    )


@query(
    "partition_layout",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS rows FROM events GROUP BY ALL
    """,
)
def partition_layout(spark, sf):
    """Events laid out by day and type; rows are counted from the folders."""
    home = new_lake(spark, "layout")
    lake.write(table(spark, sf, "events"), home, "events", "create", partition_by=["days(ts)", "event_type"])
    return upkeep.partition_rows(spark, home, "events").select(
        F.col("_p_ts_day").alias("day"), F.col("_p_event_type").alias("event_type"), "rows"
    )


@query(
    "partition_pruned_read",
    f"SELECT * FROM events WHERE ts BETWEEN {MID_TS} AND (SELECT max(ts) FROM events)",
)
def partition_pruned_read(spark, sf):
    """A time range on a table laid out by month; the derived folder column prunes."""
    home, events = new_lake(spark, "prune"), table(spark, sf, "events")
    lake.write(events, home, "events", "create", partition_by=["days(ts)", "bucket(4, user_id)"])
    row = events.agg(F.min("ts").alias("a"), F.max("ts").alias("z")).first()
    low = row["a"] + (row["z"] - row["a"]) / 2
    return lake.read(spark, home, "events", between=("ts", str(low), str(row["z"])))


@query(
    "compact",
    """
    SELECT 'before' AS stage, CAST(4 AS BIGINT) AS segments, count(*) AS rows FROM events
    UNION ALL SELECT 'after', 1, count(*) FROM events
    """,
)
def compact(spark, sf):
    """Four appends become one segment of files near the target size; rows stay."""
    home, events = new_lake(spark, "compact"), table(spark, sf, "events")
    ranges = events.select(F.percentile_approx("event_id", [0.25, 0.5, 0.75], 10000).alias("p")).first()["p"]
    lows, highs = [None, *ranges], [*ranges, None]
    for low, high in zip(lows, highs):
        part = above(events, "event_id", low)
        part = part if high is None else part.filter(F.col("event_id") <= high)
        lake.write(part, home, "events", "append", watermark="event_id")
    stages = []
    for stage in ("before", "after"):
        if stage == "after":
            upkeep.compact(spark, home, "events", sort_by=["ts"])
        segments = len(lake.state(spark, home, "events").segments)
        rows = lake.read(spark, home, "events").agg(F.count(F.lit(1)).alias("rows"))
        stages.append(rows.select(F.lit(stage).alias("stage"), F.lit(segments).cast("bigint").alias("segments"), "rows"))
    return stages[0].unionByName(stages[1])


@query(
    "compact_small_files",
    "SELECT 'big file kept' AS note, count(*) AS rows, CAST(count(DISTINCT event_id) AS BIGINT) AS ids FROM events",
)
def compact_small_files(spark, sf):
    """Small appends are joined; files near the target size are not rewritten."""
    home, events = new_lake(spark, "small"), table(spark, sf, "events")
    start = middle(events, "event_id")
    lake.write(events.filter(F.col("event_id") <= start), home, "events", "create", watermark="event_id")
    first = {r["path"]: r["bytes"] for r in lake.files(spark, home, "events").collect()}
    rest = above(events, "event_id", start)
    parts = rest.select(F.percentile_approx("event_id", [0.3, 0.6], 10000).alias("p")).first()["p"]
    for low, high in zip([None, *parts], [*parts, None]):
        part = above(rest, "event_id", low)
        lake.write(part if high is None else part.filter(F.col("event_id") <= high), home, "events", "append")
    target = max(first.values())
    upkeep.compact_small_files(spark, home, "events", target_bytes=target)
    # The first write may leave small files, too, such as the one of the task that holds the middle: they are joined.
    large = {path for path, size in first.items() if size >= 0.75 * target}
    kept = large <= {r["path"] for r in lake.files(spark, home, "events").collect()}
    return lake.read(spark, home, "events").agg(
        F.lit("big file kept" if kept else "big file rewritten").alias("note"),
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"),
    )


@query("compact_many_files", "SELECT *, 'kept' AS large, TRUE AS several FROM events")
def compact_many_files(spark, sf):
    """Sixty small files joined in several tasks, beside a large one that stays."""
    home, events = new_lake(spark, "many"), table(spark, sf, "events")
    start = middle(events, "event_id")
    lake.write(events.filter(F.col("event_id") <= start).coalesce(1), home, "events", "create")
    first = {r["path"]: r["bytes"] for r in lake.files(spark, home, "events").collect()}
    lake.write(above(events, "event_id", start).repartition(60), home, "events", "append")
    upkeep.compact_small_files(spark, home, "events", target_bytes=max(first.values()) // 3, smaller_than=1.0)
    now = {r["path"] for r in lake.files(spark, home, "events").collect()}
    large = "kept" if set(first) <= now else "rewritten"
    return lake.read(spark, home, "events").withColumn("large", F.lit(large)).withColumn("several", F.lit(1 < len(now) - 1 < 60))


@query(
    "identifier_watermark",
    """
    SELECT 'orders' AS table_name, '1' AS identifier_field_ids, 'o_orderkey' AS "column", CAST(max(o_orderkey) AS VARCHAR) AS watermark FROM orders
    UNION ALL SELECT 'events', '2,1', 'ts', CAST(max(ts) AS VARCHAR) FROM events
    UNION ALL SELECT 'part', '1', 'p_partkey', CAST(max(p_partkey) AS VARCHAR) FROM part
    """,
)
def identifier_watermark(spark, sf):
    """Identifier columns kept with the table, resolved to the tracking column and its highest value."""
    home, marks = new_lake(spark, "ids"), {"orders": ["o_orderkey"], "events": ["ts", "event_id"], "part": ["p_partkey"]}
    schemas = {}
    for name, columns in marks.items():
        rows = table(spark, sf, name)
        schemas[name] = rows.schema
        lake.write(rows, home, name, "create")
        lake.set_identifiers(spark, home, name, columns)
    tables = lake.describe(spark, home, list(marks)).select(
        "table_name", F.col("properties")["identifier-field-ids"].alias("identifier_field_ids")
    )
    found = detect.identifier_columns(tables, catalog(spark, schemas)).join(tables, "table_name")
    tops = [
        watermark(lake.read(spark, home, r["table_name"]), r["column"]).select(F.lit(r["table_name"]).alias("table_name"), "watermark")
        for r in found.collect()  # one row per table
    ]
    result = tops[0]
    for top in tops[1:]:
        result = result.unionByName(top)
    return found.join(result, "table_name").select("table_name", "identifier_field_ids", "column", "watermark")


@query("sorted_rewrite", "SELECT * FROM lineitem")
def sorted_rewrite(spark, sf):
    home, lines = new_lake(spark, "sorted"), table(spark, sf, "lineitem")
    lake.write(lines, home, "lineitem", "create")
    upkeep.compact(spark, home, "lineitem", sort_by=["l_shipdate"], target_bytes=1 << 20, compression="zstd")
    return lake.read(spark, home, "lineitem")


@query(
    "snapshot_upkeep",
    f"""
    SELECT CAST(2 AS BIGINT) AS expired, CAST(1 AS BIGINT) AS kept, count(*) AS rows FROM orders
    WHERE o_orderkey <= {MID_ORDER}
    """,
)
def snapshot_upkeep(spark, sf):
    """Old snapshots expire, unreferenced files go, the newest snapshot still reads."""
    home, orders = new_lake(spark, "expire"), table(spark, sf, "orders")
    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    half = orders.filter(F.col("o_orderkey") <= middle(orders, "o_orderkey"))
    for day, rows in ((1, orders), (2, orders), (12, half)):
        lake.write(rows, home, "orders", "overwrite", committed_at=at(day))
    expired = upkeep.expire_snapshots(spark, home, "orders", at(5))
    upkeep.remove_unreferenced(spark, home, "orders")
    kept = lake.manifest(spark, home, "orders").select("snapshot").distinct().count()
    return lake.read(spark, home, "orders").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(len(expired)).cast("bigint").alias("expired"), F.lit(kept).cast("bigint").alias("kept"), "rows"
    )


@query(
    "file_health",
    "SELECT strftime(ts, '%Y-%m') AS month, FALSE AS too_many_files, count(*) AS rows FROM events GROUP BY ALL",
)
def file_health(spark, sf):
    """File counts and alerts per partition, next to its rows."""
    home = new_lake(spark, "health")
    lake.write(table(spark, sf, "events"), home, "events", "create", partition_by=["months(ts)"])
    health = upkeep.file_health(lake.files(spark, home, "events")).withColumn(
        "month", F.substring_index("partition", "=", -1)
    )
    rows = upkeep.partition_rows(spark, home, "events").withColumnRenamed("_p_ts_month", "month")
    return health.join(rows, "month").select("month", "too_many_files", "rows")


@query(
    "file_alerts",
    """
    WITH t AS (SELECT event_type, CAST(ceil(count(*) / 100.0) AS BIGINT) AS files FROM events GROUP BY 1),
    m AS (SELECT CAST(avg(files) AS BIGINT) AS usual FROM t)
    SELECT event_type, files, files > usual AS too_many_files, TRUE AS small_under_a_gigabyte, FALSE AS small_under_a_byte,
      TRUE AS large_over_a_byte, FALSE AS large_over_a_gigabyte, (SELECT count(*) FROM t) > 1 AS too_many_partitions FROM t, m
    """,
)
def file_alerts(spark, sf):
    """Every alert both ways: files of 100 rows, partitions with more files than is usual, and limits below and above the sizes."""
    home, events = new_lake(spark, "alerts"), table(spark, sf, "events")
    lake.write(events, home, "events", "create", partition_by=["event_type"], max_records_per_file=100)
    listed = workspace(spark, "listed")  # a listing asks for each file's size: once, not for each use
    lake.files(spark, home, "events").select("partition", "bytes").hint("rebalance").write.parquet(listed)
    files = spark.read.parquet(listed)
    per_type = F.ceil(F.col("count") / 100)
    usual = int(events.groupBy("event_type").count().agg(F.round(F.avg(per_type)).alias("m")).first()["m"])
    low = upkeep.file_health(files, small=1, large=1, most_files=usual)
    high = upkeep.file_health(files, small=1 << 30, large=1 << 30).select(
        "partition", F.col("files_too_small").alias("small_under_a_gigabyte"), F.col("files_too_large").alias("large_over_a_gigabyte"))
    too_many = upkeep.table_health(files, most_partitions=1).first()["too_many_partitions"]
    return low.join(high, "partition").select(
        F.substring_index("partition", "=", -1).alias("event_type"), "files", "too_many_files", "small_under_a_gigabyte",
        F.col("files_too_small").alias("small_under_a_byte"), F.col("files_too_large").alias("large_over_a_byte"), "large_over_a_gigabyte",
        F.lit(too_many).alias("too_many_partitions"))


# --------------------------------------------------------------------------
# repair

CHANGED = """
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def changed_orders(orders):
    return (
        orders.filter("o_orderpriority = '1-URGENT'")
        .withColumn("o_orderstatus", F.lit("X"))
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    )


def new_orders(orders):
    """The urgent orders once more under keys that follow the last one."""
    top = orders.agg(F.max("o_orderkey").alias("top")).first()["top"] + 1
    return orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", F.col("o_orderkey") + top)


@query(
    "upsert",
    f"""
    WITH delta AS (
      {CHANGED}
      UNION ALL
      SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, o_orderstatus, o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderpriority = '1-URGENT'
    )
    SELECT * FROM delta
    UNION ALL SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = o.o_orderkey)
    """,
)
def upsert(spark, sf):
    """Changed, repeated and new rows put in by key, twice; the second time changes nothing."""
    home, orders = new_lake(spark, "upsert"), table(spark, sf, "orders")
    lake.write(orders, home, "orders", "create", watermark="o_orderkey", partition_by=["bucket(16, o_orderkey)"])
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    delta = changed_orders(orders).unionByName(urgent).unionByName(new_orders(orders))
    for _ in range(2):
        repair.upsert(spark, home, "orders", delta, ["o_orderkey"], ["o_totalprice"])
    return lake.read(spark, home, "orders")


NULL_KEYS = "SELECT if(o_orderkey % 7 = 0, NULL, o_orderkey) AS k, if(o_custkey % 3 = 0, NULL, o_custkey) AS c, o_totalprice AS v FROM orders"


@query(
    "upsert_null_keys",
    f"""
    WITH t AS ({NULL_KEYS}),
    d AS (SELECT k, c, max(v) + 1 AS v FROM t WHERE k IS NULL OR k % 2 = 0 GROUP BY 1, 2)
    SELECT * FROM d
    UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.k IS NOT DISTINCT FROM t.k AND d.c IS NOT DISTINCT FROM t.c)
    """,
)
def upsert_null_keys(spark, sf):
    """Keys of two columns, either of which may be NULL, put in twice: NULL is a key like others."""
    home = new_lake(spark, "nulls")
    rows = table(spark, sf, "orders").selectExpr(
        "if(o_orderkey % 7 = 0, NULL, o_orderkey) AS k", "if(o_custkey % 3 = 0, NULL, o_custkey) AS c", "o_totalprice AS v")
    lake.write(rows, home, "keyed", "create", partition_by=["bucket(8, c)"])
    delta = rows.filter("k IS NULL OR k % 2 = 0").withColumn("v", F.col("v") + 1)
    for _ in range(2):
        repair.upsert(spark, home, "keyed", delta, ["k", "c"], ["v"])
    return lake.read(spark, home, "keyed")


@query(
    "newest_per_key",
    """
    SELECT user_id, event_type, event_id, ts, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events
    ) WHERE n = 1
    """,
)
def newest_per_key(spark, sf):
    rows = repair.newest_per_key(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("user_id", "event_type", "event_id", "ts", "value", "props")


@query("trim_beyond_bookmark", f"SELECT * FROM orders WHERE o_orderkey <= {MID_ORDER}")
def trim_beyond_bookmark(spark, sf):
    home, orders = new_lake(spark, "trim"), table(spark, sf, "orders")
    lake.write(orders, home, "orders", "create", watermark="o_orderkey")
    repair.trim(spark, home, "orders", "o_orderkey", str(middle(orders, "o_orderkey")))
    return lake.read(spark, home, "orders")


@query(
    "recover_bookmark",
    """
    SELECT 'same rows' AS target, 'advanced' AS outcome, CAST(max(o_orderkey) AS VARCHAR) AS bookmark, count(*) AS rows FROM orders
    UNION ALL
    SELECT 'other rows', 'trimmed', CAST(m.m AS VARCHAR), count(*)
    FROM orders, (SELECT (min(o_orderkey) + max(o_orderkey)) // 2 AS m FROM orders) m
    WHERE o_orderkey <= m.m GROUP BY m.m
    """,
)
def recover_bookmark(spark, sf):
    """A target ahead of its bookmark: rows like the source's stay, others are removed."""
    orders = table(spark, sf, "orders")
    start = middle(orders, "o_orderkey")
    spec = TableSpec("orders", "primary_key", "o_orderkey")
    parts = []
    for name in ("same rows", "other rows"):
        target, store = new_lake(spark, "recover"), new_store(spark)
        job = Job("recover", Files(sf), target, store)
        beyond = F.col("o_orderkey") > start
        price = F.col("o_totalprice") + F.when(beyond & F.lit(name == "other rows"), 1).otherwise(0)
        lake.write(orders.withColumn("o_totalprice", price), target, "orders", "create", watermark="o_orderkey")
        store.put(spark, job.name, [loads.next_bookmark(spec, None, str(start), 0)])
        outcome = repair.recover(spark, job, spec)
        value = store.get(spark, job.name, ["orders"])["orders"].value
        rows = lake.read(spark, target, "orders").agg(F.count(F.lit(1)).alias("rows"))
        parts.append(rows.select(F.lit(name).alias("target"), F.lit(outcome).alias("outcome"), F.lit(value).alias("bookmark"), "rows"))
    return parts[0].unionByName(parts[1])


@query("recover_ranges", "SELECT *, CAST(3 AS BIGINT) AS ranges, TRUE AS few FROM orders")
def recover_ranges(spark, sf):
    """Missing, changed and surplus rows planted in three ranges of a target; only those ranges are loaded again."""
    orders, target, store = table(spark, sf, "orders"), new_lake(spark, "ranges"), new_store(spark)
    total = orders.count()
    cut = orders.select(F.percentile_approx("o_orderkey", [0.1, 0.12, 0.5, 0.52, 0.8, 0.82], 10000).alias("p")).first()["p"]
    inside = lambda i: F.col("o_orderkey").between(cut[i], cut[i + 1])
    damaged = (
        orders.filter(~(inside(0) & (F.col("o_orderkey") % 3 == 0)))
        .withColumn("o_totalprice", F.when(inside(2), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    )
    damaged = damaged.unionByName(orders.filter(inside(4) & (F.col("o_orderkey") % 2 == 0)))
    lake.write(damaged, target, "orders", "create", watermark="o_orderkey")
    job, spec = Job("ranges", Files(sf), target, store), TableSpec("orders", "primary_key", "o_orderkey")
    # One cell per order and little tolerance of rows that are equal, so that each planted range is one range found.
    done = repair.recover_ranges(spark, job, spec, fan=64, least_rows=max(8, total // 50))
    return lake.read(spark, target, "orders").withColumns({"ranges": F.lit(done.ranges).cast("bigint"), "few": F.lit(done.rows * 5 < total)})


@query(
    "target_consistency",
    """
    SELECT 'orders' AS table_name, CAST(max(o_orderkey) AS VARCHAR) AS target_max, 'ahead' AS state FROM orders
    UNION ALL SELECT 'customer', CAST(max(c_custkey) AS VARCHAR), 'consistent' FROM customer
    UNION ALL SELECT 'part', CAST(max(p_partkey) AS VARCHAR), 'behind' FROM part
    UNION ALL SELECT 'events', CAST(max(event_id) AS VARCHAR), 'no_bookmark' FROM events
    """,
)
def target_consistency(spark, sf):
    """Highest value of each target against its bookmark, as numbers."""
    shift = {"orders": ("o_orderkey", -1), "customer": ("c_custkey", 0), "part": ("p_partkey", 1), "events": ("event_id", None)}
    states, marks = [], []
    for name, (column, by) in shift.items():
        state = repair.target_state(table(spark, sf, name), name, column)
        states.append(state)
        value = F.col("target_max").cast("bigint") + F.lit(by).cast("bigint")
        marks.append(state.select("table_name", value.cast("string").alias("last_processed_value")))
    found, bookmarks = states[0], marks[0]
    for s, m in zip(states[1:], marks[1:]):
        found, bookmarks = found.unionByName(s), bookmarks.unionByName(m)
    return repair.consistency(found, bookmarks).select("table_name", "target_max", "state")
