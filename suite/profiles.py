"""Profiles, fingerprints, change splits, gaps and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import query, table
from tablesync.operators import draw, fingerprint, profile, upkeep
from tablesync.functions import amounts
from tablesync.session import workspace


def _profile_sql(t: str, strategy: str, column: str, ends: bool = False) -> str:
    usable = f"count({column})" if strategy == "timestamp" else f"count(DISTINCT {column})"
    values = f" CAST(min({column}) AS VARCHAR) AS low, CAST(max({column}) AS VARCHAR) AS high," if ends else ""
    return (
        f"SELECT '{column}' AS \"column\", '{strategy}' AS strategy, count(*) AS total, {usable} AS usable,"
        f"{values} {usable} * 100 >= count(*) * 95 AS is_valid FROM {t}"
    )


@query(
    "profile_key",
    _profile_sql("lineitem", "primary_key", "l_orderkey", ends=True) + " UNION ALL " + _profile_sql("lineitem", "primary_key", "l_partkey", ends=True)
    + " UNION ALL " + _profile_sql("orders", "primary_key", "o_orderkey", ends=True),
)
def profile_key(spark, sf):
    """Exact distinct shares: l_orderkey repeats too often for a key, o_orderkey does not."""
    lines = profile.profile_columns(table(spark, sf, "lineitem"), keys=["l_orderkey", "l_partkey"])
    return lines.unionByName(profile.profile_columns(table(spark, sf, "orders"), keys=["o_orderkey"]))


MANY_KEYS = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "orders": ["o_orderkey", "o_custkey"]}


@query("profile_many_keys", " UNION ALL ".join(_profile_sql(t, "primary_key", c, ends=True) for t, keys in MANY_KEYS.items() for c in keys))
def profile_many_keys(spark, sf):
    """Every key column of two tables, all distinct counts of a table by one shuffle of its distinct values."""
    found = [profile.profile_columns(table(spark, sf, t), keys=keys) for t, keys in MANY_KEYS.items()]
    return found[0].unionByName(found[1])


INCREMENTAL = [("primary_key", "l_orderkey"), ("primary_key", "l_partkey"), ("timestamp", "l_shipdate")]


@query("profile_incremental", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{strategy}' AS strategy, count(*) AS total, count(DISTINCT {c}) AS exact, CAST(min({c}) AS VARCHAR) AS low,"
    f" CAST(max({c}) AS VARCHAR) AS high, TRUE AS as_of_the_whole, TRUE AS is_close FROM lineitem" for strategy, c in INCREMENTAL))
def profile_incremental(spark, sf):
    """Profiles of four loads of lineitem, stored and merged: the profile of the whole table, its sketches included."""
    lines, path = table(spark, sf, "lineitem"), workspace(spark, "profiles")
    of = lambda df: profile.sketched_profile(df, [c for s, c in INCREMENTAL if s == "timestamp"], [c for s, c in INCREMENTAL if s != "timestamp"])
    for i in range(4):
        of(lines.filter(F.pmod("l_orderkey", F.lit(4)) == i)).write.mode("append").parquet(path)
    merged = profile.merged_profiles(spark.read.parquet(path))
    whole = of(lines).select("column", F.hll_sketch_estimate("sketch").alias("estimate"))
    exact = profile.distinct_counts(lines, [c for _, c in INCREMENTAL]).withColumnRenamed("distinct", "exact")
    found = merged.withColumn("merged", F.hll_sketch_estimate("sketch")).join(whole, "column").join(exact, "column")
    near = lambda a, b, share: F.abs(F.col(a) - F.col(b)) <= share * F.col(b)
    return found.select(
        "column", "strategy", "total", "exact", "low", "high", near("merged", "estimate", 0.02).alias("as_of_the_whole"),
        near("merged", "exact", 0.05).alias("is_close"))


@query("profile_ts", _profile_sql("events", "timestamp", "ts", ends=True) + " UNION ALL " + _profile_sql("lineitem", "timestamp", "l_shipdate", ends=True))
def profile_ts(spark, sf):
    events = profile.profile_columns(table(spark, sf, "events"), timestamps=["ts"])
    lines = profile.profile_columns(table(spark, sf, "lineitem"), timestamps=["l_shipdate"])
    return events.unionByName(lines)


@query("profile_nulls", """
    SELECT 'shipped' AS "column", 'timestamp' AS strategy, count(*) AS total, count(*) FILTER (l_returnflag <> 'R') AS usable,
           CAST(min(l_shipdate) FILTER (l_returnflag <> 'R') AS VARCHAR) AS low,
           CAST(max(l_shipdate) FILTER (l_returnflag <> 'R') AS VARCHAR) AS high,
           count(*) FILTER (l_returnflag <> 'R') * 100 >= count(*) * 95 AS is_valid FROM lineitem
""")
def profile_nulls(spark, sf):
    """A time that a third of the rows lack is no tracking column."""
    lines = table(spark, sf, "lineitem").withColumn("shipped", F.expr("if(l_returnflag <> 'R', l_shipdate, null)"))
    return profile.profile_columns(lines, timestamps=["shipped"])


@query(
    "profile_key_approximate",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS total, count(DISTINCT {c}) AS distinct_keys, TRUE AS is_close, min({c})::VARCHAR AS low, max({c})::VARCHAR AS high FROM lineitem"
        for c in ("l_orderkey", "l_partkey")),
)
def profile_key_approximate(spark, sf):
    """Distinct keys by sketch, in one pass without a shuffle of the keys, beside the exact ones: within 5 %."""
    lines, keys = table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"]
    sketch = profile.profile_columns(lines, keys=keys, approximate=True)
    exact = profile.profile_columns(lines, keys=keys).select("column", F.col("usable").alias("distinct_keys"))
    near = F.abs(F.col("usable") - F.col("distinct_keys")) <= 0.05 * F.col("distinct_keys")
    return sketch.join(exact, "column").select("column", "total", "distinct_keys", near.alias("is_close"), "low", "high")


@query(
    "table_statistics",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ),
)
def table_statistics(spark, sf):
    return upkeep.column_statistics(table(spark, sf, "orders")).select("column", "rows", "nulls", "low", "high")


FINGERPRINT = """
    SELECT '{name}' AS "table", count(*) AS rows,
      CAST(coalesce(sum(CAST(CAST('0x' || substr(md5({columns}), 1, 15) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS hash_sum
    FROM {source}
"""


def row_text(*values: str) -> str:
    """A row's text in SQL: each value after its length, NULL as a hyphen."""
    shown = [f"CAST({v} AS VARCHAR)" for v in values]
    return " || ".join(f"coalesce(length({v}) || ':' || {v}, '-')" for v in shown)


ORDER_COLUMNS = row_text("o_orderkey", "o_custkey", "o_orderstatus", "CAST(round(o_totalprice * 100) AS BIGINT)", "o_orderdate", "o_orderpriority")
DOCUMENT_COLUMNS = row_text("doc_id", "text", "lang", "source", "n_chars")


@query(
    "table_fingerprint",
    FINGERPRINT.format(name="orders", columns=ORDER_COLUMNS, source="orders") + " UNION ALL "
    + FINGERPRINT.format(name="documents", columns=DOCUMENT_COLUMNS, source="documents"),
)
def table_fingerprint(spark, sf):
    """Order-free fingerprints that another engine can recompute; documents over their whole text."""
    parts = [
        fingerprint.table_fingerprint(table(spark, sf, t), decimals=2).select(
            F.lit(t).alias("table"), "rows", F.col("hash_sum").cast("string").alias("hash_sum")
        )
        for t in ("orders", "documents")
    ]
    return parts[0].unionByName(parts[1])


EDGES = {"apart": ["text", "'b:-'"], "moved": ["text || 'b'", "':-'"], "marked": ["'-'", "text"], "missing": ["CAST(NULL AS VARCHAR)", "text"]}


@query(
    "fingerprint_edges",
    "SELECT doc_id, " + ", ".join(
        f"CAST('0x' || substr(md5({row_text(*columns)}), 1, 15) AS BIGINT) AS {name}" for name, columns in EDGES.items()) + " FROM documents",
)
def fingerprint_edges(spark, sf):
    """Rows whose values hold the marks of a row's text, or give the same text when run together."""
    documents = table(spark, sf, "documents")
    values = {"apart": ["text", "'b:-'"], "moved": ["text || 'b'", "':-'"], "marked": ["'-'", "text"], "missing": ["CAST(NULL AS STRING)", "text"]}
    rows = documents.select("doc_id", *[F.expr(v).alias(f"{name}_{i}") for name, pair in values.items() for i, v in enumerate(pair)])
    return rows.select("doc_id", *[fingerprint.row_hash(rows, [f"{name}_0", f"{name}_1"]).alias(name) for name in values])


@query(
    "change_split",
    """
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
      CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete'
           WHEN a.o_orderpriority = '1-URGENT' THEN 'update' ELSE 'same' END AS change
    FROM (SELECT * FROM orders WHERE o_orderpriority <> '2-HIGH') a
    FULL JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') b ON a.o_orderkey = b.o_orderkey
    """,
)
def change_split(spark, sf):
    """Inserts, deletes, updates and same rows between two versions of orders."""
    orders = table(spark, sf, "orders")
    old = orders.filter("o_orderpriority <> '2-HIGH'")
    new = orders.filter("o_orderstatus <> 'P'").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    )
    return fingerprint.change_split(old, new, ["o_orderkey"], decimals=2).select("o_orderkey", "change")


@query(
    "change_split_repeated_keys",
    """
    WITH o AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1),
    n AS (SELECT conv_id, count(*) AS n FROM conversations WHERE role <> 'assistant' OR turn > 1 GROUP BY 1)
    SELECT coalesce(o.conv_id, n.conv_id) AS conv_id, coalesce(o.n, 0) AS rows_before, coalesce(n.n, 0) AS rows_after,
      CASE WHEN n.n IS NULL THEN 'delete' WHEN o.n = n.n THEN 'same' ELSE 'update' END AS change
    FROM o FULL JOIN n ON o.conv_id = n.conv_id
    """,
)
def change_split_repeated_keys(spark, sf):
    """conv_id repeats: keys are compared as groups of rows and never paired."""
    talks = table(spark, sf, "conversations")
    return fingerprint.change_split(talks, talks.filter("role <> 'assistant' or turn > 1"), ["conv_id"])


@query(
    "seq_gaps",
    """
    SELECT event_id, previous, gap FROM (
      SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS previous,
             event_id - lag(event_id) OVER (ORDER BY event_id) AS gap
      FROM events WHERE event_type <> 'error'
    ) WHERE gap > 1
    """,
)
def seq_gaps(spark, sf):
    """Gaps that removed events leave in the sequence of ids."""
    return profile.sequence_gaps(table(spark, sf, "events").filter("event_type <> 'error'"), "event_id")


@query(
    "seq_gaps_many_groups",
    """
    SELECT l_orderkey, previous, gap FROM (
      SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous,
             l_orderkey - lag(l_orderkey) OVER (ORDER BY l_orderkey) AS gap FROM lineitem
    ) WHERE gap > 1
    """,
)
def seq_gaps_many_groups(spark, sf):
    """Repeated keys, and groups small enough for several levels of edges."""
    return profile.sequence_gaps(table(spark, sf, "lineitem"), "l_orderkey", group=64)


@query(
    "size_estimate",
    """
    SELECT 'documents' AS "table", count(*) AS rows,
      CAST(floor(avg(strlen(to_json({'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars})::VARCHAR)) * count(*)) AS BIGINT) AS estimated_bytes
    FROM documents
    UNION ALL
    SELECT 'nation', count(*), CAST(floor(avg(strlen(to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})::VARCHAR)) * count(*)) AS BIGINT)
    FROM nation
    """,
)
def size_estimate(spark, sf):
    """JSON length over every row instead of a sample, so that SQL can follow it."""
    documents = table(spark, sf, "documents")
    parts = [
        profile.size_estimate(df, fraction=1.0).select(F.lit(name).alias("table"), "rows", "estimated_bytes")
        for name, df in (("documents", documents), ("nation", table(spark, sf, "nation")))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "size_estimate_sampled",
    f"""
    WITH d AS (
      SELECT strlen(to_json({{'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars}})::VARCHAR) AS len,
        CAST('0x' || substr(md5({DOCUMENT_COLUMNS}), 1, 15) AS BIGINT) % 1000000 < 10000 AS drawn FROM documents
    ), a AS (SELECT count(*) AS rows, count(*) FILTER (drawn) AS n, avg(len) AS whole, avg(len) FILTER (drawn) AS sample FROM d)
    SELECT rows, if(n > 0, n, rows) AS sampled, CAST(floor(if(n > 0, sample, whole) * rows) AS BIGINT) AS estimated_bytes FROM a
    """,
)
def size_estimate_sampled(spark, sf):
    """The usual 1 % sample, drawn by a hash of the row, over whole documents."""
    return profile.size_estimate(table(spark, sf, "documents"), fraction=0.01).drop("row_bytes")


# --------------------------------------------------------------------------
# derived columns and change batches


@query(
    "derived_amounts",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(round(l_quantity * 10) AS BIGINT) AS total10,
      CAST(l_quantity - floor(l_quantity / 2) AS BIGINT) AS backorder,
      CAST(greatest(0, floor(l_quantity) - 20) AS BIGINT) AS available
    FROM lineitem
    """,
)
def derived_amounts(spark, sf):
    """Line totals, back orders and free stock over all order lines."""
    quantity = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(amounts.line_total(quantity, F.lit(10))).cast("bigint").alias("total10"),
        amounts.backorder(quantity, F.floor(quantity / 2)).cast("bigint").alias("backorder"),
        amounts.available(F.floor(quantity), F.lit(20)).cast("bigint").alias("available"),
    )


@query(
    "derived_tax",
    """
    SELECT o_orderkey, CAST((CAST(round(o_totalprice * 100) AS BIGINT) * 8 + 50) // 100 AS BIGINT) AS tax_cents FROM orders
    """,
)
def derived_tax(spark, sf):
    """8 % tax of every order, in cents."""
    tax = amounts.order_tax(F.col("o_totalprice"), F.lit(0), F.lit(0))
    return table(spark, sf, "orders").select("o_orderkey", (tax * 100).cast("bigint").alias("tax_cents"))


@query(
    "change_draw",
    """
    WITH ranked AS (
      SELECT *, row_number() OVER (ORDER BY CAST('0x' || substr(md5(length(CAST(c_custkey AS VARCHAR)) || ':' || c_custkey), 1, 15) AS BIGINT)) AS n,
             count(*) OVER () AS total FROM customer
    )
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ranked WHERE n <= greatest(1, CAST(floor(total * 0.1) AS BIGINT))
    """,
)
def change_draw(spark, sf):
    """Exactly a tenth of the customers for an update batch, drawn by hash without sorting them."""
    customer = table(spark, sf, "customer")
    return draw.drawn_share(customer, 0.1, fingerprint.row_hash(customer, ["c_custkey"]))
