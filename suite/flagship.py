"""The flagship run: detect, load a first slice, increment, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import TABLES, middle, new_lake, new_store, table
from tablesync.operators.incremental import above
from tablesync.plans import runner
from tablesync.plans.loads import Job
from tablesync.sources import lake
from tablesync.sources.files import Files


def flagship(spark, sf_dir: str):
    """Run log of two runs over all tables: first with half of orders and events, then with all."""
    source, target, store = new_lake(spark, "flag-source"), new_lake(spark, "flag-target"), new_store(spark)
    halves = {"orders": "o_orderkey", "events": "event_id"}
    for name, key in halves.items():
        rows = table(spark, sf_dir, name)
        lake.write(rows.filter(F.col(key) <= middle(rows, key)), source, name, "create", watermark=key)
    first = Job("flagship", source, target, store)
    rest = Job("flagship", Files(sf_dir), target, store)
    specs = {s.table: s for s in runner.detect_specs(spark, rest, TABLES, manual={"orders": "o_orderkey"})}
    log = runner.run(spark, first, [specs[t] for t in halves])
    for name, key in halves.items():
        rows = table(spark, sf_dir, name)
        lake.write(above(rows, key, middle(rows, key)), source, name, "append", watermark=key)
    log += runner.run(spark, first, [specs[t] for t in halves])
    log += runner.run(spark, rest, [specs[t] for t in TABLES if t not in halves])
    return runner.run_log(spark, log)
