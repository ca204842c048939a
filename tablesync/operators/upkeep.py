"""Upkeep of lake tables: file health, compaction, statistics, old snapshots."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.structs import local_rows, struct
from tablesync.sources import lake
from tablesync.sources.lake import Commit, Lake

# Target size of a file and the limits for alerts.
TARGET_BYTES = 128 * 1024 * 1024
SMALL_FILE = 128 * 1024 * 1024
LARGE_FILE = 1024 * 1024 * 1024
MAX_FILES_PER_PARTITION = 10_000
MAX_PARTITIONS = 1_000
# Rows that one task sorts. A file of the target size can hold far more where rows compress well.
SORT_ROWS = 1 << 20


def file_health(
    files: DataFrame, small: int = SMALL_FILE, large: int = LARGE_FILE, most_files: int = MAX_FILES_PER_PARTITION
) -> DataFrame:
    """Per partition: files, bytes, average size, small and large files, and alerts on each of these limits."""
    return (
        files.groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("bytes").alias("bytes"),
            F.count_if(F.col("bytes") < small).alias("small_files"),
            F.count_if(F.col("bytes") > large).alias("large_files"),
        )
        .withColumn("average_bytes", F.floor(F.col("bytes") / F.col("files")))
        .withColumn("too_many_files", F.col("files") > most_files)
        .withColumn("files_too_small", F.col("average_bytes") < small)
        .withColumn("files_too_large", F.col("large_files") > 0)
    )


def table_health(files: DataFrame, most_partitions: int = MAX_PARTITIONS, **limits: int) -> DataFrame:
    """The whole table as one row, with an alert for too many partitions."""
    return file_health(files, **limits).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("small_files").alias("small_files"),
        F.sum("large_files").alias("large_files"),
        F.max("too_many_files").alias("too_many_files"),
        (F.count(F.lit(1)) > most_partitions).alias("too_many_partitions"),
    )


def partition_rows(spark: SparkSession, target: Lake, table: str) -> DataFrame:
    """Rows per partition folder; the scan reads no data column."""
    current = lake.state(spark, target, table)
    rows = lake.scan_segments(spark, target, current, current.segments)
    names = [lake.partition_column(p) for p in current.partition_spec]
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))


def sorted_layout(df: DataFrame, columns: Sequence[str], files: int, rows: int) -> DataFrame:
    """About `rows` rows in `files` ranges of `columns`, one task each, sorted inside.

    A hash of the row ends the range key, so one value that holds a third of the rows
    is still cut into several ranges. Where a file takes more rows than a task should sort, they are sorted in
    narrower ranges, and a file takes adjacent ones, each as a sorted run; no two of its runs overlap.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    runs = max(1, -(-rows // (files * SORT_ROWS)))
    ranged = df.repartitionByRange(files * runs, *columns, spread).sortWithinPartitions(*columns)
    return ranged if runs == 1 else ranged.repartitionById(files, F.floor(F.spark_partition_id() / runs).cast("int"))


def compact(
    spark: SparkSession,
    target: Lake,
    table: str,
    target_bytes: int = TARGET_BYTES,
    sort_by: Sequence[str] = (),
    compression: str = "snappy",
    committed_at: datetime | None = None,
) -> Commit:
    """Rewrite a table into one segment with files near the target size, sorted on request."""
    before = lake.state(spark, target, table)
    total = lake.files(spark, target, table).agg(F.sum("bytes").alias("b")).first()["b"] or 0
    files = max(1, -(-total // target_bytes))
    rows = lake.read(spark, target, table)
    if sort_by and not before.partition_spec:
        rows = sorted_layout(rows, sort_by, files, before.rows)
    elif not before.partition_spec:
        # Joining scan tasks needs no shuffle; each writes one file near the target size.
        rows = rows.coalesce(files)
    segment, _ = lake.write_segment(
        rows, target, table, before.schema, before.partition_spec, before.watermark_column,
        compression, sort_by=sort_by if before.partition_spec else (),
    )
    after = replace(
        before, snapshot=before.snapshot + 1, operation="compact",
        segments=(segment,) if segment.rows else (),
    )
    lake.commit(spark, target, after, committed_at)
    return Commit(table, after.snapshot, segment.rows, segment.low, segment.high, True)


def compact_small_files(
    spark: SparkSession, target: Lake, table: str, target_bytes: int = TARGET_BYTES, smaller_than: float = 0.75
) -> Commit:
    """Join only the files well below the target size; all others stay untouched, those beside them too.

    The usual upkeep of a big table: the work follows the new small files, not the table. As many
    tasks write as the bytes really rewritten ask for. A small file without another one to join in its
    folder of the layout stays.
    """
    before = lake.state(spark, target, table)
    below = math.ceil(target_bytes * smaller_than)
    small = lake.files(spark, target, table).filter(F.col("bytes") < below)
    several = small.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).filter("n > 1")
    total = several.agg(F.sum("b").alias("b")).first()["b"]
    if total is None:
        return Commit(table, before.snapshot, 0, None, None, False)
    files = max(1, -(-total // target_bytes))
    touched = small.join(several, "partition", "left_semi").select(F.col("path").alias("_file"))
    return lake.rewrite_folders(
        spark, target, before, touched,
        lambda rows: rows if before.partition_spec else rows.coalesce(files), None, "compact_small_files", below=below,
    )


def column_statistics(df: DataFrame) -> DataFrame:
    """Rows, NULLs, distinct values (sketch), smallest and largest value of every column, in one pass."""
    plain = [f for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(plain):
        c = F.col(f"`{f.name}`")
        measures += [
            F.count(c).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"a{i}"), F.max(c).cast("string").alias(f"z{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col(f"d{i}").alias("distinct"), F.col(f"a{i}").alias("low"), F.col(f"z{i}").alias("high"),
        )
        for i, f in enumerate(plain)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def record_statistics(spark: SparkSession, target: Lake, table: str) -> DataFrame:
    """Compute column statistics and keep them in the table's properties."""
    stats = column_statistics(lake.read(spark, target, table))
    found = [r.asDict() for r in stats.collect()]  # one row per column
    before = lake.state(spark, target, table)
    after = replace(
        before, snapshot=before.snapshot + 1, operation="statistics",
        properties={**before.properties, "statistics": json.dumps(found)},
    )
    lake.commit(spark, target, after)
    return stats


# --------------------------------------------------------------------------
# removal


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_unfinished_commits(spark: SparkSession, target: Lake, table: str) -> list[str]:
    """Drop manifest folders without a file, as a driver lost during a commit leaves them.

    Until then the next commit of that number fails, because the folder could belong to
    another writer at work. Run it when there is none.
    """
    home = spark._jvm.org.apache.hadoop.fs.Path(target.manifest_dir(table))
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for folder in files.listStatus(home):
        inside = [f.getPath().getName() for f in files.listStatus(folder.getPath())]
        if not any(name.endswith(".parquet") for name in inside):
            gone.append(folder.getPath().getName())
            files.delete(folder.getPath(), True)
    return sorted(gone)


def expired_snapshots(spark: SparkSession, target: Lake, table: str, older_than: datetime) -> DataFrame:
    """Snapshots committed before a time, the newest one never among them."""
    newest = lake.state(spark, target, table).snapshot
    rows = lake.manifest(spark, target, table).groupBy("snapshot").agg(F.min("committed_at").alias("at"))
    return rows.filter((F.col("at") < F.lit(older_than)) & (F.col("snapshot") < newest))


def expire_snapshots(spark: SparkSession, target: Lake, table: str, older_than: datetime) -> list[int]:
    """Drop the manifests of old snapshots. Their files go with `remove_unreferenced`."""
    gone = sorted(r["snapshot"] for r in expired_snapshots(spark, target, table, older_than).collect())
    for number in gone:
        _delete(spark, f"{target.manifest_dir(table)}/snapshot={number}")
    return gone


def unreferenced_files(spark: SparkSession, target: Lake, table: str) -> DataFrame:
    """Files no remaining snapshot shows: of failed writes, and of expired snapshots."""
    shown = lake.manifest(spark, target, table)
    segments = shown.select("segment").distinct()
    # A file is dead in a kept segment only when every snapshot that has the segment removed it.
    uses = shown.groupBy("segment").agg(F.count(F.lit(1)).alias("uses"))
    whole = shown.select("snapshot", "segment", F.explode("removed_folders").alias("partition"), F.lit(2**63 - 1).alias("below"))
    part = shown.select("snapshot", "segment", F.explode("removed_below").alias("partition", "size"))
    removed = (
        whole.unionByName(part.select("snapshot", "segment", "partition", F.col("size").cast("bigint").alias("below")))
        .groupBy("segment", "partition", "snapshot").agg(F.max("below").alias("below"))
        .groupBy("segment", "partition").agg(F.count(F.lit(1)).alias("times"), F.min("below").alias("below"))
        .join(uses, "segment").filter("times = uses").select("segment", "partition", "below")
    )
    listed = lake.all_files(spark, target, table)
    orphans = listed.join(segments, "segment", "left_anti")
    dead = listed.join(removed, ["segment", "partition"]).filter("bytes < below")
    return orphans.unionByName(dead.select(*orphans.columns))


def remove_unreferenced(spark: SparkSession, target: Lake, table: str) -> int:
    """Delete unreferenced files, folder by folder: whole segments, and removed folders of the others.

    Only in a folder that keeps some of its files the others are deleted one by one. Run it when no write to
    the table is going on: a write's files are not in a manifest before its commit.
    """
    found = unreferenced_files(spark, target, table)
    known = lake.manifest(spark, target, table).select("segment", F.lit(True).alias("known")).distinct()
    inside = lake.all_files(spark, target, table).groupBy("segment", "partition").agg(F.count(F.lit(1)).alias("all"))
    counted = found.groupBy("segment", "partition").agg(F.count(F.lit(1)).alias("n")).join(inside, ["segment", "partition"]).join(known, "segment", "left")
    # Of a segment that no snapshot knows the whole folder goes; at most a row per folder of the layout.
    folders = counted.groupBy("segment", F.when(F.col("known"), F.col("partition")).alias("partition"))
    gone = folders.agg(F.sum("n").alias("n"), F.sum("all").alias("all")).collect()
    mixed = [(r["segment"], r["partition"]) for r in gone if r["n"] < r["all"]]
    if mixed:
        beside = local_rows(spark, mixed, struct(segment="string", partition="string"))
        for row in found.join(beside, ["segment", "partition"], "left_semi").select("path").toLocalIterator():
            _delete(spark, unquote(row["path"]))
    for row in gone:
        if row["n"] == row["all"]:
            inside = "/" + unquote(row["partition"]) if row["partition"] else ""
            _delete(spark, f"{target.data_dir(table)}/seg={row['segment']}{inside}")
    return sum(row["n"] for row in gone)
