"""A lake of parquet tables with snapshots.

Layout: ``<root>/<table>/data/seg=<id>/[_p_<name>=<value>/]part-*.parquet`` and
``<root>/<table>/manifest/snapshot=<n>/``. A manifest row stands for one segment,
so a commit writes as many rows as the table has segments, never one per file.

A write puts its files into a new segment first and becomes visible only through
the manifest written after it. A failed or repeated write therefore leaves the
table as it was; its orphan segment is removed by table upkeep.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.structs import local_rows, struct
from tablesync.functions.text import clock_text
from tablesync.operators.incremental import above, mark_text

PARTITION_PREFIX = "_p_"

MANIFEST_SCHEMA = struct(
    table_name="string", committed_at="timestamp", operation="string", segment="string",
    rows="bigint", low="string", high="string", removed_folders="strings", removed_below="texts",
    segment_schema="string", schema="string", partition_spec="strings",
    identifier_columns="strings", watermark_column="string", properties="texts", snapshot="bigint",
)


class TableNotFound(LookupError):
    """The lake has no committed snapshot of the table."""


class TableExists(ValueError):
    """`create` was asked for a table that is already there."""


class StagingMismatch(RuntimeError):
    """A staged write holds a different number of rows than were sent."""


@dataclass(frozen=True)
class Lake:
    """A lake endpoint: the folder that holds the tables."""

    root: str

    def table_dir(self, table: str) -> str:
        return f"{self.root}/{table}"

    def data_dir(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    def manifest_dir(self, table: str) -> str:
        return f"{self.root}/{table}/manifest"


@dataclass(frozen=True)
class Segment:
    """One write's folder and what later snapshots removed from it.

    The unit of removal is a folder of the table's partition layout: a bucket, a day. So a manifest row
    lists at most as many names as the layout has folders, however many files a write made; without a
    layout a segment goes as a whole. Where small files were joined beside larger ones, `removed_below`
    holds a size per folder: its files of fewer bytes are gone, too. Files never change, so a size is exact.
    """

    id: str
    rows: int
    schema: str
    low: str | None = None
    high: str | None = None
    removed_folders: tuple[str, ...] = ()
    removed_below: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class TableState:
    """What the manifest says about one snapshot of one table."""

    table: str
    snapshot: int
    committed_at: datetime | None
    operation: str
    schema: T.StructType
    segments: tuple[Segment, ...]
    partition_spec: tuple[str, ...] = ()
    identifier_columns: tuple[str, ...] = ()
    watermark_column: str | None = None
    properties: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(s.rows for s in self.segments)


@dataclass(frozen=True)
class Commit:
    """The outcome of a write."""

    table: str
    snapshot: int
    rows: int
    low: str | None
    high: str | None
    committed: bool
    observed: dict = field(default_factory=dict)


# --------------------------------------------------------------------------
# manifest


def _path_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def manifest(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """All manifest rows of a table as a DataFrame."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(lake.manifest_dir(table))
    except AnalysisException as error:
        if _path_missing(error):
            raise TableNotFound(table) from None
        raise


def state(
    spark: SparkSession,
    lake: Lake,
    table: str,
    as_of: datetime | None = None,
    snapshot: int | None = None,
) -> TableState:
    """The newest snapshot, a numbered one, or the one valid at `as_of`."""
    rows = manifest(spark, lake, table)
    if as_of is not None:
        rows = rows.filter(F.col("committed_at") <= F.lit(as_of))
        newest = rows.agg(F.max("snapshot").alias("n")).first()["n"]
    else:
        # Snapshot numbers are folder names, which the listing has already seen.
        numbers = {int(re.search(r"/snapshot=(\d+)/", path)[1]) for path in rows.inputFiles()}
        newest = max(numbers, default=None) if snapshot is None else snapshot
    # One row per segment of a single snapshot: bounded by the number of writes
    # since the last compaction, not by data.
    found = [] if newest is None else rows.filter(F.col("snapshot") == newest).collect()
    if not found:
        raise TableNotFound(f"{table} has no snapshot for this request")
    head = found[0]
    segments = tuple(
        Segment(
            r.segment, r.rows, r.segment_schema, r.low, r.high, tuple(r.removed_folders or ()),
            {folder: int(size) for folder, size in (r.removed_below or {}).items()},
        )
        for r in sorted(found, key=lambda r: r.segment or "")
        if r.segment
    )
    return TableState(
        table=table,
        snapshot=newest,
        committed_at=head.committed_at,
        operation=head.operation,
        schema=T.StructType.fromJson(json.loads(head.schema)),
        segments=segments,
        partition_spec=tuple(head.partition_spec or ()),
        identifier_columns=tuple(head.identifier_columns or ()),
        watermark_column=head.watermark_column,
        properties=dict(head.properties or {}),
    )


def exists(spark: SparkSession, lake: Lake, table: str) -> bool:
    """Whether the table has a snapshot; the listing says so without a job."""
    try:
        return bool(manifest(spark, lake, table).inputFiles())
    except TableNotFound:
        return False


def commit(
    spark: SparkSession, lake: Lake, new: TableState, committed_at: datetime | None = None
) -> TableState:
    """Publish a snapshot. A second writer of the same number fails instead of winning."""
    stamp = committed_at or datetime.now(timezone.utc)
    schema_json = new.schema.json()
    shared = (schema_json, list(new.partition_spec), list(new.identifier_columns),
              new.watermark_column, dict(new.properties))
    segments = new.segments or (Segment("", 0, schema_json),)
    rows = [
        (new.table, stamp, new.operation, s.id, s.rows, s.low, s.high, list(s.removed_folders),
         {folder: str(size) for folder, size in s.removed_below.items()}, s.schema, *shared, new.snapshot)
        for s in segments
    ]
    frame = local_rows(spark, rows, MANIFEST_SCHEMA).coalesce(1).drop("snapshot")
    frame.write.mode("errorifexists").parquet(f"{lake.manifest_dir(new.table)}/snapshot={new.snapshot}")
    return replace(new, committed_at=stamp)


# --------------------------------------------------------------------------
# partition layout

# Days, months and hours are cut from the clock text, which no session time zone changes.
_TRANSFORMS = {
    "identity": lambda c, kind, n: c,
    "day": lambda c, kind, n: F.substring(clock_text(c, kind), 1, 10),
    "month": lambda c, kind, n: F.substring(clock_text(c, kind), 1, 7),
    "hour": lambda c, kind, n: F.translate(F.substring(clock_text(c, kind), 1, 13), " ", "-"),
    "bucket": lambda c, kind, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int"),
}


def parse_transform(text: str) -> tuple[str, str, int]:
    """`day(ts)` → (day, ts, 0); `bucket(16, id)` → (bucket, id, 16); `region` → identity."""
    if "(" not in text:
        return "identity", text.strip(), 0
    name, _, inner = text.partition("(")
    parts = [p.strip() for p in inner.rstrip(") ").split(",")]
    name = name.strip().lower().rstrip("s")
    if name not in _TRANSFORMS:
        raise ValueError(f"unknown partition transform {text!r}")
    if name == "bucket":
        return name, parts[1], int(parts[0])
    return name, parts[0], 0


def partition_column(transform: str) -> str:
    kind, column, _ = parse_transform(transform)
    return f"{PARTITION_PREFIX}{column}" + ("" if kind == "identity" else f"_{kind}")


def partition_value(transform: str, value: Column, kind: T.DataType) -> Column:
    name, _, n = parse_transform(transform)
    return _TRANSFORMS[name](value, kind, n)


def _partition_type(transform: str, schema: T.StructType) -> T.DataType:
    kind, column, _ = parse_transform(transform)
    if kind == "identity":
        return schema[column].dataType
    return T.IntegerType() if kind == "bucket" else T.StringType()


# --------------------------------------------------------------------------
# scans


def _project(files: DataFrame, written: T.StructType, wanted: T.StructType) -> DataFrame:
    """Show files of an older schema under the current one: match columns by field id."""
    by_id = {f.metadata.get("field_id"): f.name for f in written.fields}
    columns = []
    for f in wanted.fields:
        source = by_id.get(f.metadata.get("field_id"))
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        columns.append(value.cast(f.dataType).alias(f.name))
    return files.select(*columns, *[c for c in files.columns if c.startswith(PARTITION_PREFIX)])


def segment_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/seg=([^/]+)/", 1)


def folder_of(path: Column) -> Column:
    """The partition folder of a file inside its segment, empty without a layout."""
    return F.regexp_extract(path, r"/seg=[^/]+/(.*?)/?[^/]+$", 1)


def _in_folders(path: Column, folders: dict[str, Sequence[str]]) -> Column:
    found = F.lit(False)
    for segment, names in folders.items():
        found = found | ((segment_of(path) == segment) & F.array_contains(F.lit(list(names)), folder_of(path)))
    return found


def _joined(path: Column, size: Column, segments: Sequence[Segment]) -> Column:
    """Whether a file is one of the small ones that were joined while larger ones of its folder stayed."""
    found = F.lit(False)
    for s in segments:
        if s.removed_below:
            limits = F.create_map(*[F.lit(x) for pair in s.removed_below.items() for x in pair])
            gone = size < F.coalesce(F.try_element_at(limits, folder_of(path)), F.lit(0))
            found = found | ((segment_of(path) == s.id) & gone)
    return found


def scan_segments(
    spark: SparkSession,
    lake: Lake,
    table: TableState,
    segments: Sequence[Segment],
    with_file: bool = False,
    only: dict[str, Sequence[str]] | None = None,
    below: int | None = None,
) -> DataFrame:
    """Read some segments of a snapshot, or `only` some of their folders, one scan per schema version.

    `below` takes only files of fewer bytes. What is left out is left out when the scan lists its files.
    """
    partitions = [
        T.StructField(partition_column(p), _partition_type(p, table.schema))
        for p in table.partition_spec
    ]
    data_dir = lake.data_dir(table.table)
    frames = []
    for written_json in dict.fromkeys(s.schema for s in segments):
        group = [s for s in segments if s.schema == written_json]
        written = T.StructType.fromJson(json.loads(written_json))
        files = (
            spark.read.schema(T.StructType(written.fields + partitions))
            .option("basePath", data_dir)
            .parquet(*[f"{data_dir}/seg={s.id}" for s in group])
        )
        path = F.col("_metadata.file_path")
        removed = {s.id: s.removed_folders for s in group if s.removed_folders}
        if only is not None:
            files = files.filter(_in_folders(path, {s.id: only[s.id] for s in group}))
        elif removed:
            files = files.filter(~_in_folders(path, removed))
        size = F.col("_metadata.file_size")
        if any(s.removed_below for s in group):
            files = files.filter(~_joined(path, size, group))
        if below is not None:
            files = files.filter(size < below)
        extra = [F.col("_metadata.file_path").alias("_file")] if with_file else []
        files = files.select(
            *[F.col(f"`{f.name}`") for f in written.fields + partitions], *extra
        )
        shown = files if written == table.schema else None
        if shown is None:
            shown = _project(files, written, table.schema) if not with_file else files
        frames.append(shown)
    if not frames:
        extra = [T.StructField("_file", T.StringType())] if with_file else []
        return local_rows(spark, [], T.StructType(table.schema.fields + partitions + extra))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=with_file)
    return result


def read(
    spark: SparkSession,
    lake: Lake,
    table: str,
    as_of: datetime | None = None,
    snapshot: int | None = None,
    between: tuple[str, object, object] | None = None,
) -> DataFrame:
    """A table snapshot. `between=(column, low, high)` filters and prunes derived partitions."""
    current = state(spark, lake, table, as_of, snapshot)
    result = scan_segments(spark, lake, current, current.segments)
    if between is not None:
        column, low, high = between
        kind = current.schema[column].dataType
        result = result.filter(F.col(column).between(*[F.lit(v).cast(kind) for v in (low, high)]))
        result = pruned(result, current, column, low, high)
    return result.select(*[F.col(f"`{f.name}`") for f in current.schema.fields])


def pruned(rows: DataFrame, table: TableState, column: str, low: object | None, high: object | None = None, nulls: bool = False) -> DataFrame:
    """Rows without the partition folders that cannot hold low <= column <= high (an open end: None).

    Only transforms that keep the order of the column can prune a range. With `nulls` the folder of
    rows without a value stays, too.
    """
    kind = table.schema[column].dataType
    for spec in table.partition_spec:
        transform, base, _ = parse_transform(spec)
        if base != column or transform == "bucket":
            continue
        folder, inside = F.col(partition_column(spec)), F.lit(True)
        if low is not None:
            inside = inside & (folder >= partition_value(spec, F.lit(low).cast(kind), kind))
        if high is not None:
            inside = inside & (folder <= partition_value(spec, F.lit(high).cast(kind), kind))
        rows = rows.filter(inside | folder.isNull() if nulls else inside)
    return rows


def read_increment(
    spark: SparkSession, lake: Lake, table: str, column: str, value: object, ordered: bool = False
) -> DataFrame:
    """Rows above a bookmark. A global sort happens only on request."""
    current = state(spark, lake, table)
    kept = current if value is None else reaching_beyond(current, column, value)
    rows = above(scan_segments(spark, lake, current, kept.segments), column, value)
    if value is not None:
        rows = pruned(rows, current, column, value)
    rows = rows.select(*[F.col(f"`{f.name}`") for f in current.schema.fields])
    return rows.orderBy(column) if ordered else rows


def _comparable(text: str, kind: T.DataType):
    if isinstance(kind, T.IntegralType):
        return int(text)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return datetime.fromisoformat(text).replace(tzinfo=None)
    if isinstance(kind, T.TimestampType):
        # Text without an offset depends on the session time zone; comparing it fails, and
        # the segment is read.
        return datetime.fromisoformat(text)
    raise TypeError(kind)


def _all_at_or_below(table: TableState, segment: Segment, value: object) -> bool:
    """True when segment statistics prove that no row lies above `value`."""
    if segment.high is None:
        return False
    kind = table.schema[table.watermark_column].dataType
    try:
        return _comparable(segment.high, kind) <= _comparable(str(value), kind)
    except (TypeError, ValueError):
        return False


def reaching_beyond(table: TableState, column: str, value: object) -> TableState:
    """The snapshot without the segments whose statistics say that no row lies above a value."""
    if table.watermark_column != column:
        return table
    return replace(table, segments=tuple(s for s in table.segments if not _all_at_or_below(table, s, value)))


# --------------------------------------------------------------------------
# sinks


def with_field_ids(schema: T.StructType, known: T.StructType | None = None) -> T.StructType:
    """Give every field an id; fields already known keep theirs, new ones count on."""
    ids = {f.name.lower(): f.metadata.get("field_id") for f in (known.fields if known else [])}
    following = max([i or 0 for i in ids.values()], default=0)
    fields = []
    for f in schema.fields:
        number = ids.get(f.name.lower())
        if number is None:
            following += 1
            number = following
        meta = {"field_id": number}
        if not f.nullable:
            meta["required"] = True
        if f.metadata.get("doc"):
            meta["doc"] = f.metadata["doc"]
        fields.append(T.StructField(f.name, f.dataType, True, meta))
    return T.StructType(fields)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns by name, whatever their order; missing ones become NULL."""
    present = {c.lower(): c for c in df.columns}
    unknown = set(present) - {f.name.lower() for f in schema.fields}
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


# Files that one task of a folder writes at least, where files are limited by rows.
FILES_PER_TASK = 16


def in_full_files(df: DataFrame, folders: Sequence[str], most: int) -> DataFrame:
    """Rows dealt over all tasks so that each folder gets full files of `most` rows and one with the rest.

    A folder's rows go to as many slices as its number of rows asks for, at most one per shuffle partition. The
    full files of a slice are written together, and so is what remains of a folder's slices: less than a file of
    each. The rows of a slice are numbered by their hashes, so repeated tasks deal them out alike.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    # Equal rows of several tasks go to different slices.
    hashed = df.withColumn("_full_hash", F.xxhash64(*[F.col(f"`{c}`") for c in plain])).withColumn("_full_slice", F.xxhash64("_full_hash", F.spark_partition_id()))
    names = [F.col(f"`{c}`") for c in folders]
    counted = df.groupBy(*[c.alias(f"_full_{i}") for i, c in enumerate(names)]).agg(F.count(F.lit(1)).alias("_full_rows"))  # a row per folder
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & c.eqNullSafe(F.col(f"_full_{i}"))
    wanted = F.least(F.lit(slices).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_full_rows") / (most * FILES_PER_TASK))))
    rows = hashed.join(F.broadcast(counted), same, "left").withColumn("_full_slice", F.pmod("_full_slice", F.coalesce(wanted, F.lit(1).cast("bigint"))))
    group = Window.partitionBy(*names, "_full_slice")
    numbered = rows.withColumn("_full_place", F.row_number().over(group.orderBy("_full_hash"))).withColumn("_full_rows", F.count(F.lit(1)).over(group))
    full = F.col("_full_place") <= F.col("_full_rows") - F.col("_full_rows") % most
    return numbered.withColumn("_full_slice", F.when(full, F.col("_full_slice"))).repartition(slices, *names, "_full_slice").select(*[F.col(f"`{c}`") for c in df.columns])


def write_segment(
    df: DataFrame,
    lake: Lake,
    table: str,
    schema: T.StructType,
    partition_spec: Sequence[str] = (),
    watermark: str | None = None,
    compression: str = "snappy",
    max_records_per_file: int = 0,
    sort_by: Sequence[str] = (),
    rebalance: bool = False,
    measures: Sequence[Column] = (),
) -> tuple[Segment, dict]:
    """Write files and learn row count, watermark range and `measures` from that same write.

    With `max_records_per_file` each folder of the layout holds full files but for one; its rows are counted first.
    """
    rows = df
    partitions = []
    for spec in partition_spec:
        name = partition_column(spec)
        source = parse_transform(spec)[1]
        rows = rows.withColumn(name, partition_value(spec, F.col(source), schema[source].dataType))
        partitions.append(name)
    if partitions and max_records_per_file:
        rows = in_full_files(rows, partitions, max_records_per_file)
    elif partitions:
        # Rebalance instead of repartition: the adaptive plan splits a hot partition
        # value over several tasks and joins small ones.
        rows = rows.hint("rebalance", *[F.col(p) for p in partitions])
    elif rebalance:
        rows = rows.hint("rebalance")
    if sort_by:
        rows = rows.sortWithinPartitions(*partitions, *sort_by)
    # Observed after the last shuffle, so that rerun map tasks are not counted twice.
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("n"), *measures]
    if watermark:
        kind = schema[watermark].dataType
        wanted += [
            mark_text(F.min(watermark), kind).alias("low"),
            mark_text(F.max(watermark), kind).alias("high"),
        ]
    segment = uuid.uuid4().hex
    writer = rows.observe(seen, *wanted).write.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{lake.data_dir(table)}/seg={segment}")
    got = seen.get
    written = Segment(segment, got.get("n") or 0, schema.json(), got.get("low"), got.get("high"))
    return written, got


def write(
    df: DataFrame,
    lake: Lake,
    table: str,
    mode: str = "append",
    *,
    partition_by: Sequence[str] | None = None,
    watermark: str | None = None,
    identifier_columns: Sequence[str] | None = None,
    properties: dict | None = None,
    verify: bool = False,
    skip_empty: bool = False,
    committed_at: datetime | None = None,
    **layout,
) -> Commit:
    """Write in mode `create`, `append` or `overwrite` and publish the snapshot.

    `verify` reads the staged row count back before publishing; `skip_empty`
    publishes nothing when no row came.
    """
    if mode not in ("create", "append", "overwrite"):
        raise ValueError(f"unsupported lake write mode {mode!r}")
    spark = df.sparkSession
    try:
        before = state(spark, lake, table)
    except TableNotFound:
        before = None
    if mode == "create" and before is not None:
        raise TableExists(table)
    keeps_rows = mode == "append" and before is not None
    schema = before.schema if keeps_rows else with_field_ids(df.schema, before and before.schema)
    spec = tuple(partition_by if partition_by is not None else (before.partition_spec if before else ()))
    if keeps_rows and spec != before.partition_spec:
        raise ValueError("an append keeps the table's partition layout")
    marker = watermark or (before.watermark_column if before else None)
    # Segment statistics are about one column for the whole table.
    if keeps_rows and before.segments and before.watermark_column not in (None, marker):
        raise ValueError(f"{table} tracks {before.watermark_column}, not {marker}")
    known = {f.name.lower(): f.name for f in schema.fields}
    marker = known.get(marker.lower()) if marker else None
    segment, observed = write_segment(align(df, schema), lake, table, schema, spec, marker, **layout)
    observed = {**observed, "bytes": folder_bytes(spark, f"{lake.data_dir(table)}/seg={segment.id}")}
    if verify:
        staged = spark.read.parquet(f"{lake.data_dir(table)}/seg={segment.id}").count() if segment.rows else 0
        if staged != segment.rows:
            raise StagingMismatch(f"{table}: staged {staged} of {segment.rows} rows")
    number = before.snapshot + 1 if before else 1
    if skip_empty and segment.rows == 0 and before is not None:
        return Commit(table, before.snapshot, 0, None, None, False, observed)
    old = before.segments if keeps_rows else ()
    fresh = (segment,) if segment.rows else ()
    after = TableState(
        table=table,
        snapshot=number,
        committed_at=None,
        operation=mode,
        schema=schema,
        segments=old + fresh,
        partition_spec=spec,
        identifier_columns=tuple(
            identifier_columns
            if identifier_columns is not None
            else (before.identifier_columns if before else ())
        ),
        watermark_column=marker,
        properties={**(before.properties if before else {}), **(properties or {})},
    )
    commit(spark, lake, after, committed_at)
    return Commit(table, number, segment.rows, segment.low, segment.high, True, observed)


def slice_of(df: DataFrame, column: str, highs: Sequence, labels: Sequence) -> Column:
    """The label of the slice a row lies in: of the first one whose highest value is not below its own.

    A tree of comparisons, as deep as the logarithm of the number of slices.
    """
    if len(labels) == 1:
        return F.lit(labels[0])
    half = len(labels) // 2
    inside = F.col(column) <= F.lit(str(highs[half - 1])).cast(df.schema[column].dataType)
    return F.when(inside, slice_of(df, column, highs[:half], labels[:half])).otherwise(slice_of(df, column, highs[half:], labels[half:]))


def write_slices(
    df: DataFrame, lake: Lake, table: str, column: str, highs: Sequence, compression: str = "snappy"
) -> list[Segment]:
    """Write rows once, in a segment per slice of `column`, and return the segments that have rows, in order.

    Nothing is visible until a segment is appended to the manifest.
    """
    spark, before = df.sparkSession, state(df.sparkSession, lake, table)
    rows = align(df, before.schema)
    partitions = []
    for spec in before.partition_spec:
        source = parse_transform(spec)[1]
        rows = rows.withColumn(partition_column(spec), partition_value(spec, F.col(source), before.schema[source].dataType))
        partitions.append(partition_column(spec))
    ids = [uuid.uuid4().hex for _ in highs]
    rows = rows.withColumn("seg", slice_of(rows, column, highs, ids)).hint("rebalance", F.col("seg"), *[F.col(p) for p in partitions])
    rows.write.option("compression", compression).partitionBy("seg", *partitions).mode("append").parquet(lake.data_dir(table))
    kind = before.schema[column].dataType
    folders = {i: f"{lake.data_dir(table)}/seg={i}" for i in ids}
    there = [path for path in folders.values() if path_exists(spark, path)]  # a slice without rows has none
    if not there:
        return []
    written = spark.read.schema(T.StructType([before.schema[column]])).option("basePath", lake.data_dir(table)).parquet(*there)
    measured = written.groupBy(segment_of(F.col("_metadata.file_path")).alias("_seg")).agg(
        F.count(F.lit(1)).alias("n"), mark_text(F.min(column), kind).alias("low"), mark_text(F.max(column), kind).alias("high"))
    found = {r["_seg"]: r for r in measured.collect()}  # a row per slice
    return [Segment(i, found[i]["n"], before.schema.json(), found[i]["low"], found[i]["high"]) for i in ids if i in found]


def append_segment(spark: SparkSession, lake: Lake, table: str, segment: Segment, watermark: str) -> TableState:
    """Publish a segment written before."""
    before = state(spark, lake, table)
    known = {f.name.lower(): f.name for f in before.schema.fields}
    if before.segments and before.watermark_column not in (None, known[watermark.lower()]):
        raise ValueError(f"{table} tracks {before.watermark_column}, not {watermark}")
    return commit(spark, lake, replace(
        before, snapshot=before.snapshot + 1, operation="append", segments=(*before.segments, segment), watermark_column=known[watermark.lower()]))


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a folder, as the file system knows them; no file is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def create_if_missing(
    spark: SparkSession,
    lake: Lake,
    table: str,
    schema: T.StructType,
    identifier_columns: Sequence[str] = (),
    properties: dict | None = None,
    partition_by: Sequence[str] = (),
) -> bool:
    """Create an empty table from a schema; False when it is already there."""
    if exists(spark, lake, table):
        return False
    names = {f.name.lower(): i + 1 for i, f in enumerate(schema.fields)}
    ids = ",".join(str(names[c.lower()]) for c in identifier_columns)
    new = TableState(
        table, 1, None, "create", with_field_ids(schema), (), tuple(partition_by),
        tuple(identifier_columns), None,
        {**(properties or {}), **({"identifier-field-ids": ids} if ids else {})},
    )
    commit(spark, lake, new)
    return True


def clone_empty(df: DataFrame, lake: Lake, table: str, **options) -> bool:
    """Take over the schema of `df` without any row."""
    return create_if_missing(df.sparkSession, lake, table, df.schema, **options)


def rewrite_folders(
    spark: SparkSession,
    lake: Lake,
    before: TableState,
    touched: DataFrame,
    keep,
    added: DataFrame | None,
    operation: str,
    below: int | None = None,
    **layout,
) -> Commit:
    """Replace the folders that hold the files in `touched` (`_file`), keeping all others as they are.

    `keep` maps the rows of the touched folders to the rows that stay; `added` rows go into the same new
    segment. With `below` only their files of fewer bytes are replaced. The driver sees folder names, as many
    as the layout has in the segments that are touched.
    """
    names = touched.select(segment_of(F.col("_file")).alias("seg"), folder_of(F.col("_file")).alias("folder")).distinct()
    found = names.groupBy("seg").agg(F.sort_array(F.collect_list("folder")).alias("folders")).collect()
    folders = {r["seg"]: tuple(r["folders"]) for r in found}
    if not folders and added is None:
        return Commit(before.table, before.snapshot, 0, None, None, False)
    hit = [s for s in before.segments if s.id in folders]
    rows, rewritten = [], {}
    if hit:
        columns = [F.col(f"`{f.name}`") for f in before.schema.fields]
        if before.partition_spec or below is not None:
            counted = scan_segments(spark, lake, before, hit, with_file=True, only=folders, below=below)
            counts = counted.groupBy(segment_of(F.col("_file")).alias("seg")).count().collect()  # a row per segment, from file footers
            rewritten = {r["seg"]: r["count"] for r in counts}
        else:
            rewritten = {s.id: s.rows for s in hit}
        rows.append(keep(scan_segments(spark, lake, before, hit, only=folders, below=below).select(*columns)))
    if added is not None:
        rows.append(align(added, before.schema))
    merged = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    segment, _ = write_segment(
        merged, lake, before.table, before.schema, before.partition_spec,
        before.watermark_column, **layout,
    )
    kept = []
    for s in before.segments:
        left = s.rows - rewritten.get(s.id, 0)
        gone = folders.get(s.id, ())
        if left > 0 and below is None:
            kept.append(replace(s, rows=left, removed_folders=s.removed_folders + gone))
        elif left > 0:
            sizes = {f: max(below, s.removed_below.get(f, 0)) for f in gone}
            kept.append(replace(s, rows=left, removed_below={**s.removed_below, **sizes}))
    after = replace(
        before,
        snapshot=before.snapshot + 1,
        operation=operation,
        segments=tuple(kept) + ((segment,) if segment.rows else ()),
    )
    commit(spark, lake, after)
    return Commit(before.table, after.snapshot, segment.rows, segment.low, segment.high, True)


def buckets_of(rows: DataFrame, table: TableState, columns: Sequence[str]) -> dict[str, list[int]]:
    """Per bucket column of the layout that is made of one of `columns`, the buckets in which the rows lie."""
    specs = {partition_column(p): p for p in table.partition_spec if parse_transform(p)[0] == "bucket" and parse_transform(p)[1] in columns}
    if not specs:
        return {}
    values = [partition_value(p, F.col(parse_transform(p)[1]), table.schema[parse_transform(p)[1]].dataType) for p in specs.values()]
    found = rows.agg(*[F.sort_array(F.collect_set(F.coalesce(v, F.lit(-1)))).alias(n) for n, v in zip(specs, values)]).first()
    return {n: found[n] for n in specs}  # at most as many as the layout has buckets


def scan_with_files(
    spark: SparkSession, lake: Lake, table: TableState, columns: Sequence[str], ranges: Sequence[tuple] = (),
    buckets: dict[str, list[int]] | None = None,
) -> DataFrame:
    """Some columns of a snapshot together with the file each row lies in (`_file`).

    Each of `ranges`, the arguments of `pruned` after the table, leaves out folders, and so do `buckets`.
    """
    frames = []
    for s_json in dict.fromkeys(s.schema for s in table.segments):
        group = [s for s in table.segments if s.schema == s_json]
        view = replace(table, schema=T.StructType.fromJson(json.loads(s_json)))
        rows = scan_segments(spark, lake, view, group, with_file=True)
        for limits in ranges:
            rows = pruned(rows, table, *limits)
        for name, numbers in (buckets or {}).items():
            rows = rows.filter(F.array_contains(F.lit(numbers), F.coalesce(F.col(name), F.lit(-1))))
        by_id = {f.metadata.get("field_id"): f.name for f in view.schema.fields}
        picked = []
        for c in columns:
            f = table.schema[c]
            source = by_id.get(f.metadata.get("field_id"))
            value = F.lit(None) if source is None else F.col(f"`{source}`")
            picked.append(value.cast(f.dataType).alias(c))
        frames.append(rows.select(*picked, "_file"))
    if not frames:
        empty = T.StructType([table.schema[c] for c in columns] + [T.StructField("_file", T.StringType())])
        return local_rows(spark, [], empty)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


# --------------------------------------------------------------------------
# schema evolution


def add_column(spark: SparkSession, lake: Lake, table: str, name: str, kind: str, doc: str | None = None) -> int:
    """Add a column; rows written before read as NULL. No file is touched."""
    before = state(spark, lake, table)
    if name.lower() in {f.name.lower() for f in before.schema.fields}:
        raise ValueError(f"{table} already has {name}")
    used = [json.loads(s.schema)["fields"] for s in before.segments]
    top = max(
        [f.metadata["field_id"] for f in before.schema.fields]
        + [f["metadata"]["field_id"] for fields in used for f in fields]
    )
    meta = {"field_id": top + 1, **({"doc": doc} if doc else {})}
    added = T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType, True, meta)
    after = replace(
        before, snapshot=before.snapshot + 1, operation="add_column",
        schema=T.StructType(before.schema.fields + [added]),
    )
    return commit(spark, lake, after).snapshot


def rename_column(spark: SparkSession, lake: Lake, table: str, old: str, new: str) -> int:
    """Rename a column in the manifest. Files keep the old name and match by field id."""
    before = state(spark, lake, table)
    if old not in before.schema.names:
        raise ValueError(f"{table} has no column {old}")
    if any(parse_transform(p)[1] == old for p in before.partition_spec):
        raise ValueError(f"{old} is a partition source")
    fields = [
        T.StructField(new if f.name == old else f.name, f.dataType, True, f.metadata)
        for f in before.schema.fields
    ]
    after = replace(
        before, snapshot=before.snapshot + 1, operation="rename_column",
        schema=T.StructType(fields),
        identifier_columns=tuple(new if c == old else c for c in before.identifier_columns),
        watermark_column=new if before.watermark_column == old else before.watermark_column,
    )
    return commit(spark, lake, after).snapshot


def set_identifiers(spark: SparkSession, lake: Lake, table: str, columns: Sequence[str]) -> str:
    """Record identifier columns and their ids (position + 1) as a table property."""
    before = state(spark, lake, table)
    places = {f.name.lower(): (i + 1, f.name) for i, f in enumerate(before.schema.fields)}
    picked = [places[c.lower()] for c in columns]
    ids = ",".join(str(i) for i, _ in picked)
    after = replace(
        before, snapshot=before.snapshot + 1, operation="set_identifiers",
        identifier_columns=tuple(name for _, name in picked),
        properties={**before.properties, "identifier-field-ids": ids},
    )
    commit(spark, lake, after)
    return ids


# --------------------------------------------------------------------------
# description


def describe(spark: SparkSession, lake: Lake, tables: Sequence[str]) -> DataFrame:
    """One row per asked table: there or not, location, columns, keys, times."""
    wanted = local_rows(spark, [(t,) for t in tables], struct(table_name="string"))
    try:
        rows = (
            spark.read.schema(T.StructType(MANIFEST_SCHEMA.fields[:-1]))
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .parquet(f"{lake.root}/*/manifest")
            .withColumn(
                "snapshot", F.regexp_extract("_metadata.file_path", r"/snapshot=(\d+)/", 1).cast("bigint")
            )
        )
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        rows = local_rows(spark, [], MANIFEST_SCHEMA)
    per_snapshot = rows.groupBy("table_name", "snapshot").agg(
        F.min("committed_at").alias("committed_at"),
        F.sum("rows").alias("rows"),
        F.count(F.when(F.col("segment") != "", 1)).alias("segments"),
        F.first("schema").alias("schema"),
        F.first("partition_spec").alias("partition_spec"),
        F.first("identifier_columns").alias("identifier_columns"),
        F.first("properties").alias("properties"),
    )
    newest = per_snapshot.groupBy("table_name").agg(
        F.max_by(F.struct("*"), "snapshot").alias("s"),
        F.min("committed_at").alias("created_at"),
    )
    fields = F.from_json("s.schema", "struct<fields: array<struct<name: string, type: string>>>")
    return (
        wanted.join(newest, "table_name", "left")
        .withColumn("f", fields)
        .select(
            "table_name",
            F.col("s").isNotNull().alias("table_exists"),
            F.when(F.col("s").isNotNull(), F.concat(F.lit(lake.root + "/"), "table_name")).alias("location"),
            F.col("s.snapshot").alias("snapshot"),
            F.col("s.rows").alias("rows"),
            F.col("s.segments").alias("segments"),
            F.transform("f.fields", lambda x: x["name"]).alias("columns"),
            F.col("s.partition_spec").alias("partition_keys"),
            F.col("s.identifier_columns").alias("identifier_columns"),
            F.col("s.properties").alias("properties"),
            "created_at",
            F.col("s.committed_at").alias("updated_at"),
        )
    )


def files(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Live data files of the newest snapshot: path, bytes, segment, partition folder.

    Paths are URLs as in `_metadata.file_path`.
    """
    current = state(spark, lake, table)
    segments = local_rows(spark, [(s.id,) for s in current.segments], struct(segment="string"))
    removed = local_rows(
        spark, [(s.id, p) for s in current.segments for p in s.removed_folders], struct(segment="string", partition="string")
    )
    limits = local_rows(
        spark, [(s.id, p, n) for s in current.segments for p, n in s.removed_below.items()],
        struct(segment="string", partition="string", below="bigint"),
    )
    listed = all_files(spark, lake, table).join(segments, "segment").join(removed, ["segment", "partition"], "left_anti")
    return listed.join(limits, ["segment", "partition"], "left").filter("bytes >= coalesce(below, 0)").drop("below")


def all_files(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Every data file in the table's folder, shown by a snapshot or not. Only the listing is read."""
    path = F.col("_metadata.file_path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(lake.data_dir(table))
        .select(
            path.alias("path"), F.col("length").alias("bytes"), segment_of(path).alias("segment"), folder_of(path).alias("partition"),
        )
    )
