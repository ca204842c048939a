"""Upserts, trims and checks that make loads safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.fingerprint import lane_sums, row_hash, table_fingerprint
from tablesync.operators.incremental import above, between_marks, from_position, highest_text, mark, mark_text, position
from tablesync.plans.loads import Job, TableSpec, next_bookmark, source_rows, up_to
from tablesync.session import remove, workspace
from tablesync.sources import endpoints, jdbc, lake
from tablesync.sources.lake import Commit, Lake
from tablesync.sources.ranges import literal, quoted


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the highest in `order`, ties settled by a hash of the row.

    An aggregate instead of a window: each task sorts its rows by key and sends the newest
    one per key, so repeats of a hot key are dropped before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def by_key(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join on keys in which NULL equals NULL."""
    other = wanted.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return rows.join(other, same, how)


def upsert_rows(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the delta does not have, plus the delta; columns match by name."""
    return by_key(target, delta, keys, "left_anti").unionByName(delta)


def upsert(
    spark: SparkSession, target: Lake, table: str, delta: DataFrame, keys: Sequence[str],
    order: Sequence[str], **layout,
) -> Commit:
    """Put a delta into a lake table by key; running it again changes nothing, NULL keys included.

    The delta is written to the shared folder, which fixes its rows and their key ranges, and
    deleted again. Only folders of the target that hold one of its keys are rewritten: lay a table that
    takes upserts out by `bucket(n, key)`, and the work follows the buckets that are touched. The
    delta's own buckets leave out all other folders when the join lists its files.
    """
    before = lake.state(spark, target, table)
    path = workspace(spark, "delta")
    try:
        staged, seen = _stage(newest_per_key(lake.align(delta, before.schema), keys, order), keys, path)
        ranges = [(k, seen[f"low{i}"], seen[f"high{i}"], bool(seen[f"nulls{i}"])) for i, k in enumerate(keys)]
        rows = lake.scan_with_files(spark, target, before, list(keys), ranges, lake.buckets_of(staged, before, keys))
        for i, key in enumerate(keys):
            rows = rows.filter(_within(rows, key, seen[f"low{i}"], seen[f"high{i}"], seen[f"nulls{i}"]))
        return lake.rewrite_folders(
            spark, target, before, by_key(rows, staged, keys, "left_semi"),
            lambda rows: by_key(rows, staged, keys, "left_anti"), staged, "upsert", **layout,
        )
    finally:
        remove(spark, path)


def _within(rows: DataFrame, key: str, low: str | None, high: str | None, nulls: int) -> Column:
    """The key range of a delta, which lets file statistics skip what cannot match."""
    inside = F.lit(False) if low is None else F.col(key).between(mark(rows, key, low), mark(rows, key, high))
    return inside | F.col(key).isNull() if nulls else inside


def _stage(df: DataFrame, keys: Sequence[str], path: str) -> tuple[DataFrame, dict]:
    """Write a delta aside and measure its key ranges in the same pass."""
    seen, measures = Observation(), []
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        measures += [
            mark_text(F.min(key), kind).alias(f"low{i}"), mark_text(F.max(key), kind).alias(f"high{i}"),
            F.count_if(F.col(key).isNull()).alias(f"nulls{i}"),
        ]
    df.observe(seen, *measures).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def without_rows_beyond(df: DataFrame, column: str, bookmark: object) -> DataFrame:
    """Rows at or below a bookmark, and those without a value."""
    return df.filter(F.col(column).isNull() | (F.col(column) <= mark(df, column, bookmark)))


def trim(spark: SparkSession, target: Lake, table: str, column: str, bookmark: object) -> Commit:
    """Remove rows beyond the bookmark, as a partly written load leaves them.

    Only folders that hold such rows are rewritten; file statistics find them, and segments whose
    statistics end at or below the bookmark are not looked at.
    """
    before = lake.state(spark, target, table)
    rows = lake.scan_with_files(spark, target, lake.reaching_beyond(before, column, bookmark), [column], [(column, bookmark)])
    touched = above(rows, column, bookmark)
    return lake.rewrite_folders(
        spark, target, before, touched,
        lambda kept: without_rows_beyond(kept, column, bookmark), None, "trim",
    )


def staged_write(df: DataFrame, target: Lake, table: str, mode: str = "overwrite", **options) -> Commit:
    """Write aside, read the row count back, and only then publish."""
    return lake.write(df, target, table, mode, verify=True, **options)


def target_state(rows: DataFrame, table: str, column: str) -> DataFrame:
    """Highest value of a target table and its type as one row, to be matched with bookmarks."""
    kind = rows.schema[column].dataType.simpleString()
    return rows.agg(highest_text(rows, column).alias("target_max")).select(
        "target_max", F.lit(table).alias("table_name"), F.lit(kind).alias("value_type"))


def consistency(target_states: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Per table: is the target ahead of its bookmark, behind it, or equal.

    Values are text; the target column's type says whether they compare as numbers, as times, or as they are.
    """
    as_number = lambda c: F.expr(f"try_cast({c} as decimal(38,10))")
    as_time = lambda c: F.expr(f"try_cast({c} as timestamp_ntz)")
    value, top, kind = "last_processed_value", "target_max", F.col("value_type")
    numbers = kind.rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    times = kind.rlike("^(date|timestamp)")
    ahead = (
        F.when(numbers, as_number(top) > as_number(value))
        .when(times, as_time(top) > as_time(value))
        .otherwise(F.col(top) > F.col(value))
    )
    equal = (
        F.when(numbers, as_number(top) == as_number(value))
        .when(times, as_time(top) == as_time(value))
        .otherwise(F.col(top) == F.col(value))
    )
    return (
        bookmarks.select("table_name", value)
        .join(target_states, "table_name", "left")
        .withColumn(
            "state",
            F.when(F.col(value).isNull() & F.col(top).isNull(), "empty")
            .when(F.col(value).isNull(), "no_bookmark")
            .when(F.col(top).isNull(), "behind")
            .when(ahead, "ahead")
            .when(equal, "consistent")
            .otherwise("behind"),
        )
    )


def ranges_agree(source: DataFrame, target: DataFrame, column: str, low: object, high: object) -> bool:
    """Whether both sides hold the same rows with low < column <= high."""
    columns = sorted(target.columns)
    a = table_fingerprint(between_marks(source, column, low, high), columns).first()
    b = table_fingerprint(between_marks(target, column, low, high), columns).first()
    return tuple(a) == tuple(b)


@dataclass(frozen=True)
class Ranges:
    """Spans low <= column <= high, as numbers in the order of the column, and whether rows without a value belong to them."""

    column: str
    kind: T.DataType
    spans: tuple[tuple[int, int], ...] = ()
    nulls: bool = False

    def __bool__(self) -> bool:
        return bool(self.spans) or self.nulls

    def ends(self) -> list[tuple[str, str]]:
        return [(str(from_position(self.kind, a)), str(from_position(self.kind, z))) for a, z in self.spans]

    def hold(self) -> Column:
        """Whether a row lies in one of the spans: comparisons that a scan takes over."""
        c = F.col(f"`{self.column}`")
        found = c.isNull() if self.nulls else F.lit(False)
        for a, z in self.ends():
            found = found | c.between(F.lit(a).cast(self.kind), F.lit(z).cast(self.kind))
        return F.coalesce(found, F.lit(False))

    def sql(self, engine: str) -> list[str]:
        """The same spans as conditions of a database."""
        name = quoted(self.column)
        found = [f"{name} >= {literal(a, self.kind, engine)} AND {name} <= {literal(z, self.kind, engine)}" for a, z in self.ends()]
        return found + ([f"{name} IS NULL"] if self.nulls else [])


def differing_ranges(source: DataFrame, target: DataFrame, column: str, fan: int = 1024, least_rows: int = 1000, most: int = 256) -> Ranges:
    """Spans of a column in which two tables hold different rows.

    A tree of fingerprints: both tables are cut into `fan` cells, each with its row count and sum of row hashes, and
    only cells that differ are cut again, until none holds over `least_rows` rows of the source, which is what
    a repair loads again; what the target has beyond them is surplus however a cell is cut. A level reads the spans it cuts
    and no others, on both sides in one job, and the driver sees the cells that differ. Where over `most` of them do,
    the spans of the level before are the answer, so it has `most` spans at most and at worst is the whole table.
    """
    kind = source.schema[column].dataType
    names = sorted(target.columns)
    # The same types on both sides, so that equal values have equal text.
    alike = target.select(*[F.col(f"`{c}`").cast(source.schema[c].dataType).alias(c) for c in names])
    source = source.select(*[F.col(f"`{c}`") for c in names])
    sides = [(source, F.lit(True)), (alike, F.lit(False))]

    def cells(found: Ranges | None, width: int) -> list:
        rows = None
        for df, new in sides:
            part = df if found is None else df.filter(found.hold())
            part = part.select(position(part, column).alias("_place"), row_hash(part, names).alias("_h"), new.alias("_new"))
            rows = part if rows is None else rows.unionByName(part)
        new, old = F.col("_new"), ~F.col("_new")
        sums = rows.groupBy(F.expr(f"_place div {width}L").alias("cell")).agg(
            F.min("_place").alias("low"), F.max("_place").alias("high"), F.count_if(new).alias("a"), F.count_if(old).alias("b"),
            *lane_sums(F.col("_h"), "_a", new), *lane_sums(F.col("_h"), "_b", old))
        same = F.col("a") == F.col("b")
        for i in range(3):
            same = same & F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))
        return sums.filter(~same).select("cell", "low", "high", "a", "b").limit(most + 1).collect()

    places = None
    for df, _ in sides:
        part = df.select(position(df, column).alias("_place"))
        places = part if places is None else places.unionByName(part)
    ends = places.agg(F.min("_place").alias("low"), F.max("_place").alias("high"), F.count_if(F.col("_place").isNull()).alias("e")).first()
    whole = ((ends["low"], ends["high"]),) if ends["low"] is not None else ()
    found = Ranges(column, kind, whole, ends["e"] > 0)
    width = max(1, (ends["high"] - ends["low"]) // fan + 1) if whole else 1
    while found:
        rows = cells(found, width)
        if len(rows) > most:
            return found
        spans, largest, last = [], 0, None
        for r in sorted((r for r in rows if r["cell"] is not None), key=lambda r: r["cell"]):
            if last is not None and r["cell"] == last + 1:
                spans[-1] = (spans[-1][0], r["high"])
            else:
                spans.append((r["low"], r["high"]))
            last, largest = r["cell"], max(largest, r["a"])
        found = Ranges(column, kind, tuple(spans), any(r["cell"] is None for r in rows))
        if width == 1 or largest <= least_rows:
            return found
        width = max(1, width // fan)
    return found


@dataclass(frozen=True)
class Reloaded:
    """What a repair by ranges did."""

    ranges: int
    rows: int


def recover_ranges(spark: SparkSession, job: Job, spec: TableSpec, fan: int = 1024, least_rows: int = 1000) -> Reloaded:
    """Make a target equal to its source up to the bookmark, by reloading only the ranges that differ.

    For lakes and databases alike: missing, changed, repeated and surplus rows, those beyond the bookmark among the
    surplus. The source's rows of these ranges are written aside first, so both steps see the same ones. A lake
    publishes the repair as one snapshot. A database deletes the ranges in one transaction and takes the rows by an
    append; the ranges are compared once more afterwards, and a repair that stopped half way is found by the next.
    """
    if spec.column is None:
        raise ValueError(f"{spec.table}: a repair by ranges needs a column to cut ranges of")
    known = job.store.get(spark, job.name, [spec.table]).get(spec.table)
    source = source_rows(spark, job, spec)
    if known is not None and known.value is not None:
        source = up_to(source, spec.column, known.value)
    target = endpoints.scan(spark, job.target, spec.target)
    found = differing_ranges(source, target, spec.column, fan, least_rows)
    if not found:
        return Reloaded(0, 0)
    path = workspace(spark, "reload")
    try:
        seen = Observation()
        part = source.filter(found.hold())
        part.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        staged = spark.read.schema(part.schema).parquet(path)
        if isinstance(job.target, Lake):
            before = lake.state(spark, job.target, spec.target)
            touched = lake.scan_with_files(spark, job.target, before, [spec.column]).filter(found.hold())
            lake.rewrite_folders(spark, job.target, before, touched, lambda rows: rows.filter(~found.hold()), staged, "recover")
        else:
            jdbc.delete(spark, job.target, spec.target, found.sql(job.target.engine))
            endpoints.sink(staged, job.target, spec.target, "append", spec.column)
            again = endpoints.scan(spark, job.target, spec.target).filter(found.hold())
            if differing_ranges(staged, again, spec.column, fan, least_rows):
                raise RuntimeError(f"{spec.target}: ranges still differ after they were loaded again; recover once more")
    finally:
        remove(spark, path)
    return Reloaded(len(found.spans) + found.nulls, seen.get["n"] or 0)


def recover(spark: SparkSession, job: Job, spec: TableSpec) -> str:
    """Bring bookmark and target back together after a load that stopped half way.

    Rows beyond the bookmark that equal the source's are kept and the bookmark
    advances; otherwise a lake removes them and the next run loads them again, while
    a database has the ranges that differ loaded again.
    """
    known = job.store.get(spark, job.name, [spec.table]).get(spec.table)
    if known is None or known.value is None:
        return "no_bookmark"
    target = endpoints.scan(spark, job.target, spec.target)
    beyond = above(target.select(spec.column), spec.column, known.value)
    found = beyond.agg(highest_text(beyond, spec.column).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return "consistent"
    if ranges_agree(source_rows(spark, job, spec), target, spec.column, known.value, found["m"]):
        job.store.put(spark, job.name, [next_bookmark(spec, known, found["m"], found["n"])])
        return "advanced"
    if not isinstance(job.target, Lake):
        recover_ranges(spark, job, spec)
        return "reloaded"
    trim(spark, job.target, spec.target, spec.column, known.value)
    return "trimmed"
