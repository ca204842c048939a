"""Running sums over an order, without a window that holds the whole of it.

Rows are dealt to sorted ranges of the order, which Spark samples to be of even size. A range is summed by
itself, the sums before it are added up over one row per range, and a window inside each range does the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.incremental import has_position, position
from tablesync.session import workspace

CHUNK = "_chunk"
# What one chunk spans: 30 days of a time, 4096 whole numbers or days.
SPAN_MICROS = 30 * 86_400 * 1_000_000
SPAN_STEPS = 4096


def with_spans(df: DataFrame, column: str, span: int | None = None) -> DataFrame:
    """The rows with a chunk number (`_chunk`) cut from a column's value; nothing is written or sampled.

    For tables of one row per period, where a span of time bounds the rows of a chunk.
    """
    kind = df.schema[column].dataType
    if not has_position(kind):
        return df.withColumn(CHUNK, F.lit(0).cast("bigint"))
    times = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    return df.withColumn(CHUNK, F.floor(position(df, column) / (span or (SPAN_MICROS if times else SPAN_STEPS))))


def in_chunks(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """The rows with the number of their range (`_chunk`), and the folder of the shared store they were written to.

    Writing them fixes the ranges: whatever is repeated later sees the same ones. The folder is the caller's to remove.
    """
    path = workspace(df.sparkSession, "chunks")
    dealt = df.repartitionByRange(*[F.col(f"`{c}`").asc_nulls_first() for c in [*by, *order]])
    numbered = dealt.withColumn(CHUNK, F.spark_partition_id())
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path), path


def carried(chunks: DataFrame, sums: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Per group and range, `sums` over all earlier ranges of the group (0 for its first one).

    The window sees one row per range, however many rows the ranges have.
    """
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = chunks.groupBy(*by, CHUNK).agg(*[c.alias(name) for name, c in sums.items()])
    return per_chunk.select(*by, CHUNK, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums])


def running_sum(chunks: DataFrame, column: str, order: Sequence[str], name: str) -> DataFrame:
    """Rows of `in_chunks` with the sum of a column over all rows up to their own."""
    before = carried(chunks, {"_before": F.sum(column)})
    inside = Window.partitionBy(CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return chunks.join(before, CHUNK).withColumn(name, F.col("_before") + F.sum(column).over(inside)).drop("_before")


def same_chunk(rows: DataFrame, chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows joined with what is known of their group and chunk; a group without a name is a group like others."""
    other = chunks.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate([*by, CHUNK])], *[c for c in chunks.columns if c not in (*by, CHUNK)])
    same = F.lit(True)
    for i, c in enumerate([*by, CHUNK]):
        same = same & rows[c].eqNullSafe(other[f"_by{i}"])
    return rows.join(other, same).drop(*[f"_by{i}" for i in range(len(by) + 1)], CHUNK)


def earlier_averages(df: DataFrame, columns: Mapping[str, str], order: str, by: Sequence[str] = (), span: int | None = None) -> DataFrame:
    """Rows with the average of columns over all earlier rows of their group: new name to column.

    Each chunk adds up its own rows, and starts from the sums of the chunks before it.
    """
    rows = with_spans(df, order, span)
    value = {name: F.col(c).cast("double") for name, c in columns.items()}
    sums = {f"_{kind}_{name}": f(v) for name, v in value.items() for kind, f in (("sum", F.sum), ("count", F.count))}
    local = Window.partitionBy(*by, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    here = {f"_here_{key}": F.coalesce(c.over(local), F.lit(0)) for key, c in sums.items()}
    found = same_chunk(rows.withColumns(here), carried(rows, sums, by), by)
    total = lambda key: F.col(key) + F.col(f"_here_{key}")
    averages = {name: F.try_divide(total(f"_sum_{name}"), total(f"_count_{name}")) for name in columns}
    return found.withColumns(averages).drop(*sums, *here)


def streaks(df: DataFrame, holds: Column, order: str, by: Sequence[str] = (), step: int | None = None, span: int | None = None, name: str = "streak") -> DataFrame:
    """Rows with how many rows in a row, up to their own, `holds` was true.

    With `step`, the distance of one row to the next in the order's whole numbers, a gap ends a streak as well. The
    streak at a chunk's first row follows from the last break before it, of which each chunk tells its own.
    """
    at = position(df, order) if has_position(df.schema[order].dataType) else F.lit(None).cast("bigint")
    rows = with_spans(df.withColumns({"_holds": F.coalesce(holds, F.lit(False)), "_at": at}), order, span)
    local = Window.partitionBy(*by, CHUNK).orderBy(order)
    gap = F.col("_at") - F.lag("_at").over(local) != F.lit(step)
    rows = rows.withColumn("_i", F.row_number().over(local).cast("bigint"))
    # A row that does not hold ends a streak at itself, a gap ends one just before its row.
    breaks = F.when(~F.col("_holds"), F.col("_i")).when(gap, F.col("_i") - 1) if step else F.when(~F.col("_holds"), F.col("_i"))
    rows = rows.withColumn("_break", breaks)
    edges = rows.groupBy(*by, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_break").alias("_last"), F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    in_order = Window.partitionBy(*by).orderBy(CHUNK)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumns({"_base": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_before": F.lag("_to").over(in_order)})
    first = F.when(F.col("_from") - F.col("_before") != F.lit(step), F.col("_base")) if step else F.lit(None).cast("bigint")
    edges = edges.withColumn("_first", first)
    own = F.greatest(F.col("_base") + F.col("_last"), F.col("_first"))
    edges = edges.select(*by, CHUNK, "_base", F.greatest(F.max(own).over(earlier), F.col("_first"), F.lit(0).cast("bigint")).alias("_broken"))
    last = F.max("_break").over(local.rowsBetween(Window.unboundedPreceding, 0))
    found = same_chunk(rows.withColumn("_here", last), edges, by)
    streak = F.col("_base") + F.col("_i") - F.greatest(F.col("_broken"), F.col("_base") + F.col("_here"))
    return found.withColumn(name, streak).drop("_holds", "_at", "_i", "_break", "_here", "_base", "_broken")
