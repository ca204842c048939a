"""Gapless positions of rows in groups, without a window that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.base import own_name, settled


def ranked(rows: DataFrame, group: list[str], order: list[str], position: str, size: str) -> DataFrame:
    """The rows with their position in their group, from 0, in the given order, and the group's number of rows.

    The rows are dealt by ranges of (group, order) and written sorted, so a large group spreads over many tasks,
    equal rows too: rows that tie take the order in which they were read. A row's number in its range, and the
    rows of its group in earlier ranges, give its position. Those sums have one row per range and group in it.
    Group columns hold no nulls; nulls in order columns come first. Columns named like the two new ones go.
    """
    tie, place, part, before, first = (own_name(x) for x in ("tie", "place", "part", "before", "first"))
    keys = [*group, *order, tie]
    dealt = rows.drop(position, size).withColumn(tie, F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*[F.col(f"`{k}`").asc_nulls_first() for k in keys])
    sorted_rows = dealt.sortWithinPartitions(*[F.col(f"`{k}`").asc_nulls_first() for k in keys])
    numbered = sorted_rows.drop(tie).withColumn(place, F.monotonically_increasing_id())
    # The id holds the number of the range in its upper bits and the row's number in its lower 33.
    written = settled(numbered, "ranked").withColumn(part, F.shiftright(place, 33))
    runs = written.groupBy(*group, part).agg(F.min(place).alias(first), F.count(F.lit(1)).alias(size))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *group, part, first, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before), F.sum(size).over(Window.partitionBy(*group)).alias(size))
    placed = written.join(runs, [*group, part]).withColumn(position, F.col(place) - F.col(first) + F.col(before))
    return placed.drop(place, part, before, first)
