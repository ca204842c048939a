"""Increments: rows above a bookmark, and what the next bookmark is."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import format_iso


def mark(df: DataFrame, column: str, value: object) -> Column:
    """A bookmark, stored as text, as a literal of its column's type.

    Casting the literal and not the column keeps the predicate pushable and
    compares '9' < '10' as numbers.
    """
    return F.lit(value).cast(df.schema[column].dataType)


def above(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """Rows strictly above the bookmark; every row when there is no bookmark.

    The test is for a missing bookmark, so 0 and '' are bookmarks. Rows equal to
    the bookmark are not read again, and NULLs only ever come with a full load.
    """
    if value is None:
        return df
    return df.filter(F.col(column) > mark(df, column, value))


def between_marks(df: DataFrame, column: str, low: object | None, high: object) -> DataFrame:
    """Rows with low < column <= high: a closed upper end keeps ties together."""
    return above(df, column, low).filter(F.col(column) <= mark(df, column, high))


def mark_text(value: Column, kind: T.DataType) -> Column:
    """A value as bookmark text. An instant carries its offset, so that a later run in
    another session time zone reads the same instant."""
    return format_iso(value) if isinstance(kind, T.TimestampType) else value.cast("string")


def highest_text(df: DataFrame, column: str) -> Column:
    return mark_text(F.max(column), df.schema[column].dataType)


def watermark(df: DataFrame, column: str) -> DataFrame:
    """New bookmark and row count of a delta, as one row."""
    return df.agg(highest_text(df, column).alias("watermark"), F.count(F.lit(1)).alias("rows"))


def position(df: DataFrame, column: str) -> Column:
    """A column as a whole number with the same order, independent of the session zone."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10**kind.scale)).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(c.cast("date")).cast("bigint")
        minutes = days * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    raise TypeError(f"{column}: no whole-number order for {kind.simpleString()}")


def has_position(kind: T.DataType) -> bool:
    """Whether `position` knows the type; others, such as text and wide decimals, have an order of their own."""
    if isinstance(kind, T.DecimalType):
        return kind.precision <= 18
    return isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType))


def from_position(kind: T.DataType, place: int) -> int | Decimal | date | datetime:
    """The inverse of `position` for one value."""
    if isinstance(kind, T.DecimalType):
        return Decimal(place).scaleb(-kind.scale)
    if isinstance(kind, T.DateType):
        return date(1970, 1, 1) + timedelta(days=place)
    if isinstance(kind, T.TimestampType):
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=place)
    if isinstance(kind, T.TimestampNTZType):
        return datetime(1970, 1, 1) + timedelta(microseconds=place)
    return place


class RankBounds:
    """Finds the value at which a given number of rows is reached, without sorting.

    A histogram of at most `buckets` rows is taken over the value range; the bucket
    the rank falls into is split again until it holds one value. Every step is one
    map-side aggregate over a pushed-down range, so neither a hot value nor a large
    rank puts rows into a single task. Histograms are kept for the next rank.
    """

    def __init__(self, df: DataFrame, column: str, low: object | None = None, buckets: int = 16_384):
        self.column = column
        self.kind = df.schema[column].dataType
        self.buckets = buckets
        self.rows = (
            above(df, column, low)
            .filter(F.col(column).isNotNull())
            .select(column, position(df, column).alias("_place"))
        )
        ends = self.rows.agg(
            F.min("_place").alias("low"), F.max("_place").alias("high"), F.count(F.lit(1)).alias("n")
        ).first()
        self.low, self.high, self.total = ends["low"], ends["high"], ends["n"]
        self._known: dict[tuple[int, int], list] = {}

    def _histogram(self, low: int, high: int) -> list:
        if (low, high) not in self._known:
            width = (high - low) // self.buckets + 1
            ends = [F.lit(from_position(self.kind, p)).cast(self.kind) for p in (low, high)]
            self._known[low, high] = (
                self.rows.filter(F.col(self.column).between(*ends))
                .groupBy(F.expr(f"_place div {width}L").alias("b"))
                .agg(
                    F.count(F.lit(1)).alias("n"),
                    F.min("_place").alias("low"),
                    F.max("_place").alias("high"),
                )
                .collect()  # at most `buckets` + 2 rows
            )
            self._known[low, high].sort(key=lambda cell: cell["b"])
        return self._known[low, high]

    def bound(self, rank: int) -> tuple[object, int] | None:
        """The smallest value with at least `rank` rows at or below it, and that row count."""
        if not self.total:
            return None
        if rank >= self.total:
            return from_position(self.kind, self.high), self.total
        low, high, before = self.low, self.high, 0
        while True:
            for cell in self._histogram(low, high):
                if before + cell["n"] >= rank:
                    break
                before += cell["n"]
            if cell["low"] == cell["high"]:
                return from_position(self.kind, cell["low"]), before + cell["n"]
            low, high = cell["low"], cell["high"]
