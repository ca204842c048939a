"""Order-free fingerprints of rows, keys and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import clock_text

NULL_MARK = "-"  # no part begins like it: a value's part begins with its length
LANE_BITS = 20


def text_of(df: DataFrame, column: str, decimals: int | None = None) -> Column:
    """One column as text with its length before it, so that parts of a row cannot run into one another."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if decimals is not None and isinstance(kind, (T.DoubleType, T.FloatType)):
        # Equal money values must give equal text in every engine.
        value = F.round(value * 10**decimals).cast("bigint")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value)
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    elif isinstance(kind, T.TimestampType):
        text = clock_text(value, kind)
    else:
        text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, decimals: int | None = None) -> Column:
    """60 bits of the MD5 of a row's text, as a bigint that other engines can recompute."""
    parts = [text_of(df, c, decimals) for c in (columns or df.columns)]
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def lane_sums(value: Column, name: str, when: Column | None = None) -> list[Column]:
    """Aggregates that add 60-bit hashes as three bigint sums.

    Each lane holds 20 bits and stays far from overflow up to 2**43 rows, and
    long additions are much cheaper than adding 38-digit decimals row by row.
    """
    mask = (1 << LANE_BITS) - 1
    lanes = []
    for i in range(3):
        lane = F.shiftright(value, i * LANE_BITS).bitwiseAND(F.lit(mask).cast("bigint"))
        if when is not None:
            lane = F.when(when, lane)
        lanes.append(F.sum(lane).alias(f"{name}{i}"))
    return lanes


def lane_total(name: str) -> Column:
    """The exact sum behind `lane_sums`."""
    total = F.lit(0).cast("decimal(38,0)")
    for i in range(3):
        part = F.coalesce(F.col(f"{name}{i}"), F.lit(0)).cast("decimal(20,0)")
        total = total + part * F.lit(1 << (i * LANE_BITS)).cast("decimal(14,0)")
    return total.cast("decimal(38,0)")


def table_fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, decimals: int | None = None
) -> DataFrame:
    """One row: row count and sum of row hashes. Row order and file layout do not matter."""
    hashed = df.select(row_hash(df, columns, decimals).alias("_h"))
    return hashed.agg(F.count(F.lit(1)).alias("rows"), *lane_sums(F.col("_h"), "_s")).select(
        "rows", lane_total("_s").alias("hash_sum")
    )


def checkpoint_text(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """A fingerprint as the text kept in a bookmark's `row_hash_checkpoint`."""
    row = table_fingerprint(df, columns).first()
    return f"{row['rows']}:{row['hash_sum']}"


def change_split(
    before: DataFrame, after: DataFrame, keys: Sequence[str], decimals: int | None = None
) -> DataFrame:
    """Per key: insert, update, delete or same.

    Both sides are reduced to row hashes and added up per key in one shuffle with
    map-side partial sums, so repeated keys never pair up and a hot key stays small.
    """
    columns = [c for c in before.columns if c not in keys]

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select(
            *keys, row_hash(df, [*keys, *columns], decimals).alias("_h"), F.lit(is_new).alias("_new")
        )

    new, old = F.col("_new"), ~F.col("_new")
    sums = (
        side(before, False)
        .unionByName(side(after, True))
        .groupBy(*keys)
        .agg(
            F.count_if(old).alias("rows_before"),
            F.count_if(new).alias("rows_after"),
            *lane_sums(F.col("_h"), "_o", old),
            *lane_sums(F.col("_h"), "_n", new),
        )
    )
    same = F.col("rows_before") == F.col("rows_after")
    for i in range(3):
        same = same & F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}"))
    kind = (
        F.when(F.col("rows_before") == 0, "insert")
        .when(F.col("rows_after") == 0, "delete")
        .when(same, "same")
        .otherwise("update")
    )
    return sums.select(*keys, kind.alias("change"), "rows_before", "rows_after")
