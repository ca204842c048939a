"""Column profiles, size estimates and sequence gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.structs import local_rows, struct
from tablesync.operators.fingerprint import row_hash
from tablesync.operators.incremental import has_position, position

# Fixed value: share of usable values a tracking column needs, in percent.
MINIMUM_SHARE = 95

# Registers of a distinct-value sketch, as a power of two: a standard error of about 0.8 %.
SKETCH_BITS = 14

# A window over one group of ids never sees more rows than this.
IDS_PER_GROUP = 1_000_000


def profile_columns(
    df: DataFrame,
    timestamps: Sequence[str] = (),
    keys: Sequence[str] = (),
    approximate: bool = False,
    relative_error: float = 0.01,
) -> DataFrame:
    """Profile all candidate columns of a table in one pass, one result row per column.

    A timestamp column is valid when at least 95 % of its values are not NULL, a key
    when at least 95 % are distinct. `approximate` counts distinct keys with a
    sketch, which needs no shuffle of the key values. Several exact keys are counted by
    `distinct_counts`, beside the pass for everything else.
    """
    if len(keys) > 1 and not approximate:
        rest = _profile(df, timestamps, keys, F.count)
        exact = distinct_counts(df, keys).select("column", F.col("distinct").alias("_exact"), F.lit("primary_key").alias("strategy"))
        found = rest.join(exact, ["column", "strategy"], "left").withColumn("usable", F.coalesce("_exact", "usable")).drop("_exact")
        return found.withColumn("is_valid", F.col("usable") * 100 >= F.col("total") * MINIMUM_SHARE).select(*rest.columns)
    return _profile(df, timestamps, keys, (lambda c: F.approx_count_distinct(c, relative_error)) if approximate else F.count_distinct)


def _profile(df: DataFrame, timestamps: Sequence[str], keys: Sequence[str], counted) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate([*timestamps, *keys]):
        usable = F.count(c) if i < len(timestamps) else counted(F.col(c))
        measures += [
            usable.alias(f"usable_{i}"),
            F.min(c).cast("string").alias(f"low_{i}"),
            F.max(c).cast("string").alias(f"high_{i}"),
        ]
    wide = df.agg(*measures)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit("timestamp" if i < len(timestamps) else "primary_key").alias("strategy"),
            F.col("total"),
            F.col(f"usable_{i}").alias("usable"),
            F.col(f"low_{i}").alias("low"),
            F.col(f"high_{i}").alias("high"),
        )
        for i, c in enumerate([*timestamps, *keys])
    ]
    return (
        wide.select(F.inline(F.array(*rows)))
        .withColumn("is_valid", F.col("usable") * 100 >= F.col("total") * MINIMUM_SHARE)
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct): exact numbers of distinct values of many columns, NULL not among them, by one shuffle.

    Each task turns its rows into pairs (column, value) and keeps every pair once before it sends them, so what is
    shuffled are the distinct values of each task, never rows of several columns or a hot value many times.
    """
    kinds = {df.schema[c].dataType for c in columns}
    whole = all(isinstance(k, T.IntegralType) for k in kinds)

    def value(c: str):
        kind, v = df.schema[c].dataType, F.col(f"`{c}`")
        if whole:  # numbers are compared as such; columns of several types as text
            return v.cast("bigint")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            v = v + F.lit(0.0)  # -0.0 is 0.0
        if isinstance(kind, T.BinaryType):
            return F.hex(v)
        return F.to_json(F.struct(v)) if isinstance(kind, (T.StructType, T.ArrayType)) else v.cast("string")

    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value(c).alias("v")) for i, c in enumerate(columns)])).alias("p"))
    counts = pairs.select("p.i", "p.v").distinct().groupBy("i").agg(F.count("v").alias("distinct"))
    # A table without rows has no pair of any column, and each of them no value.
    names = local_rows(df.sparkSession, list(enumerate(columns)), struct(i="int", column="string"))
    return names.join(counts, "i", "left").select("column", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def sketched_profile(df: DataFrame, timestamps: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """A profile that can be added to others: per column total, values, ends and a sketch of the distinct values.

    One pass over one load; `merged_profiles` makes the profile of a table from those of its loads, so a profile of a
    growing table reads what is new. Ends are kept as text and, where a type has an order in whole numbers, as those.
    """
    columns = [*timestamps, *keys]
    measures = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        place = position(df, c) if has_position(kind) else F.lit(None).cast("bigint")
        # Sketches take numbers, text and bytes; a value's text stands for the rest.
        value = F.col(f"`{c}`") if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else F.col(f"`{c}`").cast("string")
        measures += [
            F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"a{i}"), F.max(c).cast("string").alias(f"z{i}"),
            F.min(place).alias(f"p{i}"), F.max(place).alias(f"q{i}"), F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"s{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit("timestamp" if i < len(timestamps) else "primary_key").alias("strategy"), F.col("total"),
            F.col(f"n{i}").alias("filled"), F.col(f"a{i}").alias("low"), F.col(f"z{i}").alias("high"),
            F.col(f"p{i}").alias("low_place"), F.col(f"q{i}").alias("high_place"), F.col(f"s{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def merged_profiles(stored: DataFrame) -> DataFrame:
    """One profile per column from those of several loads, itself to be stored and merged again."""
    by_place = lambda pick, end: F.coalesce(
        pick(end, f"{end}_place"), {"low": F.min, "high": F.max}[end](F.when(F.col(f"{end}_place").isNull(), F.col(end))))
    return stored.groupBy("column", "strategy").agg(
        F.sum("total").alias("total"), F.sum("filled").alias("filled"), by_place(F.min_by, "low").alias("low"),
        by_place(F.max_by, "high").alias("high"), F.min("low_place").alias("low_place"), F.max("high_place").alias("high_place"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def judged_profile(profiles: DataFrame) -> DataFrame:
    """The columns of `profile_columns` from mergeable profiles; distinct keys are estimates."""
    usable = F.when(F.col("strategy") == "timestamp", F.col("filled")).otherwise(F.least(F.hll_sketch_estimate("sketch"), "filled"))
    return profiles.withColumn("usable", usable).select(
        "column", "strategy", "total", "usable", "low", "high", (F.col("usable") * 100 >= F.col("total") * MINIMUM_SHARE).alias("is_valid"))


def size_estimate(df: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Bytes of a table: average JSON length of a sample × row count, 0 for no rows.

    Rows are drawn by a hash of the row, so the same rows are drawn however they are laid out, and
    measured where they are, in the pass that counts them. A table so small that none is drawn is
    measured whole.
    """
    length = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    drawn = F.lit(True)
    if fraction < 1:
        drawn = row_hash(df) % 1_000_000 < int(fraction * 1_000_000)
        if df.filter(drawn).isEmpty():
            return size_estimate(df, 1.0)
    return (
        df.select(F.when(drawn, length).alias("_len"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count("_len").alias("sampled"), F.avg("_len").alias("row_bytes"))
        .withColumn(
            "estimated_bytes",
            F.when(F.col("rows") == 0, 0)
            .otherwise(F.floor(F.col("row_bytes") * F.col("rows")))
            .cast("bigint"),
        )
    )


def sequence_gaps(df: DataFrame, column: str, group: int = IDS_PER_GROUP) -> DataFrame:
    """Gaps in a whole-number sequence: each value more than 1 above the one before it.

    No window runs over the whole table. Distinct values are grouped by value range,
    so a group holds at most `group` rows by construction; inside it LAG finds
    the gaps. What remains are the group edges, a table smaller by that factor,
    to which the same step is applied until one group is left.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column}: gaps need a whole-number column")
    ids = (
        df.select(F.col(column).cast("bigint").alias("low"))
        .filter("low is not null")
        .distinct()
        .withColumn("high", F.col("low"))
        .withColumn("_place", F.col("low"))
    )
    ends = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    found, edges, more = [], ids, True
    while more:
        low, high = _div(low, group), _div(high, group)
        more = low != high
        edges = edges.withColumn("_place", F.expr(f"_place div {group}L"))
        inside = edges.withColumn("_before", F.expr("lag(high) over (partition by _place order by low)"))
        found.append(
            inside.filter(F.col("low") - F.col("_before") > 1).select(
                F.col("low").alias(column),
                F.col("_before").alias("previous"),
                (F.col("low") - F.col("_before")).alias("gap"),
            )
        )
        edges = edges.groupBy("_place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def _div(value: int, by: int) -> int:
    """Whole-number division that drops the fraction, as SQL `div` does."""
    return value // by if value >= 0 else -(-value // by)
