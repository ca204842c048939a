"""Shards of near equal bytes: groups of equal texts packed by best fit, largest first.

Rows with equal texts form a group that is not divided; a group's weight is the bytes of all its rows. Groups are
taken by falling weight, and each enters the shard with the least room that still holds it, found in a balanced
search tree over the room that is left; where none holds it a new shard opens. Which of equally heavy groups comes
first changes nothing in the packing, so it is planned on the number of groups per weight: at most the square
root of twice the table's bytes are distinct, however many groups there are. The groups then get their rank among
those of their weight, and a join with the plan gives them their shards.

Exceptions that size forces: a group heavier than a shard is cut into pieces of whole rows that each fill a shard
as far as rows allow; a row heavier than a shard makes all shards as large as itself. Null texts count as empty
ones, in one group; null keys and repeated rows are rows like others. An empty table has no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import settled
from tablesync.llm.ranking import ranked


class Rooms:
    """Shards by the room they have left: a balanced search tree (AA tree) of (room, shard), smallest room first."""

    def __init__(self) -> None:
        self.top: list | None = None  # [key, level, left, right]

    def add(self, key: tuple[int, int]) -> None:
        self.top = _added(self.top, key)

    def drop(self, key: tuple[int, int]) -> None:
        self.top = _dropped(self.top, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The entry of the least room that is at least `size`; of equal rooms the first shard."""
        node, best = self.top, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best


def _level(node: list | None) -> int:
    return node[1] if node else 0


def _skewed(node: list) -> list:
    left = node[2]
    if _level(left) == node[1]:
        node[2], left[3] = left[3], node
        return left
    return node


def _split(node: list) -> list:
    right = node[3]
    if right and _level(right[3]) == node[1]:
        node[3], right[2] = right[2], node
        right[1] += 1
        return right
    return node


def _added(node: list | None, key: tuple[int, int]) -> list:
    if node is None:
        return [key, 1, None, None]
    side = 2 if key < node[0] else 3
    node[side] = _added(node[side], key)
    return _split(_skewed(node))


def _dropped(node: list | None, key: tuple[int, int]) -> list | None:
    if node is None:
        return None
    if key == node[0]:
        if node[2] is None and node[3] is None:
            return None
        side, other = (3, 2) if node[2] is None else (2, 3)
        near = node[side]
        while near[other]:
            near = near[other]
        node[0] = near[0]
        node[side] = _dropped(node[side], near[0])
    else:
        side = 2 if key < node[0] else 3
        node[side] = _dropped(node[side], key)
    lower = min(_level(node[2]), _level(node[3])) + 1
    if lower < node[1]:
        node[1] = lower
        if node[3] and node[3][1] > lower:
            node[3][1] = lower
    node = _skewed(node)
    if node[3]:
        node[3] = _skewed(node[3])
        if node[3][3]:
            node[3][3] = _skewed(node[3][3])
    node = _split(node)
    if node[3]:
        node[3] = _split(node[3])
    return node


@dataclass
class Plan:
    """Of the groups of a weight, those with ranks from first to before last go to a shard."""

    shards: int = 0
    weight: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    shard: list[int] = field(default_factory=list)


def best_fit(weights: list[int], counts: list[int], capacity: int, most: int | None = None) -> Plan | None:
    """The packing of `counts` groups of each weight, heaviest first; None if it needs more than `most` shards.

    A shard that took one group of a weight is the tightest for the next one as well, so it takes as many as it holds.
    """
    plan, rooms = Plan(), Rooms()
    for weight, count in zip(weights, counts):
        done = 0
        while done < count:
            tight = rooms.tightest(weight)
            if tight is None:
                if weight > capacity or plan.shards == most:
                    return None
                tight = (capacity, plan.shards)
                plan.shards += 1
            else:
                rooms.drop(tight)
            room, shard = tight
            taken = min(count - done, room // weight)
            for column, value in ((plan.weight, weight), (plan.first, done), (plan.last, done + taken), (plan.shard, shard)):
                column.append(value)
            done += taken
            if room > taken * weight:
                rooms.add((room - taken * weight, shard))
    return plan


def balanced(weights: list[int], counts: list[int], shards: int) -> Plan:
    """The packing into that many shards at about the least capacity for which best fit needs no more.

    The capacity starts at an equal share and its surplus doubles from a millionth of it, so it ends at most
    that much, or twice the least surplus, above the least one that the search could find.
    """
    total = sum(w * c for w, c in zip(weights, counts))
    least = max(-(-total // shards), weights[0])
    surplus = 0
    while (plan := best_fit(weights, counts, least + surplus, shards)) is None:
        surplus = surplus * 2 or max(1, least // 1_000_000)
    return plan


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _joined(rows: DataFrame, pieces: DataFrame, total: int, bound: int = 1000) -> DataFrame:
    """Rows with the shard of their piece. Pieces of over a thousandth of the rows, so under `bound` many, are broadcast."""
    on = ["digest", "piece"]
    limit = max(1, total // bound)
    heavy = pieces.filter(F.col("copies") > limit).select(*on, "shard")
    light = pieces.filter(F.col("copies") <= limit).select(*on, "shard")
    hot = rows.join(F.broadcast(heavy), on)
    rest = rows.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on)
    return hot.unionByName(rest)


def sharded(df: DataFrame, key: str, text: str, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """Per row: key, size, text_crc32, shard and slot (its place in the shard, from 0, without gaps).

    Either into a number of shards of near equal bytes, or into as few shards of `capacity` bytes as best fit
    needs. Equal texts lie beside each other. The result has these columns only, whatever others the table has.
    """
    value = F.col(f"`{text}`").cast("string")
    whole = F.coalesce(value, F.lit(""))
    rows = settled(df.select(
        F.col(f"`{key}`").alias("key"), size_of(value).alias("size"), F.crc32(F.encode(whole, "utf-8")).alias("text_crc32"),
        F.unhex(F.sha2(whole, 256)).alias("digest")), "sharding-rows")
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("widest")).first()
    count = found["rows"]
    if not count:
        empty = rows.select(F.col("key").alias(key), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
        return empty.filter(F.lit(False))
    full = max(-(-found["bytes"] // shards), found["widest"]) if shards else max(capacity, found["widest"])

    # Groups that no shard holds: at most one per shard's worth of bytes.
    groups = rows.groupBy("digest").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    groups = groups.withColumn("part", F.greatest(F.floor(F.lit(full) / F.col("size")), F.lit(1)).cast("long"))
    groups = settled(groups, "sharding-groups")
    over = groups.filter(F.col("copies") > F.col("part"))
    whole_rows = rows.withColumn("piece", F.lit(0).cast("long"))
    if not over.isEmpty():
        names = F.broadcast(over.select("digest", "part"))
        cut = ranked(rows.join(names, "digest"), ["digest"], ["key"], "at", "of")
        cut = cut.withColumn("piece", F.floor(F.col("at") / F.col("part"))).drop("at", "of", "part")
        whole_rows = whole_rows.join(names.select("digest"), "digest", "left_anti").unionByName(cut)
    pieces = groups.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("copies") / F.col("part")) - 1)))
    pieces = pieces.withColumn("copies", F.least(F.col("part"), F.col("copies") - F.col("piece") * F.col("part")))
    pieces = settled(pieces.select("digest", "piece", "copies", (F.col("copies") * F.col("size")).alias("weight")), "sharding-pieces")

    weights = pieces.groupBy("weight").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("weight", "descending")])
    listed = [weights.column(c).to_pylist() for c in ("weight", "n")]
    plan = balanced(*listed, shards) if shards else best_fit(*listed, full)
    planned = df.sparkSession.createDataFrame(
        pd.DataFrame({"weight": plan.weight, "first": plan.first, "last": plan.last, "shard": np.array(plan.shard, dtype=np.int32)}),
        "weight bigint, first bigint, last bigint, shard int")
    placed = ranked(pieces, ["weight"], ["digest", "piece"], "rank", "of")
    placed = placed.join(planned, "weight").filter("rank >= first AND rank < last").select("digest", "piece", "copies", "shard")
    assigned = settled(_joined(whole_rows, placed, count), "sharding-assigned")
    slots = ranked(assigned, ["shard"], ["digest", "key"], "slot", "of")
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
