"""An exact share of a table's rows, drawn by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.incremental import RankBounds


def drawn_share(df: DataFrame, share: float, draw: Column) -> DataFrame:
    """Exactly `max(1, floor(rows × share))` rows, the ones with the smallest draw.

    The rank is found by histogram, so no task sorts the table. Draws are 60-bit hashes of a key;
    equal ones come or stay together.
    """
    ranked = df.withColumn("_draw", draw)
    ranks = RankBounds(ranked, "_draw")
    found = ranks.bound(max(1, int(ranks.total * share)))
    if found is None:
        return df.limit(0)
    return ranked.filter(F.col("_draw") <= F.lit(found[0])).drop("_draw")
