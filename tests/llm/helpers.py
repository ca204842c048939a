"""Small tables with every kind of awkward row."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()),
    StructField("n_chars", LongType()), StructField("key", StringType()), StructField("id", LongType()), StructField("hits", StringType()),
    StructField("label", StringType()), StructField("text_share", StringType()), StructField("kept", StringType()),
])
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def prose(seed, n, words=60):
    """n words of a small invented vocabulary."""
    rng = random.Random(seed)
    return " ".join("w" + "abcdefghijklmnopqrstuvwxyz"[rng.randrange(26)] * rng.randrange(1, 4) + str(rng.randrange(words)) for _ in range(n))


def documents(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) with extra columns under names that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 1, "x", 7, "h", "l", "t", "k") for r in rows]
    return spark.createDataFrame(full, DOCS)


def awkward():
    """Null, empty and blank texts, one very long one, ties, repeated rows and null keys."""
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One"), (6, "a b c d"), (7, "a b c d e"), (8, prose(1, 40_000, 3000)),
        (9, "ÄÖ 日本語 \U0001f600 x y \x1c z"), (10, prose(2, 50)), (10, prose(2, 50)), (None, prose(2, 50)), (11, prose(2, 50)), (None, None),
        (12, "don't  'S a\n\n b  ###$$$ <b>&amp;"), (13, "x" * 3000), (14, "the the the the the the the the the the the the"),
    ]
