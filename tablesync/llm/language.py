"""Language by Bayesian evidence fusion.

The text's likelihood under each language is a model of hashed byte trigrams, counted over all rows
whose declared language is one of the modelled ones. The declared language enters through a confusion
table, the address through priors smoothed in steps: a host's language shares towards those of its address
suffix, a suffix's towards all. Tables and priors are sums of text posteriors by group, a row's own part
taken out again, so one large host is a sum like any other.

A row is kept if its text has enough letters, its best language is confident, and (if `wanted` is given)
is one of the wanted. Rows that declare a language that is not modelled (too few rows, or beyond the
`most_languages` largest) have no likelihood to be judged by: they keep the declared language, with no
confidence, are kept if they have enough letters, and add nothing to the priors of the others.

Edge cases: null and empty texts have no letters, get their language from the other evidence, and are not
kept. A null declared language, host or suffix is no evidence, nor is a blank declared language that is not modelled. Without any modelled language the language
and its confidence are null and no row is kept. Repeated rows give repeated rows (and count twice). An empty
table gives an empty table. In `keep_known` rows without a key all stay, and rows that share a key are
judged each by its own text, declaration and host. Other columns are never read; those that pass through keep their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import shingles
from tablesync.llm.base import own_name, settled


@dataclass(frozen=True)
class Fusion:
    most_languages: int = 64  # modelled, by number of rows that declare them
    least_rows: int = 5  # that declare a language, for it to be modelled
    buckets: int = 1 << 14
    evidence: float = 40.0  # a text weighs as much as this many independent trigrams, at most
    independent: float = 0.2  # of a text's trigrams
    host_rows: float = 20.0  # rows by which a host is drawn to its suffix
    suffix_rows: float = 50.0  # rows by which a suffix is drawn to all
    least_letters: int = 3
    confidence: float = 0.6
    wanted: tuple[str, ...] | None = None


_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[:] = 0x20
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each trigram around a letter, the texts they belong to, and the letters of each text."""
    kept = _LETTER[data]
    wide = np.full(len(kept) + 2, 0x20, dtype=np.uint32)
    wide[1:-1] = kept
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    letter = kept != 0x20
    # Bytes that continue a character are no letters of their own, but belong to trigrams.
    letters = np.concatenate(([0], np.cumsum(letter & ((data & 0xC0) != 0x80))))
    at = np.flatnonzero(letter)
    bucket = ((code[at] * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64)
    return bucket, np.searchsorted(at, offsets), letters[offsets[1:]] - letters[offsets[:-1]]


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null if there is only one."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1)))


def languages(rows: DataFrame, p: Fusion) -> list[str]:
    found = rows.filter("declared IS NOT NULL").groupBy("declared").count().filter(F.col("count") >= p.least_rows)
    return sorted(r["declared"] for r in found.orderBy(F.desc("count"), "declared").limit(p.most_languages).collect())


def text_model(rows: DataFrame, codes: list[str], p: Fusion) -> np.ndarray:
    """Log probabilities, buckets by languages; as many numbers as these two settings allow."""
    place = {c: i for i, c in enumerate(codes)}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(codes), p.buckets), dtype=np.int64)
        for part in parts:
            of = np.array([place[c] for c in part.column(1).to_pylist()], dtype=np.int64)
            for first, last, data, offsets in shingles.text_chunks(part.column(0)):
                bucket, at, _ = trigrams(data, offsets, p.buckets)
                whose = np.repeat(of[first:last], np.diff(at))
                total += np.bincount(whose * p.buckets + bucket, minlength=total.size).reshape(total.shape)
        code, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(bucket), pa.array(total[code, bucket])], ["code", "bucket", "n"])

    used = rows.filter(F.col("declared").isin(codes)).select("text", "declared")
    sums = used.mapInArrow(run, "code bigint, bucket bigint, n bigint").groupBy("code", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((p.buckets, len(codes)), 0.5)
    found = sums.toArrow()
    counts[found["bucket"].to_numpy(), found["code"].to_numpy()] += found["n"].to_numpy()
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def text_scores(rows: DataFrame, model: np.ndarray, p: Fusion) -> DataFrame:
    """key, declared, host, suffix, letters, and the log likelihood of the text under each language (0 at best)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in parts:
            for first, last, data, offsets in shingles.text_chunks(part.column(0)):
                bucket, at, letters = trigrams(data, offsets, p.buckets)
                sums = np.zeros((last - first, model.shape[1]))
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    for i in range(model.shape[1]):
                        sums[full, i] = np.add.reduceat(model[bucket, i].astype(np.float64), at[:-1][full])
                n = np.diff(at)[:, None]
                sums *= np.minimum(p.independent, p.evidence / np.maximum(n, 1))
                sums -= sums.max(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i).slice(first, last - first) for i in range(1, 5)], pa.array(letters, pa.int64()), pa.array(list(sums), pa.list_(pa.float64()))],
                    ["key", "declared", "host", "suffix", "letters", "likelihood"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("text", "key", "declared", "host", "suffix").mapInArrow(
        run, f"key {kind}, declared string, host string, suffix string, letters bigint, likelihood array<double>")


def _sums(column: str, n: int) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(n)])


def _normal(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(F.array(total), lambda t: F.transform(weights, lambda w: w / t))[0]


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(F.array(top), lambda t: F.transform(logs, lambda x: F.exp(x - t)))[0]
    return F.transform(F.array(powers), lambda w: _normal(w))[0]


def identify(df: DataFrame, key: str, text: str, declared: str | Column, host: str | Column, suffix: Column | None = None, p: Fusion = Fusion()) -> DataFrame:
    """Per row: key, language, confidence, letters, kept."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(
        F.col(key).alias("key"), F.col(text).alias("text"), column(declared).alias("declared"), column(host).alias("host"),
        (F.lit(None).cast("string") if suffix is None else suffix).alias("suffix"))
    codes = languages(rows, p)
    if not codes:
        none = rows.select("key", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"), F.lit(0).cast("long").alias("letters"), F.lit(False).alias("kept"))
        return none.withColumnRenamed("key", key)
    n = len(codes)
    scores = settled(text_scores(rows, text_model(rows, codes, p), p), "language-scores")
    scores = scores.withColumn("text_share", _softmax(F.col("likelihood")))

    # What a language's rows declare; every language is first taken to be declared as itself.
    believed = {r["declared"]: r["s"] for r in scores.filter(F.col("declared").isin(codes)).groupBy("declared").agg(_sums("text_share", n).alias("s")).collect()}
    confusion = np.array([believed.get(c, [0.0] * n) for c in codes]) + 5 * np.eye(n) + 0.05
    confusion = np.log(confusion / confusion.sum(axis=0))
    unmodelled = F.col("declared").isNotNull() & (F.trim("declared") != "") & ~F.col("declared").isin(codes)
    judged = scores.filter(~unmodelled)
    overall = judged.agg(_sums("text_share", n).alias("s")).first()["s"] or [1.0] * n
    overall = np.array(overall) + 1.0
    overall = F.array(*[F.lit(float(x)) for x in overall / overall.sum()])

    hosts = judged.filter("host IS NOT NULL").groupBy("host").agg(_sums("text_share", n).alias("of_host"))
    suffixes = judged.filter("suffix IS NOT NULL").groupBy("suffix").agg(_sums("text_share", n).alias("of_suffix"))
    # Rows without a host or suffix look for one that no row has, each by itself.
    apart = F.concat(F.lit("\0"), F.xxhash64("key", "letters", "likelihood").cast("string"))
    rows = scores.withColumns({"at_host": F.coalesce("host", apart), "at_suffix": F.coalesce("suffix", apart)})
    rows = rows.join(hosts.withColumnRenamed("host", "at_host"), "at_host", "left").join(suffixes.withColumnRenamed("suffix", "at_suffix"), "at_suffix", "left")

    def drawn(sums: str, parent: Column, strength: float) -> Column:
        """The shares of a group without this row's own part, drawn to those of the group above."""
        others = F.zip_with(F.col(sums), F.col("text_share"), lambda s, own: F.greatest(s - own, F.lit(0.0)))
        return F.when(F.col(sums).isNull(), parent).otherwise(_normal(F.zip_with(others, parent, lambda s, q: s + strength * q)))

    rows = rows.withColumn("above", drawn("of_suffix", overall, p.suffix_rows))
    rows = rows.withColumn("prior", drawn("of_host", F.col("above"), p.host_rows))
    told = F.array(*[F.lit(0.0)] * n)
    for i, c in enumerate(codes):
        told = F.when(F.col("declared") == c, F.array(*[F.lit(float(x)) for x in confusion[i]])).otherwise(told)
    logs = F.zip_with(F.zip_with("likelihood", F.transform("prior", lambda q: F.log(F.greatest(q, F.lit(1e-9)))), lambda a, b: a + b), told, lambda a, b: a + b)
    out = rows.withColumn("share", _softmax(logs))
    best = F.array_max("share")
    names = F.array(*[F.lit(c) for c in codes])
    likeliest = F.get(names, (F.array_position("share", best) - 1).cast("int"))
    out = out.select(
        "key", F.when(unmodelled, F.col("declared")).otherwise(likeliest).alias("language"),
        F.when(unmodelled, F.lit(None)).otherwise(best).alias("confidence"), "letters")
    kept = (F.col("letters") >= p.least_letters) & F.coalesce(F.col("confidence") >= p.confidence, F.lit(True))
    if p.wanted is not None:
        kept = kept & F.col("language").isin(list(p.wanted))
    return out.withColumn("kept", kept).withColumnRenamed("key", key)


def keep_known(df: DataFrame, key: str, text: str, declared: str, host: str, p: Fusion = Fusion()) -> DataFrame:
    """The rows whose language is known, with the columns they came with.

    A row is found again by its key and a hash of what it was judged by, so a row that repeats a key with
    another text, declaration or host is judged by its own.
    """
    at, mark = own_name("key"), own_name("mark")
    evidence = [F.col(f"`{c}`") for c in (text, declared, host)]
    marked = df.withColumn(mark, F.xxhash64(*[c for e in evidence for c in (e, e.isNull())]))
    rows = marked.withColumn(at, F.struct(F.col(f"`{key}`").alias("key"), F.col(mark).alias("mark")))
    gone = identify(rows, at, text, declared, host, p=p).filter("NOT kept")
    gone = gone.select(F.col(f"{at}.key").alias(at), F.col(f"{at}.mark").alias(mark)).distinct()
    return marked.withColumn(at, F.col(f"`{key}`")).join(gone, [at, mark], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def of_pages(pages: DataFrame, key: str, url: str, source: str, p: Fusion = Fusion()) -> DataFrame:
    """Languages of web pages: their mark-up's declared language, host and address suffix, and the text between tags."""
    from tablesync.llm.site_style import host_of

    declared = F.lower(F.regexp_extract(F.col(source), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    visible = F.regexp_replace(F.coalesce(F.col(source), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    rows = pages.select(F.col(key), visible.alias("text"), F.when(declared != "", declared).alias("declared"), host_of(F.col(url)).alias("host"))
    return identify(rows, key, "text", "declared", "host", suffix_of(F.col("host")), p)
