"""Document quality by hierarchical empirical Bayes.

A logistic classifier on a few measures of the text, fitted on a bounded sample of labelled rows, gives
each document's evidence. Sites and the paths below them have posteriors of their own: a path's mean
quality is drawn to its site's, a site's to that of all documents, by as many rows as the spread between
sites (and between the paths of a site) says, estimated by moments. Sums by group, without the document
itself, replace the general odds in the document's evidence. A sparse site thus hardly matters, and one
with a third of all rows is a sum like any other.

Edge cases: null and empty texts have all measures zero and are judged like other texts. A null site or
path is no evidence: the document meets the level above. Labels that are null, of no document, or repeated
with different values (then the mean decides) do no harm; without labels of both kinds every evidence is the
even one and all rows are kept. Repeated rows give repeated rows (and count twice). An empty table gives an
empty table. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import shingles
from tablesync.llm.base import settled


@dataclass(frozen=True)
class Quality:
    sample: int = 20_000  # labelled rows the classifier is fitted on, drawn by a hash of their key
    ridge: float = 1e-3
    strength: tuple[float, float] = (2.0, 10_000.0)  # least and most rows by which a group is drawn
    least: float = 0.5  # probability of good quality from which a row is kept


_KIND = np.full(256, 6, dtype=np.uint8)  # letters of other scripts count by their bytes
_KIND[:128] = 5
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4

MEASURES = ["lower", "upper", "digit", "space", "stop", "symbol", "other", "word_length", "spread", "repeated", "different", "size", "short", "lone"]


def measures(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row + 1, one row of numbers per text), chunk by chunk."""
    for first, last, data, offsets in shingles.text_chunks(texts):
        n = last - first
        start, end, before = shingles.word_spans(data, offsets)
        words = shingles.word_hashes(data, start, end)
        values, at = shingles.shingles(words, before, 3)
        kinds, kinds_at = shingles.distinct(words, before)
        runs, runs_at = shingles.distinct(values, at)
        counts = np.diff(before)
        out = np.zeros((n, len(MEASURES)))
        whose = np.repeat(np.arange(n), np.diff(offsets))
        shares = np.bincount(whose * 7 + _KIND[data], minlength=n * 7).reshape(n, 7)
        out[:, :7] = shares / np.maximum(np.diff(offsets), 1)[:, None]
        lengths = (end - start).astype(np.float64)
        of = np.repeat(np.arange(n), counts)
        some = np.maximum(counts, 1)
        out[:, 7] = np.bincount(of, lengths, n) / some / 10
        out[:, 8] = np.sqrt(np.maximum(np.bincount(of, lengths**2, n) / some - (10 * out[:, 7]) ** 2, 0)) / 10
        out[:, 9] = 1 - np.diff(runs_at) / np.maximum(np.diff(at), 1)
        out[:, 10] = np.diff(kinds_at) / some
        out[:, 11] = np.log1p(counts) / 10
        out[:, 12] = counts < 10
        out[:, 13] = np.bincount(of, lengths <= 1, n) / some
        yield first, last, out


def fit(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last for the constant) of a logistic classifier, by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - centre) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    pull = np.full(len(w), ridge * len(x))
    pull[-1] = 0
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (q * (1 - q) + 1e-9)[:, None]).T @ z + np.diag(pull + 1e-9), z.T @ (y - q) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, p: Quality) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of at most `sample` labelled rows."""
    drawn = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    drawn = drawn.orderBy(F.xxhash64("key"), "key").limit(p.sample)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(drawn), "key").select("y", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, last, x in measures(part.column(1)):
                yield pa.RecordBatch.from_arrays([part.column(0).slice(first, last - first), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    found = rows.mapInArrow(run, "y double, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist(), dtype=np.float64).reshape(-1, len(MEASURES))
    y = found["y"].to_numpy()
    order = np.lexsort((*x.T, y))
    return x[order], (y[order] >= 0.5).astype(np.float64)


def evidence(df: DataFrame, text: str, model, keep: list[str]) -> DataFrame:
    """The columns to keep, and `good`: the classifier's probability of good quality."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in parts:
            for first, last, x in measures(part.column(0)):
                good = np.full(last - first, 0.5)
                if model is not None:
                    centre, scale, w = model
                    good = 1 / (1 + np.exp(-np.clip((x - centre) / scale @ w[:-1] + w[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([*[c.slice(first, last - first) for c in part.columns[1:]], pa.array(good)], [*keep, "good"])

    used = df.select(F.col(text).alias("__text"), *keep)
    schema = df.select(*keep).schema.add("good", "double")
    return used.mapInArrow(run, schema)


def _strength(groups: DataFrame, mean: Column, p: Quality) -> float:
    """Rows by which groups are drawn to `mean`: the ratio of the spread within groups to that between."""
    r = groups.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("s") / F.col("n") - mean) ** 2).alias("between"),
        F.sum(F.col("q") - F.col("s") ** 2 / F.col("n")).alias("within"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") ** 2).alias("n2")).first()
    if not r["n"] or r["k"] < 2 or r["n"] <= r["k"]:
        return p.strength[1]
    inside = max(r["within"], 0.0) / (r["n"] - r["k"])
    size = (r["n"] - r["n2"] / r["n"]) / (r["k"] - 1)
    between = (max(r["between"], 0.0) / (r["k"] - 1) - inside) / max(size, 1.0)
    return float(min(max(inside / between if between > 0 else p.strength[1], p.strength[0]), p.strength[1]))


def quality(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, site: str | Column, path: str | Column, p: Quality = Quality()) -> DataFrame:
    """Per row: key, evidence (the classifier alone), site_quality and path_quality (posteriors), quality, kept."""
    x, y = sample(docs, labels, key, text, label, p)
    model = fit(x, y, p.ridge) if 0 < y.sum() < len(y) else None
    general = float(y.mean()) if model is not None else 0.5
    column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), column(site).cast("string").alias("site"), column(path).cast("string").alias("path"))
    rows = settled(evidence(rows, "text", model, ["key", "site", "path"]), "quality-evidence")

    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("s"), F.sum(F.col("good") ** 2).alias("q")]
    overall = rows.agg(*sums).first()
    mean = (overall["s"] or 0.0) / max(overall["n"], 1)
    sites = rows.filter("site IS NOT NULL").groupBy("site").agg(*sums)
    paths = rows.filter("site IS NOT NULL AND path IS NOT NULL").groupBy("site", "path").agg(*sums)
    to_all = _strength(sites, F.lit(mean), p)
    within = paths.join(sites.select("site", (F.col("s") / F.col("n")).alias("site_mean")), "site")
    to_site = _strength(within, F.col("site_mean"), p)

    # One table of paths with their sites' sums, so that rows are joined once; rows without a site or path
    # look for one that no row has, each by itself.
    groups = paths.select("site", "path", F.col("n").alias("path_n"), F.col("s").alias("path_s"))
    groups = groups.union(sites.select("site", F.lit(None).cast("string"), F.lit(0).cast("long"), F.lit(0.0)))
    groups = groups.join(sites.select("site", F.col("n").alias("site_n"), F.col("s").alias("site_s")), "site")
    groups = groups.select(F.xxhash64("site", "path").alias("group"), "site", "path", "path_n", "path_s", "site_n", "site_s").withColumnsRenamed({"site": "g_site", "path": "g_path"})
    rows = rows.withColumn("group", F.when(F.col("site").isNotNull(), F.xxhash64("site", "path")).otherwise(F.xxhash64("key", "good")))
    same = (F.col("r.group") == F.col("g.group")) & F.col("site").eqNullSafe(F.col("g_site")) & F.col("path").eqNullSafe(F.col("g_path"))
    rows = rows.alias("r").join(groups.alias("g"), same, "left")
    at_site = F.when(F.col("site_n").isNull(), F.lit(mean)).otherwise(
        (F.col("site_s") - F.col("good") + to_all * mean) / (F.col("site_n") - 1 + to_all))
    at_path = F.when(F.coalesce("path_n", F.lit(0)) == 0, F.col("site_quality")).otherwise(
        (F.col("path_s") - F.col("good") + to_site * F.col("site_quality")) / (F.col("path_n") - 1 + to_site))
    logit = lambda c: F.log(c / (1 - c))
    bound = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    odds = logit(bound(F.col("good"))) - float(np.log(general / (1 - general))) + logit(bound(F.col("path_quality")))
    out = rows.withColumn("site_quality", at_site).withColumn("path_quality", at_path).withColumn("quality", 1 / (1 + F.exp(-odds)))
    return out.select(F.col("key").alias(key), F.col("good").alias("evidence"), "site_quality", "path_quality", "quality", (F.col("quality") >= p.least).alias("kept"))
