"""Benchmark passages in documents, by SimHash of item-sized windows.

Every document is covered with windows as long as the benchmark items, in classes of nearly equal
length, an eighth of a window apart. A window and an item have 64-bit SimHash fingerprints of their
two-word shingles. The fingerprints of a class are cut into blocks; an item is listed under every
block value within radius // blocks bits of its own, so an item within the radius of a window is
listed under at least one of the window's block values. Each candidate is then verified
exactly: among all item-sized windows beside it, the best weighted similarity (sum of the smaller over
sum of the larger number of occurrences) of five-word shingles must reach 0.75.

The benchmark is the stated query set. It is read in blocks of bounded bytes, each of which is sent to
the tasks; documents stay where they are, and nothing is shuffled.

Edge cases: null and empty texts hold no passage. Items that are null or have fewer than five words
are no evidence and are left out. Repeated items are each reported; repeated rows give repeated rows.
An empty benchmark leaves every document clean, an empty table stays empty. A document shorter than an
item is one window. Columns of the input pass through under their names, whatever these are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.llm import shingles
from tablesync.llm.base import own_name

HIT = "array<struct<item_id:bigint,similarity:double,first_word:bigint>>"


@dataclass(frozen=True)
class Decontamination:
    width: int = 5  # words in a shingle of the exact similarity
    percent: int = 75
    feature: int = 2  # words in a shingle of the fingerprint
    radius: int = 19  # bits in which the fingerprints of a window and an item may differ
    blocks: int = 4
    spread: float = 1.15  # longest over shortest item of one class
    step: int = 8  # windows begin a window's length over this apart
    block_bytes: int = 1 << 19  # of benchmark text sent to the tasks at once; an item's index takes 32 KB at least


def fingerprints(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 majority bits, of the counts of ones among `sizes` features."""
    return np.packbits(2 * counts > sizes[:, None], axis=1).view(np.uint64).ravel()


def one_bits(features: np.ndarray) -> np.ndarray:
    return np.unpackbits(features.view(np.uint8).reshape(-1, 8), axis=1)


class Ones:
    """Running counts of the ones in each of 64 bits, many counters to a machine word.

    Row j holds the bits j, j + lane, j + 2 * lane, ... of the features before every second one, each in a lane of its
    own. Sums are taken modulo the word; a difference is exact while no counter of it outgrows its lane, which the
    longest window decides.
    """

    def __init__(self, features: np.ndarray, longest: int):
        self.lane = 8 if longest < 250 else 16 if longest < 65_000 else 32
        self.ones = np.uint64(sum(1 << i for i in range(0, 64, self.lane)))
        even, odd = features[0::2], features[1::2]
        self.total = np.zeros((self.lane, len(even) + 1), dtype=np.uint64)
        for j, row in enumerate(self.total):
            pair = (even >> np.uint64(j)) & self.ones
            pair[: len(odd)] += (odd >> np.uint64(j)) & self.ones
            np.cumsum(pair, out=row[1:])

    def prints(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Of the features of pairs a to before z, the 64 majority bits."""
        # A counter above z - a, half the features, reaches the lane's top bit with this added.
        lift = ((1 << (self.lane - 1)) - 1 - (z - a)).astype(np.uint64) * self.ones
        out = np.zeros(len(a), dtype=np.uint64)
        for j, row in enumerate(self.total):
            lifted = row[z]
            lifted -= row[a]
            lifted += lift
            lifted >>= np.uint64(self.lane - 1)
            lifted &= self.ones
            lifted <<= np.uint64(j)
            out |= lifted
        return out


class LengthClass:
    """Items of nearly one length: their fingerprints, and per block the items near each block value, as bits of words."""

    def __init__(self, window: int, items: list[int], prints: np.ndarray, p: Decontamination):
        self.window, self.stride = window, max(2, window // p.step)
        self.items, self.prints, self.radius = np.array(items), prints, p.radius
        bits = 64 // p.blocks
        values = np.arange(1 << bits, dtype=np.uint64)
        self.bits, self.mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        self.near_items = np.zeros((-(-len(items) // 64), p.blocks, 1 << bits), dtype=np.uint64)
        for k, whole in enumerate(prints):
            for b in range(p.blocks):
                own = (whole >> np.uint64(b * bits)) & self.mask
                near = np.bitwise_count(values ^ own) <= p.radius // p.blocks
                self.near_items[k // 64, b, near] |= np.uint64(1 << (k % 64))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius, each once."""
        values = [((prints >> (np.uint64(b) * self.bits)) & self.mask).astype(np.intp) for b in range(self.near_items.shape[1])]
        found = [np.zeros(0, dtype=np.int64)]
        for w, tables in enumerate(self.near_items):
            items = tables[0][values[0]]
            for table, value in zip(tables[1:], values[1:]):
                items |= table[value]
            rows = np.flatnonzero(items)
            items, own = items[rows], prints[rows]
            # The lowest item of each window's set, then the next ones of those that have more.
            while len(rows):
                lowest = items & (~items + np.uint64(1))
                k = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) + 64 * w
                good = np.flatnonzero(np.bitwise_count(own ^ self.prints[k]) <= self.radius)
                found.append(rows[good] * len(self.items) + k[good])
                items ^= lowest
                more = np.flatnonzero(items)
                rows, items, own = rows[more], items[more], own[more]
        pairs = np.sort(np.concatenate(found))
        return pairs // len(self.items), self.items[pairs % len(self.items)]


class Index:
    """One block of the benchmark, ready to be sent to the tasks."""

    def __init__(self, items: list[tuple[int, str]], p: Decontamination):
        self.p, self.ids, self.shingles, sizes, prints = p, [], [], [], []
        for item_id, text in items:
            for _, _, data, offsets in shingles.text_chunks(pa.array([text], pa.string()), max(1, len(text) * 4)):
                start, end, before = shingles.word_spans(data, offsets)
                if len(start) < p.width:
                    continue
                words = shingles.word_hashes(data, start, end)
                features, _ = shingles.shingles(words, before, p.feature)
                exact, _ = shingles.shingles(words, before, p.width)
                self.ids.append(item_id)
                self.shingles.append(np.unique(exact, return_counts=True))
                sizes.append(len(features))
                prints.append(fingerprints(one_bits(features).sum(axis=0, dtype=np.int64)[None], np.array([len(features)]))[0])
        self.table = np.zeros(1 << 20, dtype=bool)  # which shingles may be an item's
        for found, _ in self.shingles:
            self.table[found & np.uint64(0xFFFFF)] = True
        self.totals = np.array([int(c.sum()) for _, c in self.shingles], dtype=np.int64)
        self.lengths = np.array(sizes, dtype=np.int64)
        self.classes, group = [], []
        for i in [*np.argsort(self.lengths, kind="stable").tolist(), None]:
            if group and (i is None or sizes[i] > p.spread * sizes[group[0]]):
                window = (sizes[group[0]] + sizes[group[-1]] + 1) // 2
                self.classes.append(LengthClass(window, group, np.array([prints[k] for k in group], dtype=np.uint64), p))
                group = []
            if i is not None:
                group.append(i)

    def search(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, dict[int, tuple[float, int]]]:
        """For each text of a chunk that holds items: item to (similarity, first word of the passage)."""
        p = self.p
        start, end, before = shingles.word_spans(data, offsets)
        words = shingles.word_hashes(data, start, end)
        features, feature_at = shingles.shingles(words, before, p.feature)
        exact, exact_at = shingles.shingles(words, before, p.width)
        hits: dict[int, dict[int, tuple[float, int]]] = {}
        if not len(features) or not self.classes:
            return hits
        ones = Ones(features, max(c.window for c in self.classes))
        of_item = np.concatenate(([0], np.cumsum(self.table[exact & np.uint64(0xFFFFF)])))
        lengths = np.diff(feature_at)
        for c in self.classes:
            spare = np.maximum(lengths - c.window, 0)
            count = np.where(lengths > 0, -(-spare // c.stride) + 1, 0)
            text = np.repeat(np.arange(len(lengths)), count)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            first = np.minimum(nth * c.stride, spare[text])
            for i in range(0, len(text), 1 << 16):
                t, f = text[i : i + (1 << 16)], first[i : i + (1 << 16)]
                a = (feature_at[t] + f + 1) // 2
                z = np.maximum((feature_at[t] + np.minimum(f + c.window, lengths[t])) // 2, a)
                rows, items = c.near(ones.prints(a, z))
                if len(rows):
                    self._verify(t[rows], f[rows], items, c, exact, exact_at, of_item, hits)
        return hits

    def _verify(self, texts, firsts, items, c, exact, exact_at, of_item, hits) -> None:
        p = self.p
        slack = c.stride + np.abs(self.lengths[items] - c.window)
        a = exact_at[texts] + np.maximum(firsts - slack, 0)
        z = np.minimum(exact_at[texts] + firsts + self.totals[items] + slack + c.stride, exact_at[texts + 1])
        a = np.minimum(a, z)
        # Of n shingles an equally long window shares at least 2 * s / (1 + s) * n; a shorter text, s * n.
        whole = z - a < self.totals[items]
        least = np.where(whole, p.percent / 100, 2 * p.percent / (100 + p.percent)) * self.totals[items]
        for k in np.flatnonzero(of_item[z] - of_item[a] >= least - 1e-6):
            text, item = int(texts[k]), int(items[k])
            like, at = self._best(exact[a[k] : z[k]], item)
            if like >= p.percent / 100:
                known = hits.setdefault(text, {})
                at += int(a[k] - exact_at[text])
                if item not in known or (-known[item][0], known[item][1]) > (-like, at):
                    known[item] = (like, at)

    def _best(self, part: np.ndarray, item: int) -> tuple[float, int]:
        """The best weighted similarity of the item and an item-sized window of the part, and where it begins."""
        own, weights = self.shingles[item]
        total = int(self.totals[item])
        size = min(total, len(part))
        at = np.minimum(np.searchsorted(own, part), len(own) - 1)
        at[own[at] != part] = -1
        seen = np.zeros(len(own) + 1, dtype=np.int64)
        shared, best, where = 0, -1, 0
        for i, s in enumerate(at.tolist()):
            if s >= 0:
                shared += seen[s] < weights[s]
                seen[s] += 1
            if i >= size:
                gone = at[i - size]
                if gone >= 0:
                    seen[gone] -= 1
                    shared -= seen[gone] < weights[gone]
            if i >= size - 1 and shared > best:
                best, where = shared, i - size + 1
        return (best / (total + size - best) if size else 0.0), where


def indexes(benchmark: DataFrame, item_id: str, text: str, p: Decontamination) -> Iterator[Index]:
    """The benchmark in blocks of about `block_bytes` of text; each is held by the driver for a moment."""
    used = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
    size = used.agg(F.sum(F.octet_length("t").cast("long")).alias("n")).first()["n"] or 0
    blocks = -(-size // p.block_bytes)
    for b in range(blocks):
        yield Index([tuple(r) for r in used.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()], p)


def with_hits(df: DataFrame, text: str, index: Index, hits: str) -> DataFrame:
    """The rows with the items of this index added to the column `hits` (made if it is not there)."""
    sent = df.sparkSession.sparkContext.broadcast(index)
    adds = hits in df.columns
    names = df.columns if adds else [*df.columns, hits]
    at = df.columns.index(text)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for part in parts:
            found: list[list[dict]] = []
            for first, last, data, offsets in shingles.text_chunks(part.column(at)):
                got = index.search(data, offsets)
                for i in range(last - first):
                    found.append([
                        {"item_id": index.ids[item], "similarity": like, "first_word": word}
                        for item, (like, word) in sorted(got.get(i, {}).items())])
            columns = list(part.columns)
            if adds:
                known = columns.pop(names.index(hits)).to_pylist()
                found = [a + b for a, b in zip(known, found)]
                columns.insert(names.index(hits), pa.array(found, kind))
            else:
                columns.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays(columns, names)

    empty = df.sparkSession.range(0).select(F.lit(None).cast(HIT).alias(hits))
    return df.mapInArrow(run, df.schema if adds else StructType([*df.schema, *empty.schema]))


def passages(df: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str, p: Decontamination = Decontamination(),
             hits: str = "hits") -> DataFrame:
    """The rows with the benchmark passages each holds: item, similarity, first word."""
    out = df
    for index in indexes(benchmark, item_id, item_text, p):
        out = with_hits(out, text, index, hits)
    return out if hits in out.columns else out.withColumn(hits, F.array().cast(HIT))


def clean(df: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str, p: Decontamination = Decontamination()) -> DataFrame:
    """The rows that hold no passage, with the columns they came with."""
    hits = own_name("hits")
    found = passages(df, text, benchmark, item_id, item_text, p, hits)
    return found.filter(F.size(hits) == 0).drop(hits)


def found_items(hits: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["item_id"])))
