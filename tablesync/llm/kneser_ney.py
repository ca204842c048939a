"""Interpolated modified Kneser-Ney language model of order two, counted in Spark.

Counting takes two passes. The first counts words; the second word pairs. Tasks count what they read,
and send sorted, compressed blocks of counts to the task of a range of keys, so a frequent word or
pair is one entry per sending task, and a context with very many followers is cut into several ranges.
Each range becomes a file: a sorted array of 64-bit keys and an array of counts. A vocabulary key is a
word's hash, and its place among all is the word's number; a pair's key is both numbers. Scoring
workers map these files into memory and look keys up; nothing of the model passes through the driver but
one line per file.

Words are maximal runs outside `\\x20\\x09-\\x0D`, A-Z lower-cased; every text ends with one more token.
Probabilities: `p(w | v) = (n(v w) - D(n)) / n(v) + L(v) * p(w)`, with `p(w)` from the number of
different words before w, and the uniform `1 / (V + 1)` below that; unknown words get only the last.

Edge cases: null and empty texts are the end token alone. A null key counts as empty text when the
training part is drawn. Repeated rows count, and are scored, as often as they come. Without any
training token every token is uniform over one word. An empty table gives an empty table. Columns other
than the two named are never read.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import shingles
from tablesync.llm.base import file_system, settled
from tablesync.session import workspace

END = np.uint64(1)  # the hash of the token after the last word
HELD = 1 << 22  # tokens a task counts before it merges the counts
FLUSHED = 1 << 23  # different keys a task holds before it sends them
SHARD_TOKENS = 1 << 22  # tokens behind the pairs of one file, about
MOST_SLOTS = 1 << 16
NUMBER = np.uint64(32)


def tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, token hashes, offsets of the rows in them), the end tokens included."""
    for first, last, data, offsets in shingles.text_chunks(texts):
        start, end, before = shingles.word_spans(data, offsets)
        at = before + np.arange(len(before))
        out = np.full(at[-1], END, dtype=np.uint64)
        inside = np.ones(at[-1], dtype=bool)
        inside[at[1:] - 1] = False
        out[inside] = shingles.word_hashes(data, start, end)
        yield first, last, out, at


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys and columns of numbers, byte by byte of equal weight, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(c.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in (steps, *columns)]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(block: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(block, decompressed_size=n * 8 * columns, codec="zstd", asbytes=True), dtype=np.uint8)
    parts = [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in raw.reshape(columns, 8, n)]
    parts[0] = np.cumsum(parts[0], dtype=np.uint64)
    return parts


class Counter:
    """Counts of keys in bounded memory."""

    def __init__(self):
        self.waiting, self.n = [], 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.n += len(keys)
        if self.n >= HELD:
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.keys, self.counts = summed(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts.astype(np.uint64))))
            self.waiting, self.n = [], 0

    def blocks(self, bounds: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(range, entries, block) of all counts so far; bounds are the first keys of the ranges."""
        self.merge()
        cuts = [0, *np.searchsorted(self.keys, bounds[1:]).tolist(), len(self.keys)]
        for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])):
            if z > a:
                yield i, z - a, pack(self.keys[a:z], self.counts[a:z])
        self.keys, self.counts = self.keys[:0], self.counts[:0]


BLOCKS = "slot bigint, n bigint, block binary"


def _sent(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for slot, n, block in rows:
        yield pa.RecordBatch.from_pydict({"slot": [slot], "n": [n], "block": [block]})


def _by_slot(parts: Iterator[pa.RecordBatch], columns: int = 2) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per slot the sums of its blocks, of rows sorted by slot; merged as they come."""
    slot, held, size = None, [], 0

    def merged() -> list[np.ndarray]:
        keys = np.concatenate([h[0] for h in held])
        return [summed(keys, np.concatenate([h[0 + c] for h in held])) for c in range(1, columns)]

    def close():
        found = merged()
        return [found[0][0], *[f[1] for f in found]]

    for part in parts:
        for at, n, block in zip(*part.columns):
            if slot is not None and at.as_py() != slot:
                yield slot, close()
                held, size = [], 0
            slot = at.as_py()
            held.append(unpack(block.as_py(), n.as_py(), columns))
            size += n.as_py()
            if size > 2 * FLUSHED and len(held) > 1:
                held = [close()]
                size = len(held[0][0])
    if held:
        yield slot, close()


def _write(folder: str, *arrays: np.ndarray) -> str:
    system, inner = file_system(folder)
    system.create_dir(inner, recursive=True)
    name = uuid.uuid4().hex
    with system.open_output_stream(f"{inner}/{name}") as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a))
    return f"{folder}/{name}"


@functools.lru_cache(maxsize=None)
def mapped(path: str) -> np.ndarray:
    """The bytes of a file, mapped into memory; one in a remote store is first copied, once per worker."""
    system, inner = file_system(path)
    if system.type_name != "local":
        folder = os.path.join(tempfile.gettempdir(), "language-model")
        os.makedirs(folder, exist_ok=True)
        copy = os.path.join(folder, os.path.basename(inner))
        if not os.path.exists(copy):
            with system.open_input_stream(inner) as source, open(copy + uuid.uuid4().hex, "wb") as out:
                while part := source.read(1 << 22):
                    out.write(part)
            os.rename(out.name, copy)
        inner = copy
    return np.memmap(inner, dtype=np.uint8, mode="r") if os.path.getsize(inner) else np.zeros(0, dtype=np.uint8)


@dataclass(frozen=True)
class Sorted:
    """Files of sorted keys, each followed by one column of counts; the ranges follow one another."""

    paths: list[str]
    firsts: np.ndarray  # the smallest key that may be in each file
    sizes: np.ndarray
    kind: str  # numpy type of the counts

    @functools.cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def find(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted queries, the place of each among all keys (-1: not there), and its count (0)."""
        place, count = np.full(len(queries), -1, dtype=np.int64), np.zeros(len(queries), dtype=np.uint64)
        if not len(queries) or not len(self.paths):
            return place, count
        files = np.maximum(np.searchsorted(self.firsts, queries, side="right") - 1, 0)
        cuts = np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1], [True])))
        for a, z in zip(cuts[:-1], cuts[1:]):
            file, n = files[a], int(self.sizes[files[a]])
            if not n:
                continue
            data = mapped(self.paths[file])
            keys, counts = data[: n * 8].view(np.uint64), data[n * 8 :].view(self.kind)
            at = np.minimum(np.searchsorted(keys, queries[a:z]), n - 1)
            hit = keys[at] == queries[a:z]
            place[a:z] = np.where(hit, self.starts[file] + at, -1)
            count[a:z] = np.where(hit, counts[at], 0)
        return place, count


def discounts(n: list[int]) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and 3 or more, of the numbers of entries counted 1, 2, 3, 4 times."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))])


@dataclass(frozen=True)
class Model:
    words: Sorted
    pairs: Sorted
    contexts: list[str]  # per vocabulary file: followers seen once, twice, more often; different words before
    tokens: int
    texts: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    kinds: int  # different pairs
    word_rest: float

    @property
    def vocabulary(self) -> int:
        return int(self.words.sizes.sum())

    def _of_words(self, ids: np.ndarray) -> np.ndarray:
        """The four context numbers of each word number, in ascending order; the start of a text is number V."""
        out = np.zeros((4, len(ids)), dtype=np.uint32)
        files = np.minimum(np.searchsorted(self.words.starts, ids, side="right") - 1, len(self.contexts) - 1)
        cuts = np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1], [True]))) if len(ids) else [0]
        for a, z in zip(cuts[:-1], cuts[1:]):
            data = mapped(self.contexts[files[a]]).view(np.uint32).reshape(4, -1)
            out[:, a:z] = data[:, ids[a:z] - self.words.starts[files[a]]]
        return out

    def score(self, hashes: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """Per text: known tokens, the unigram base score and the model's log10 probability."""
        kinds, of = np.unique(hashes, return_inverse=True)
        ids, counts = self.words.find(kinds)
        size = self.vocabulary
        if not size:
            zero = np.zeros(len(offsets) - 1)
            base = np.add.reduceat(np.full(len(hashes), np.log10(0.5 / 0.5)), offsets[:-1])
            return {"n_known": zero.astype(np.int64), "base_score": base, "score": zero}
        known = np.flatnonzero(ids >= 0)
        numbers = self._of_words(np.append(ids[known], size))
        # One more entry for the start of a text: it stands before a text's first token.
        single = np.full(len(kinds), self.word_rest / (size + 1))
        before = numbers[3, :-1].astype(np.int64)
        single[known] += np.maximum(before - self.word_discounts[np.minimum(before, 3)], 0) / max(1, self.kinds)
        total, rest = np.ones(len(kinds) + 1), np.ones(len(kinds) + 1)
        total[known], total[-1] = counts[known], max(1, self.texts)
        places = np.append(known, len(kinds))
        rest[places] = (self.pair_discounts[1:] @ numbers[:3].astype(np.float64)) / total[places]
        # The end of a text is no context.
        rest[np.flatnonzero(kinds == END)] = 1.0
        previous = np.empty(len(hashes), dtype=np.int64)
        previous[1:] = of[:-1]
        previous[offsets[:-1]] = len(kinds)
        number = np.append(ids, size)
        left, right = number[previous], ids[of]
        both = np.flatnonzero((left >= 0) & (right >= 0))
        keys, at = np.unique((left[both].astype(np.uint64) << NUMBER) | right[both].astype(np.uint64), return_inverse=True)
        seen = self.pairs.find(keys)[1].astype(np.int64)[at]
        p = rest[previous] * single[of]
        p[both] += np.maximum(seen - self.pair_discounts[np.minimum(seen, 3)], 0) / total[previous[both]]
        base = np.log10((counts + 0.5) / (self.tokens + 0.5 * (size + 1)))[of]
        starts = offsets[:-1]
        return {
            "n_known": np.add.reduceat((counts > 0)[of].astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts),
        }


def _sorted_blocks(blocks: DataFrame, slots: int) -> DataFrame:
    return blocks.repartition(slots, "slot").sortWithinPartitions("slot")


def train(texts: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Model:
    """The model of all rows of a DataFrame of one string column."""
    spark = texts.sparkSession
    folder = workspace(spark, "kneser-ney")
    slots = 16
    while slots < min(texts.rdd.getNumPartitions(), MOST_SLOTS):
        slots *= 2
    hash_bounds = (np.arange(slots, dtype=np.uint64) << np.uint64(64 - slots.bit_length() + 1))

    def count_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for part in parts:
            for _, _, hashes, _ in tokens(part.column(0)):
                counter.add(hashes)
            if len(counter.keys) > FLUSHED:
                yield from _sent(counter.blocks(hash_bounds))
        yield from _sent(counter.blocks(hash_bounds))

    def keep_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, (keys, counts) in _by_slot(parts):
            mass = np.cumsum(counts)
            # Where a new file of pairs begins, and into how many files the pairs of one word are cut.
            cut = np.flatnonzero(np.diff((mass - counts) // np.uint64(shard_tokens), prepend=0))
            heavy = np.flatnonzero(counts > shard_tokens)
            begins = np.unique(np.concatenate((cut, heavy, heavy + 1)))
            begins = begins[begins < len(keys)]
            parts_of = np.ones(len(begins), dtype=np.int64)
            big = np.isin(begins, heavy)
            parts_of[big] = -(-counts[begins[big]] // np.uint64(shard_tokens))
            ends = int(counts[keys == END].sum())
            cuts = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (begins, parts_of)]  # may be empty
            yield pa.RecordBatch.from_pydict({
                "slot": [slot], "path": [_write(folder, keys, counts)], "n": [len(keys)], "tokens": [int(counts.sum())], "texts": [ends],
                "begins": cuts[0], "parts": cuts[1]})

    blocks = texts.mapInArrow(count_words, BLOCKS)
    files = settled(
        _sorted_blocks(blocks, slots).mapInArrow(
            keep_words, "slot bigint, path string, n bigint, tokens bigint, texts bigint, begins array<bigint>, parts array<bigint>"),
        "kneser-ney-words").orderBy("slot").collect()
    words = Sorted([f["path"] for f in files], hash_bounds[[f["slot"] for f in files]], np.array([f["n"] for f in files], dtype=np.int64), "<u8")
    count, n_texts = sum(f["tokens"] for f in files), sum(f["texts"] for f in files)
    size = int(words.sizes.sum())
    if size >= 1 << 32:
        raise ValueError("the vocabulary has more than 2**32 words")
    if not size:
        none = Sorted([], np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), "<u4")
        return Model(words, none, [], 0, 0, discounts([0] * 4), discounts([0] * 4), 0, 1.0)

    bounds = {0}
    for start, f in zip(words.starts.tolist(), files):
        bounds.add(start << 32)
        for begin, cuts in [*zip(f["begins"], f["parts"])]:
            bounds.update(((start + begin) << 32) + size * k // cuts for k in range(cuts))
    cuts = -(-n_texts // shard_tokens)
    bounds.update((size << 32) + size * k // cuts for k in range(cuts))
    pair_bounds = np.array(sorted(bounds), dtype=np.uint64)

    def count_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for part in parts:
            for _, _, hashes, offsets in tokens(part.column(0)):
                kinds, of = np.unique(hashes, return_inverse=True)
                ids = words.find(kinds)[0][of].astype(np.uint64)
                before = np.empty_like(ids)
                before[1:] = ids[:-1]
                before[offsets[:-1]] = size
                counter.add((before << NUMBER) | ids)
            if len(counter.keys) > FLUSHED:
                yield from _sent(counter.blocks(pair_bounds))
        yield from _sent(counter.blocks(pair_bounds))

    of_slot = np.append(words.starts, size + 1).astype(np.uint64)
    of_slot[len(files)] = size + 1

    def by_words(kind: str, ids: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
        at = np.searchsorted(ids, of_slot)
        for i, (a, z) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if z > a:
                yield kind, i, z - a, pack(ids[a:z], *[c[a:z] for c in columns])

    def keep_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (keys, counts) in _by_slot(parts):
            path = _write(folder, keys, np.minimum(counts, np.uint64(2**32 - 1)).astype("<u4"))
            left = keys >> NUMBER
            first = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1])))
            times = [np.add.reduceat(c.astype(np.uint64), first) for c in (counts == 1, counts == 2, counts > 2)]
            right, before = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
            rows = [("file", shard, len(keys), b""), *by_words("after", left[first], *times), *by_words("before", right, before)]
            yield pa.RecordBatch.from_pydict({
                "kind": [r[0] for r in rows], "slot": [r[1] for r in rows], "n": [r[2] for r in rows], "block": [r[3] for r in rows],
                "path": [path] * len(rows), "times": [[int((counts == k).sum()) for k in (1, 2, 3, 4)]] * len(rows)})

    pairs = texts.mapInArrow(count_pairs, BLOCKS)
    kept = settled(
        _sorted_blocks(pairs, len(pair_bounds)).mapInArrow(
            keep_pairs, "kind string, slot bigint, n bigint, block binary, path string, times array<bigint>"), "kneser-ney-pairs")
    shards = kept.filter("kind = 'file'").select("slot", "n", "path", "times").orderBy("slot").collect()

    def keep_contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(slot: int, sums: np.ndarray) -> pa.RecordBatch:
            before = sums[3, : len(sums[3]) - (slot == len(files) - 1)]
            times = [int((before == k).sum()) for k in (1, 2, 3, 4)] + [int((before > 2).sum())]
            return pa.RecordBatch.from_pydict({"slot": [slot], "path": [_write(folder, sums.astype("<u4"))], "times": [times]})

        slot, sums = None, None
        for part in parts:
            for at, kind, n, block in zip(*part.columns):
                if at.as_py() != slot:
                    if slot is not None:
                        yield done(slot, sums)
                    slot = at.as_py()
                    sums = np.zeros((4, int(of_slot[slot + 1] - of_slot[slot])), dtype=np.int64)
                after = kind.as_py() == "after"
                ids, *columns = unpack(block.as_py(), n.as_py(), 4 if after else 2)
                for row, column in zip((0, 1, 2) if after else (3,), columns):
                    sums[row, (ids - of_slot[slot]).astype(np.int64)] += column.astype(np.int64)
        if slot is not None:
            yield done(slot, sums)

    contexts = settled(
        kept.filter("kind <> 'file'").select("slot", "kind", "n", "block").repartition(len(files), "slot").sortWithinPartitions("slot")
        .mapInArrow(keep_contexts, "slot bigint, path string, times array<bigint>"), "kneser-ney-contexts").orderBy("slot").collect()
    total = lambda rows, i: sum(r["times"][i] for r in rows)
    kinds = sum(s["n"] for s in shards)
    word_discounts = discounts([total(contexts, i) for i in range(4)])
    rest = float(word_discounts[1:] @ np.array([total(contexts, 0), total(contexts, 1), total(contexts, 4)])) / kinds
    return Model(
        words, Sorted([s["path"] for s in shards], pair_bounds[[s["slot"] for s in shards]], np.array([s["n"] for s in shards], dtype=np.int64), "<u4"),
        [c["path"] for c in contexts], count, n_texts, discounts([total(shards, i) for i in range(4)]), word_discounts, kinds, rest)


def held_out(key: Column) -> Column:
    """Whether the checksum of the key as text leaves one when divided by five."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def score(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in parts:
            for first, last, hashes, offsets in tokens(part.column(2)):
                found = model.score(hashes, offsets)
                n = last - first
                yield pa.RecordBatch.from_arrays([
                    part.column(0).slice(first, n), part.column(1).slice(first, n), pa.array(np.diff(offsets), pa.int64()),
                    pa.array(found["n_known"], pa.int64()), pa.array(np.full(n, model.tokens), pa.int64()),
                    pa.array(found["base_score"], pa.float64()), pa.array(found["score"], pa.float64()),
                ], ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    used = df.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    kind = used.schema["key"].dataType.simpleString()
    out = used.mapInArrow(
        run, f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("key", key)


def train_and_score(df: DataFrame, key: str, text: str) -> DataFrame:
    """All rows scored by the model of those that are not held out."""
    return score(df, key, text, train(df.filter(~held_out(F.col(key))).select(text)))
