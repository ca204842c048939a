"""Benchmark passages against all item-sized windows, compared exactly."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from tablesync.llm import decontaminate as dc
from tablesync.llm import shingles as packed
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(text, item):
    """The best weighted similarity of the item and a window of its size."""
    own, s = shingles(item), shingles(text)
    if not own or not s or not set(own) & set(s):
        return 0.0
    best, counts = 0.0, collections.Counter(own)
    for at in range(max(1, len(s) - len(own) + 1)):
        window = collections.Counter(s[at : at + len(own)])
        shared = sum((counts & window).values())
        best = max(best, shared / (len(own) + sum(window.values()) - shared))
    return best


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(spark, rows, items, p=dc.Decontamination()):
    out = dc.passages(documents(spark, rows), "text", benchmark(spark, items), "item_id", "text", p, "found").collect()
    return [(r["doc_id"], {h["item_id"]: round(h["similarity"], 9) for h in r["found"]}) for r in out]


def expected(rows, items):
    for key, text in rows:
        likes = {i: brute(text, t) for i, t in items}
        yield key, {i: round(x, 9) for i, x in likes.items() if x >= 0.75}


def planted():
    rng = random.Random(5)
    items = [(k, prose(1000 + k, rng.randrange(12, 60), 3000)) for k in range(40)]
    rows = []
    for k in range(120):
        words = items[k % 40][1].split()
        if k % 4 == 1:
            words[len(words) // 2] = "changed"
        elif k % 4 == 2:
            words = words[: -max(1, len(words) // 9)]
        elif k % 4 == 3:
            words = [w.upper() for w in words]
        rows.append((k, f"{prose(k, rng.randrange(0, 90), 3000)} {' '.join(words)}\n{prose(k + 500, rng.randrange(0, 90), 3000)}"))
    return rows + [(k, prose(k, 150, 3000)) for k in range(900, 960)], items


def test_planted_passages(spark):
    rows, items = planted()
    key = lambda r: r[0]
    assert sorted(found(spark, rows, items), key=key) == sorted(expected(rows, items), key=key)
    assert sum(bool(h) for _, h in expected(rows, items)) > 80


def test_benchmark_in_blocks(spark):
    rows, items = planted()
    assert sorted(found(spark, rows, items, dc.Decontamination(block_bytes=3000)), key=lambda r: r[0]) == sorted(expected(rows, items), key=lambda r: r[0])


def test_awkward_rows(spark):
    rows = awkward()
    items = [(1, prose(2, 50)), (1, prose(2, 50)), (2, None), (3, ""), (4, "a b c d e"), (5, "one two"), (6, "the the the the the the the the the the"), (None, prose(3, 20))]
    whole = [(i, t) for i, t in items if t and len(t.split()) >= 5]
    out = found(spark, rows, items)
    assert sorted(map(repr, out)) == sorted(map(repr, expected(rows, whole)))
    kept = dc.clean(documents(spark, rows), "text", benchmark(spark, items), "item_id", "text")
    assert kept.columns == documents(spark, rows).columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(repr(k) for k, h in expected(rows, whole) if not h)


def test_long_items(spark):
    items = [(k, prose(3000 + k, n, 3000)) for k, n in enumerate((16_000, 40_000, 70_000))] + [(9, "all alike " * 20_000)]
    rows = [(k, f"{prose(70 + k, 50, 3000)} {text} {prose(80 + k, 50, 3000)}") for k, text in items]
    assert found(spark, rows, items) == [(k, {k: 1.0}) for k, _ in items]


def test_empty_tables(spark):
    assert found(spark, awkward()[:4], []) == [(k, {}) for k, _ in awkward()[:4]]
    assert found(spark, [], [(1, prose(1, 30))]) == []


def test_every_fingerprint_within_the_radius_is_found():
    p = dc.Decontamination()
    random_bits = np.random.default_rng(1)
    prints = random_bits.integers(0, 2**63, 30, dtype=np.uint64)
    group = dc.LengthClass(20, list(range(30)), prints, p)
    windows = prints[random_bits.integers(0, 30, 4000)].copy()
    for i in range(len(windows)):
        for bit in random_bits.choice(64, i % 26, replace=False):
            windows[i] ^= np.uint64(1) << np.uint64(bit)
    rows, items = group.near(windows)
    distance = np.bitwise_count(windows[:, None] ^ prints[None])
    assert set(zip(rows.tolist(), items.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(distance <= p.radius))))


def test_query(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    out = {r["doc_id"]: (r["kept"], r["item_ids"]) for r in QUERIES["op10_decontaminate"](spark, data).collect()}
    assert out == {k: (not h, sorted(h)) for k, h in expected(rows, items)}


@pytest.mark.parametrize("longest", [40, 300, 70_000])
def test_counters_in_lanes_equal_plain_counts(longest):
    rng = np.random.default_rng(longest)
    features = rng.integers(0, 2**63, 2 * longest + 1001, dtype=np.uint64)
    features[::3] |= np.uint64(0xFFFF0000FFFF0000)
    ones = dc.Ones(features, longest)
    a = rng.integers(0, len(features) // 2 - longest // 2, 200)
    z = a + rng.integers(0, longest // 2 + 1, 200)
    plain = [
        dc.fingerprints(dc.one_bits(features[2 * i : 2 * j]).sum(axis=0, dtype=np.int64)[None], np.array([2 * (j - i)]))[0]
        for i, j in zip(a, z)]
    assert ones.prints(a, z).tolist() == plain


def test_many_items_of_one_length_are_each_found_by_their_blocks():
    rng = np.random.default_rng(7)
    p = dc.Decontamination()
    prints = rng.integers(0, 2**63, 150, dtype=np.uint64)
    group = dc.LengthClass(30, list(range(150)), prints, p)
    windows = prints[rng.integers(0, 150, 500)]
    for _ in range(19):
        windows = windows ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    want = {(i, k) for i, w in enumerate(windows) for k in np.flatnonzero(np.bitwise_count(w ^ prints) <= p.radius).tolist()}
    assert set(zip(*(x.tolist() for x in group.near(windows)))) == want


KINDS = {
    "end cut off": lambda w, rng: w[: len(w) - len(w) // 8],
    "start cut off": lambda w, rng: w[len(w) // 8 :],
    "a word changed": lambda w, rng: [*w[: (i := rng.randrange(len(w)))], "other", *w[i + 1 :]],
    "a word inserted": lambda w, rng: [*w[: (i := rng.randrange(len(w)))], "more", *w[i:]],
    "a word left out": lambda w, rng: [*w[: (i := rng.randrange(len(w)))], *w[i + 1 :]],
    "two words changed at the start": lambda w, rng: ["other", "words", *w[2:]],
}


@pytest.mark.parametrize("kind", KINDS)
def test_recall_by_kind_of_change(kind):
    """Items with a window of exact similarity 0.75 or more, between other words at any place."""
    rng = random.Random(kind)
    items = [(i, prose(1000 + i, rng.randrange(16, 60), 400)) for i in range(120)]
    index = dc.Index(items, dc.Decontamination())
    texts, wanted = [], []
    for item, text in items:
        for _ in range(2):
            words = KINDS[kind](text.split(), rng)
            texts.append(" ".join([prose(rng.randrange(10**6), rng.randrange(200), 400), *words, prose(rng.randrange(10**6), rng.randrange(200), 400)]))
            if brute(texts[-1], text) >= 0.75:
                wanted.append((len(texts) - 1, item))
    found = set()
    for first, _, data, offsets in packed.text_chunks(pa.array(texts)):
        found |= {(first + t, index.ids[i]) for t, hit in index.search(data, offsets).items() for i in hit}
    assert len(wanted) >= 60 and len(found & set(wanted)) >= 0.99 * len(wanted), (len(found & set(wanted)), len(wanted))
