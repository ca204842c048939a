"""The model against Kneser-Ney with plain dictionaries."""

import collections
import math
import zlib

import numpy as np

from tablesync.llm import kneser_ney as kn
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, prose


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


class Brute:
    def __init__(self, texts):
        self.count = collections.Counter(t for x in texts for t in tokens(x))
        self.total, self.size = sum(self.count.values()), len(self.count)
        self.pairs = collections.Counter(p for x in texts for p in zip(["start", *tokens(x)], tokens(x)))
        self.before = collections.Counter(w for _, w in self.pairs)
        self.after, self.context = collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
        for (v, _), n in self.pairs.items():
            self.after[v][min(n, 3) - 1] += 1
            self.context[v] += n
        self.d2 = kn.discounts([sum(n == k for n in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.d1 = kn.discounts([sum(n == k for n in self.before.values()) for k in (1, 2, 3, 4)])
        self.rest = sum(self.d1[min(n, 3)] for n in self.before.values()) / max(1, len(self.pairs))

    def single(self, w):
        return max(self.before[w] - self.d1[min(self.before[w], 3)], 0) / len(self.pairs) + self.rest / (self.size + 1)

    def p(self, v, w):
        if v not in self.context:
            return self.single(w)
        n = self.pairs[(v, w)]
        rest = sum(d * k for d, k in zip(self.d2[1:], self.after[v])) / self.context[v]
        return max(n - self.d2[min(n, 3)], 0) / self.context[v] + rest * self.single(w)

    def row(self, text):
        t = tokens(text)
        base = sum(math.log10((self.count[w] + 0.5) / (self.total + 0.5 * (self.size + 1))) for w in t)
        return len(t), sum(w in self.count for w in t), self.total, base, sum(math.log10(self.p(v, w)) for v, w in zip(["start", *t], t))


def held(key):
    return zlib.crc32(str(key if key is not None else "").encode()) % 5 == 1


def same(out, rows):
    model = Brute([t for k, t in rows if not held(k)])
    expected = sorted(((k is None, k or 0, held(k), *model.row(t)) for k, t in rows), key=lambda r: (r[0], r[1], round(r[-1], 6)))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, *tuple(r)[1:]) for r in out), key=lambda r: (r[0], r[1], round(r[-1], 6)))
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:6] == b[:6]
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[6:], b[6:])), (a, b)
    return model


def test_awkward_rows(spark):
    rows = awkward() + [(k, prose(k, 80, 30)) for k in range(100, 140)]
    same(kn.train_and_score(documents(spark, rows).repartition(3), "doc_id", "text").collect(), rows)


def test_probabilities_add_up():
    model = Brute([prose(k, 80, 30) for k in range(20)])
    for v in ("start", *list(model.count)[:5], b"never seen"):
        assert abs(sum(model.p(v, w) for w in model.count) + model.p(v, b"never seen either") - 1) < 1e-9


def test_heavy_contexts_are_cut_into_files(spark):
    rows = [(k, " ".join(f"the {w}" for w in prose(k, 60, 40).split())) for k in range(60)]
    df = documents(spark, rows)
    model = kn.train(df.filter(~kn.held_out(df.doc_id)).select("text"), shard_tokens=200)
    assert len(model.pairs.paths) > 8
    same(kn.score(df, "doc_id", "text", model).collect(), rows)


def test_blocks():
    counter = kn.Counter()
    random = np.random.default_rng(2)
    keys = random.integers(0, 2**63, 5000, dtype=np.uint64)
    keys = np.concatenate((keys, keys[:900], np.array([0, 2**64 - 1], dtype=np.uint64)))
    counter.add(keys)
    bounds = np.array([0, 2**60, 2**62, 2**63 + 5], dtype=np.uint64)
    rows = list(counter.blocks(bounds))
    parts = [kn.unpack(b, n, 2) for _, n, b in rows]
    expected = np.unique(keys, return_counts=True)
    assert (np.concatenate([p[0] for p in parts]) == expected[0]).all() and (np.concatenate([p[1] for p in parts]) == expected[1]).all()
    for (i, _, _), (k, _) in zip(rows, parts):
        assert k[0] >= bounds[i] and (i == 3 or k[-1] < bounds[i + 1])


def test_discounts():
    assert kn.discounts([0, 0, 0, 0]).tolist() == [0.0, 0.5, 1.0, 1.5]
    assert np.allclose(kn.discounts([100, 40, 20, 10]), [0, 1 - 2 * (100 / 180) * 0.4, 2 - 3 * (100 / 180) * 0.5, 3 - 4 * (100 / 180) * 0.5])


def test_no_training_rows(spark):
    rows = [(k, "a b") for k in range(200) if held(k)][:3]
    out = kn.train_and_score(documents(spark, rows), "doc_id", "text").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in out] == [(3, 0, 0, 0.0, 0.0)] * 3
    assert kn.train_and_score(documents(spark, []), "doc_id", "text").collect() == []


def test_query(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = QUERIES["op9_kneser_ney"](spark, data).collect()
    same(out, rows)
    held_rows = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)
