"""Near-duplicate components against all pairs, compared exactly."""

import random

from tablesync.llm import minhash
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, prose


def shingles(text):
    words = (text or "").encode().lower().split() if text else []
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """(doc_id, n_shingles, component, kept) of distinct ids, by all pairs of distinct sets."""
    ids = {}
    for key, text in rows:
        ids.setdefault(key, shingles(text))
    sets = {}
    for key, s in sorted(ids.items()):
        sets.setdefault(s, key)
    parent = {key: key for key in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    for key, s in ids.items():
        if s:
            join(key, sets[s])
    full = [s for s in sets if s]
    for i, a in enumerate(full):
        for b in full[:i]:
            if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                join(sets[a], sets[b])
    return {key: (len(s), root(key), root(key) == key) for key, s in ids.items()}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"new{rng.randrange(1000)}" for w in text.split())


def test_components_match_all_pairs(spark):
    rows, key = [], 100
    for group in range(12):
        base = prose(group, 120, 2000)
        for copy in range(group + 1):
            rows.append((key, edited(base, key, copy * 0.006)))
            key += 7
    rows += [(k, prose(k, 60, 2000)) for k in range(5000, 5040)]
    assert found(minhash.components(documents(spark, rows), "doc_id", "text")) == brute(rows)


def test_large_group_in_small_cells(spark):
    """One group whose members mostly reach each other only through others, in cells of 8."""
    base = prose(77, 200, 4000)
    rows = [(k, edited(base, k, 0.03 * (k % 3))) for k in range(1, 61)] + [(k, prose(k, 100, 4000)) for k in range(100, 130)]
    p = minhash.MinHash(cell=8, tries=1)
    assert found(minhash.components(documents(spark, rows), "doc_id", "text", p)) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward()
    out = minhash.components(documents(spark, rows), "doc_id", "text").collect()
    assert len(out) == len(rows)
    named = [r for r in rows if r[0] is not None]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] is not None} == brute(named)
    assert all(r["component_id"] is None and r["kept"] for r in out if r["doc_id"] is None)
    kept = minhash.one_of_each(documents(spark, rows), "doc_id", "text")
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 6, 7, 8, 9, 10, 12, 13, 14]
    assert kept.filter("doc_id IS NULL").count() == 2


def test_repeated_ids_with_other_texts(spark):
    """Rows of one id are judged each by its own text, in labels and in what stays."""
    a, b = prose(1, 120, 2000), prose(2, 120, 2000)
    rows = [(5, a), (5, b), (3, a + " more"), (9, b + " end"), (7, "few words"), (7, prose(3, 90, 2000)), (5, b), (8, ""), (8, "few words")]
    out = {}
    for r in minhash.components(documents(spark, rows), "doc_id", "text").collect():
        out.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert out == {5: {(3, False), (5, True)}, 3: {(3, True)}, 9: {(5, False)}, 7: {(7, True)}, 8: {(8, True), (7, False)}}
    kept = minhash.one_of_each(documents(spark, rows), "doc_id", "text").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, b), (3, a + " more"), (7, "few words"), rows[5], (8, "")])


def test_linked_texts_of_one_id(spark):
    """Of linked texts under one id one stays; a row repeated very often is one node and one text."""
    a = prose(4, 120, 2000)
    rows = [(2, a), (2, a + " more"), (2, prose(5, 80, 2000))] + [(2, a)] * 400 + [(6, a + " other")] * 400
    kept = [r["text"] for r in minhash.one_of_each(documents(spark, rows), "doc_id", "text").collect()]
    assert len(kept) == 2 and rows[2][1] in kept and set(kept) < {a, a + " more", rows[2][1]}


def test_empty_table(spark):
    assert minhash.components(documents(spark, []), "doc_id", "text").collect() == []


def test_query(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert found(QUERIES["op1_minhash"](spark, data)) == brute(rows)
