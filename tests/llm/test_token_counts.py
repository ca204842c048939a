"""The automaton against plain greedy matching."""

import random

import public_tokenizers

from tablesync.llm import token_counts as tc
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def brute(text, pieces):
    words = (text or "").encode().translate(tc._LOWER).split()
    found = [tc.greedy_pieces(w, pieces) for w in words]
    return len(words), sum(1 if f is None else len(f) for f in found)


def test_random_vocabularies():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {tuple(rng.choices((97, 98, 99, tc.END), weights=(4, 4, 2, 1), k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 25))}
        pieces = {p for p in pieces if tc.END not in p[:-1]}
        automaton = tc.Automaton(pieces)
        for _ in range(60):
            word = bytes(rng.choices(b"abc", k=rng.randrange(0, 14)))
            plain = tc.greedy_pieces(word, pieces)
            assert automaton.count(word) == (1 if plain is None else len(plain)), (word, pieces)


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 8]
    pieces = set(tc.read_pieces(VOCABULARY))
    out = tc.token_counts(documents(spark, rows), "doc_id", "text", VOCABULARY).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out), key=key) == sorted(((k, *brute(t, pieces)) for k, t in rows), key=key)


def test_empty_table(spark):
    assert tc.token_counts(documents(spark, []), "doc_id", "text", VOCABULARY).collect() == []


def test_query(spark, data):
    pieces = set(tc.read_pieces(VOCABULARY))
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    out = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in QUERIES["op4_token_counts"](spark, data).collect()}
    assert out.keys() == rows.keys()
    assert all(out[k] == brute(t, pieces) for k, t in list(rows.items())[:60])
