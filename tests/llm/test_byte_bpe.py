"""Encoding against the tiktoken library, and exact round trips."""

import hashlib

import public_tokenizers
import tiktoken

from tablesync.llm import byte_bpe
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def expected(text):
    ids = reference().encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_awkward_rows(spark):
    rows = awkward() + [(k, t) for k, t in enumerate(["a  b", " a", "a ", "\n x\t y  ", " \x85   b", "é" * 50, "1" * 400 + " " * 9 + "\n\nz", "﻿​'ll"], 50)]
    out = byte_bpe.round_trip(documents(spark, rows), "doc_id", "text", RANKS, PATTERN).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out), key=key) == sorted(((k, *expected(t)) for k, t in rows), key=key)


def test_ids_offsets_and_decoding(spark):
    rows = [(k, t) for k, t in awkward() if k is not None and k != 10]
    encoded = byte_bpe.encode(documents(spark, rows), "doc_id", "text", RANKS, PATTERN)
    texts, ranks = dict(rows), {v: k for k, v in byte_bpe.read_ranks(RANKS).items()}
    for r in encoded.collect():
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == reference().encode_ordinary(text)
        data, at = text.encode(), 0
        for i, byte, character in zip(r["ids"], r["byte_start"], r["char_start"]):
            assert byte == at and data[at : at + len(ranks[i])] == ranks[i]
            assert character == len(data[: at + 1].decode(errors="ignore")) - (data[at] & 0xC0 != 0x80 and data[at] < 0x80) or data[at] >= 0x80
            at += len(ranks[i])
    back = {r["doc_id"]: (bytes(r["bytes"]), r["text"]) for r in byte_bpe.decode(encoded, "doc_id", "ids", RANKS, PATTERN).collect()}
    assert back == {k: ((t or "").encode(), t or "") for k, t in rows}


def test_split_characters(spark):
    """A token may end inside a character: its bytes alone are no text, all bytes together are."""
    codec = byte_bpe.codec(RANKS, PATTERN)
    text = "\U0001f9ffக"
    ids = codec.encode(text)[1]
    assert len(ids) > 2 and codec.decode(ids) == text.encode()
    byte_at, char_at = codec.offsets(text, ids)
    assert set(char_at.tolist()) == {0, 1} and byte_at.tolist() == sorted(set(byte_at.tolist()))
    cut = spark.createDataFrame([(1, ids[:1].tolist())], "doc_id long, ids array<int>")
    r = byte_bpe.decode(cut, "doc_id", "ids", RANKS, PATTERN).first()
    assert text.encode().startswith(bytes(r["bytes"])) and "�" in r["text"]


def test_cache_in_generations():
    made = []
    recent = byte_bpe.Recent(lambda k: made.append(k) or k * 2, 3)
    assert [recent[k] for k in (1, 2, 3, 1, 4, 1, 2)] == [2, 4, 6, 2, 8, 2, 4]
    assert made == [1, 2, 3, 4]


def test_empty_table(spark):
    assert byte_bpe.round_trip(documents(spark, []), "doc_id", "text", RANKS, PATTERN).collect() == []


def test_query(spark, data):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    out = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_byte_bpe"](spark, data).collect()}
    assert out == {k: expected(t) for k, t in texts.items()}
