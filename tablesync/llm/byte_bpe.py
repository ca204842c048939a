"""Byte-level BPE encoding and decoding with the `tokenizers` library over Arrow batches.

Bytes are written as printable characters (the byte table below), so that the library's BPE model
works on text; each match of the splitting pattern is encoded by itself. What lies between two
spaces is encoded once and kept by the worker, since most of it comes again. Decoding reverses the byte
table. A token may end inside a character: byte offsets are exact, character offsets name the
character a token starts in, and decoding to text joins the bytes before it reads characters.

Edge cases: null text counts as empty (no ids, empty bytes); repeated rows give repeated rows; an
empty table gives an empty table; other columns of the input are never read, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CACHED = 100_000  # encoded units, and pieces, a worker keeps in each of two generations

#: A space before a non-space always begins a match of the pattern, so texts can be cut there.
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")


def byte_table() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Recent(dict):
    """Values by key, made when first asked for; of the older ones, those not asked for again go."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Codec:
    """Encodes and decodes by one rank file; a worker builds it once (`codec`)."""

    def __init__(self, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import regex
        from tokenizers import models

        by_bytes = read_ranks(ranks)
        shown = byte_table()
        as_text = {token: "".join(shown[b] for b in token) for token in by_bytes}
        # Any two adjacent tokens merge if together they are a token; the rank is that of the whole.
        merges = [
            (as_text[token[:i]], as_text[token[i:]])
            for token in sorted(by_bytes, key=by_bytes.get)
            for i in range(1, len(token))
            if token[:i] in as_text and token[i:] in as_text
        ]
        vocab = {as_text[token]: rank for token, rank in by_bytes.items()}
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0)
        self.split = regex.compile(pattern).findall
        self.shown = dict(enumerate(shown))
        self.decimal = [str(i) for i in range(max(vocab.values(), default=-1) + 1)]
        self.units = Recent(self._encode_after_space, CACHED)  # by the text after a space; its ids, with the space
        self.pieces = Recent(self._encode_piece, CACHED)
        self._reverse(vocab, shown)

    def _reverse(self, vocab: dict[str, int], shown: list[str]) -> None:
        """Flat table of the bytes of each id, read back from the vocabulary's characters."""
        byte_of = {c: b for b, c in enumerate(shown)}
        tokens = [b""] * (max(vocab.values(), default=-1) + 1)
        for text, rank in vocab.items():
            tokens[rank] = bytes(byte_of[c] for c in text)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, text: str) -> tuple[str, np.ndarray]:
        """The ids of a text, as decimal numbers joined by commas and as an array."""
        units = _CUT.split(text) if _ODD.search(text) else text.split(" ")
        if not text:
            return "", np.zeros(0, dtype=np.int32)
        units[0], first = "", self._encode(units[0])
        found = list(map(self.units.__getitem__, units))
        found[0] = first
        shown, ids = zip(*found)
        return ",".join(filter(None, shown)), np.frombuffer(b"".join(ids), dtype=np.int32)

    def _encode(self, unit: str) -> tuple[str, bytes]:
        ids: list[int] = []
        for piece in self.split(unit):
            ids += self.pieces[piece]
        return ",".join([self.decimal[i] for i in ids]), array("i", ids).tobytes()

    def _encode_after_space(self, unit: str) -> tuple[str, bytes]:
        return self._encode(" " + unit) if unit else ("", b"")

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        mapped = piece.encode().decode("latin-1").translate(self.shown)
        return tuple([t.id for t in self.model.tokenize(mapped)])

    def decode(self, ids) -> bytes:
        """The bytes of the ids, in order."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return b""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.flat[at].tobytes()

    def offsets(self, text: str, ids) -> tuple[np.ndarray, np.ndarray]:
        """For each id the byte it starts at, and the character that byte belongs to."""
        sizes = self.lengths[np.asarray(ids, dtype=np.int64)]
        byte_at = np.cumsum(sizes) - sizes
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return byte_at, character[byte_at]


@functools.lru_cache(maxsize=2)
def codec(ranks: str, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def encode(df: DataFrame, key: str, text: str, ranks: str, pattern: str) -> DataFrame:
    """Per row: key, ids, and the byte and the character each id starts at."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for part in parts:
            ids, at = [], []
            for text in part.column(1):
                text = text.as_py() or ""
                ids.append(c.encode(text)[1])
                at.append(c.offsets(text, ids[-1]))
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(ids, pa.list_(pa.int32())),
                pa.array([b for b, _ in at], pa.list_(pa.int64())), pa.array([h for _, h in at], pa.list_(pa.int64())),
            ], ["key", "ids", "byte_start", "char_start"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>, byte_start array<bigint>, char_start array<bigint>")
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, key: str, ids: str, ranks: str, pattern: str) -> DataFrame:
    """Per row: key, the bytes of the ids, and their text; bytes that are no character become U+FFFD."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for part in parts:
            data = [c.decode(i.as_py() or []) for i in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(data, pa.binary()), pa.array([d.decode(errors="replace") for d in data], pa.string())],
                ["key", "bytes", "text"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, bytes binary, text string")
    return out.withColumnRenamed("key", key)


def round_trip(df: DataFrame, key: str | Column, text: str | Column, ranks: str, pattern: str) -> DataFrame:
    """Per row: key, n_tokens, and SHA-256 (lower-case hex) of the ids and of the decoded bytes.

    The ids are written as decimal numbers joined by commas. They are encoded and decoded in one pass
    and never leave the task.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for part in parts:
            counts, of_ids, of_bytes = [], [], []
            for text in part.column(1):
                joined, ids = c.encode(text.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    used = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = used.schema["key"].dataType.simpleString()
    out = used.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
