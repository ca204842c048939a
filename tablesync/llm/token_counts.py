"""Token counts of greedy word pieces by a linear longest-match automaton.

The vocabulary is a trie over bytes in which the end of a word is one more symbol. Each node has a
failure link: the node reached after the greedy longest matches of its string have been popped, with
the number of tokens popped on the way. A word is then counted in one walk over its bytes; no piece
is ever built. Steps that follow failure links are kept once taken, so a step costs one lookup.

A word is a maximal run of bytes outside `\\x20\\x09-\\x0D`, A-Z lower-cased. A word that greedy
matching cannot cover with vocabulary pieces counts as one unknown token.

Edge cases: null and empty texts have no words and no tokens; repeated rows give repeated rows; an
empty table gives an empty table; columns other than the two named are never read.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tablesync.llm.byte_bpe import byte_table

CACHED_WORDS = 400_000  # counted words a worker keeps; when full the cache starts anew
END = 256  # the symbol after a word's last byte

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_pieces(path: str, word_end: str = "</w>", special: tuple[str, ...] = ("<|startoftext|>", "<|endoftext|>")):
    """The vocabulary of a tokenizer file whose pieces are written with the byte table, as symbol tuples."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    byte_of = {c: b for b, c in enumerate(byte_table())}
    for piece in vocab:
        if piece in special:
            continue
        last = piece.endswith(word_end)
        shown = piece[: -len(word_end)] if last else piece
        yield (*(byte_of[c] for c in shown), *([END] if last else []))


class Automaton:
    """Counts greedy longest-match pieces. Node 0 is the root, -1 stands for no way on."""

    def __init__(self, pieces):
        self.next: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                at = self.next[node].get(symbol)
                if at is None:
                    at = self.next[node][symbol] = len(self.next)
                    self.next.append({})
                    is_piece.append(False)
                node = at
            if node:
                is_piece[node] = True
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        level = [0]
        while level:  # breadth first: the links of shorter strings come first
            below = []
            for parent in level:
                for symbol, node in self.next[parent].items():
                    below.append(node)
                    if is_piece[node]:
                        self.fail[node], self.popped[node] = 0, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at >= 0 and symbol not in self.next[at]:
                        at, count = self.fail[at], count + self.popped[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][symbol], count
            level = below
        self.steps: dict[int, tuple[int, int]] = {}
        self.words: dict[bytes, int] = {}

    def step(self, node: int, symbol: int) -> tuple[int, int]:
        """Where a symbol leads, failure links followed, and the tokens popped on the way."""
        count, at = 0, node
        while at >= 0:
            onward = self.next[at].get(symbol)
            if onward is not None:
                found = (onward, count)
                break
            count, at = count + self.popped[at], self.fail[at]
        else:
            found = (-1, 0)
        self.steps[node * 257 + symbol] = found
        return found

    def count(self, word: bytes) -> int:
        """The number of pieces of one word and its end; 1 (unknown) if they cannot cover it."""
        node, total, steps = 0, 0, self.steps
        for symbol in (*word, END):
            found = steps.get(node * 257 + symbol) or self.step(node, symbol)
            node = found[0]
            if node < 0:
                return 1
            total += found[1]
        while node > 0:  # pop what the last symbols left
            total, node = total + self.popped[node], self.fail[node]
        return total if node == 0 else 1

    def count_text(self, text: str | None) -> tuple[int, int]:
        """(words, tokens) of a text."""
        words = (text or "").encode().translate(_LOWER).split()
        known, total = self.words, 0
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in words:
            n = known.get(word)
            if n is None:
                n = known[word] = self.count(word)
            total += n
        return len(words), total


@functools.lru_cache(maxsize=1)
def automaton(path: str) -> Automaton:
    return Automaton(read_pieces(path))


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """Per row: key, n_words, n_tokens."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for part in parts:
            found = [a.count_text(t.as_py()) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([w for w, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                ["key", "n_words", "n_tokens"])

    used = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = used.schema["key"].dataType.simpleString()
    out = used.mapInArrow(run, f"key {kind}, n_words bigint, n_tokens bigint")
    return out.withColumnRenamed("key", key)


def greedy_pieces(word: bytes, pieces: set[tuple[int, ...]]) -> list[tuple[int, ...]] | None:
    """The plain way, for tests: the longest piece that fits, again and again; None if none fits."""
    symbols, found = (*word, END), []
    while symbols:
        n = next((n for n in range(len(symbols), 0, -1) if symbols[:n] in pieces), 0)
        if not n:
            return None
        found.append(symbols[:n])
        symbols = symbols[n:]
    return found
