"""Token counts by greedy longest match, with a linear automaton over a vocabulary trie.

Each word is matched with one blank before it, against a byte-level vocabulary: at every point the longest entry that
fits is taken. Every node of the trie has a failure link and the number of entries that taking the link pops, so
each byte is read once, nothing is matched again, and no piece is ever built.

Distinct words of a chunk go through the automaton together, one byte position at a time. Words over ``LONG`` bytes
go one at a time, still linear. The vocabulary is read on the driver from a path and broadcast (bounded by the
vocabulary, a few MB). All 256 single bytes must be in it, so no word is without a split.

Edge cases: null, empty and blank texts have no words and no tokens; rows are counted one by one, so repeated rows
and null doc_ids don't matter; a very long text is counted whole; an empty table gives an empty one; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrays as A
from .common import in_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LONG = 128


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Entries of a rank file: a base64 string and a rank in each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Arrays over trie nodes (0 is the root): sorted (node, byte) keys with children, failure links, popped counts."""

    def __init__(self, vocabulary: Iterable[bytes]):
        child: dict[int, int] = {}
        entry = [False]
        for token in vocabulary:
            node = 0
            for b in token:
                key = node << 8 | b
                if key not in child:
                    child[key] = len(entry)
                    entry.append(False)
                node = child[key]
            if node:
                entry[node] = True
        if any(b not in child or not entry[child[b]] for b in range(256)):
            raise ValueError("the vocabulary lacks a single byte")
        n = len(entry)
        fail, pops, rest = [0] * n, [0] * n, [0] * n
        below: dict[int, list[tuple[int, int]]] = {}
        for key, v in child.items():
            below.setdefault(key >> 8, []).append((key & 255, v))
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for b, v in below.get(u, ()):
                queue.append(v)
                if entry[v]:
                    fail[v], pops[v] = 0, 1
                else:  # pop what the parent pops, and go on until the byte fits
                    z, popped = fail[u], pops[u]
                    while z << 8 | b not in child:
                        popped += pops[z]
                        z = fail[z]
                    fail[v], pops[v] = child[z << 8 | b], popped
                rest[v] = pops[v] + rest[fail[v]]
        keys = np.array(sorted(child), np.int64)
        self.keys, self.children = keys, np.array([child[k] for k in keys.tolist()], np.int32)
        self.fail, self.pops, self.rest = (np.array(x, np.int32) for x in (fail, pops, rest))
        self._child: dict[int, int] | None = None

    def one(self, word: bytes) -> int:
        """Tokens of one word, byte by byte."""
        if self._child is None:
            self._child = dict(zip(self.keys.tolist(), self.children.tolist(), strict=True))
            self._fail, self._pops = self.fail.tolist(), self.pops.tolist()
        child, fail, pops, node, count = self._child, self._fail, self._pops, 0, 0
        for b in word:
            while (v := child.get(node << 8 | b)) is None:
                count += pops[node]
                node = fail[node]
            node = v
        return count + int(self.rest[node])

    def many(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, head: int = 0x20) -> np.ndarray:
        """Tokens of data[start:end], each with the byte `head` before it."""
        first = self.children[np.searchsorted(self.keys, head)]
        size = end - start
        order = np.argsort(-size, kind="stable")
        size, at = size[order], start[order]
        node, count = np.full(len(at), first, np.int32), np.zeros(len(at), np.int32)
        short = int(np.searchsorted(-size, -LONG, "left"))
        for i in range(short):
            count[i] = self.one(bytes([head]) + data[at[i] : at[i] + size[i]].tobytes())
        node[:short] = 0
        longest = int(size[short]) if short < len(size) else 0
        for j in range(longest):
            k = short + int(np.searchsorted(-size[short:], -j, "left"))  # words with a byte j
            live = np.arange(short, k)
            byte = data[at[short:k] + j].astype(np.int64)
            cur = node[short:k].astype(np.int64)
            while len(live):
                key = cur << 8 | byte
                slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[slot] == key
                node[live[ok]] = self.children[slot[ok]]
                live, cur, byte = live[~ok], cur[~ok], byte[~ok]
                count[live] += self.pops[cur]
                cur = self.fail[cur].astype(np.int64)
        out = np.empty(len(at), np.int64)
        out[order] = count + self.rest[node]
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if isinstance(v, np.ndarray)} | {"_child": None}


def row_tokens(c: A.Chunk, automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each row; each distinct word of the chunk is matched once."""
    ws, we, wrow = c.words()
    n_words = np.diff(wrow)
    if not len(ws):
        return n_words, np.zeros(c.rows, np.int64)
    _, first, back = np.unique(A.span_hash(A.prefix_hash(c.data), ws, we), return_index=True, return_inverse=True)
    total = np.zeros(len(ws) + 1, np.int64)
    np.cumsum(automaton.many(c.data, ws[first], we[first])[back], out=total[1:])
    return n_words, np.diff(total[wrow])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(Automaton(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(1)):
                cols = np.diff(c.off), *row_tokens(c, shipped.value)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.rows), *(pa.array(x.astype(np.int64)) for x in cols)], names=["doc_id", "n_bytes", "n_words", "n_tokens"])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_bytes long, n_words long, n_tokens long")
