"""Vectorised text scanning on Arrow string columns.

The Python-side operators never loop over characters. A batch of texts is cut into chunks of a few MB; each
chunk is one ``uint8`` array plus row offsets, and words, lines and hashes come from whole-array numpy steps.
Memory is bounded by the chunk budget or by the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: Separators of words: blank and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: First bytes of U+3000 to U+9FFF (Chinese and kana), which are written without blanks; Thai is E0 B8 and E0 B9.
WIDE = np.zeros(256, bool)
WIDE[0xE3:0xEA] = True
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80
#: ASCII lower-casing.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: A random value for each byte; polynomial hashes over these are taken modulo 2**64.
BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**0 .. B**(n-1) and their inverses modulo 2**64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(1 << 12, n + n // 8)
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]), dtype=np.uint64)
        _inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE_INV)]), dtype=np.uint64)
    return _powers, _inverse


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hash(data: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """H with H[j]-H[i] = sum of code[byte k] * B**k for i <= k < j."""
    power, _ = powers(len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * power[: len(data)], out=h[1:], dtype=np.uint64)
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand."""
    _, inverse = powers(len(h) + 1)
    return mix((h[end] - h[start]) * inverse[start] + (end - start).astype(np.uint64))


def string_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n+1, int64) and bytes of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return off, np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)


class Chunk:
    """Rows first..last of a batch: their bytes one after another, and where each begins."""

    def __init__(self, first: int, off: np.ndarray, data: np.ndarray):
        self.first, self.rows = first, len(off) - 1
        self.off = off - off[0]
        self.data = data[off[0] : off[-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and the index of each row's first word (n+1)."""
        return self.runs(~SPACE[self.data])

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of a mask within rows."""
        if not len(inside):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.rows + 1, np.int64)
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        edge = self.off[:-1][np.diff(self.off) > 0]
        begin[edge] = inside[edge]
        edge = self.off[1:][np.diff(self.off) > 0] - 1
        stop[edge] = inside[edge]
        start = np.flatnonzero(begin)
        return start, np.flatnonzero(stop) + 1, np.searchsorted(start, self.off)

    def segments(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """runs(), but each code point of a script without blanks is a run of its own."""
        start, end, row0 = self.runs(inside)
        d = self.data
        wide = WIDE[d]
        wide[:-2] |= (d[:-2] == 0xE0) & ((d[1:-1] == 0xB8) | (d[1:-1] == 0xB9))
        at = np.flatnonzero(wide)
        if not len(at):
            return start, end, row0
        begin, stop = np.zeros(len(d) + 3, bool), np.zeros(len(d) + 1, bool)
        begin[start], stop[end] = True, True
        begin[at], stop[np.minimum(at + 3, len(d))] = True, True
        after = at + 3
        begin[after[after < len(d)]] |= inside[after[after < len(d)]]
        stop[at[at > 0]] |= inside[at[at > 0] - 1]
        start = np.flatnonzero(begin)
        return start, np.flatnonzero(stop), np.searchsorted(start, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the \\n-split lines (an empty text has one empty line), and each row's first line."""
        brk = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.off[:-1], brk + 1]), kind="stable")
        row = np.searchsorted(brk, self.off[:-1]) + np.arange(self.rows)
        # a row that begins where the last one ended with a break: the break's line comes first
        first = np.concatenate([row, [len(start)]])
        end = np.sort(np.concatenate([self.off[1:], brk]), kind="stable")
        return start, end, first

    def text(self, i: int) -> str:
        return self.data[self.off[i] : self.off[i + 1]].tobytes().decode("utf-8", "replace")


def chunks(column: pa.Array, budget: int = CHUNK_BYTES, max_rows: int = 50_000) -> Iterator[Chunk]:
    """The rows of a column in order, at most `budget` bytes (or one row) and `max_rows` rows at a time."""
    off, data = string_views(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + budget, "right")) - 1)
        b = min(b, n, a + max_rows)
        yield Chunk(a, off[a : b + 1], data)
        a = b


def codepoints(data: np.ndarray) -> np.ndarray:
    """c with c[i] = code points in data[:i]."""
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum(LEAD[data], out=c[1:])
    return c


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once; is it a later occurrence."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    more = same.copy()
    more[:-1] |= same[1:]
    any_, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    any_[order], later[order] = more, same
    return any_, later
