"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are normalised alike: letters lower-cased (ASCII and Latin-1), everything but letters, digits and
bytes beyond ASCII is a separator, runs of separators become one blank. Items are cut into overlapping segments of
``SEGMENT`` bytes, one every ``STRIDE`` and one at the end (a shorter item is one segment). A document is
contaminated by an item if one of its substrings is within ``e`` edits of a segment of L bytes, where
``e = (L - Q) / Q`` rounded down, the most that the lemma below allows. So a verbatim excerpt of
``SEGMENT + STRIDE - 1`` bytes is always found.

By the q-gram lemma such a substring shares at least ``L - Q + 1 - Q * e`` q-grams with the segment, on at most e + 1
neighbouring diagonals. So: (1) every q-gram of a text is looked up in the segments' q-grams; (2) hits are counted in
diagonal bands of H + e + 1 that overlap by e + 1, so some band holds all of them; (3) where a band has enough hits
within the length of a segment, alignment inside that band, with free ends in the text, gives the edit distance.
No step drops a possible match: the lemma's count is a lower bound, and the alignment covers the whole band.

The items are a stated set met by every document. Equal segments, such as those of a template that many items share, are indexed once
with a list of their items. Items are broadcast in blocks whose index takes at most about ``INDEX_BYTES``, so memory is bounded
however many there are (one item stays whole). Documents are never shuffled.

A text that repeats itself is searched once: of q-gram starts with the same ``CONTEXT`` bytes before and behind, only the first in a row
is looked up. That loses nothing: those bytes hold every substring that a segment could match there, so the first
occurrence of such a substring keeps all its hits. Hits are expanded ``HITS`` at a time, in slices that overlap by more than a match.

Edge cases: null and empty texts and items match nothing, nor do items under Q normalised bytes; rows with equal or
null doc_id are searched one by one; ties of item ids are items of their own; a very long text is one chunk and is searched
whole; an empty table of documents or items gives no match; further columns, whatever their names, pass through untouched in
clean() and are not read in matches().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrays as A
from .common import in_batches, map_whole

Q, SEGMENT, STRIDE, H = 12, 52, 13, 16
#: Bytes of a block's index, what it takes for each byte of items (measured; a test holds it), and hits that are held at once.
INDEX_BYTES, INDEX_PER_BYTE, HITS = 64 << 20, 40, 1 << 20
#: More than a segment with its edits and a q-gram.
CONTEXT = 96
FOLD = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in A.LOWER.tolist()], np.uint8)
OUT = "doc_id long, item_id long, n_segments long, edits long, first_char long"


def normalise(c: A.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, the place of each in the chunk, and where each row begins among them (n+1)."""
    d = FOLD[c.data]
    lead = np.flatnonzero(d[:-1] == 0xC3)
    after = d[lead + 1]
    upper = (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
    d[lead[upper] + 1] += 0x20
    keep = d != 32
    gap = ~keep
    gap[1:] &= keep[:-1]
    gap[c.off[:-1][c.off[:-1] < len(d)]] = False
    at = np.flatnonzero(keep | gap)
    return d[at], at, np.searchsorted(at, c.off)


def normal(text: str) -> bytes:
    """One normalised text without blanks at its ends."""
    for c in A.chunks(pa.array([text])):
        return normalise(c)[0].tobytes().strip()
    return b""


def grams(d: np.ndarray) -> np.ndarray:
    """64-bit codes of the q-grams of d, one for each start."""
    x = A.BYTE_CODE[d]
    p = 1
    out, have = x, 1
    while have * 2 <= Q:
        m = np.uint64(pow(0x9E3779B97F4A7C15, p, 1 << 64))
        out = out[: len(out) - have] * m + out[have:]
        have, p = have * 2, p * 2
        if have == 4:
            four = out
    for _ in range((Q - have) // 4):
        out = out[: len(four) - have] * np.uint64(pow(0x9E3779B97F4A7C15, 4, 1 << 64)) + four[have:]
        have += 4
    return out


class Segments:
    """Segments of items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items: list[int | None] = []
        owner, first, size, whole, at = [], [], [], [], 0
        for item, text in items:
            t = normal(text or "")
            if len(t) < Q:
                continue
            last = max(0, len(t) - SEGMENT)
            starts = np.unique(np.append(np.arange(0, last, STRIDE), last))
            owner.append(np.full(len(starts), len(self.items)))
            first.append(starts + at)
            size.append(np.full(len(starts), min(len(t), SEGMENT)))
            whole.append(t)
            at += len(t)
            self.items.append(item)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        owner, first, size, self.text = join(owner), join(first), join(size), np.frombuffer(b"".join(whole), np.uint8)
        # equal segments are one, with all their items
        key = A.mix(A.span_hash(A.prefix_hash(self.text), first, first + size) + size.astype(np.uint64))
        _, one, back = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(back, kind="stable")
        self.owners, self.owner0 = owner[order].astype(np.int32), np.searchsorted(back[order], np.arange(len(one) + 1))
        self.begin, self.size = first[one], size[one]
        self.edits = (self.size - Q) // Q
        self.need = self.size - Q + 1 - Q * self.edits
        n = self.size - Q + 1
        seg = np.repeat(np.arange(len(one), dtype=np.int32), n)
        pos = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
        code = grams(self.text)[self.begin[seg] + pos] if len(seg) else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code, entry0 = np.unique(code[order], return_index=True)
        self.first = np.append(entry0, len(code)).astype(np.int32)
        self.seg, self.pos = seg[order], pos[order].astype(np.uint8)
        bits = max(16, int(4 * max(1, len(self.code))).bit_length())
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self._slot(self.code)] = True

    def nbytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0xD6E8FEB86659FD93)) >> self.shift

    def search(self, c: A.Chunk) -> tuple[np.ndarray, ...]:
        """(row, segment, edits, byte of the chunk) of every segment found, the least edits each."""
        none = (np.zeros(0, np.int64),) * 4
        d, at, row0 = normalise(c)
        if len(d) < Q or not len(self.code):
            return none
        code = grams(d)
        p = np.flatnonzero(self.seen[self._slot(code)])
        slot = np.minimum(np.searchsorted(self.code, code[p]), len(self.code) - 1)
        ok = self.code[slot] == code[p]
        p, slot = p[ok], slot[ok]
        row = np.searchsorted(row0, p, "right") - 1
        ok = p + Q <= row0[row + 1]
        p, slot, row = p[ok], slot[ok], row[ok]
        # enough distinct starts for any segment in this row? Else its hits can't matter.
        count = np.bincount(row, minlength=c.rows)
        ok = count[row] >= (self.need.min() if len(self.need) else 1)
        p, slot, row = p[ok], slot[ok], row[ok]
        # of starts in the same surroundings the first one of the row
        lo, hi = np.maximum(p - CONTEXT, row0[row]), np.minimum(p + CONTEXT, row0[row + 1])
        around = A.span_hash(A.prefix_hash(d), lo, hi) + A.mix((p - lo).astype(np.uint64) * np.uint64(2 * CONTEXT) + (hi - p).astype(np.uint64))
        _, once = np.unique(A.mix(around) ^ A.mix(row.astype(np.uint64), 1), return_index=True)
        once.sort()
        p, slot, row = p[once], slot[once], row[once]
        if not len(p):
            return none
        many = (self.first[slot + 1] - self.first[slot]).astype(np.int64)
        total = np.append(0, np.cumsum(many))
        found, i = [], 0
        while i < len(p):  # slices of HITS hits, each at least twice as wide as what it shares with the next one
            j = max(int(np.searchsorted(total, total[i] + HITS, "right")) - 1, int(np.searchsorted(p, p[i] + 2 * CONTEXT)), i + 1)
            found.append(self._slice(d, at, row0, c.rows, p[i:j], slot[i:j], row[i:j], many[i:j]))
            if j >= len(p):
                break
            i = max(i + 1, int(np.searchsorted(p, p[j] - CONTEXT)))
        row, seg, dist, start = (np.concatenate(x) for x in zip(*found))
        return self._least(row, seg, dist, start)

    @staticmethod
    def _least(row: np.ndarray, seg: np.ndarray, dist: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
        """The least edits of each row and segment, and the first place with these."""
        order = np.lexsort((start, dist, seg, row))
        row, seg, dist, start = row[order], seg[order], dist[order], start[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (seg[1:] != seg[:-1])
        return row[new], seg[new], dist[new], start[new]

    def _slice(self, d: np.ndarray, at: np.ndarray, row0: np.ndarray, rows: int, p: np.ndarray, slot: np.ndarray, row: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
        none = (np.zeros(0, np.int64),) * 4
        entry = np.repeat(self.first[slot] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        seg, pos, p, row = self.seg[entry].astype(np.int64), self.pos[entry].astype(np.int64), np.repeat(p, many), np.repeat(row, many)
        # a first count for each row and segment, over all diagonals
        pair = row * len(self.size) + seg
        _, back, n = np.unique(pair, return_inverse=True, return_counts=True)
        ok = n[back] >= self.need[seg]
        seg, pos, p, row, pair = seg[ok], pos[ok], p[ok], row[ok], pair[ok]
        if not len(p):
            return none
        diag = p - pos - row0[row] + SEGMENT  # from the row's start, never negative
        band = diag // H
        also = diag % H <= self.edits[seg]
        band, p, seg, row, pair = (np.append(x, y[also]) for x, y in ((band, band - 1), (p, p), (seg, seg), (row, row), (pair, pair)))
        order = np.lexsort((p, band, pair))
        band, p, seg, row, pair = band[order], p[order], seg[order], row[order], pair[order]
        last = np.arange(len(p)) + self.need[seg] - 1
        ok = last < len(p)
        i, j = np.flatnonzero(ok), last[ok]
        ok = (pair[i] == pair[j]) & (band[i] == band[j]) & (p[j] - p[i] <= self.size[seg[i]] - Q + self.edits[seg[i]])
        i = i[ok]
        if not len(i):
            return none
        new = np.ones(len(i), bool)
        new[1:] = (pair[i][1:] != pair[i][:-1]) | (band[i][1:] != band[i][:-1])
        i = i[new]
        row, seg, band = row[i], seg[i], band[i]
        dist = np.concatenate([self.align(d, row0, row[k : k + 20_000], seg[k : k + 20_000], band[k : k + 20_000]) for k in range(0, len(i), 20_000)])
        ok = dist <= self.edits[seg]
        row, seg, dist, band = row[ok], seg[ok], dist[ok], band[ok]
        start = at[np.clip(row0[row] + band * H - SEGMENT, row0[row], np.maximum(row0[row + 1] - 1, row0[row]))]
        return self._least(row, seg, dist, start)

    def align(self, d: np.ndarray, row0: np.ndarray, row: np.ndarray, seg: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Edit distance of each segment to the best substring on the diagonals of its band; all candidates step together."""
        width = H + int(self.edits.max()) + 1
        lo = row0[row] + band * H - SEGMENT
        k = np.arange(width)
        end = row0[row + 1]
        size = self.size[seg]
        # cell k of row i stands for text place lo + i + k; row 0 is free
        v = np.zeros((len(row), width), np.int32)
        best = np.full(len(row), 1 << 20)
        for i in range(1, int(size.max()) + 1):
            place = lo[:, None] + (i - 1) + k
            inside = (place >= row0[row][:, None]) & (place < end[:, None])
            same = inside & (d[np.clip(place, 0, len(d) - 1)] == self.text[np.minimum(self.begin[seg] + i - 1, len(self.text) - 1)][:, None])
            nxt = v + ~same
            nxt[:, :-1] = np.minimum(nxt[:, :-1], v[:, 1:] + 1)
            v = (np.minimum.accumulate(nxt - k, axis=1) + k).astype(np.int32)
            done = size == i
            best[done] = v[done].min(1)
        return best


def blocks(bench: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, as many at a time as INDEX_BYTES allow."""
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total * INDEX_PER_BYTE // INDEX_BYTES)
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield sorted(((r.item_id, r.text) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row for each document and item that meet: how many segments, the least edits, and about where the first is."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], OUT)
    for i, block in enumerate(blocks(bench)):
        shipped = spark.sparkContext.broadcast(Segments(block))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            s = shipped.value
            for b in batches:
                ids = b.column(0)
                for c in A.chunks(b.column(1)):
                    row, seg, dist, start = s.search(c)
                    if not len(row):
                        continue
                    char = A.codepoints(c.data)
                    char = char[start] - char[c.off[row]]
                    many = s.owner0[seg + 1] - s.owner0[seg]
                    item = s.owners[np.repeat(s.owner0[seg] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())]
                    row, dist, char = np.repeat(row, many), np.repeat(dist, many), np.repeat(char, many)
                    order = np.lexsort((char, item, row))
                    row, item, dist, char = row[order], item[order], dist[order], char[order]
                    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])))
                    n = np.diff(np.append(first, len(row)))
                    cols = [ids.take(pa.array(c.first + row[first])), pa.array([s.items[k] for k in item[first]], pa.int64()), pa.array(n), pa.array(np.minimum.reduceat(dist, first).astype(np.int64)), pa.array(char[first].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in OUT.split(", ")])

        found = in_batches(rows, run, OUT)
        out = found if not i else out.unionByName(found)
    return out


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that meet no item, with all their columns."""
    at = docs.columns.index("text")
    schema = docs.schema
    for block in blocks(bench):
        shipped = docs.sparkSession.sparkContext.broadcast(Segments(block))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for c in A.chunks(b.column(at)):
                    keep[c.first + shipped.value.search(c)[0]] = False
                yield b.filter(pa.array(keep))

        docs = map_whole(docs, run, schema)
    return docs
