"""Substring dedup over sliding sentence spans.

A word is a run without blanks, or one code point of a script written without them. A sentence ends at . ! ? or a line
break. Run-on text has no such marks, so in every ``WINDOW`` words without one a sentence also ends after the word with
the least hash (the last such word): no sentence is longer, and ends depend on nearby words only, so the same passage
has the same sentences inside whatever surrounds it. At each sentence begins a run: the fewest consecutive sentences,
``MIN_SENTENCES`` at least, that hold ``MIN_WORDS`` words. Runs are equal if their words are, case aside. A repeated
passage of 4 * WINDOW + MIN_WORDS - 3 = 49 words or more surely holds a whole run: WINDOW - 1 words at either end may have
other ends, the first sure one comes at most WINDOW words on, and a run is shorter than MIN_WORDS + WINDOW words.

1. One scan gives a 64-bit hash for each run. A run that repeats one of its own document goes in any case and is left
   out here, so a hash comes at most once a document. Hashes are counted with partial sums before the exchange.
2. Runs are joined with the hashes that occur twice or more. The hash side has each hash once; a passage that very
   many documents share only adds its rows to one partition's stream, which adaptive execution may split.
3. The first run of a hash, by (doc_id, row identity, place), stays. Every sentence that another one covers goes.
4. Removal lists, at most one a document, are joined to the documents, and the texts are cut, repeats within one too.

Edge cases: null doc_ids come first in the order; rows with the same doc_id and text are one document and are cut
alike (neither is the other's copy); null and empty texts have no runs and come back as they are; documents shorter
than a run are never cut; a very long text is scanned and cut whole; an empty table gives an empty one; other columns,
whatever their names, are kept by clean() and not read by digest().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from . import arrays as A
from .common import in_batches, map_whole, own_columns, row_uid, stored, unused

WINDOW, MIN_SENTENCES, MIN_WORDS = 8, 3, 20
_P = 0xBF58476D1CE4E5B9


class Sentences:
    """Sentences of a chunk's rows: the first word of each, and each row's first sentence (n+1)."""

    def __init__(self, c: A.Chunk):
        self.c = c
        self.ws, self.we, wrow = c.segments(~A.SPACE[c.data])
        n = len(self.ws)
        self.wh = A.span_hash(A.prefix_hash(A.LOWER[c.data]), self.ws, self.we)
        end = np.zeros(n, bool)
        if n:
            last = c.data[self.we - 1]
            end = (last == 46) | (last == 33) | (last == 63)
            brk = np.flatnonzero(c.data == 10)
            end[:-1] |= np.searchsorted(brk, self.ws[1:]) > np.searchsorted(brk, self.we[:-1])
            end[wrow[1:][np.diff(wrow) > 0] - 1] = True
            end |= self._least(end)
        begin = np.zeros(n, bool)
        begin[1:] = end[:-1]
        begin[:1] = True
        self.word = np.append(np.flatnonzero(begin), n)  # first word of each sentence, and the end
        self.row0 = np.searchsorted(self.word[:-1], wrow)

    def _least(self, end: np.ndarray) -> np.ndarray:
        """The least word of each window of WINDOW words without an end (a row's last word is one, so rows don't mix)."""
        out = np.zeros(len(end), bool)
        ends = np.append(0, np.cumsum(end))
        at = np.flatnonzero(ends[WINDOW:] == ends[:-WINDOW]) if len(end) >= WINDOW else np.zeros(0, int)
        value = A.mix(self.wh, 7)
        best, where = value[at], at.copy()
        for k in range(1, WINDOW):
            new = value[at + k] <= best
            best, where = np.where(new, value[at + k], best), np.where(new, at + k, where)
        out[where] = True
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, place << 8 | length, hash, repeats an earlier run of the row) of every run."""
        n = np.diff(self.row0)
        row = np.repeat(np.arange(len(n)), n)
        s = np.arange(len(row))
        stop = np.maximum(s + MIN_SENTENCES, np.searchsorted(self.word, self.word[:-1] + MIN_WORDS))
        ok = stop <= self.row0[row + 1]
        row, s, stop = row[ok], s[ok], stop[ok]
        # one prefix sum over the words; spans are brought to a common power by the inverse
        k = len(self.wh) + 1
        power, inverse = _powers(k)
        h = np.zeros(k, np.uint64)
        np.cumsum(self.wh * power[: k - 1], out=h[1:], dtype=np.uint64)
        a, b = self.word[s], self.word[stop]
        code = A.mix((h[b] - h[a]) * inverse[a] + (b - a).astype(np.uint64))
        later = A.repeated(code + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[1]
        return row, (s - self.row0[row]) << 8 | (stop - s), code, later

    def own(self) -> list[np.ndarray]:
        """For each row, the runs that repeat an earlier one of the same row."""
        row, at, _, later = self.runs()
        row, at = row[later], at[later]
        return np.split(at, np.searchsorted(row, np.arange(1, self.c.rows)))

    def cut(self, i: int, runs: np.ndarray) -> tuple[bytes, int, int]:
        """Row i without the sentences of `runs` (place << 8 | length): its text, and how many sentences and bytes went."""
        a, b = self.row0[i], self.row0[i + 1]
        data = self.c.data[self.c.off[i] : self.c.off[i + 1]]
        if a == b or not len(runs):
            return data.tobytes(), 0, 0
        gone = np.zeros(b - a + 1, np.int32)
        np.add.at(gone, runs >> 8, 1)
        np.add.at(gone, np.minimum((runs >> 8) + (runs & 255), b - a), -1)
        gone = np.cumsum(gone[:-1]) > 0
        start = self.ws[self.word[a:b]] - self.c.off[i]
        edge = np.append(start, len(data))
        keep = np.ones(len(data), bool)
        step = np.zeros(len(data) + 1, np.int32)
        np.add.at(step, edge[:-1][gone], 1)
        np.add.at(step, edge[1:][gone], -1)
        keep = np.cumsum(step[:-1]) == 0
        return data[keep].tobytes(), int(gone.sum()), int(len(data) - keep.sum())


_cache: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_cache[0]) < n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            _cache[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
    return _cache


RUNS = "hash long, doc_id long, uid long, at long"


def runs(docs: DataFrame) -> DataFrame:
    """(hash, doc_id, uid, place << 8 | length) of the first run of each hash in every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(2)):
                row, at, h, later = Sentences(c).runs()
                where = pa.array(c.first + row[~later])
                yield pa.RecordBatch.from_arrays([pa.array(h[~later].view(np.int64)), b.column(0).take(where), b.column(1).take(where), pa.array(at[~later])], names=["hash", "doc_id", "uid", "at"])

    doc_id = F.col("doc_id").cast("long")
    return in_batches(docs.select(doc_id.alias("doc_id"), row_uid(doc_id, F.col("text")).alias("uid"), "text"), run, RUNS)


def removals(docs: DataFrame) -> DataFrame:
    """(uid, runs to remove) for each document that has any; small next to the texts."""
    all_runs = runs(docs)
    twice = all_runs.groupBy("hash").count().filter("count > 1").select("hash")
    shared = stored(all_runs.join(twice.hint("shuffle_hash"), "hash"))
    # stored, so that the join below is between two plain exchanges and a hot hash can be split
    first = stored(shared.groupBy("hash").agg(F.min(F.struct("doc_id", "uid", "at")).alias("first")))
    later = shared.join(first, "hash").filter(~F.struct("doc_id", "uid", "at").eqNullSafe(F.col("first")))
    return later.groupBy("uid", "doc_id").agg(F.collect_set("at").alias("runs"))


def _cut(docs: DataFrame) -> DataFrame:
    """The columns of docs, then the list of runs to remove."""
    uid, runs_ = unused(docs, "row_uid"), unused(docs, "cut_runs")
    doc_id = F.col("doc_id").cast("long")
    gone = removals(docs).select(F.col("uid").alias(f"{uid}_cut"), F.col("doc_id").alias(f"{uid}_id"), F.col("runs").alias(runs_))
    marked = docs.withColumn(uid, row_uid(doc_id, F.col("text")))
    # ids too: 64-bit hashes may agree by chance among very many rows
    rows = marked.join(gone, (F.col(uid) == F.col(f"{uid}_cut")) & doc_id.eqNullSafe(F.col(f"{uid}_id")), "left")
    return rows.select(*own_columns(docs), F.col(runs_))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed_bytes and the text that stays, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, off = _lists(b.column(2))
            for c in A.chunks(b.column(1)):
                s = Sentences(c)
                cut = [s.cut(i, np.append(own, lists[off[c.first + i] : off[c.first + i + 1]])) for i, own in enumerate(s.own())]
                null = b.column(1).slice(c.first, c.rows).is_null().to_pylist()
                texts = pa.array([None if z else t[0] for t, z in zip(cut, null, strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.rows), pa.array(np.diff(s.row0)), pa.array([t[1] for t in cut], pa.int64()), pa.array([t[2] for t in cut], pa.int64()), texts], names=["doc_id", "n_sentences", "n_removed", "removed_bytes", "text"])

    rows = _cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return in_batches(rows, run, "doc_id long, n_sentences long, n_removed long, removed_bytes long, text string")


def clean(docs: DataFrame) -> DataFrame:
    """docs with the cut texts; n_chars follows. Documents left without a word go."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, off = _lists(b.column(b.num_columns - 1))
            texts, keep = [], []
            for c in A.chunks(b.column(at)):
                s = Sentences(c)
                for i, own in enumerate(s.own()):
                    text, n, _ = s.cut(i, np.append(own, lists[off[c.first + i] : off[c.first + i + 1]]))
                    texts.append(text)
                    keep.append(n == 0 or n < s.row0[i + 1] - s.row0[i])
            new = pa.array(texts, pa.binary()).cast(b.column(at).type)
            if b.column(at).null_count:
                new = pa.compute.if_else(b.column(at).is_null(), pa.scalar(None, new.type), new)
            cols = [new if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    out = map_whole(_cut(docs), run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes))
