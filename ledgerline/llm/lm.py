"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Tokens are words (ASCII letters lower-cased) and one end mark a text; a text begins with a begin mark that is a
context only. Training rows are those whose crc32(doc_id) modulo 7 is not 2. Counting has three exchanges, each of
packed arrays that were summed in the task before:

* A: word hashes and counts, dealt by hash range. Each part is written as one file of sorted hashes and counts; a
  word's id is its rank over all parts.
* B: bigrams (two 32-bit ids) and counts, dealt by a hash of both words, so no frequent word's bigrams meet in one
  task. Each part is written as one file of sorted keys and counts, and gives counts of counts.
* C: for each word how many different words come before it, and how many follow it once, twice and more often,
  summed within B's parts first; dealt by the ranges of A and written beside its files.

Everything covers all training rows; nothing is pruned. Files go to the shared folder under names that only depend
on the part, by write-and-rename, so a task that runs again leaves the same file. Workers map the files where the
folder is local (or mounted); otherwise a worker copies a part to a nameless temporary file once and maps that. So
the model's size isn't bound by memory, and nothing is broadcast but the list of parts. A worker keeps ``MAX_OPEN`` files
mapped, those used last.

Scores are log10. p(w|u) = max(c(uw)-D, 0)/c(u) + g(u) q(w), q(w) = max(m(w)-D', 0)/M + g' /(V+1), with m the number
of different words before w, and an unseen word taking q = g'/(V+1). Discounts are the usual ones from counts of
counts; where those are zero, D_k = k/2.

Edge cases: null and empty texts are one end mark; a null doc_id counts as the empty text for the held-out rule;
repeated rows count and are scored as often as they occur; without training rows every probability is 1/(V+1) with
V = 0; an empty table to score gives no row; a very long text is one chunk and is scored whole; ties of doc_id are rows like
others; more than 2**32 - 4 different words is an error. Other columns are not read.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import arrays as A
from .common import in_batches, shared_dir, stored

BEGIN, END, UNSEEN, FIRST = 0, 1, 2, 3
PART_BYTES = 32 << 20
FLUSH = 4_000_000
#: Files that a worker keeps mapped; each holds a descriptor, of which a process has some 1,000.
MAX_OPEN = 512


def held_out(doc_id: Column, modulus: int = 7, rest: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest


# ---- packed arrays and files


def pack(x: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed: small or slowly growing numbers take little room."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), "zstd", asbytes=True) if len(x) else b""


def unpack(b: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(b, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(b: bytes, n: int, kind: type) -> np.ndarray:
    return np.cumsum(unpack(b, n, kind), dtype=kind)


def put(uri: str, arrays: list[np.ndarray]) -> None:
    """A file of arrays: their number, then length and item code of each, then the data, each from a multiple of 8."""
    head = np.array([len(arrays), *(v for a in arrays for v in (len(a), ord(a.dtype.char)))], np.int64)
    parts = [head.tobytes(), *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)]
    url = urlparse(uri)
    if url.scheme in ("", "file"):
        path = unquote(url.path)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        temp = f"{path}.{uuid.uuid4().hex}"
        with open(temp, "wb") as f:
            f.writelines(parts)
        os.replace(temp, path)
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        temp = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(temp) as f:
            for p in parts:
                f.write(p)
        store.move(temp, path)


def mapped(uri: str) -> list[np.ndarray]:
    """The arrays of a file, mapped and not read."""
    url = urlparse(uri)
    if url.scheme in ("", "file"):
        with open(unquote(url.path), "rb") as f:
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        with tempfile.TemporaryFile() as f, store.open_input_stream(path) as src:  # gone with the mapping
            while block := src.read(8 << 20):
                f.write(block)
            f.flush()
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    n = int(np.frombuffer(m, np.int64, 1)[0])
    head = np.frombuffer(m, np.int64, 2 * n, 8)
    at, out = 8 * (1 + 2 * n), []
    for i in range(n):
        kind = np.dtype(chr(head[2 * i + 1]))
        out.append(np.frombuffer(m, kind, int(head[2 * i]), at))
        at += -(-int(head[2 * i]) * kind.itemsize // 8) * 8
    return out


# ---- token scanning


def word_part(h: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of hashes."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def pair_part(key: np.ndarray, parts: int) -> np.ndarray:
    return word_part(A.mix(key, 5), parts)


def word_hashes(c: A.Chunk) -> tuple[np.ndarray, np.ndarray]:
    ws, we, row0 = c.words()
    return A.span_hash(A.prefix_hash(A.LOWER[c.data]), ws, we), row0


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


class Tally:
    """Keys counted within a task, given out as packed rows by part."""

    def __init__(self, parts: int, part_of):
        self.parts, self.part_of = parts, part_of
        self.keys: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys = np.concatenate(self.keys)
        self.keys, self.size = [], 0
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
        yield from packed(keys[first], [counts], self.part_of(keys[first], self.parts))


PACKED = "part int, n int, keys binary, vals array<binary>"


def packed(keys: np.ndarray, values: list[np.ndarray], part: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their values as one row for each part."""
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.append(True, np.diff(part[order]) != 0)) if len(part) else np.zeros(0, int)
    ends = np.append(edge[1:], len(part))
    rows = [(int(part[order[a]]), int(b - a), pack_sorted(keys[order[a:b]]), [pack(v[order[a:b]].astype(np.uint32)) for v in values]) for a, b in zip(edge, ends, strict=True)]
    if rows:
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.list_(pa.binary()))], names=["part", "n", "keys", "vals"])


def gathered(df: pd.DataFrame, kind: type, n_values: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys and values of a part's rows, one after another."""
    keys = np.concatenate([unpack_sorted(k, n, kind) for k, n in zip(df["keys"], df["n"], strict=True)])
    return keys, [np.concatenate([unpack(v[i], n, np.uint32) for v, n in zip(df["vals"], df["n"], strict=True)]) for i in range(n_values)]


# ---- the model as files


class Files:
    """Word files (hashes, counts; ids by rank), statistics files beside them, and bigram files."""

    def __init__(self, base: str, words: list[int], pairs: int = 0):
        self.base, self.pairs = base, pairs
        self.empty: set[int] = set()  # parts without a bigram have no file
        self.n_words = np.array(words, np.int64)
        self.start = FIRST + np.append(0, np.cumsum(self.n_words))
        self._open: dict[str, list[np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def arrays(self, kind: str, part: int) -> list[np.ndarray]:
        name = f"{self.base}/{kind}-{part}"
        got = self._open.pop(name, None)
        if got is None:
            while len(self._open) >= MAX_OPEN:
                del self._open[next(iter(self._open))]
            got = mapped(name)
        self._open[name] = got  # the last one used stands last
        return got

    def find(self, h: np.ndarray, stats: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sorted different hashes (UNSEEN if absent), and a row (count, before, once, twice, more) for each."""
        parts = len(self.n_words)
        ids = np.full(len(h), UNSEEN, np.uint64)
        out = np.zeros((len(h), 5), np.int64)
        edge = np.searchsorted(word_part(h, parts), np.arange(parts + 1))
        for p in np.flatnonzero((np.diff(edge) > 0) & (self.n_words > 0)):
            q = slice(edge[p], edge[p + 1])
            keys, counts = self.arrays("words", p)
            at = np.minimum(np.searchsorted(keys, h[q]), len(keys) - 1)
            ok = keys[at] == h[q]
            ids[q] = np.where(ok, at + self.start[p], UNSEEN)
            out[q, 0] = np.where(ok, counts[at], 0)
            if stats:
                for k, a in enumerate(self.arrays("stats", p), 1):
                    out[q, k] = np.where(ok, a[at], 0)
        return ids, out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted different bigrams."""
        out = np.zeros(len(keys), np.int64)
        part = pair_part(keys, self.pairs)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(self.pairs + 1))
        for p in np.flatnonzero(np.diff(edge)):
            if p in self.empty:
                continue
            q = order[edge[p] : edge[p + 1]]
            have, small, where, large = self.arrays("pairs", p)
            at = np.minimum(np.searchsorted(have, keys[q]), len(have) - 1)
            ok = have[at] == keys[q]
            n = np.where(ok, small[at], 0).astype(np.int64)
            over = np.flatnonzero(n == 255)
            if len(over):
                n[over] = large[np.searchsorted(where, at[over])]
            out[q] = n
        return out


def sequence(token: np.ndarray, row0: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and tokens of all places of all rows (each row: its words, then END), and each row's first place."""
    rows = len(row0) - 1
    n = np.diff(row0)
    s = np.full(len(token) + 2 * rows, BEGIN, np.uint64)
    s[np.arange(len(token)) + 2 * np.repeat(np.arange(rows), n) + 1] = token
    last = row0[1:] + 2 * np.arange(rows) + 1
    s[last] = END
    inner = np.ones(max(len(s) - 1, 0), bool)
    inner[last[:-1]] = False
    return s[:-1][inner], s[1:][inner], row0[:-1] + np.arange(rows)


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of things counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.0
    raw = [k - (k + 1) * y * b / a if a and b and y else k / 2 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *np.clip(raw, 0, [1, 2, 3])])


class Model:
    """Totals, discounts and files; scores chunks."""

    def __init__(self, files: Files, texts: int, words: int, pairs: np.ndarray, before: np.ndarray, begin: tuple[int, int, int], end_before: int):
        self.files, self.texts = files, texts
        self.tokens = words + texts
        self.types = int(files.n_words.sum()) + (texts > 0)
        self.pair_types = int(pairs[0])
        self.d2, self.d1 = discounts(pairs[1:]), discounts(before[:4])
        self.begin, self.end_before = begin, end_before
        m = self.pair_types
        self.back = (self.d1[1] * before[0] + self.d1[2] * before[1] + self.d1[3] * before[4]) / m if m else 1.0

    def score(self, c: A.Chunk) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and model score of each row, and the number of rows."""
        wh, row0 = word_hashes(c)
        different, back = np.unique(wh, return_inverse=True)
        ids, stats = self.files.find(different, True)
        # distinct words first, then END and BEGIN, as rows of one table
        stats = np.r_[stats, [[self.texts, self.end_before, 0, 0, 0]], [[self.texts, 0, *self.begin]]]
        ids = np.append(ids, np.array([END, BEGIN], np.uint64))
        count = stats[:, 0]
        base = np.log10((count + 1) / (self.tokens + self.types + 1))
        m = stats[:, 1]
        q = self.back / (self.types + 1) + (np.maximum(m - self.d1[np.minimum(m, 3)], 0) / self.pair_types if self.pair_types else np.zeros(len(count)))
        g = np.divide(stats[:, 2:] @ self.d2[1:], count, out=np.ones(len(count)), where=count > 0)
        # places: index of context and token in the table
        n = len(different)
        u, w, place0 = sequence(back.astype(np.uint64) + np.uint64(FIRST), row0)
        u, w = (np.where(x >= FIRST, x.astype(np.int64) - FIRST, np.where(x == END, n, n + 1)) for x in (u, w))
        local = u * (n + 2) + w
        pair, inverse = np.unique(local, return_inverse=True)
        pu, pw = pair // (n + 2), pair % (n + 2)
        seen = np.flatnonzero((ids[pu] != UNSEEN) & (ids[pw] != UNSEEN))
        key = ids[pu[seen]] << np.uint64(32) | ids[pw[seen]]
        order = np.argsort(key)
        c2 = np.zeros(len(pair), np.int64)
        c2[seen[order]] = self.files.pair_counts(key[order])
        p = g[pu] * q[pw] + np.divide(np.maximum(c2 - self.d2[np.minimum(c2, 3)], 0), count[pu], out=np.zeros(len(pair)), where=count[pu] > 0)
        logs = np.log10(p)[inverse]
        rows = c.rows
        return np.diff(row0) + 1, np.add.reduceat((count[w] > 0).astype(np.int64), place0), np.add.reduceat(base[w], place0), np.add.reduceat(logs, place0), rows


def train(docs: DataFrame) -> Model:
    """Count the model over all rows that are not held out."""
    spark = docs.sparkSession
    rows = docs.filter(~held_out(F.col("doc_id"))).select("text")
    texts, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(8, -(-(size or 0) // PART_BYTES))
    base = f"{shared_dir(spark)}/lm-{uuid.uuid4().hex}"

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(parts, word_part)
        for b in batches:
            for c in A.chunks(b.column(0)):
                yield from tally.add(word_hashes(c)[0])
        yield from tally.flush()

    def write_words(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        keys, (counts,) = gathered(df, np.uint64, 1)
        keys, counts = summed(keys, counts.astype(np.int64))
        put(f"{base}/words-{key[0]}", [keys, counts])
        return pd.DataFrame({"part": [int(key[0])], "types": [len(keys)], "tokens": [int(counts.sum())]})

    got = stored(in_batches(rows, count_words, PACKED).groupBy("part").applyInPandas(write_words, "part int, types long, tokens long")).collect()
    types = [0] * parts
    for r in got:
        types[r.part] = r.types
    if sum(types) > 2**32 - 4:
        raise ValueError("too many different words for 32-bit ids")
    files = Files(base, types)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(parts, pair_part)
        for b in batches:
            for c in A.chunks(b.column(0)):
                wh, row0 = word_hashes(c)
                different, back = np.unique(wh, return_inverse=True)
                u, w, _ = sequence(files.find(different, False)[0][back], row0)
                yield from tally.add(u << np.uint64(32) | w)
        yield from tally.flush()

    def stat_part(ids: np.ndarray) -> np.ndarray:
        """The part of A that a word belongs to; -1 for BEGIN and END."""
        return np.where(ids < FIRST, -1, np.searchsorted(files.start, ids.astype(np.int64), "right") - 1)

    def write_pairs(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        keys, (counts,) = gathered(df, np.uint64, 1)
        keys, counts = summed(keys, counts.astype(np.int64))
        over = np.flatnonzero(counts >= 255)
        put(f"{base}/pairs-{key[0]}", [keys, np.minimum(counts, 255).astype(np.uint8), over.astype(np.int64), counts[over]])
        u, w = (keys >> np.uint64(32)).astype(np.uint32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        first = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
        follow = [np.add.reduceat((counts == 1).astype(np.uint32), first), np.add.reduceat((counts == 2).astype(np.uint32), first), np.add.reduceat((counts > 2).astype(np.uint32), first)]
        after, before = np.unique(w, return_counts=True)
        zero = np.zeros(len(after), np.uint32)
        out = [r for ids, vals in ((u[first], [np.zeros(len(first), np.uint32), *follow]), (after, [before.astype(np.uint32), zero, zero, zero])) for r in packed(ids, vals, stat_part(ids))]
        frame = pa.Table.from_batches(out).to_pandas()
        frame["tell"] = [[] for _ in range(len(frame))]
        tell = [len(keys), *(int((counts == k).sum()) for k in (1, 2, 3, 4)), int(key[0])]
        extra = pd.DataFrame({"part": [-2], "n": [0], "keys": [b""], "vals": [[]], "tell": [tell]})
        return pd.concat([frame, extra], ignore_index=True)[["part", "n", "keys", "vals", "tell"]]

    told = stored(in_batches(rows, count_pairs, PACKED).groupBy("part").applyInPandas(write_pairs, PACKED + ", tell array<long>"))

    def write_stats(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        ids, values = gathered(df, np.uint32, 4)
        start, n = (0, FIRST) if part < 0 else (int(files.start[part]), int(files.n_words[part]))
        sums = [np.bincount(ids.astype(np.int64) - start, v, n).astype(np.int64) for v in values]
        if part >= 0:
            put(f"{base}/stats-{part}", [s.astype(np.uint32) for s in sums])
        m = sums[0][sums[0] > 0]
        tell = [int((m == k).sum()) for k in (1, 2, 3, 4)] + [int((m > 2).sum())]
        marks = [int(sums[0][END]), *(int(s[BEGIN]) for s in sums[1:])] if part < 0 else []
        return pd.DataFrame({"part": [part], "tell": [tell], "marks": [marks]})

    stats = stored(told.filter("part >= -1").groupBy("part").applyInPandas(write_stats, "part int, tell array<long>, marks array<long>")).collect()
    pairs = np.zeros(5, np.int64)
    sums = told.filter("part = -2").select(*(F.sum(F.col("tell")[i]) for i in range(5))).first()
    pairs += np.array([x or 0 for x in sums], np.int64)
    before = sum((np.array(r.tell, np.int64) for r in stats), np.zeros(5, np.int64))
    marks = next((r.marks for r in stats if r.part < 0), [0, 0, 0, 0])
    files.pairs = parts
    files.empty = set(range(parts)) - {r[0] for r in told.filter("part = -2").select(F.col("tell")[5]).collect()}
    return Model(files, int(texts), int(sum(r.tokens for r in got)), pairs, before, tuple(marks[1:]), marks[0])


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Base and model scores of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(2)):
                n, known, base, logs, rows = model.score(c)
                cols = [*(b.column(i).slice(c.first, rows) for i in (0, 1)), pa.array(n.astype(np.int64)), pa.array(known), pa.array(np.full(rows, model.tokens, np.int64)), pa.array(base), pa.array(logs), pa.array(10.0 ** np.minimum(-logs / n, 300))]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in OUT.split(", ")])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"), run, OUT)
