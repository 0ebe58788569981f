"""Vector code compression: product codes of integer vectors, one codebook for each part of a vector.

Components become integers, floor(4096 * x), and a vector is cut into ``parts`` equal consecutive parts. A part's codebook starts as that
part of the vectors with the ``entries`` smallest ids. Each round broadcasts the codebooks, each as a kd-tree; every task assigns
its rows' parts to the nearest entries and adds them up in integers, and Spark adds the tasks' sums (parts x entries rows
a task; the driver sees parts x entries totals). An entry becomes the componentwise floor of its parts' mean; unused entries stay.

The search is branch and bound: a part first goes down to its own leaf, which gives a first distance; then the tree is swept once
and a node is left out only if the squared distance to its box is greater than the best so far. Nodes of equal bound are
visited, so of equally near entries the one with the lowest index is found. All distances are exact integers.

Edge cases: rows whose vector is null or holds a null or a non-finite component are dropped. An id that is null comes after all others;
repeated ids are ordered by their integer components, and repeated rows are rows like others. With fewer rows than entries a codebook
has as many entries as there are rows; an empty table gives an empty one. Vectors of several lengths, a length that ``parts`` doesn't divide,
more than 256 entries (two hex digits) and components of 2**27 or more after scaling (their squares' sums must fit a long) are errors.
Labels are compared as values, nulls together; NaN is one value. A label's rows never meet in one task. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import vectors as V
from .common import HOT_ROWS, bounded, in_batches, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LIMIT = (1 << 27) - 1
#: Entries of a leaf, and rows that are searched together.
LEAF, SLICE = 2, 1 << 14


class KdTree:
    """Entries of one codebook. A node is (low, high, entries, axis, cut, left, right); leaves have entries, others None there."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(entries)))

    def _grow(self, at: np.ndarray) -> int:
        box = self.entries[at]
        low, high = box.min(0), box.max(0)
        spread = high - low
        me = len(self.nodes)
        self.nodes.append(())
        if len(at) <= LEAF or not spread.any():
            self.nodes[me] = (low, high, at, 0, 0, -1, -1)
            return me
        axis = int(spread.argmax())
        values = np.sort(box[:, axis])
        cut = int(values[(len(at) - 1) // 2])
        if cut == values[-1]:  # the upper half is one value: cut below it, so that both sides have entries
            cut = int(values[values < cut][-1])
        left = self._grow(at[box[:, axis] <= cut])
        right = self._grow(at[box[:, axis] > cut])
        self.nodes[me] = (low, high, None, axis, cut, left, right)
        return me

    def _leaf(self, x: np.ndarray, rows: np.ndarray, entries: np.ndarray, best: np.ndarray, dist: np.ndarray) -> None:
        for e in entries.tolist():
            gap = x[rows] - self.entries[e]
            d = (gap * gap).sum(1)
            better = (d < dist[rows]) | ((d == dist[rows]) & (e < best[rows]))
            hit = rows[better]
            dist[hit], best[hit] = d[better], e

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry."""
        best, dist = np.full(len(x), len(self.entries), np.int64), np.full(len(x), np.iinfo(np.int64).max, np.int64)
        own: dict[int, np.ndarray] = {}
        stack = [(0, np.arange(len(x)))]
        while stack:  # each row to its own leaf
            node, rows = stack.pop()
            low, high, entries, axis, cut, left, right = self.nodes[node]
            if entries is not None:
                own[node] = rows
                self._leaf(x, rows, entries, best, dist)
                continue
            lower = x[rows, axis] <= cut
            stack += [(kid, kept) for kid, kept in ((left, rows[lower]), (right, rows[~lower])) if len(kept)]
        stack = [(0, np.arange(len(x)))]
        while stack:  # then all nodes that may hold an entry as near
            node, rows = stack.pop()
            low, high, entries, axis, cut, left, right = self.nodes[node]
            gap = np.maximum(low - x[rows], 0) + np.maximum(x[rows] - high, 0)
            rows = rows[(gap * gap).sum(1) <= dist[rows]]
            if not len(rows):
                continue
            if entries is not None:
                self._leaf(x, np.setdiff1d(rows, own[node], assume_unique=True) if node in own else rows, entries, best, dist)
            else:
                stack += [(left, rows), (right, rows)]
        return best, dist


def _assign(x: np.ndarray, trees: list[KdTree]) -> tuple[np.ndarray, np.ndarray]:
    """rows x parts indexes of nearest entries, and their squared distances."""
    cut = x.reshape(len(x), len(trees), -1)
    found = [[t.nearest(cut[i : i + SLICE, p]) for i in range(0, len(x), SLICE)] for p, t in enumerate(trees)]
    if not len(x):
        return np.zeros((0, len(trees)), np.int64), np.zeros((0, len(trees)), np.int64)
    return np.stack([np.concatenate([a for a, _ in f]) for f in found], 1), np.stack([np.concatenate([d for _, d in f]) for f in found], 1)


def _first(rows: DataFrame, entries: int, parts: int) -> np.ndarray:
    """parts x entries x length of a part: the vectors with the smallest ids."""
    scaled = F.transform("vec", lambda x: F.floor(x * SCALE).cast("long"))
    got = rows.select("id", scaled.alias("x")).orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r.x for r in got], np.int64)
    if np.abs(x).max(initial=0) > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT} after scaling by {SCALE}")
    return x.reshape(len(got), parts, -1).swapaxes(0, 1)


def train(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks, parts x entries x components of a part; None for a table without a vector."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    rows = V.usable(df, vec_col, id=F.col(id_col))
    size = V.length(rows)
    if not size:
        return None
    if size % parts:
        raise ValueError(f"{size} components can't be cut into {parts} equal parts")
    books, sc = _first(rows, entries, parts), df.sparkSession.sparkContext
    only = rows.select("vec")
    for _ in range(rounds):
        shipped = sc.broadcast([KdTree(b) for b in books])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = shipped.value
            p, e, w = len(trees), max(len(t.entries) for t in trees), trees[0].entries.shape[1] + 1
            total = np.zeros((p, e, w), np.int64)
            for b in batches:
                x = V.matrix(b.column(0), SCALE, LIMIT)
                if not len(x):
                    continue
                at, _ = _assign(x, trees)
                for k in range(p):
                    part = x[:, k * (w - 1) : (k + 1) * (w - 1)]
                    order = np.argsort(at[:, k], kind="stable")
                    used, starts, n = np.unique(at[order, k], return_index=True, return_counts=True)
                    total[k, used, :-1] += np.add.reduceat(part[order], starts, axis=0)
                    total[k, used, -1] += n
            k, e, i = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)) for a in (k, e, i)] + [pa.array(total[k, e, i])], names=["part", "entry", "at", "v"])

        sums = np.zeros((*books.shape[:2], books.shape[2] + 1), object)
        partials = in_batches(only, add, "part int, entry int, at int, v long").withColumn("v", F.col("v").cast("decimal(28,0)"))
        for r in V.summed(partials, "part", "entry", "at").collect():
            sums[r.part, r.entry, r["at"]] = int(r.v)
        n = sums[:, :, -1:]
        used = (n != 0)[:, :, 0]
        books = books.copy()
        books[used] = (sums[:, :, :-1][used] // n[used]).astype(np.int64)
    return books


def digest_of(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, books: np.ndarray, id_col: str = "vec_id", vec_col: str = "embedding", **others: Column) -> DataFrame:
    """id, `others`, code (two hex digits a part) and error (squared distance to the coded vector) of each row that counts."""
    rows = V.usable(df, vec_col, id=F.col(id_col), **others)
    shipped = df.sparkSession.sparkContext.broadcast([KdTree(b) for b in books])
    hexes = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, d = _assign(V.matrix(b.column(b.num_columns - 1), SCALE, LIMIT), shipped.value)
            code = np.ascontiguousarray(hexes[at]).view(f"<U{2 * at.shape[1]}")[:, 0] if len(at) else np.zeros(0, "<U1")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(code.tolist(), pa.string()), pa.array(d.sum(1))], names=[*b.schema.names[:-1], "code", "error"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "vec"]
    return in_batches(rows, run, ", ".join([*kept, "code string", "error long"]))


def decode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """`coded` with `approx`, the vector that its column `code` stands for, in integers."""
    flat = F.array(*(F.array(*(F.array(*map(F.lit, e)) for e in b)) for b in books.tolist()))
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return coded.withColumn("approx", F.flatten(F.array(*(flat[p][index(p)] for p in range(len(books))))))


def with_totals(rows: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """Stored `rows` with `total`, the sum of `value` over rows with an equal `key` (nulls together).

    Few keys: their totals are broadcast. Many: those with more rows than a task's even share, fewer than there are shuffle
    partitions, are broadcast, and only the rows of all others are shuffled."""
    sums = stored(rows.groupBy(F.col(key).alias("k")).agg(F.sum(value).alias(total), F.count("*").alias("rows_of_key")))
    join = lambda left, right, how="inner": left.join(right.drop("rows_of_key"), F.col(key).eqNullSafe(F.col("k")), how).drop("k")
    few = bounded(sums)
    if few is not sums:
        return join(rows, few)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(HOT_ROWS, rows.count() // parts)
    hot = F.broadcast(sums.filter(F.col("rows_of_key") > share))
    rest = rows.join(hot.select("k"), F.col(key).eqNullSafe(F.col("k")), "left_anti")
    return join(rows, hot).unionByName(join(rest, sums.filter(F.col("rows_of_key") <= share)))


DIGEST = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def digest(df: DataFrame, **choice) -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels), codebooks_sha256 of the final codebooks."""
    books = train(df, **choice)
    if books is None:
        return df.sparkSession.createDataFrame([], DIGEST)
    coded = stored(encode(df, books, label=F.col("label")))
    return with_totals(coded, "label", "error", "label_error").select(F.col("id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256"))
