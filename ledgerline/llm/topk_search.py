"""Exact top-k by integer inner product: a dual-tree search with cover trees.

Components become integers, floor(1024 * x). One scan turns the table into an index without any exchange: every task cuts its own rows
into blocks of at most ``BLOCK`` rows and builds a cover tree of each block; an index row holds one block in tree order with its
nodes. Queries get a tree of the same kind, in chunks of bounded bytes, so that one chunk is a bounded broadcast and the index is
read once a chunk.

A search walks pairs (query node, data node), best bound first. No query q of a node (centre a, radius r) can score more with a row of
another node (centre b, radius s) than a.b + |a| s + |b| r + r s; a pair is left out if that is less than the worst k-th score of the node's
queries, so equal scores survive and the smaller id wins. Leaf pairs are one matrix product. Blocks are searched in rounds of growing
size (16, then 256, 4096 ... blocks, by a hash of their number). After each round every query's k-th score bounds the next one,
so a round adds some 16 * k rows a query to the merge, whatever the size of the table, and no row is left out.

A node of the cover tree has children whose centres are further apart than their covering radius: farthest rows are made centres until all
rows lie within 1 / 1.3 of the node's radius, or the node has ``FAN`` children and the radius is what these reach. A node of at most ``LEAF``
rows, one without a radius, or one whose children wouldn't shrink it by a tenth is a leaf.

Edge cases: vectors that are null or hold a null or a non-finite component take no part, neither do rows without an id. Ids stand for rows: a
query's own rows are all those with its id, and rows with equal id and equal score count once in a query's result. An id with several
different vectors is a query for each of them (their results have the same query_id). Fewer rows than k: all are returned. An
empty table or no query gives an empty result. Ties go to the smaller id. Vectors of several lengths are errors, and so are components
whose products could exceed 2**63; up to 2**53 products are taken in doubles, which is exact, beyond in longs. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import vectors as V
from .common import in_batches, stored

SCALE, K, EVERY = 1024, 10, 100
BLOCK, LEAF, FAN, BASE = 1 << 13, 64, 64, 1.3
#: Bytes of query vectors in one broadcast.
CHUNK_BYTES = 32 << 20
#: Blocks of the first round, and how much larger each next round is.
ROUND = 16
LIMIT = 1 << 40
NONE = np.iinfo(np.int64).min


class CoverTree:
    """Rows in tree order (`order`, positions of the given matrix) and nodes: centre row, radius, first row, end row, first child, end child."""

    def __init__(self, x: np.ndarray, order: np.ndarray | None = None, nodes: np.ndarray | None = None):
        if nodes is None:
            order, nodes = self._build(x.astype(float))
        self.order, self.nodes, self.x = order, nodes, x[order]
        self.centres = x[nodes[:, 0].astype(np.int64)].astype(float)
        self.norms = np.sqrt((self.centres**2).sum(1))
        self.radius = nodes[:, 1]
        self.span = nodes[:, 2:].astype(np.int64)

    @staticmethod
    def _build(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = lambda rows, c: np.sqrt(((f[rows] - f[c]) ** 2).sum(1))
        order = np.arange(len(f))
        first = away(order, 0)
        nodes = [[0, first.max(initial=0), 0, len(f), 0, 0]]
        todo = [(0, first)]
        while todo:
            me, near = todo.pop(0)
            centre, radius, lo, hi, _, _ = nodes[me]
            if hi - lo <= LEAF or radius == 0:
                continue
            rows = order[lo:hi]
            near, child, centres = near.copy(), np.zeros(hi - lo, np.int64), [centre]
            while near.max() > radius / BASE and len(centres) < FAN:
                centres.append(int(rows[near.argmax()]))
                d = away(rows, centres[-1])
                closer = d < near
                near[closer], child[closer] = d[closer], len(centres) - 1
            if near.max() > 0.9 * radius:
                continue
            sort = np.argsort(child, kind="stable")
            order[lo:hi], near, child = rows[sort], near[sort], child[sort]
            ends = np.searchsorted(child, np.arange(len(centres) + 1))
            nodes[me][4:] = len(nodes), len(nodes) + len(centres)
            for c, a, b in zip(centres, ends, ends[1:]):
                todo.append((len(nodes), near[a:b]))
                nodes.append([c, near[a:b].max(), lo + a, lo + b, 0, 0])
        return order, np.array(nodes, float)


class Best:
    """The k best (score, id) of each query, in the tree order of the queries."""

    def __init__(self, ids: np.ndarray, kth: np.ndarray, k: int):
        self.ids, self.k, self.kth = ids, k, kth.copy()
        self.q = self.score = self.id = np.zeros(0, np.int64)
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, lo: int, scores: np.ndarray, ids: np.ndarray, unique: bool) -> None:
        """Scores of queries lo.. with rows `ids`."""
        own = self.ids[lo : lo + len(scores), None] == ids
        scores = np.where(own, NONE, scores)
        least = self.kth[lo : lo + len(scores)]
        if unique and len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        q, r = np.nonzero((scores >= least[:, None]) & ~own)
        self.fresh.append((q + lo, scores[q, r], ids[r]))
        self.pending += len(q)
        if self.pending > 4 * self.k * max(len(self.ids), 64):
            self.settle()
        elif unique and len(ids) > self.k:
            # a k-th score in one leaf is a bound for the query already; one's own row is no candidate
            self.kth[lo : lo + len(scores)] = least

    def settle(self) -> None:
        q, score, i = (np.concatenate([a, *(f[n] for f in self.fresh)]) for n, a in enumerate((self.q, self.score, self.id)))
        self.fresh, self.pending = [], 0
        sort = np.lexsort((i, -score, q))
        q, score, i = q[sort], score[sort], i[sort]
        if len(q):
            new = np.r_[True, (q[1:] != q[:-1]) | (score[1:] != score[:-1]) | (i[1:] != i[:-1])]
            q, score, i = q[new], score[new], i[new]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            last = rank == self.k - 1
            self.kth[q[last]] = np.maximum(self.kth[q[last]], score[last])
            kept = rank < self.k
            q, score, i = q[kept], score[kept], i[kept]
        self.q, self.score, self.id = q, score, i


def search(queries: CoverTree, best: Best, data: CoverTree, ids: np.ndarray) -> int:
    """Adds the block `data` (ids in tree order) to `best`. The number of products of vectors that it took."""
    unique = len(np.unique(ids)) == len(ids)
    most = int(np.abs(queries.x).max(initial=0)) * int(np.abs(data.x).max(initial=0)) * max(queries.x.shape[1], 1)
    if most >= 1 << 62:
        raise ValueError("inner products exceed a long")
    kind = np.float64 if most < 1 << 53 else np.int64
    left, right = queries.x.astype(kind, copy=False), data.x.astype(kind, copy=False)

    def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        r, s = queries.radius[a], data.radius[b]
        top = (queries.centres[a] * data.centres[b]).sum(1) + queries.norms[a] * s + data.norms[b] * r + r * s
        return top + 1 + np.abs(top) * 1e-9  # rounding must not lose a row

    done, zero = 0, np.zeros(1, np.int64)
    stack = [(float(bound(zero, zero)[0]), 0, 0)]
    while stack:
        top, a, b = stack.pop()
        lo, hi, kid, end = queries.span[a]
        if hi == lo or top < best.kth[lo:hi].min():
            continue
        first, last, kid_b, end_b = data.span[b]
        if kid == end and kid_b == end_b:
            scores = (left[lo:hi] @ right[first:last].T).astype(np.int64)
            done += scores.size
            best.add(lo, scores, ids[first:last], unique)
            continue
        grow_a = kid < end and (kid_b == end_b or queries.radius[a] >= data.radius[b])
        one, two = (np.arange(kid, end), np.full(end - kid, b)) if grow_a else (np.full(end_b - kid_b, a), np.arange(kid_b, end_b))
        tops = bound(one, two)
        stack += [(float(tops[i]), int(one[i]), int(two[i])) for i in np.argsort(tops, kind="stable")]
    best.settle()
    return done


BLOCKS = "block long, ids binary, x binary, order binary, nodes binary"


def index(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of rows (columns id, vec) with their cover trees. `block` is a hash of the block's content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids, x = np.concatenate([i for i, _ in held]), np.concatenate([x for _, x in held])
            held.clear()
            tree = CoverTree(x)
            number = int(np.bitwise_xor.reduce((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(len(ids))) >> np.uint64(1))
            values = [ids[tree.order].astype(np.int64), x, tree.order.astype(np.int64), tree.nodes]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names=["block", "ids", "x", "order", "nodes"])

        for b in batches:
            ids, x = b.column(0).to_numpy(zero_copy_only=False), V.matrix(b.column(1), SCALE, LIMIT)
            small = np.abs(x).max(initial=0) < 1 << 31
            x = x.reshape(len(ids), size)
            at = 0
            while at < len(ids):
                room = BLOCK - sum(len(i) for i, _ in held)
                held.append((ids[at : at + room], x[at : at + room].astype(np.int64 if not small else np.int32)))
                at += room
                if sum(len(i) for i, _ in held) >= BLOCK:
                    yield flush()
        if held:
            yield flush()

    return in_batches(rows, run, BLOCKS)


def _load(row: dict, size: int) -> tuple[CoverTree, np.ndarray]:
    ids, order = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["order"], np.int64)
    wide = len(row["x"]) == 8 * len(ids) * size and size > 0
    x = np.frombuffer(row["x"], np.int64 if wide else np.int32).reshape(len(ids), size)
    return CoverTree(x, order, np.frombuffer(row["nodes"], float).reshape(-1, 6)), ids


TOP = "q long, score long, id long"


def _chunk(blocks: DataFrame, queries: CoverTree, ids: np.ndarray, k: int, size: int, n_blocks: int) -> DataFrame:
    """q (place in the query tree), score, id: the k best of every query of one chunk."""
    spark = blocks.sparkSession
    sc = spark.sparkContext
    window = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    kth, found, lo, hi = np.full(len(ids), NONE), None, 0, ROUND
    tree = sc.broadcast((queries, ids))
    while found is None or lo < n_blocks:
        bounds = sc.broadcast(kth)

        def run(batches: Iterator[pa.RecordBatch], bounds=bounds) -> Iterator[pa.RecordBatch]:
            qt, own = tree.value
            best = Best(own, bounds.value, k)
            for b in batches:
                for row in b.to_pylist():
                    search(qt, best, *_load(row, size))
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (best.q, best.score, best.id)], names=["q", "score", "id"])

        part = blocks.filter((F.col("turn") >= lo) & (F.col("turn") < hi)).drop("turn", "block")
        got = in_batches(part, run, TOP)
        got = (got if found is None else found.unionByName(got)).repartition("q").distinct()
        found = stored(got.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k).drop("rank"))
        lo, hi = hi, hi * ROUND
        if lo < n_blocks:
            kth = kth.copy()
            for r in found.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("s")).filter(F.col("n") == k).toLocalIterator():
                kth[r.q] = r.s
    return found


RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `is_query` holds, the k other rows of the highest inner product."""
    spark = df.sparkSession
    rows = V.usable(df, vec_col, id=F.col(id_col).cast("long"), asked=F.coalesce(is_query, F.lit(False))).filter("id is not null")
    size = V.length(rows)
    blocks = stored(index(rows.select("id", "vec"), size))
    n_blocks = blocks.count()
    # the turn of a block: where its hash falls in 0 .. n_blocks - 1
    turn = F.least(F.floor(F.lit(float(n_blocks)) * (F.col("block") / F.lit(float(1 << 63)))), F.lit(max(n_blocks - 1, 0)))
    placed = blocks.withColumn("turn", turn)
    per_chunk = max(1, CHUNK_BYTES // (8 * max(size, 1)))
    asked = stored(rows.filter("asked").select("id", "vec").distinct())
    total = asked.count()
    if not total or not n_blocks:
        return spark.createDataFrame([], RESULT)
    chunks = -(-total // per_chunk)
    lot = F.pmod(F.xxhash64("id", "vec"), F.lit(chunks))
    out = None
    for c in range(chunks):
        mine = (asked if chunks == 1 else asked.filter(lot == c)).toArrow().combine_chunks()
        if not mine.num_rows:
            continue
        ids, x = mine.column("id").to_numpy(), np.concatenate([V.matrix(v, SCALE, LIMIT) for v in mine.column("vec").chunks]).reshape(mine.num_rows, size)
        sort = np.lexsort((*x.T[::-1], ids))
        ids, x = ids[sort], x[sort]
        tree = CoverTree(x)
        ids = ids[tree.order]
        found = _chunk(placed, tree, ids, k, size, n_blocks)
        names = spark.createDataFrame(list(enumerate(ids.tolist())), "q long, query_id long")
        ranked = found.join(F.broadcast(names), "q").withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id")))
        part = ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
        out = part if out is None else out.unionByName(part)
    return out


def digest(df: DataFrame) -> DataFrame:
    """The 10 best others of every row whose vec_id is divisible by 100."""
    return top_k(df, F.col("vec_id") % EVERY == 0)
