"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are runs of letters, digits and bytes beyond ASCII, ASCII letters lower-cased, or one code point of a script that
is written without blanks. The k-mers of a text are its
``K`` -word shingles, each labelled with how often it came before. A function of the sketch takes the ``L`` labelled
k-mers with the least hash values and keeps them in the order of the text, so the sketch agrees for texts that are
close in edit distance, not only in content. ``ROWS`` functions make a band. Two texts are near copies if their edit
distance over words is at most ``(1 - SIMILARITY)`` of the longer one.

1. One scan gives each text's content hash and bands. Texts with the same words form a class; from here on one node
   stands for a class, so exact copies make no pairs. A bucket is a band value that two or more nodes have.
2. In each bucket every node is compared with one pivot, the least node there: at most as many pairs as nodes, whatever
   the bucket's size. The links' components are taken.
   Bounds from lengths, word counts and common k-mers settle most pairs; the others are aligned.
3. Buckets that now lie in one component are done. In others of at most ``SMALL`` nodes, all pairs in different
   components are compared.
4. The nodes of larger buckets that still hold several components (many texts with one passage in common, for one)
   meet by an exact join (``crowded``): near copies share all but a fifth of their words, each counted as often as both have it, so
   of each text's rarest fifth and ``COMMON`` more (rare in the crowd) they share ``COMMON`` (fewer, where a text has no more). Texts of different
   components that do make a pair, if lengths and places leave enough words; only their ids and a count go through the exchange. Keys of many
   nodes are dealt out in squares of blocks. As a node may be in many such pairs, its words go once to each cell of pairs, not along with each pair.
5. Components of all links, by large and small stars, are the near-duplicate groups. The least doc_id stays.

So two near copies are missed only if no band agrees: no bucket is cut, whatever its size, and a test holds a crowded bucket against all of its
pairs. Steps 1 to 3 are linear in the nodes and their bands. Step 4 makes only pairs that share some of their rarest words; texts that are
alike in nearly four fifths of their words and yet no near copies are compared one by one, which no exact way avoids. Another test runs the
operator on pairs at several edit rates, also on texts that all share a passage, and asks for a recall of 0.9 or more.

Edge cases: texts with fewer than K words are near copies only of texts with the same words; texts without a word
(null, empty, blank, symbols) are never copies; an empty table gives an empty result; a very long text is one row of
its chunk and is sketched and aligned whole; ties of doc_id and text are copies, and keep_first() leaves one of
them; null doc_ids come last in the order; other columns, whatever their names, are not read, and keep_first()
returns them.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from ..session import spread
from . import arrays as A
from .alignment import distances
from .common import BROADCAST_ROWS, bounded, in_batches, own_columns, row_uid, spread_join, stored, unused
from .components import components

K, L, BANDS, ROWS, SIMILARITY = 3, 2, 32, 1, 0.8
#: Nodes of a bucket that are compared pair by pair; nodes of a key in the crowd that meet in one block, where it has no more.
SMALL, BLOCK = 6, 1000
#: Words that two texts of the crowd must share of their rarest, beyond those that edits may take.
COMMON = 5
#: Groups of nodes, at least, of which two make a cell of pairs; bytes of the words of one.
GROUPS, GROUP_BYTES = 8, 32 << 20
#: Bins of a text's word counts, which bound its edit distance from below.
BINS = 256
_FOLD = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in A.LOWER.tolist()], np.uint8)
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, 2 * BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_C = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(c: A.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and each row's first word (n+1)."""
    d = _FOLD[c.data]
    ws, we, row0 = c.segments(d != 32)
    return A.span_hash(A.prefix_hash(d), ws, we), row0


def content(wh: np.ndarray, row0: np.ndarray) -> np.ndarray:
    """A hash of each row's word sequence."""
    i = np.arange(len(wh), dtype=np.uint64) - np.repeat(row0[:-1], np.diff(row0)).astype(np.uint64)
    s = np.zeros(len(wh) + 1, np.uint64)
    np.cumsum(A.mix(wh + i * _C), out=s[1:], dtype=np.uint64)
    return A.mix((s[row0[1:]] - s[row0[:-1]]) + np.diff(row0).astype(np.uint64) * _C)


def labelled(wh: np.ndarray, row0: np.ndarray, k_mer: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k-mers of all rows, each hashed with the number of its earlier occurrences in its row; the rows that have
    any, and where each of these begins (and the end)."""
    n = np.diff(row0) - k_mer + 1
    rows = np.flatnonzero(n > 0)
    size = n[rows]
    first = np.append(0, np.cumsum(size))
    if not len(rows):
        return np.zeros(0, np.uint64), rows, first
    m = len(wh) - k_mer + 1
    code = wh[:m].copy()
    for k in range(1, k_mer):
        code = code * _C + wh[k : k + m]
    at = np.repeat(row0[rows] - first[:-1], size) + np.arange(first[-1])
    code = A.mix(code[at])
    key = code ^ (np.repeat(np.arange(len(rows)), size).astype(np.uint64) * _C)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    begin = np.flatnonzero(new)
    rank = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    seen = np.zeros(len(key), np.uint64)
    seen[order] = rank
    return A.mix(code + seen * np.uint64(0xC2B2AE3D27D4EB4F)), rows, first


def sketch(wh: np.ndarray, row0: np.ndarray) -> np.ndarray:
    """rows x BANDS band hashes; rows with fewer than K words get zeros."""
    out = np.zeros((len(row0) - 1, BANDS), np.uint64)
    label, rows, first = labelled(wh, row0)
    if not len(rows):
        return out
    size = np.diff(first)
    owner = np.repeat(np.arange(len(rows)), size)
    top = np.uint64(2**64 - 1)
    for f in range(BANDS * ROWS):
        value = (label ^ _SEEDS[2 * f]) * _SEEDS[2 * f + 1]
        value ^= value >> np.uint64(29)
        spots = np.empty((L, len(rows)), np.int64)
        for j in range(L):
            least = np.minimum.reduceat(value, first[:-1])
            hit = np.flatnonzero(value == np.repeat(least, size))
            # the first place for each row (equal values are one label, which occurs once, save hash ties)
            o, idx = np.unique(owner[hit], return_index=True)
            spots[j, o] = hit[idx]
            value[spots[j]] = top
        spots.sort(axis=0)
        code_f = label[spots[0]]
        for j in range(1, L):
            code_f = A.mix(code_f * _C + label[spots[j]])
        band = f // ROWS
        out[rows, band] = A.mix(out[rows, band] * _C + code_f + np.uint64(band + 1))
    return out


SKETCH = "doc_id long, uid long, node long, n_words long, bands array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """Content hash and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(2)):
                wh, row0 = word_hashes(c)
                n = np.diff(row0)
                bands = sketch(wh, row0).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(n >= K, BANDS, 0))).astype(np.int32)), pa.array(bands[n >= K].ravel()))
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(c.first, c.rows) for i in (0, 1)), pa.array(content(wh, row0).view(np.int64)), pa.array(n), lists], names=["doc_id", "uid", "node", "n_words", "bands"])

    doc_id = F.col("doc_id").cast("long")
    return in_batches(docs.select(doc_id.alias("doc_id"), row_uid(doc_id, F.col("text")).alias("uid"), "text"), run, SKETCH)


def sequences(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, words) for the given nodes, once each: 32-bit word hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for c in A.chunks(b.column(0)):
                wh, row0 = word_hashes(c)
                node = content(wh, row0).view(np.int64)
                short = wh.astype(np.uint32)
                keep = [i for i in range(c.rows) if row0[i + 1] - row0[i] >= K and not (node[i] in seen or seen.add(node[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(node[keep], pa.int64()), pa.array([short[row0[i] : row0[i + 1]].tobytes() for i in keep], pa.binary())], names=["node", "words"])

    rows = in_batches(docs.select("text"), run, "node long, words binary").join(bounded(nodes), "node", "left_semi")
    return stored(rows.groupBy("node").agg(F.first("words").alias("words")))


def _common_kmers(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How many k-mers two word sequences share, each as often as both have it; and an upper bound of their edit distance:
    k-mers that come once in both, in a chain that rises in both, are kept, and what lies between them is edited."""

    def counted(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = max(len(w) - K + 1, 0)
        code = w[:n].astype(np.uint64)
        for k in range(1, K):
            code = code * _C + w[k : k + n]
        return np.unique(code, return_index=True, return_counts=True)

    (x, at_x, nx), (y, at_y, ny) = counted(a), counted(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(nx[i], ny[j]).sum())
    once = (nx[i] == 1) & (ny[j] == 1)
    u, v = at_x[i[once]], at_y[j[once]]
    order = np.argsort(u)
    u, v = u[order], v[order]
    if (np.diff(v) <= 0).any():
        keep = _rising(v.tolist())
        u, v = u[keep], v[keep]
    if not len(u):
        return common, max(len(a), len(b))
    gap_a, gap_b = np.diff(u) - K, np.diff(v) - K
    # where k-mers overlap, the second one gives up what the first one has
    between = np.maximum(gap_a, gap_b) + np.maximum(0, np.maximum(-gap_a, -gap_b))
    return common, int(between.sum()) + max(u[0], v[0]) + max(len(a) - u[-1], len(b) - v[-1]) - K


def _rising(v: list[int]) -> np.ndarray:
    """Indices of a longest rising subsequence."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(v)
    for i, value in enumerate(v):
        k = bisect_left(ends, value)
        before[i] = at[k - 1] if k else -1
        if k == len(ends):
            ends.append(value)
            at.append(i)
        else:
            ends[k], at[k] = value, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1], int)


def _alike(a: list[np.ndarray], p: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which of the pairs of word sequences are near copies?"""
    limit = np.array([int((1 - similarity) * max(len(x), len(y)) + 1e-9) for x, y in zip(a, p, strict=True)], np.int64)
    # an edit changes the word counts by two at most, and spoils K k-mers at most
    ok = np.array([np.abs(np.bincount(x % BINS, minlength=BINS) - np.bincount(y % BINS, minlength=BINS)).sum() for x, y in zip(a, p, strict=True)]) <= 2 * limit
    sure = np.zeros(len(ok), bool)
    for i in np.flatnonzero(ok):
        common, most = _common_kmers(a[i], p[i])
        ok[i] = common >= max(len(a[i]), len(p[i])) - K + 1 - K * limit[i]
        sure[i] = most <= limit[i]
    # what neither bound settles is aligned
    open_ = np.flatnonzero(ok & ~sure)
    ok[open_] = distances([a[i] for i in open_], [p[i] for i in open_], limit[open_]) <= limit[open_]
    return ok


def verified(pairs: DataFrame, words: DataFrame, similarity: float, cells: bool = False) -> DataFrame:
    """pairs (node, pivot) with `linked`: is their edit similarity at least `similarity`? `cells` if nodes are in many pairs each."""
    if cells:
        return _verified_in_cells(pairs, words, similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ok = _alike(*([np.frombuffer(x.as_buffer(), np.uint32) for x in part.column(i)] for i in (2, 3)), similarity)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok)], names=["node", "pivot", "linked"])

    rows = pairs.count()
    both = spread_join(pairs, words, "node", F.xxhash64("pivot"), rows)
    both = spread_join(both, words.select(F.col("node").alias("pivot"), F.col("words").alias("pivot_words")), "pivot", F.xxhash64("node"), rows, pairs.groupBy("pivot").agg(F.count("*").alias("n")))
    return in_batches(both.select("node", "pivot", "words", "pivot_words"), run, "node long, pivot long, linked boolean")


def _verified_in_cells(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Nodes fall into groups of bounded size by hash, and two groups make a cell, which gets
    its pairs and, once, the words of each node in them."""

    def run(mine: pa.Table, held: pa.Table) -> pa.Table:
        place = {node: i for i, node in enumerate(held.column("node").to_pylist())}
        seq = [np.frombuffer(x.as_buffer(), np.uint32) for x in held.column("words")]
        node, pivot = (mine.column(c).to_pylist() for c in ("node", "pivot"))
        both = [i for i in range(len(node)) if node[i] in place and pivot[i] in place]
        linked = [_alike(*([seq[place[x[i]]] for i in both[at : at + 500]] for x in (node, pivot)), similarity) for at in range(0, len(both), 500)]
        rows = mine.select(["node", "pivot"]).take(pa.array(both, pa.int64()))
        return rows.append_column("linked", pa.array(np.concatenate([np.zeros(0, bool), *linked])))

    nodes = stored(pairs.select(F.explode(F.array("node", "pivot")).alias("node")).distinct())
    size = words.join(bounded(nodes), "node", "left_semi").agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = max(GROUPS, -(-size // GROUP_BYTES))
    a, b = (F.pmod(F.xxhash64(c), F.lit(n)) for c in ("node", "pivot"))
    dealt = pairs.select("node", "pivot", (F.least(a, b) * n + F.greatest(a, b)).alias("cell"))
    cells = stored(dealt.select(F.explode(F.array("node", "pivot")).alias("node"), "cell").groupBy("node").agg(F.collect_set("cell").alias("cells")))
    held = words.join(bounded(cells), "node").select("node", "words", F.explode("cells").alias("cell"))
    return dealt.groupBy("cell").cogroup(held.groupBy("cell")).applyInArrow(run, "node long, pivot long, linked boolean")


def links(docs: DataFrame, rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): pairs of nodes of one group, enough of them to connect every group."""
    nodes = rows.groupBy("node").agg(F.first("bands").alias("bands"))
    buckets = _buckets(nodes.select("node", F.explode("bands").alias("key")))
    words = sequences(docs, stored(buckets.select("node").distinct()))
    sizes = stored(words.select("node", (F.octet_length("words") / 4).cast("int").alias("n")))
    lengths = bounded(sizes)

    few = lengths is not sizes

    def test(pairs: DataFrame, more: DataFrame | None = None) -> DataFrame:
        """Pairs that lengths don't rule out and `more`, aligned."""
        other = lengths.select(F.col("node").alias("pivot"), F.col("n").alias("m"))
        if few:
            both = pairs.join(lengths, "node").join(other, "pivot")
        else:  # a bucket's pivot is in as many pairs as the bucket has nodes
            pairs = stored(pairs)
            n = pairs.count()
            both = spread_join(spread_join(pairs, lengths, "node", F.xxhash64("pivot"), n), other, "pivot", F.xxhash64("node"), n)
        near = both.filter(F.abs(F.col("n") - F.col("m")) <= F.floor((1 - similarity) * F.greatest("n", "m") + 1e-9))
        near = near.select("node", "pivot")
        return stored(verified(stored(near if more is None else near.unionByName(more)), words, similarity, more is not None))

    tested = test(buckets.filter("node <> pivot").select("node", "pivot").distinct())
    roots = stored(components(_linked(tested)))
    more, crowd = _apart(buckets, roots)
    # the greater node of a pair comes first, so that a pair is tested once
    pairs = more.select(F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot")).distinct()
    done = buckets.filter("node <> pivot").select(F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot")).distinct()
    apart = crowded(stored(crowd), words, similarity).join(done.unionByName(pairs), ["node", "pivot"], "left_anti")
    late = _linked(test(pairs.join(done, ["node", "pivot"], "left_anti"), apart))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late)


def _linked(tested: DataFrame) -> DataFrame:
    return tested.filter("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))


def _buckets(entries: DataFrame) -> DataFrame:
    """The entries (node, key) of the keys that n > 1 nodes have, with n and the pivot, the least node."""
    size = stored(entries.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1"))
    rows = size.agg(F.sum("n")).first()[0] or 0
    return stored(spread_join(entries, size, "key", F.xxhash64("node"), rows, size))


def _pairs(buckets: DataFrame) -> DataFrame:
    """All pairs of nodes with different roots in buckets of 3 to SMALL nodes (a bucket of two is settled by its pivot)."""
    left = buckets.filter(f"n between 3 and {SMALL}").select("key", "node", "root")
    right = left.select("key", F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    return left.join(right, "key").filter("node > pivot and root <> pivot_root").select("node", "pivot")


def _apart(buckets: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes in different components in small buckets; (node, root) of the nodes of larger buckets with several."""
    buckets = stored(buckets.join(roots, "node", "left").select("key", "n", "node", F.coalesce("root", "node").alias("root")))
    large = buckets.filter(f"n > {SMALL}")
    mixed = stored(large.groupBy("key").agg(F.first("n").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key", "n"))
    rows = mixed.agg(F.sum("n")).first()[0] or 0
    crowd = spread_join(large.drop("n"), mixed, "key", F.xxhash64("node"), rows, mixed).select("node", "root").distinct()
    return _pairs(buckets), crowd


def crowded(crowd: DataFrame, words: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, pivot), node > pivot: the pairs of nodes in different components (node, root) that may be near copies; none that is gets lost."""
    held = stored(words.join(bounded(crowd), "node").select("node", "root", "words"))
    counts = in_batches(held.select("words"), _word_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = stored(counts)
    # any order will do; if there are too many words to send, those that few nodes have count as rare
    least, more = 1, counts.count()
    while more > BROADCAST_ROWS:
        least *= 2
        more = counts.filter(F.col("n") > least).count()
    busy = counts.filter(F.col("n") > least).toArrow()
    order = np.argsort(busy.column("key").to_numpy().view(np.uint64))
    known = tuple(busy.column(c).to_numpy()[order].view(np.uint64) for c in ("key", "n"))
    shipped = crowd.sparkSession.sparkContext.broadcast(known)
    # a text gives as many entries as it may have edits, and COMMON more; dealt over all cores, each task makes its share of them.
    # where all words of two nodes or more are known, the others make no pair
    entries = in_batches(spread(held, "node"), lambda batches: _rarest(batches, *shipped.value, similarity, least == 1), "node long, root long, m int, need int, keys array<long>, places array<int>")
    entries = entries.select("node", "root", "m", "need", F.explode(F.arrays_zip("keys", "places")).alias("e")).select("node", "root", "m", "need", F.col("e.places").alias("place"), F.col("e.keys").alias("key"))
    entries = stored(entries)
    shared = stored(entries.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key", "n"))
    rows = shared.agg(F.sum("n")).first()[0] or 0
    each = spread_join(entries, shared, "key", F.xxhash64("node"), rows, shared).withColumn("side", F.ceil(F.sqrt(F.col("n") / BLOCK)).cast("int")).drop("n")
    each = stored(each)
    left, right = _in_square(each)
    right = right.select("key", "block", *(F.col(c).alias(f"r_{c}") for c in ("node", "root", "m", "need", "place")))
    longer = F.greatest("m", "r_m")
    least_common = longer - F.floor((1 - similarity) * longer + 1e-9)
    apart = (F.col("node") > F.col("r_node")) & (F.col("root") != F.col("r_root")) & (F.least("m", "r_m") >= least_common)
    # the words that both may have from this one on, and before it
    after = F.least(F.col("m") - F.col("place"), F.col("r_m") - F.col("r_place"))
    enough = after + F.least("place", "r_place") >= least_common
    on = (left["key"] == right["key"]) & (left["block"] == right["block"]) & apart & enough
    # shares of what a pair must have in common, in whole numbers; before the first common word there is none
    whole = math.lcm(*range(1, COMMON + 1))
    found = left.join(right, on).select("node", F.col("r_node").alias("pivot"), (whole / F.least("need", "r_need")).cast("int").alias("part"), (after >= least_common).alias("first"))
    return found.groupBy("node", "pivot").agg(F.sum("part").alias("part"), F.max("first").alias("first")).filter((F.col("part") >= whole) & F.col("first")).select("node", "pivot")


def _in_square(each: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries as the rows and as the columns of each key's square of `side` x `side` blocks: every two meet in one block. A block holds as
    many pairs as a run of BLOCK entries has with all n, and an entry is copied some sqrt(n / BLOCK) times on each side; most keys have one block."""
    side, at = F.col("side"), F.pmod(F.xxhash64("node"), F.col("side"))
    one, more = each.filter("side = 1").withColumn("block", F.lit(0).cast("long")), each.filter("side > 1")
    dealt = lambda block: one.unionByName(more.withColumn("other", F.explode(F.sequence(F.lit(0), side - 1))).withColumn("block", block.cast("long")).drop("other"))
    return dealt(at * side + F.col("other")), dealt(F.col("other") * side + at)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many nodes have each labelled word, by batch."""
    for words, _ in _in_parts(batches, 0):
        label, _, _ = labelled(*words, 1)
        key, n = np.unique(label, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


def _rarest(batches: Iterator[pa.RecordBatch], key: np.ndarray, n: np.ndarray, similarity: float, known: bool = False) -> Iterator[pa.RecordBatch]:
    """Each node's rarest labelled words in order, `need` (up to COMMON) more than the edits it may have, and their places; words that aren't in
    `key` (sorted, with counts n) come first, and are left out if `known`."""
    for words, part in _in_parts(batches, 2):
        label, rows, first = labelled(*words, 1)
        often = np.zeros(len(label), np.uint64)
        if len(key):
            at = np.minimum(np.searchsorted(key, label), len(key) - 1)
            often = np.where(key[at] == label, n[at], 0).astype(np.uint64)
        size = np.diff(first)
        order = np.lexsort((label, often, np.repeat(np.arange(len(rows)), size)))
        edits = ((1 - similarity) * size + 1e-9).astype(np.int64)
        need = np.clip(size - edits, 1, COMMON)
        place = np.arange(len(label)) - np.repeat(first[:-1], size)
        keep = place < np.repeat(edits + need, size)
        if known:
            keep &= often[order] > 0
        offsets = pa.array(np.append(0, np.cumsum(keep))[first].astype(np.int32))
        lists = (pa.ListArray.from_arrays(offsets, pa.array(x[keep])) for x in (label[order].view(np.int64), place.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*(part.column(i).take(pa.array(rows)) for i in (0, 1)), pa.array(size.astype(np.int32)), pa.array(need.astype(np.int32)), *lists], names=["node", "root", "m", "need", "keys", "places"])


def _in_parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], pa.RecordBatch]]:
    """The words of 500 rows at a time with where each row's begin, and the rows."""
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            words = [np.frombuffer(x.as_buffer(), np.uint32) for x in part.column(column)]
            yield (np.concatenate(words).astype(np.uint64), np.append(0, np.cumsum([len(w) for w in words]))), part


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The sketch rows, and for each node in a group of two or more rows: the first row's (null, doc_id, uid), the size."""
    rows = stored(sketches(docs))
    worded = rows.filter("n_words > 0")
    roots = stored(components(links(docs, worded, similarity)))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    nodes = stored(worded.groupBy("node").agg(F.min(order).alias("first"), F.count("*").alias("n")))
    joined = stored(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    total = joined.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count("*").alias("nodes")).filter("n > 1")
    total = stored(total)
    members = spread_join(joined.select("node", "root"), total.select("root", "first", "n"), "root", F.xxhash64("node"), joined.count(), total.select("root", F.col("nodes").alias("n")))
    return rows, stored(members.select("node", "first", "n"))


def _with_group(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of a group with its `first` and `n`; a node with many rows (exact copies) is spread."""
    worded = rows.filter("n_words > 0").drop("bands")
    return spread_join(worded, found, "node", F.xxhash64("doc_id", "uid"), rows.count())


def digest(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (least doc_id of the group), class_size, is_first, n_words for every row."""
    rows, found = groups(docs, similarity)
    grouped = _with_group(rows, found)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid").eqNullSafe(F.col("first"))
    out = grouped.select("doc_id", F.col("first.doc_id").alias("class_id"), F.col("n").alias("class_size"), first.alias("is_first"), "n_words")
    single = rows.filter("n_words > 0").join(found.select("node"), "node", "left_anti").unionByName(rows.filter("n_words = 0"))
    return out.unionByName(single.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("is_first"), "n_words"))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group; all columns stay."""
    rows, found = groups(docs, similarity)
    uid, lost = unused(docs, "group_uid"), unused(docs, "lost_id")
    doc_id = F.col("doc_id").cast("long")
    losers = _with_group(rows, found).filter(F.col("uid") != F.col("first.uid")).select(F.col("uid").alias(f"{uid}_lost"), F.col("doc_id").alias(lost)).distinct()
    marked = docs.withColumn(uid, row_uid(doc_id, F.col("text")))
    kept = marked.join(bounded(stored(losers)), (F.col(uid) == F.col(f"{uid}_lost")) & doc_id.eqNullSafe(F.col(lost)), "left_anti")
    # rows that are equal in doc_id and text: one of them stays
    again = stored(rows.filter("n_words > 0").groupBy(F.col("uid").alias(uid)).count().filter("count > 1").select(uid))
    if not again.isEmpty():
        again = bounded(again)
        kept = kept.join(again, uid, "left_anti").unionByName(kept.join(again, uid, "left_semi").dropDuplicates([uid, "doc_id"]))
    return kept.select(*own_columns(docs))
