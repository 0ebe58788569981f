"""Variable-capacity best-fit packing of documents into training sequences.

A document takes one place for each code point and one end mark. Documents longer than the largest permitted length
are cut into pieces; nothing is dropped. Pieces are dealt by hash into groups of about ``group_pieces`` (no key decides
the dealing, so copies or a hot source can't meet in one group), and each group is packed by itself:

* pieces in falling order go to the open bin with the least room that still fits;
* if none fits, a new bin is opened at the permitted length with the least cost for each place it may still fill.
  A bin's cost is ``fixed + c + c*c/quad`` (start-up, linear and attention work);
* when all pieces are placed, each bin is cut down to the smallest permitted length that holds its contents.

The lengths are chosen jointly: the plan is made with each permitted length as the largest one to open beyond need,
and the cheapest plan after cutting down is taken. Only ids and lengths are shuffled, never texts.

Edge cases: a null or empty text is one piece of length 1 (its end mark); repeated rows and null doc_ids are packed
as rows of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import ship
from .common import stored

LENGTHS = (2048, 4096, 8192, 16384)
OUT = "doc_id long, piece int, start long, length int, bin_id long, bin_length int, bin_offset int"


def cost(c: int, fixed: float = 512, quad: float = 16384) -> float:
    return fixed + c + c * c / quad


def best_fit(sizes: list[int], permitted: tuple[int, ...], largest: int) -> tuple[list[int], list[int], list[int]]:
    """Bins and offsets of pieces given in falling order, and the lengths of the bins, cut down to their contents."""
    left = sum(sizes)
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    bins, offsets, opened = [], [], []
    for s in sizes:
        i = bisect_left(room, (s, -1))
        if i < len(room):
            free, b = room.pop(i)
        else:
            fit = [c for c in permitted if c >= s]
            free = min([c for c in fit if c <= largest] or fit[:1], key=lambda c: cost(c) / min(c, left))
            b = len(used)
            used.append(0)
            opened.append(free)
        bins.append(b)
        offsets.append(used[b])
        used[b] += s
        left -= s
        if free > s:
            insort(room, (free - s, b))
    return bins, offsets, [next(c for c in permitted if c >= u) for u in used]


def plan(sizes: list[int], permitted: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the plans over the permitted lengths."""
    return min((best_fit(sizes, permitted, c) for c in permitted), key=lambda p: sum(map(cost, p[2])))


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): rows with a number of their own, so that repeated ones are told apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))


def pieces(rows: DataFrame, largest: int) -> DataFrame:
    """One row for each piece: where it starts (code points, the end mark last) and its length."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long") + 1
    rows = rows.select("doc_id", n.alias("n"), "row")
    count = F.floor((F.col("n") - 1) / largest).cast("int")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), count)).alias("piece"))
    start = F.col("piece").cast("long") * largest
    return rows.select("doc_id", "row", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(largest)).cast("int").alias("length"))


def pack(docs: DataFrame, permitted: tuple[int, ...] = LENGTHS, group_pieces: int = 4000) -> DataFrame:
    """Where each piece goes: bin, the bin's final length and the piece's offset in it."""
    permitted = tuple(sorted(permitted))
    return place(stored(pieces(numbered(docs), permitted[-1])), permitted, group_pieces).drop("row")


def sequences(docs: DataFrame, permitted: tuple[int, ...] = LENGTHS, group_pieces: int = 4000, end: str = "\x03") -> DataFrame:
    """(bin_id, bin_length, doc_ids, text): each bin's contents, every document followed by an end mark.

    Texts are shuffled once, to their bins; a bin holds `bin_length` code points at most, so no group is large."""
    permitted = tuple(sorted(permitted))
    rows = stored(numbered(docs))
    placed = stored(place(stored(pieces(rows, permitted[-1])), permitted, group_pieces))
    cut = rows.select("row", F.concat(F.coalesce("text", F.lit("")), F.lit(end)).alias("text")).join(placed, "row")
    cut = cut.select("bin_id", "bin_length", "bin_offset", "doc_id", F.substring("text", (F.col("start") + 1).cast("int"), F.col("length")).alias("part"))
    held = F.sort_array(F.collect_list(F.struct("bin_offset", "doc_id", "part")))
    bins = cut.groupBy("bin_id", "bin_length").agg(held.alias("held"))
    return bins.select("bin_id", "bin_length", F.transform("held", lambda x: x["doc_id"]).alias("doc_ids"), F.array_join(F.transform("held", lambda x: x["part"]), "").alias("text"))


def place(rows: DataFrame, permitted: tuple[int, ...], group_pieces: int) -> DataFrame:
    """Pieces with their bins, offsets and row numbers."""
    groups = max(1, -(-rows.count() // group_pieces))
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        # by length, then place in the input: the same plan whatever order the rows arrive in
        df = df.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets, lengths = plan(df["length"].tolist(), permitted)
        b = np.array(bins)
        df = df.assign(bin_id=(int(key[0]) << 32) + b, bin_length=np.array(lengths, np.int32)[b], bin_offset=np.array(offsets, np.int32))
        return df[[*(c.split()[0] for c in OUT.split(", ")), "row"]]

    ship(rows.sparkSession)
    return dealt.groupBy("grp").applyInPandas(run, f"{OUT}, row long")
