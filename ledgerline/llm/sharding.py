"""Sharding by histogram sort, with DataFrame operations only.

Law ``bytes``: rows are put in the order of a 64-bit key, and shard borders are the keys at which the exact running
total of sizes comes within ``tolerance`` of k/shards of all bytes. The upper half of the key is a hash of the text,
so equal texts stand together; the lower half is a hash of doc_id, so that a border can pass through a large group
of copies. Rows equal in both (repeated rows) are told apart by a third number.

1. One scan of the texts gives (doc_id, size, crc, key, tie), stored in the shared folder.
2. Histogram rounds: exact bytes below evenly spaced probe keys; only the brackets that hold a border are probed
   again, ``2**STEP`` times finer, until each border is within tolerance or its bracket is one key. Then the same
   over ``tie`` inside that key. The driver sees at most (borders x probes) sums a round.
3. One exchange, by (shard, part). Each shard is cut into parts by borders found in the same rounds, so no task sorts
   a whole shard; a row's slot is its rank in its part plus the exact sizes of the parts before.

Sizes are UTF-8 bytes plus 16 (null text: 16). Edge cases: null or repeated doc_ids and repeated rows are rows like
any other; an empty table gives no rows; one text larger than a shard stays whole; further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

STEP = 8
FIRST = 12
LOW = -(1 << 63)
#: Borders that a row is compared with at once.
BLOCK = 64


def keyed(docs: DataFrame) -> DataFrame:
    """Sizes and keys; `key` and `tie` are spread over all 64-bit values."""
    text = F.col("text")
    high = F.xxhash64(text).bitwiseAND(F.lit(-(1 << 32)))
    low = F.xxhash64(F.col("doc_id")).bitwiseAND(F.lit((1 << 32) - 1))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        high.bitwiseOR(low).alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )


def refine(rows: DataFrame, col: str, targets: list[tuple[int, int]], tolerance: float) -> list[tuple[int, int, int]]:
    """For each target (group, bytes): (value, bytes below it, bytes at it), the border lying at or inside `value`.

    `rows` has columns grp, size and `col`; each group is its own number line. Brackets are aligned ranges of
    values; a round counts exact bytes of all ranges of the next finer width inside the open brackets."""
    open_ = {(g, t): (LOW, 64, 0) for g, t in targets}  # target -> start of bracket, its width in bits, bytes below
    done: dict[tuple[int, int], tuple[int, int, int]] = {}
    width = 64
    while open_:
        step = min(FIRST if width == 64 else STEP, width)
        fine = width - step
        brackets = sorted({(g, lo) for (g, _), (lo, _, _) in open_.items()})
        inside = rows
        if width < 64:
            values = F.array(*(F.struct(F.lit(g).alias("g"), F.lit(lo).alias("lo")) for g, lo in brackets)) if len(brackets) <= 8 else None
            at = F.col(col).bitwiseAND(F.lit(-(1 << width)))
            if values is not None:
                inside = rows.filter(F.exists(values, lambda s: (s["g"] == F.col("grp")) & (s["lo"] == at)))
            else:  # at most one bracket a border, so the number of literals is bounded by the number of borders
                inside = rows.filter(F.concat_ws(":", "grp", at).isin([f"{g}:{lo}" for g, lo in brackets]))
        probe = F.col(col).bitwiseAND(F.lit(-(1 << fine))) if fine else F.col(col)
        hist: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in inside.groupBy("grp", probe.alias("lo")).agg(F.sum("size").alias("b")).collect():
            own = -(1 << width) & r.lo if width < 64 else LOW
            hist.setdefault((r.grp, own), []).append((r.lo, r.b))
        for h in hist.values():
            h.sort()
        runs = {k: [0] for k in hist}
        for k, h in hist.items():
            for _, b in h:
                runs[k].append(runs[k][-1] + b)
        for (g, t), (lo, _, below) in list(open_.items()):
            h, run = hist[g, lo], runs[g, lo]
            i = min(max(bisect_right(run, t - below) - 1, 0), len(h) - 1)
            start, here, under = h[i][0], h[i][1], below + run[i]
            if t - under <= tolerance:  # the border may stand right before this range
                done[g, t] = (start, under, 0)
            elif under + here - t <= tolerance and i + 1 < len(h):
                done[g, t] = (h[i + 1][0], under + here, 0)
            elif not fine:
                done[g, t] = (start, under, here)
            else:
                open_[g, t] = (start, fine, under)
                continue
            del open_[g, t]
        width = fine
    return [done[x] for x in targets]


def shard_by_bytes(docs: DataFrame, shards: int = 40, tolerance: float = 0.002, part_rows: int = 250_000, max_parts: int = 4000) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row. `tolerance` is a share of a shard's bytes."""
    rows = stored(keyed(docs))
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    parts = max(1, min(-(-n // (part_rows * shards)), max_parts // shards))
    slack = tolerance * total / shards / 2
    targets = [(0, round(total * k / (shards * parts))) for k in range(1, shards * parts)] if n else []
    cuts = refine(rows.select(F.lit(0).alias("grp"), "key", "size"), "key", list(dict.fromkeys(targets)), slack) if n else []
    by_target = dict(zip(dict.fromkeys(targets), cuts, strict=True))
    # borders that fall inside one key: the same search over `tie` within that key
    inner = [(i, by_target[t]) for i, t in enumerate(targets) if by_target[t][2] > 0]
    ties: dict[int, int] = {}
    if inner:
        names = {key: j for j, key in enumerate(sorted({c[0] for _, c in inner}))}
        at = F.array_position(F.array(*map(F.lit, names)), F.col("key")).cast("int") - 1
        own = rows.filter(F.col("key").isin(list(names))).select(at.alias("grp"), "tie", "size")
        want = [(names[c[0]], targets[i][1] - c[1]) for i, c in inner]
        found = dict(zip(dict.fromkeys(want), refine(own, "tie", list(dict.fromkeys(want)), slack), strict=True))
        ties = {i: found[w][0] for (i, _), w in zip(inner, want, strict=True)}
    borders = sorted((by_target[t][0], ties.get(i, LOW)) for i, t in enumerate(targets))
    if borders:
        # a row lies behind as many borders as are at or below it
        own = F.struct(F.col("key").alias("key"), F.col("tie").alias("tie"))
        table = lambda bs: F.array(*(F.struct(F.lit(k).alias("key"), F.lit(t).alias("tie")) for k, t in bs))
        passed = lambda bs: F.size(F.filter(bs, lambda s: s <= own))
        # whole blocks by their last borders, then the borders of one block: some 2 * BLOCK comparisons, not all of them
        whole = F.array(passed(table(borders[BLOCK - 1 :: BLOCK])))
        piece = F.get(F.transform(whole, lambda n: n * BLOCK + passed(F.slice(table(borders), n * BLOCK + 1, F.lit(BLOCK)))), F.lit(0)) if len(borders) > 2 * BLOCK else passed(table(borders))
    else:
        piece = F.lit(0)
    placed = rows.withColumn("piece", piece)
    base, start = {}, {}
    if parts > 1:
        counts = {r.piece: r["count"] for r in placed.groupBy("piece").count().collect()}
        for p in range(shards * parts):
            base[p] = start.get(p // parts, 0)
            start[p // parts] = base[p] + counts.get(p, 0)
        before = F.element_at(F.array(*(F.lit(base[p]) for p in range(shards * parts))), F.col("piece") + 1)
    else:
        before = F.lit(0)
    rank = F.row_number().over(Window.partitionBy("piece").orderBy("key", "tie")) - 1
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.floor(F.col("piece") / parts).cast("int").alias("shard"), (rank + before).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
