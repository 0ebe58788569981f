"""Operators on embeddings (11, 12, 13) against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk_search as T, vector_codes as C, whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def vectors(n, d, seed=3, spread=1.0):
    return (np.random.default_rng(seed).standard_normal((n, d)) * spread).astype(np.float32)


def whole(rows):
    """Rows of (id, vector, label) that count, as doubles."""
    return [(i, [float(c) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls everywhere, non-finite components, repeated rows, equal vectors, one vector that a third of all rows hold."""
    x = vectors(120, 16, spread=0.3)
    rows = [(i, v.tolist(), i % 4 if i % 7 else None) for i, v in enumerate(x)]
    rows += [(200 + i, x[5].tolist(), 2) for i in range(60)]
    rows += [(300, x[5].tolist(), 2)] * 3 + [(400, [0.0] * 16, None), (500, [-0.0] * 16, 9)]
    rows += [(600, None, 1), (601, [None] + [0.1] * 15, 1), (602, [math.nan] * 16, 1), (603, [math.inf] + [0.0] * 15, None), (604, [-math.inf] + [0.0] * 15, None)]
    return rows


def clash(df):
    return df.select("*", *(F.lit(1).alias(c) for c in ("id", "vec", "k", "code", "error", "x", "asked", "a.b", "q", "turn", "n")))


# ---- 11


def brute_codes(rows, parts=C.PARTS, entries=C.ENTRIES, rounds=C.ROUNDS):
    kept = sorted(((i, [math.floor(4096 * c) for c in v], lab) for i, v, lab in whole(rows)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    books = [[r[1][p * w : (p + 1) * w] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w : (p + 1) * w], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(p, v)[1] for p in range(parts)] for _, v, _ in kept]
        new = []
        for p in range(parts):
            new.append([])
            for k, e in enumerate(books[p]):
                mine = [v[p * w : (p + 1) * w] for (_, v, _), a in zip(kept, at) if a[p] == k]
                new[-1].append([sum(c) // len(mine) for c in zip(*mine)] if mine else e)
        books = new
    out = []
    for i, v, lab in kept:
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted((i, c, e, total[lab]) for i, c, e, lab in out), np.array(books)


def test_codes_match_brute_force(spark, odd_rows):
    want, books = brute_codes(odd_rows)
    got = C.digest(clash(table(spark, odd_rows))).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {C.digest_of(books)}


@pytest.mark.parametrize("entries,seed", [(1, 1), (7, 2), (64, 3), (256, 4)])
def test_kd_tree_finds_the_lowest_of_equal_entries(entries, seed):
    rng = np.random.default_rng(seed)
    book, x = rng.integers(-3, 4, (entries, 3)), rng.integers(-4, 5, (3000, 3))  # a coarse grid: many ties and equal entries
    d = ((x[:, None] - book[None]) ** 2).sum(2)
    at, dist = C.KdTree(book).nearest(x)
    assert (at == d.argmin(1)).all() and (dist == d.min(1)).all()


def test_codes_of_few_rows_and_of_none(spark):
    two = [(5, [0.5] * 8, None), (2, [0.25] * 8, None)]
    assert sorted((r.vec_id, r.code, r.error) for r in C.digest(table(spark, two)).collect()) == [(2, "00" * 8, 0), (5, "01" * 8, 0)]
    for rows in ([], [(1, None, 1)]):
        empty = C.digest(table(spark, rows))
        assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert C.digest(table(spark, [(None, [0.5] * 8, 1)])).first().vec_id is None
    with pytest.raises(ValueError):
        C.train(table(spark, [(1, [0.5] * 9, 1)]))
    with pytest.raises(ValueError):
        C.train(table(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)]))


def test_labels_in_greater_number_than_a_broadcast_holds(spark, odd_rows, monkeypatch):
    from ledgerline.llm import common

    want, _ = brute_codes(odd_rows)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(C, "HOT_ROWS", 30)  # two labels are hot
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in C.digest(table(spark, odd_rows)).collect()) == want


def test_codes_are_decoded(spark, odd_rows):
    df = table(spark, odd_rows)
    books = C.train(df)
    x = {i: np.floor(4096 * np.array(v)).astype(int) for i, v, _ in whole(odd_rows)}
    for r in C.decode(C.encode(df, books), books).collect():
        assert ((x[r.id] - np.array(r.approx)) ** 2).sum() == r.error


# ---- 12


def brute_whitening(rows):
    kept = [(i, [math.floor(256 * c) + 0 for c in v]) for i, v, _ in whole(rows)]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array(sums) / n
    values, vectors_ = np.linalg.eigh(x.T @ x / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    out = {}
    for i, v in kept:
        dev = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        w = (np.array(v) - np.array(sums) / n) @ vectors_[:, :4] / np.sqrt(values[:4])
        out[i] = (dev, w)
    return n, out, values / values.sum()


@pytest.mark.parametrize("steep", [False, True])
def test_whitening_matches_the_whole_eigenproblem(spark, odd_rows, steep):
    rows = odd_rows
    if steep:  # a falling spectrum: the range finder converges without the full dimension
        x = vectors(300, 32) * (0.35 ** np.arange(32)).astype(np.float32) * 8
        rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    n, want, share = brute_whitening(rows)
    told = {}
    W.fit(table(spark, rows), powers=4, told=told)
    assert told["width"] == (12 if steep else 16)
    got = W.digest(clash(table(spark, rows))).collect()
    assert len(got) == 4 * len(whole(rows))
    sign = {c: np.sign(sum(r.whitened * want[r.vec_id][1][c - 1] for r in got if r.component == c)) for c in range(1, 5)}
    for r in got:
        assert r.n == n and r.deviation == want[r.vec_id][0] == int(r.deviation_exact)
        assert abs(r.whitened - sign[r.component] * want[r.vec_id][1][r.component - 1]) < 1e-6
        assert abs(r.explained - share[r.component - 1]) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_few_rows(spark):
    assert W.digest(table(spark, [])).count() == 0
    one = W.digest(table(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, 0.0, 0.0, 1.0)] * 4
    line = W.digest(table(spark, [(None, [1.0], 0), (2, [3.0], 0)])).collect()
    assert sorted((r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in line) == [(1, 2, 512**2, 1.0, 1.0)] * 2


def test_deviation_beyond_a_long():
    m = W.Model(1 << 40, [1 << 45, 0], np.eye(2), np.ones(2), 2.0)
    assert m.deviations(np.array([[1 << 20, 3]])) == [((1 << 60) - (1 << 45)) ** 2 + (3 << 40) ** 2]


# ---- 13


def brute_top(rows, k=T.K, every=T.EVERY):
    kept = {(i, tuple(math.floor(1024 * c) for c in v)) for i, v, _ in whole(rows) if i is not None}
    out = []
    for i, v in sorted(kept):
        if i % every == 0:
            scores = {(-sum(a * b for a, b in zip(v, w)), j) for j, w in kept if j != i}
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_top_k_matches_brute_force(spark, odd_rows):
    rows = [*odd_rows, (None, [1.0] * 16, 1), (700, odd_rows[5][1], 1), (7, odd_rows[8][1], 0)]
    got = T.digest(clash(table(spark, rows)))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == brute_top(rows)


def test_top_k_in_many_blocks_rounds_and_chunks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    middle = rng.standard_normal((12, 8))
    x = (middle[rng.integers(0, 12, 900)] + 0.1 * rng.standard_normal((900, 8))).astype(np.float32)
    x[300:600] = x[0]  # a third of all rows hold one vector
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(T, "BLOCK", 40)
    monkeypatch.setattr(T, "ROUND", 3)
    monkeypatch.setattr(T, "CHUNK_BYTES", 8 * 8 * 30)
    assert rows_of(T.top_k(table(spark, rows), F.col("vec_id") % 10 == 0)) == brute_top(rows, every=10)


def test_top_k_of_few_rows(spark):
    assert T.digest(table(spark, [])).count() == 0
    assert T.digest(table(spark, [(1, [1.0], 0)])).count() == 0
    assert T.digest(table(spark, [(100, [1.0], 0)])).count() == 0
    assert rows_of(T.digest(table(spark, [(100, [1.0], 0), (0, [-2.0], 0), (3, [-2.0], 0)]))) == [(0, 1, 3, 4 << 20), (0, 2, 100, -2 << 20), (100, 1, 0, -2 << 20), (100, 2, 3, -2 << 20)]


def test_cover_tree_holds_every_row_within_its_radii_and_prunes():
    rng = np.random.default_rng(4)
    middle = rng.integers(-4000, 4000, (40, 6))
    x = middle[rng.integers(0, 40, 4000)] + rng.integers(-30, 30, (4000, 6))
    tree = T.CoverTree(x)
    assert sorted(tree.order.tolist()) == list(range(4000)) and len(tree.nodes) > 20
    for c, r, (lo, hi, kid, end) in zip(tree.centres, tree.radius, tree.span.tolist()):
        assert np.sqrt(((tree.x[lo:hi] - c) ** 2).sum(1)).max() <= r + 1e-9
        if kid < end:
            assert [tree.span[kid][0], tree.span[end - 1][1]] == [lo, hi]
            inner = tree.centres[kid:end]
            gaps = np.sqrt(((inner[:, None] - inner[None]) ** 2).sum(2)) + np.eye(len(inner)) * 1e9
            assert gaps.min() >= tree.radius[kid:end].max() - 1e-9  # separation is no less than covering
    own = np.arange(4000)[tree.order]
    best = T.Best(own, np.full(4000, T.NONE), 10)
    assert T.search(tree, best, tree, own) < 0.5 * 4000 * 4000


def test_large_components_are_multiplied_exactly():
    x = np.array([[(1 << 29) + 1, 3], [(1 << 29) - 1, 5], [7, 1 << 28]], np.int64)
    t = T.CoverTree(x)
    best = T.Best(np.arange(3)[t.order], np.full(3, T.NONE), 2)
    T.search(t, best, t, np.arange(3)[t.order])
    own = np.arange(3)[t.order]
    got = {(int(own[q]), int(i)): int(s) for q, s, i in zip(best.q, best.score, best.id)}
    assert got == {(a, b): sum(int(u) * int(v) for u, v in zip(x[a], x[b])) for a in range(3) for b in range(3) if a != b}


def test_partial_sums_of_few_tasks_are_added_in_one_step(spark, tmp_path):
    spark.range(40, numPartitions=4).selectExpr("id % 5 as at", "id as v").write.parquet(f"{tmp_path}/p")
    p = spark.read.parquet(f"{tmp_path}/p")
    out = W.V.summed(p, "at")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["at"]: r.v for r in out.collect()} == {i: sum(range(i, 40, 5)) for i in range(5)}
