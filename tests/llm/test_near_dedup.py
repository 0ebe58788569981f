import collections
import random
import re

import numpy as np
import pytest
import pyarrow as pa

from ledgerline.llm import alignment, arrays as A, components, near_dedup as N

from .conftest import prose


def distance(a, b):
    col = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(col[j - 1] + (x != y), col[j] + 1, nxt[-1] + 1))
        col = nxt
    return col[-1]


def test_alignment_equals_full_table():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(120):
        x = [rng.randrange(8) for _ in range(rng.randint(0, 90))]
        y = list(x) if rng.random() < 0.8 else [rng.randrange(8) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 30)):
            i = rng.randrange(len(y) + 1)
            y[i : i + rng.randint(0, 1)] = [rng.randrange(8)] * rng.randint(0, 2)
        a.append(np.array(x, np.uint32))
        b.append(np.array(y, np.uint32))
    limit = np.array([rng.randint(0, 60) for _ in a])
    want = np.array([min(distance(x.tolist(), y.tolist()), k + 1) for x, y, k in zip(a, b, limit, strict=True)])
    assert (alignment.distances(a, b, limit) == want).all()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in edges:
        x, y = sorted((root(x), root(y)))
        parent[y] = x
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def spoil(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], ["newword"], [w[i], "extra"]])
    return " ".join(w)


def make(rng):
    docs = []
    for g in range(25):
        base = prose(rng, rng.randint(60, 200))
        docs.append(base)
        docs += [spoil(rng, base, rng.choice([0, 1, 2])) for _ in range(rng.randint(0, 4))]
    hot = prose(rng, 120)
    docs += [spoil(rng, hot, rng.randint(0, 3)) for _ in range(60)]
    docs += [f"{hot[:250]} {prose(rng, 150)}" for _ in range(30)]  # a common passage, else different
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_groups_match_brute_force(spark):
    docs = make(random.Random(3))
    words = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t)) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids: dict[str, int] = {}
    seqs = [np.array([ids.setdefault(w, len(ids)) for w in ws], np.uint32) for ws in words]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i)]
    limit = np.array([int(0.2 * max(len(seqs[i]), len(seqs[j])) + 1e-9) for i, j in pairs])
    near = alignment.distances([seqs[i] for i, _ in pairs], [seqs[j] for _, j in pairs], limit) <= limit
    for (i, j), ok in zip(pairs, near, strict=True):
        if ok:
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in N.digest(d).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: root(i) for i in range(len(docs))}
    kept = {r.doc_id for r in N.keep_first(d).collect()}
    assert kept == {root(i) for i in range(len(docs))} == {i for i, r in got.items() if r.is_first}


def test_order_counts():
    a, b = (" ".join(x) for x in (["one", "two"] * 20, ["two", "one"] * 20))
    (c,) = A.chunks(pa.array([a, a, b]))
    s = N.sketch(*N.word_hashes(c))
    assert (s[0] == s[1]).all()


def test_odd_rows(odd_docs):
    rows = N.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    none = [r for r in rows if not r.n_words]
    assert all(r.is_first and r.class_size == 1 for r in none)
    assert {r.class_size for r in rows if r.doc_id == 12} == {3}
    out = N.keep_first(odd_docs)
    assert out.columns == odd_docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert kept.count(12) == 1 and kept.count(15) == 1 and len(kept) == len(rows) - 3
    assert N.digest(odd_docs.limit(0)).count() == 0 and N.keep_first(odd_docs.limit(0)).count() == 0


def test_near_pairs_in_a_crowded_bucket(spark):
    """Many texts that share a passage of half their length; one in five has a near copy, edited outside the passage."""
    rng = random.Random(9)
    passage = prose(rng, 100).split()
    texts, partner = [], {}
    for _ in range(150):
        texts.append(passage + prose(rng, 100).split())
    for i in range(0, 150, 5):
        w = texts[i][:]
        for j in rng.sample(range(100, 200), 4 + i // 5):
            w[j] = f"new{j}"
        partner[len(texts)] = i
        texts.append(w)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.digest(docs).collect()}
    assert sum(got[i] == j for i, j in partner.items()) >= 28
    assert all(got[i] == i for i in range(150))


def test_common_kmers_bound_the_distance():
    rng = random.Random(4)
    tight = 0
    for n in range(1000):
        size = rng.choice((3, 6, 40))
        x = [rng.randrange(size) for _ in range(rng.randint(3, 40))]
        y = x[:]
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(y) + 1)
            y[i : i + rng.randint(0, 1)] = [rng.randrange(size)] * rng.randint(0, 2)
        if n % 7 == 0:
            y = y[len(y) // 2 :] + y[: len(y) // 2]
        grams = [[tuple(w[i : i + N.K]) for i in range(len(w) - N.K + 1)] for w in (x, y)]
        both = sum((collections.Counter(grams[0]) & collections.Counter(grams[1])).values())
        common, most = N._common_kmers(np.array(x, np.uint32), np.array(y, np.uint32))
        true = distance(x, y)
        assert common == both >= max(len(x), len(y)) - N.K + 1 - N.K * true and most >= true
        tight += most <= true + 4
    assert tight > 300


def crowded(rng, k):
    """Texts of one bucket only: the fine sketch has to find what the pivot doesn't."""
    texts = [prose(rng, 100) for _ in range(k)]
    texts += [t + " tail" for t in texts[: k // 3]]
    (c,) = A.chunks(pa.array(texts))
    return texts, N.content(*N.word_hashes(c)).view(np.int64).tolist()


def test_a_large_bucket_is_settled_by_the_fine_sketch(spark):
    rng = random.Random(10)
    texts, node = crowded(rng, 90)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = spark.createDataFrame([(n, [1, 1000 + i]) for i, n in enumerate(node)], "node long, bands array<long>")
    roots = {r.node: r.root for r in components.components(N.links(docs, rows)).collect()}
    assert len(roots) == 60 and all(roots[node[i]] == roots[node[90 + i]] for i in range(30))


def test_work_is_linear_in_a_bucket(spark, monkeypatch):
    """Pairs that are aligned grow as the nodes of one crowded bucket, not as their square."""
    counted = []
    whole = N.verified
    monkeypatch.setattr(N, "verified", lambda pairs, *a: counted.append(pairs.count()) or whole(pairs, *a))
    for k in (60, 240):
        texts, node = crowded(random.Random(k), k)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = spark.createDataFrame([(n, [1]) for n in node], "node long, bands array<long>")
        N.links(docs, rows)
    assert counted[2] + counted[3] <= 5 * (counted[0] + counted[1])


def test_a_hub_is_spread(spark):
    """spread_join gives a plain join's rows with keys far above the even share, null keys and absent keys."""
    rows = [(1, i) for i in range(2000)] + [(k, k) for k in range(2, 200)] + [(None, 5)]
    many = spark.createDataFrame(rows, "u long, v long")
    one = spark.createDataFrame([(k, 10 * k) for k in range(0, 150)], "u long, m long")
    from pyspark.sql import functions as F

    got = N.spread_join(many, one, "u", F.xxhash64("v"), len(rows))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, many.join(one, "u").collect()))
    assert got.columns == ["u", "v", "m"]


def test_a_chain_in_one_bucket_is_kept(spark):
    """A is near P and B, P isn't near B; the one bucket they share links all three."""
    rng = random.Random(13)
    for _ in range(100):
        a = prose(rng, 100).split()
        p, b = a[:], a[:]
        p[5:90:6] = [f"p{i}" for i in range(15)]
        b[8:90:6] = [f"b{i}" for i in range(14)]
        texts = [" ".join(x) for x in (p, a, b)]
        (c,) = A.chunks(pa.array(texts))
        node = N.content(*N.word_hashes(c)).view(np.int64).tolist()
        if node[0] == min(node):
            break
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = spark.createDataFrame([(n, [1]) for n in node], "node long, bands array<long>")
    assert len({r.root for r in components.components(N.links(docs, rows)).collect()}) == 1
    assert components.components(N.links(docs, rows)).count() == 3


def test_sketch_reaches_the_stated_similarity():
    """Scattered edits of one word in ten share a band nearly always, and those close to the threshold mostly."""
    rng = random.Random(14)
    for rate, least in ((0.02, 0.99), (0.05, 0.99), (0.1, 0.98), (0.15, 0.95), (0.19, 0.9)):
        texts = []
        for _ in range(200):
            w = prose(rng, 200).split()
            texts.append(" ".join(w))
            for i in rng.sample(range(200), int(200 * rate)):
                w[i] = f"new{i}"
            texts.append(" ".join(w))
        s = np.concatenate([N.sketch(*N.word_hashes(c)) for c in A.chunks(pa.array(texts))])
        assert (s[::2] == s[1::2]).any(1).mean() >= least


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.7])
def test_recall_of_the_operator_at_every_edit_rate(spark, shared):
    """Pairs of texts with replaced words; `shared` of each text is one passage that all of them hold, and all edits are in the rest.
    Every pair is within the stated similarity (alignment says so), so a pair in different groups is a miss."""
    rng = random.Random(21)
    words = [prose(rng, 1).strip(".,! \n") or "x" for _ in range(4000)]
    passage, rows, truth = [rng.choice(words) for _ in range(240)], [], []
    for rate in (0.02, 0.05, 0.1, 0.15, 0.19):
        for _ in range(60):
            n = rng.randint(120, 240)
            common = passage[: int(n * shared)]
            own = [rng.choice(words) for _ in range(n - len(common))]
            other = own[:]
            for i in rng.sample(range(len(own)), min(len(own), int(n * rate))):
                other[i] = f"new{rng.randrange(10**6)}"
            truth.append((rate, len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(common + own)), (len(rows) + 1, " ".join(common + other))]
    group = {r.doc_id: r.class_id for r in N.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for rate in (0.02, 0.05, 0.1, 0.15, 0.19):
        pairs = [(a, b) for r, a, b in truth if r == rate]
        assert all(similar(rows[a][1], rows[b][1]) for a, b in pairs)
        assert np.mean([group[a] == group[b] for a, b in pairs]) >= (0.9 if rate > 0.15 else 0.95), rate
    if shared < 0.7:  # with more in common, unlike texts are near copies of others by chance
        assert len(set(group.values())) >= len(truth)


def similar(a, b):
    (c,) = A.chunks(pa.array([a, b]))
    wh, row0 = N.word_hashes(c)
    x, y = (wh[row0[i] : row0[i + 1]].astype(np.uint32) for i in (0, 1))
    limit = int((1 - N.SIMILARITY) * max(len(x), len(y)) + 1e-9)
    return N.distances([x], [y], np.array([limit]))[0] <= limit


def test_a_crowded_bucket_is_searched_whole(spark):
    """One bucket of texts that share most of their words: every near pair is linked, as all pairs of the bucket say."""
    rng = random.Random(31)
    words = [f"w{i}" for i in range(900)]
    passage = rng.sample(words, 84)
    texts = []
    for _ in range(60):  # what a text has of its own is common too, but for a few words
        own = rng.sample(words, 36)
        texts.append(passage + own)
        near = passage + own
        for i in rng.sample(range(84, 120), 24):
            near[i] = rng.choice(words)
        texts.append(near)
    (c,) = A.chunks(pa.array([" ".join(t) for t in texts]))
    wh, row0 = N.word_hashes(c)
    node = N.content(wh, row0).view(np.int64).tolist()
    seqs = [wh[row0[i] : row0[i + 1]].astype(np.uint32) for i in range(len(texts))]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    limit = np.full(len(pairs), 24)
    near = alignment.distances([seqs[i] for i, _ in pairs], [seqs[j] for _, j in pairs], limit) <= limit
    want = {frozenset((node[i], node[j])) for (i, j), ok in zip(pairs, near, strict=True) if ok}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    crowd = spark.createDataFrame([(n, n) for n in node], "node long, root long")
    held = N.sequences(docs, N.stored(crowd.select("node")))
    got = [frozenset((r.node, r.pivot)) for r in N.crowded(crowd, held).collect()]
    assert len(want) >= 60 and want <= set(got) and len(got) == len(set(got))
    rows = spark.createDataFrame([(n, [1]) for n in node], "node long, bands array<long>")
    roots = {r.node: r.root for r in components.components(N.links(docs, rows)).collect()}
    assert all(len({roots[n] for n in pair}) == 1 for pair in want)


def test_texts_that_share_one_rare_word_are_not_aligned(spark):
    """Each two of 20 texts share a passage and one rare word; only the copy with a few edits makes a pair."""
    k = 20
    texts = [[f"p{i}" for i in range(70)] + [f"w{min(a, b)}x{max(a, b)}" for b in range(k) if b != a] + [f"own{a}x{i}" for i in range(11)] for a in range(k)]
    texts.append(texts[0][:95])
    (c,) = A.chunks(pa.array([" ".join(t) for t in texts]))
    node = N.content(*N.word_hashes(c)).view(np.int64).tolist()
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    crowd = spark.createDataFrame([(n, n) for n in node], "node long, root long")
    got = N.crowded(crowd, N.sequences(docs, N.stored(crowd.select("node")))).collect()
    assert [{r.node, r.pivot} for r in got] == [{node[0], node[k]}]


def test_entries_of_a_crowded_key_meet_once(spark):
    """Each two entries of a key meet in one block, and copies grow as n to the power of 1.5, not as the square."""
    ns = {1: 5, 2: 40, 3: 160}
    each = spark.createDataFrame([(k, i, side) for (k, n), side in zip(ns.items(), (1, 2, 4)) for i in range(n)], "key long, node long, side int")
    left, right = N._in_square(each)
    assert left.count() == right.count() == 5 + 40 * 2 + 160 * 4
    met = left.join(right.select("key", "block", N.F.col("node").alias("r")), ["key", "block"]).groupBy("key", "node", "r").count()
    assert {(r["key"], r["pairs"], r["most"]) for r in met.groupBy("key").agg(N.F.count("*").alias("pairs"), N.F.max("count").alias("most")).collect()} == {(k, n * n, 1) for k, n in ns.items()}


def test_cells_of_pairs_say_what_pairs_say(spark, monkeypatch):
    """Pairs dealt over cells of bounded size are linked as each pair with its words is, and the words of a node come once to a cell."""
    rng = random.Random(5)
    texts = [prose(rng, 60) for _ in range(12)]
    texts += [" ".join(w if rng.random() > 0.1 else "x" for w in t.split()) for t in texts]
    (c,) = A.chunks(pa.array(texts))
    node = N.content(*N.word_hashes(c)).view(np.int64).tolist()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = N.sequences(docs, N.stored(spark.createDataFrame([(n,) for n in node], "node long")))
    pairs = N.stored(spark.createDataFrame([(a, b) for a in node for b in node if a > b], "node long, pivot long"))
    want = sorted(map(tuple, N.verified(pairs, words, N.SIMILARITY).collect()))
    for size in (N.GROUP_BYTES, 300):
        monkeypatch.setattr(N, "GROUP_BYTES", size)
        got = N.verified(pairs, words, N.SIMILARITY, True)
        assert sorted(map(tuple, got.collect())) == want and 12 <= sum(x[2] for x in want) < len(want)
    assert N.verified(pairs.limit(0), words, N.SIMILARITY, True).count() == 0


def test_joins_of_buckets_keep_one_plan(spark):
    """With and without a hot key the join makes one row of each row, by the same keys."""
    one = spark.createDataFrame([(k, k) for k in range(40)], "key long, m long")
    for rows in ([(k % 40, k) for k in range(400)], [(0, k) for k in range(4000)] + [(k % 40, k) for k in range(400)]):
        got = N.spread_join(spark.createDataFrame(rows, "key long, v long"), one, "key", N.F.xxhash64("v"), len(rows))
        assert got.count() == len(rows)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1 and "LeftOuter" not in plan and "salt" in plan


def test_entries_of_the_crowd_are_dealt_over_all_cores(spark, monkeypatch):
    """However few files hold the crowd, no task makes far more entries than the others, and a text makes its edits and COMMON more at most."""
    rng = random.Random(6)
    texts = [prose(rng, 100) for _ in range(150)] * 2
    texts = [f"{t} copy{i}" for i, t in enumerate(texts)]
    (c,) = A.chunks(pa.array(texts))
    wh, row0 = N.word_hashes(c)
    node = N.content(wh, row0).view(np.int64).tolist()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    crowd = spark.createDataFrame([(n, n) for n in node], "node long, root long").coalesce(1)
    words = N.stored(N.sequences(docs, N.stored(crowd.select("node"))).coalesce(1))
    made = []
    whole = N.stored

    def stored(df):
        if "place" in df.columns and "side" not in df.columns:
            made.append([r["count"] for r in df.groupBy(N.F.spark_partition_id()).count().collect()])
        return whole(df)

    monkeypatch.setattr(N, "stored", stored)
    N.crowded(crowd, words)
    (tasks,) = made
    size = np.diff(row0)
    assert len(tasks) > 4 and max(tasks) <= 3 * sum(tasks) / len(tasks)
    assert 0 < sum(tasks) <= ((1 - N.SIMILARITY) * size + N.COMMON).sum()
