import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import lm

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(t):
    return [w.translate(LOW) for w in WORD.findall(t or "")] + ["</s>"]


def out_of_training(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2


def brute(rows):
    uni, bi = Counter(), Counter()
    for d, t in rows:
        if not out_of_training(d):
            ts = tokens(t)
            uni.update(ts)
            bi.update(zip(["<s>", *ts], ts))
    n, v = sum(uni.values()), len(uni)
    ctx = Counter()
    before, follow = Counter(), defaultdict(Counter)
    for (u, w), c in bi.items():
        ctx[u] += c
        before[w] += 1
        follow[u][min(c, 3)] += 1
    d2 = lm.discounts([sum(c == k for c in bi.values()) for k in (1, 2, 3, 4)])
    d1 = lm.discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)])
    m = len(bi)

    def q(w):
        back = sum(d1[min(c, 3)] for c in before.values()) / m if m else 1
        return back / (v + 1) + (max(before[w] - d1[min(before[w], 3)], 0) / m if m else 0)

    def p(u, w):
        if not ctx[u]:
            return q(w)
        c = bi[u, w]
        return max(c - d2[min(c, 3)], 0) / ctx[u] + sum(d2[k] * x for k, x in follow[u].items()) / ctx[u] * q(w)

    out = []
    for d, t in rows:
        ts = tokens(t)
        out.append((d, out_of_training(d), len(ts), sum(uni[w] > 0 for w in ts), n, sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in ts), sum(math.log10(p(u, w)) for u, w in zip(["<s>", *ts], ts))))
    return out, p, [*uni, "never seen"]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:] for r in want], rtol=1e-9)
    assert np.allclose([r[7] for r in got], [10 ** (-r[6] / r[2]) for r in want], rtol=1e-9)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(31)
    return [(i, prose(rng, rng.randint(0, 80)).replace("thth", "Th TH th")) for i in range(150)] + [(200, "th " * 600)]


def test_scores_match_brute_force(spark, rows, monkeypatch):
    want, p, words = brute(rows)
    for u in ("<s>", words[0], words[5], "never seen"):
        assert math.isclose(sum(p(u, w) for w in words), 1)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(lm.score(d, lm.train(d)).collect(), want)
    monkeypatch.setattr(lm, "FLUSH", 200)
    monkeypatch.setattr(lm, "PART_BYTES", 500)
    monkeypatch.setattr(lm, "MAX_OPEN", 3)
    same(lm.score(d, lm.train(d)).collect(), want)


def test_odd_rows(spark, odd_docs):
    src = [(r.doc_id, r.text) for r in odd_docs.collect()]
    same(lm.score(odd_docs, lm.train(odd_docs)).collect(), brute(src)[0])
    none = odd_docs.limit(0)
    assert lm.score(none, lm.train(none)).count() == 0
    assert all(r.base_score == 0 and r.score == 0 and r.n_known == 0 for r in lm.score(odd_docs, lm.train(none)).collect())


def test_model_beats_base_on_held_out_text(spark):
    rng = random.Random(7)
    nxt = {w: [rng.choice("abcdefghij") for _ in range(2)] for w in "abcdefghij"}

    def text():
        w = [rng.choice("abcdefghij")]
        for _ in range(80):
            w.append(rng.choice(nxt[w[-1]]))
        return " ".join(w)

    d = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    out = [r for r in lm.score(d, lm.train(d)).collect() if r.held_out]
    assert sum(r.score for r in out) > 0.5 * sum(r.base_score for r in out)


def test_few_files_stay_open(tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "MAX_OPEN", 4)
    files = lm.Files(f"file://{tmp_path}", [1] * 20)
    for p in range(20):
        lm.put(f"file://{tmp_path}/words-{p}", [np.array([p], np.uint64)])
    before = len(os.listdir("/proc/self/fd"))
    for p in [*range(20), *range(20)]:
        assert files.arrays("words", p)[0][0] == p
    assert len(files._open) == 4 and len(os.listdir("/proc/self/fd")) - before <= 5


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(x), 1000, np.uint64) == x).all()
    y = rng.integers(0, 1 << 20, 77).astype(np.uint32)
    assert (lm.unpack(lm.pack(y), 77, np.uint32) == y).all() and len(lm.unpack(b"", 0, np.uint32)) == 0
