import random

import numpy as np

from ledgerline.llm import decontaminate as D

from .conftest import prose


def sellers(seg: bytes, text: bytes) -> int:
    col = [0] * (len(text) + 1)
    for i, a in enumerate(seg, 1):
        nxt = [i]
        for j, b in enumerate(text, 1):
            nxt.append(min(col[j - 1] + (a != b), col[j] + 1, nxt[-1] + 1))
        col = nxt
    return min(col)


def brute(docs, items):
    """{(doc_id, item_id): (segments, least edits)}, from segments cut anew for every item."""
    out = {}
    for item, text in items:
        t = D.normal(text or "")
        if len(t) < D.Q:
            continue
        last = max(0, len(t) - D.SEGMENT)
        for start in sorted({*range(0, last, D.STRIDE), last}):
            seg = t[start : start + D.SEGMENT]
            for doc_id, doc in docs:
                dist = sellers(seg, D.normal(doc or ""))
                if dist <= (len(seg) - D.Q) // D.Q:
                    n, e = out.get((doc_id, item), (0, 99))
                    out[doc_id, item] = n + 1, min(e, dist)
    return out


def spoil(rng, t, n):
    t = list(t) or ["."]
    for _ in range(n):
        i = rng.randrange(len(t) or 1)
        op = rng.random()
        t[i : i + 1] = [] if op < 0.3 and len(t) > 1 else [t[i], "q"] if op < 0.6 else ["z"]
    return "".join(t)


def test_matches_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate((3, 8, 20, 30, 45))] + [(5, "short"), (6, None), (None, prose(rng, 12))]
    docs = []
    for i in range(60):
        item = rng.choice(items)[1] or ""
        passage = spoil(rng, item.upper() if i % 5 == 0 else item, rng.choice([0, 1, 2, 4, 8])) if item else ""
        docs.append((i, rng.choice(["", prose(rng, 15)]) + " " + (passage if i % 3 else prose(rng, 10)) + " " + rng.choice(["", prose(rng, 15)])))
    docs += [(100, None), (101, ""), (102, "x")]
    want = brute(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_segments, r.edits) for r in D.matches(d, b).collect()}
    assert got == want and len(want) > 15
    assert {r.doc_id for r in D.clean(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_blocks_give_the_same_rows(spark, odd_docs, monkeypatch):
    b = spark.createDataFrame([(i, r.text) for i, r in enumerate(odd_docs.collect())], "item_id long, text string")
    one = sorted(map(tuple, D.matches(odd_docs, b).select("doc_id", "item_id", "n_segments").collect()), key=str)
    monkeypatch.setattr(D, "INDEX_BYTES", 800_000)
    assert sorted(map(tuple, D.matches(odd_docs, b).select("doc_id", "item_id", "n_segments").collect()), key=str) == one and one
    assert D.clean(odd_docs, b).columns == odd_docs.columns
    assert D.matches(odd_docs.limit(0), b).count() == 0 and D.matches(odd_docs, b.limit(0)).count() == 0
    assert D.clean(odd_docs, b.limit(0)).count() == odd_docs.count()


def test_grams_tell_substrings_apart():
    d = np.frombuffer(b"the cat sat on the mat, the cat sat on the hat", np.uint8)
    g = D.grams(d)
    assert len(g) == len(d) - D.Q + 1
    assert [[a == b for b in g] for a in g] == [[d[i : i + D.Q].tobytes() == d[j : j + D.Q].tobytes() for j in range(len(g))] for i in range(len(g))]


def test_excerpts_and_replaced_words_are_found():
    rng = random.Random(15)
    items = [(i, prose(rng, 40)) for i in range(40)]
    s = D.Segments(items)

    def share(change):
        texts = [f"{prose(rng, 30)} {change(t.split())} {prose(rng, 30)}" for _, t in items]
        (c,) = D.A.chunks(D.pa.array(texts))
        row, seg = s.search(c)[:2]
        return np.mean([any(i in s.owners[s.owner0[k] : s.owner0[k + 1]] for k in seg[row == i]) for i in range(len(items))])

    def cut(w):
        text = D.normal(" ".join(w)).decode("utf-8", "ignore")
        return text[31 : 31 + D.SEGMENT + D.STRIDE]

    def replaced(w):
        for i in range(rng.randrange(10), len(w), 10):
            w[i] = "replaced"
        return " ".join(w)

    assert share(cut) == 1 and share(replaced) > 0.9


TEMPLATE = "question which of the following four answers is right read all of them with care first "


def test_template_that_all_items_share(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, TEMPLATE + prose(rng, 6)) for i in range(6)]
    docs = [(0, TEMPLATE * 3), (1, prose(rng, 8) + TEMPLATE + prose(rng, 5)), (2, " ".join(t for _, t in items[:2])), (3, prose(rng, 30)), (4, (items[3][1] + " ") * 4)]
    want = brute(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for hits in (D.HITS, 300, 1):  # slices of few hits give the same rows
        monkeypatch.setattr(D, "HITS", hits)
        (c,) = D.A.chunks(D.pa.array([t for _, t in docs]))
        s = D.Segments(items)
        row, seg = s.search(c)[:2]
        assert {(int(r), int(i)) for r, k in zip(row, seg) for i in s.owners[s.owner0[k] : s.owner0[k + 1]]} == set(want)
        assert {(r.doc_id, r.item_id): (r.n_segments, r.edits) for r in D.matches(d, b).collect()} == want


def test_template_in_many_items_and_a_long_text_stays_small():
    """Measured in a process of its own: items and repeats of the template in the text make no product."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import random, resource, time
import pyarrow as pa
from ledgerline.llm import arrays as A, decontaminate as D
rng = random.Random(1)
word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
template = " ".join(word() for _ in range(12)) + " "
items = [(i, template + " ".join(word() for _ in range(12))) for i in range(800)]
s = D.Segments(items)
(c,) = A.chunks(pa.array([template * 800]))
began = time.time()
assert len(s.search(c)[0])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, time.time() - began)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, timeout=300)
    mb, seconds = out.stdout.split()
    assert int(mb) < 1000 and float(seconds) < 30, out.stderr


def test_index_of_a_block_keeps_to_its_bound():
    rng = random.Random(6)
    text = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 12))) for _ in range(400))) for i in range(300)]
    s, size = D.Segments(text), sum(len(t) for _, t in text)
    assert s.nbytes() <= D.INDEX_PER_BYTE * size
