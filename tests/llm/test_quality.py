import re
from collections import Counter

import numpy as np

from ledgerline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words)


def test_counts_match_brute_force(odd_docs):
    got = quality.annotate(odd_docs, None).toPandas()
    want = Counter((r.doc_id, *brute(r.text)) for r in odd_docs.collect())
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    mine = Counter((None if np.isnan(r[0]) else int(r[0]), *r[1:]) for r in got[cols].itertuples(index=False))
    assert mine == want
    assert (got.kept == ~got.base_failed).all()  # without a field the base verdict stands
    assert quality.annotate(odd_docs.limit(0), None).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    f = quality.LineField(rng.normal(size=(4, 2)), rng.normal(size=(2, 2)))
    lens = [3, 0, 5, 1]
    x = rng.normal(size=(sum(lens), 4))
    first = np.cumsum([0, *lens])
    got = f.viterbi(x, first)
    for a, b in zip(first, first[1:]):
        n = b - a
        if n:
            e = x[a:b] @ f.weights
            paths = [[(k >> i) & 1 for i in range(n)] for k in range(2**n)]
            best = max(paths, key=lambda p: sum(e[i, p[i]] for i in range(n)) + sum(f.trans[p[i], p[i + 1]] for i in range(n - 1)))
            assert list(got[a:b]) == best


def test_field_drops_junk_and_keeps_prose(spark):
    good = "The hand of then is there and onward. It was there for them.\n" 
    docs, labels = [], []
    for i in range(40):
        bad = i % 4 == 0
        body = "".join(f"{'W%d!! SHOUT!! ### $$' % k if bad else good.replace('hand', 'h%d x%d' % (i, k))}\n" for k in range(12))
        docs.append((i, body, "en", "s", 1))
        labels.append((i, int(not bad), 0))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    field = quality.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = {r.doc_id: r for r in quality.annotate(d, field).collect()}
    assert all(kept[i].content_share == (0 if i % 4 == 0 else 1) for i in kept)
    assert quality.keep(d, field).columns == d.columns
