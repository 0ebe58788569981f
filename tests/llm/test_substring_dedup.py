import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from ledgerline.llm import arrays as A, substring_dedup as S

from .conftest import prose

WORD = re.compile(r"[\u0e00-\u0e7f\u3000-\u9fff]|[^\x20\x09-\x0D\u0e00-\u0e7f\u3000-\u9fff]+")


def sentences(text):
    """Sentences (lists of words) by the stated rule; word hashes come from the module."""
    words = list(WORD.finditer(text))
    ends, value = [], []
    for i, m in enumerate(words):
        gap = text[m.end() : words[i + 1].start()] if i + 1 < len(words) else "\n"
        low = np.frombuffer("".join(c.lower() if c.isascii() else c for c in m[0]).encode(), "uint8")
        value.append(int(A.mix(A.span_hash(A.prefix_hash(low), np.array([0]), np.array([len(low)])), 7)[0]))
        ends.append(m[0][-1] in ".!?" or "\n" in gap)
    more = set()
    for i in range(len(words) - S.WINDOW + 1):
        if not any(ends[i : i + S.WINDOW]):
            more.add(min(range(i, i + S.WINDOW), key=lambda j: (value[j], -j)))
    out, cur = [], []
    for i, m in enumerate(words):
        cur.append(m)
        if ends[i] or i in more:
            out.append(cur)
            cur = []
    return out


def brute(docs):
    """docs: (doc_id, text) in order of doc_id, all different."""
    where, sents = defaultdict(list), {}
    for d, t in docs:
        ss = sents[d] = sentences(t or "")
        for i in range(len(ss)):
            j = i + S.MIN_SENTENCES
            while j <= len(ss) and sum(map(len, ss[i:j])) < S.MIN_WORDS:
                j += 1
            if j <= len(ss):
                key = tuple("".join(c.lower() if c.isascii() else c for c in m[0]) for s in ss[i:j] for m in s)
                where[key].append((d, i, j))
    gone = defaultdict(set)
    for v in where.values():
        for d, i, j in v[1:]:
            gone[d] |= set(range(i, j))
    out = {}
    for d, t in docs:
        ss, text = sents[d], t or ""
        starts = [s[0].start() for s in ss] + [len(text)]
        out[d] = (len(ss), len(gone[d]), (text[: starts[0]] if ss else text) + "".join(text[starts[k] : starts[k + 1]] for k in range(len(ss)) if k not in gone[d]))
    return out


def test_digest_matches_brute_force(spark):
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (30, 55, 60, 120)]
    docs = []
    for i in range(50):
        parts = [prose(rng, rng.randint(1, 80))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), prose(rng, rng.randint(0, 40))]
        docs.append((i, rng.choice([" ", "\n"]).join(parts)))
    zh = "".join(rng.choice("日本語のテキスト汉字文本没有空格ก็คือ") for _ in range(90))
    docs += [(50, zh + " abc"), (51, "abc" + zh[5:]), (52, "plain words " + zh[:70] + "end")]
    docs += [(60, docs[3][1]), (61, docs[3][1].upper()), (62, ""), (63, " \n")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in S.digest(d).collect()}
    want = brute(docs)
    assert got == want and sum(v[1] > 0 for v in want.values()) > 20
    assert {r.doc_id: r.text for r in S.clean(d).collect()} == {k: v[2] for k, v in want.items() if v[1] == 0 or v[1] < v[0]}


def test_shared_passages_leave_later_documents(spark):
    rng = random.Random(12)
    passage = prose(rng, 60)
    docs = [(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(40)]
    got = {r.doc_id: r for r in S.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0 and got[0].text == docs[0][1]
    middle = " ".join(passage.split()[20:40])
    assert all(got[i].n_removed > 0 and middle not in " ".join(got[i].text.split()) for i in range(1, 40))


def test_odd_rows(odd_docs):
    rows = S.digest(odd_docs).collect()
    src = odd_docs.collect()
    assert len(rows) == len(src)
    same = [r for r in rows if r.doc_id == 12]
    assert len(same) == 3 and all(r.n_removed == 0 for r in same)  # repeated rows are one document
    assert sum(r.text is None for r in rows) == sum(r.text is None for r in src)
    assert S.clean(odd_docs).columns == odd_docs.columns
    assert S.digest(odd_docs.limit(0)).count() == 0 and S.clean(odd_docs.limit(0)).count() == 0
    assert all(len(list(A.chunks(pa.array([], pa.string())))) == 0 for _ in (0,))


def test_every_passage_over_fifty_words_is_found(spark):
    """Run-on passages of 51 words, without a mark or a break, in other surroundings: all but the first are cut."""
    rng = random.Random(21)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8))) for _ in range(n))
    passages = [words(51) for _ in range(150)]
    docs = [(2 * i + k, f"{words(30)} {p} {words(30)}") for i, p in enumerate(passages) for k in (0, 1)]
    got = {r.doc_id: r.n_removed for r in S.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all((n > 0) == (i % 2 == 1) for i, n in got.items())


def test_segments():
    texts = ["ab 日本cd", "", "日", "x日", " ก็ y", "abc", "é日é 日"]
    (c,) = A.chunks(pa.array(texts))
    s, e, row0 = c.segments(~A.SPACE[c.data])
    assert [[c.data[a:b].tobytes().decode() for a, b in zip(s[i:j], e[i:j], strict=True)] for i, j in zip(row0[:-1], row0[1:], strict=True)] == [WORD.findall(t) for t in texts]
