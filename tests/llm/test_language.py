import random
import zlib

import numpy as np

from ledgerline.llm import arrays as A, language
import pyarrow as pa

SYL = {"en": "th er on an re he in ing tion the and".split(), "fr": "é è ê ou ai eux que ment la le".split(), "es": "ción ñ ll rr que os as ado el".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYL[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_presence_is_the_set_of_runs():
    texts = ["Abé c", "", None, "a", "xyz" * 40]
    (c,) = A.chunks(pa.array(texts))
    got = language.presence(c)
    for row, t in zip(got, texts, strict=True):
        d = [int(language.FOLD[b]) for b in (t or "").encode()]
        want = set()
        for n in range(1, language.N + 1):
            for i in range(len(d) - n + 1):
                code = int.from_bytes(bytes(d[i : i + n]), "big")
                want.add(((code * language._ODD[n - 1]) & 0xFFFFFFFF) >> (32 - language.BITS))
        assert set(np.flatnonzero(row)) == want


def test_held_out_accuracy_and_odd_rows(spark, odd_docs):
    rng = random.Random(1)
    rows = [(i, text(rng, lang := rng.choice(sorted(SYL)), rng.randint(4, 60)), lang) for i in range(600)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify(d, language.train(d, 40)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    test = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) >= 0.97 * len(test)
    odd = language.identify(odd_docs, language.train(d, 40)).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {None, 0, 1, 2, 3, 11}
    assert {r.lang_pred for r in language.identify(odd_docs, None).collect()} == {"und"}
    assert language.train(odd_docs.limit(0)) is None
