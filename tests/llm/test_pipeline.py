import random
from collections import Counter

import corpus_pipeline
import pytest

from ledgerline.llm import decontaminate, pii, quality

from .conftest import prose
from .test_near_dedup import spoil
from .test_pii import brute as personal

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    base = [prose(rng, rng.randint(60, 150)) for _ in range(30)]
    bench = [(i, prose(rng, 40)) for i in range(4)]
    texts = list(base)
    texts += [base[i] for i in (0, 1, 1)] + [spoil(rng, base[i], 1) for i in (2, 3)]
    texts += [f"{prose(rng, 30)} {b} {prose(rng, 30)}" for _, b in bench]
    texts += [f"{prose(rng, 40)} write to me@x.org or +1 234 567 8901 {prose(rng, 20)}" for _ in range(4)]
    texts += ["too short", "", None, "same words here now " * 60]
    d = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), texts, bench


def test_stages_take_effect(spark, corpus):
    d, texts, bench = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = set(range(len(texts)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        out = stage(spark, docs, d)
        assert out.columns == before and out.schema["text"].dataType == docs.schema["text"].dataType
        docs = spark.createDataFrame(out.collect(), out.schema)
        now = {r.doc_id for r in docs.collect()}
        if name == "quality_rules":
            assert kept - now == set(range(len(texts) - 4, len(texts)))
        elif name == "near_duplicates":
            assert kept - now == {30, 31, 32, 33, 34}
        elif name == "decontamination":
            assert kept - now == {35, 36, 37, 38}
        else:
            assert now == kept and not any(personal(r.text) for r in docs.collect())
            assert all(r.text == texts[r.doc_id] for r in docs.collect() if r.doc_id < 30)
        kept = now
    places = Counter()
    for r in corpus_pipeline.run(spark, d).collect():
        places[r.doc_id] += r.length
    assert places == Counter({r.doc_id: len(r.text) + 1 for r in docs.collect()})


def test_stages_call_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "best_fit_packing"]
    assert quality and decontaminate and pii
