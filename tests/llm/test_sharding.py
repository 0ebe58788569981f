import zlib
from collections import Counter

from ledgerline.llm import sharding


def check(rows, docs, shards, slack):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for k, v in by.items():
        assert 0 <= k < shards and sorted(r.slot for r in v) == list(range(len(v)))
    total = sum(r.size for r in rows)
    for k in range(shards):
        assert abs(sum(r.size for r in by.get(k, [])) - total / shards) <= slack
    return by


def test_sizes_are_near_equal(spark):
    d = spark.createDataFrame([(i, "same text" if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard_by_bytes(d, 7, part_rows=100).collect()
    check(rows, d.collect(), 7, 0.002 * 3000 * 16 + 2 * 80)
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_by_bytes(d.repartition(3), 7, part_rows=100).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_repeated_rows_are_split(spark):
    d = spark.createDataFrame([(1, "copy")] * 900 + [(i, f"t{i}") for i in range(900)], "doc_id long, text string").unionByName(spark.createDataFrame([(None, None)] * 50, "doc_id long, text string"))
    check(sharding.shard_by_bytes(d, 5).collect(), d.collect(), 5, 60)


def test_odd_rows(odd_docs):
    rows = sharding.shard_by_bytes(odd_docs, 4).collect()
    check(rows, odd_docs.collect(), 4, 60_000)
    assert sharding.shard_by_bytes(odd_docs.limit(0), 4).count() == 0
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
