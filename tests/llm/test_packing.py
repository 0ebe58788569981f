import random
from collections import Counter, defaultdict

from ledgerline.llm import packing


def check(rows, docs, permitted):
    bins = defaultdict(list)
    by_doc = Counter()
    for r in rows:
        assert 1 <= r.length <= permitted[-1] and r.start == r.piece * permitted[-1]
        bins[r.bin_id].append(r)
        by_doc[r.doc_id] += r.length
    want = Counter()
    for d in docs:
        want[d.doc_id] += len(d.text or "") + 1
    assert by_doc == want  # nothing is lost or placed twice
    for b in bins.values():
        assert len({r.bin_length for r in b}) == 1 and b[0].bin_length in permitted
        at = 0
        for r in sorted(b, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert at <= b[0].bin_length and not any(at <= c < b[0].bin_length for c in permitted)
    return bins


def test_pieces_fill_bins(spark, odd_docs):
    permitted = (16, 64, 256)
    rows = packing.pack(odd_docs, permitted, 10).collect()
    check(rows, odd_docs.collect(), permitted)
    assert packing.pack(odd_docs.limit(0)).count() == 0
    check(packing.pack(odd_docs).collect(), odd_docs.collect(), packing.LENGTHS)


def naive(sizes, permitted, largest):
    """Best fit by looking at every bin for every piece."""
    bins, where, left = [], [], sum(sizes)
    for s in sizes:
        open_ = [(free, b) for b, (free, _) in enumerate(bins) if free >= s]
        if open_:
            _, b = min(open_)
        else:
            fit = [c for c in permitted if c >= s]
            fit = [c for c in fit if c <= largest] or fit[:1]
            b = len(bins)
            bins.append([min(fit, key=lambda c: packing.cost(c) / min(c, left)), 0])
        where.append((b, bins[b][1]))
        bins[b][0] -= s
        bins[b][1] += s
        left -= s
    return where, [min(c for c in permitted if c >= used) for _, used in bins]


def test_query_matches_brute_force(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, "x" * rng.choice([rng.randint(0, 40), rng.randint(0, 200)])) for i in range(300)], "doc_id long, text string")
    permitted = (16, 32, 64)
    got = packing.pack(docs, permitted, 10_000).collect()  # one group
    sizes = sorted((r.length for r in got), reverse=True)
    where, lengths = min((naive(sizes, permitted, c) for c in permitted), key=lambda p: sum(map(packing.cost, p[1])))
    want = Counter((s, lengths[b], at) for s, (b, at) in zip(sizes, where, strict=True))
    assert Counter((r.length, r.bin_length, r.bin_offset) for r in got) == want


def test_sequences_hold_every_text(spark, odd_docs):
    permitted = (16, 64, 256)
    bins = packing.sequences(odd_docs, permitted, 10, end="\x03").collect()
    assert all(len(b.text) <= b.bin_length for b in bins)
    src = [(d.text or "") + "\x03" for d in odd_docs.collect()]
    whole = [t for t in src if len(t) <= 256]
    said = "".join(b.text for b in bins)
    assert len(said) == sum(map(len, src)) and Counter(said) == Counter("".join(src)) and all(any(t in b.text for b in bins) for t in whole)
    assert packing.sequences(odd_docs.limit(0)).count() == 0


def test_bins_are_nearly_full():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 5000) for _ in range(4000)), reverse=True)
    _, _, lengths = packing.plan(sizes, packing.LENGTHS)
    assert sum(sizes) >= 0.98 * sum(lengths)


def test_plan_is_cheapest_of_the_permitted_lengths():
    rng = random.Random(6)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(1, 40))), reverse=True)
        permitted = (16, 32, 64)
        best = sum(map(packing.cost, packing.plan(sizes, permitted)[2]))
        assert best == min(sum(map(packing.cost, packing.best_fit(sizes, permitted, c)[2])) for c in permitted)
