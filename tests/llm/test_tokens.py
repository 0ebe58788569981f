import random
import re
from collections import Counter

from ledgerline.llm import tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def greedy(word: bytes, vocabulary: set[bytes], longest: int) -> int:
    n = i = 0
    while i < len(word):
        i += next(k for k in range(min(longest, len(word) - i), 0, -1) if word[i : i + k] in vocabulary)
        n += 1
    return n


def brute(text, vocabulary, longest):
    words = WORD.findall(text or "")
    return len((text or "").encode()), len(words), sum(greedy(b" " + w.encode(), vocabulary, longest) for w in words)


def test_automaton_equals_greedy_on_small_vocabularies():
    rng = random.Random(2)
    for _ in range(30):
        v = {bytes([b]) for b in range(256)} | {bytes(rng.choices(b" ab", k=rng.randint(2, 6))) for _ in range(25)}
        a = tokens.Automaton(sorted(v))
        for _ in range(50):
            w = bytes(rng.choices(b"ab", k=rng.randint(0, 30)))
            assert a.one(b" " + w) == greedy(b" " + w, v, 6)


def test_counts_match_brute_force(odd_docs):
    v = set(tokens.read_vocabulary())
    longest = max(map(len, v))
    got = Counter(tuple(r) for r in tokens.count_tokens(odd_docs).collect())
    assert got == Counter((r.doc_id, *brute(r.text, v, longest)) for r in odd_docs.collect())
    assert tokens.count_tokens(odd_docs.limit(0)).count() == 0


def test_registered_counts_match_their_sql(spark, tmp_path, odd_docs):
    import duckdb
    from ledgerline.llm import queries

    odd_docs.select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = db.execute(queries.oracle_sql()["base_token_counts"]).fetchall()
    got = queries.queries()["base_token_counts"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_words"]
    assert Counter(map(tuple, got.collect())) == Counter(want)
