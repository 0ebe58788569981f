import hashlib
import random
import re

import pytest

from ledgerline.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pat) in enumerate(BASE.items()):
        for m in re.finditer(pat, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


CASES = [
    None, "", "a@b.c@d.e", "x@y", "a@b.c%q@d.e.f", "😀 mail me@x-y.org, né@ñ.es", "1.2.3.4.5.6.7.8 300.1.2.3.4 000255.1.1.1 256.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 9", "1 2 4111111111111111", "4111  1111 1111 1111", "card 4111111111111111 x 79927398713",
    "+49 (30) 1234-5678 90 and +1.2.3.4 555 555 5555 9", "++1 234 567 8901", "+1 (743) 555-3824", "+123456789012345 6", "+1234567890.",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 not DE89370400440532013001", "ssn 123-45-6789, 000-12-3456; code 123-45-6789",
    "call (555) 123-4567", "nothing 555-123-4567", "a" * 20000 + " " + "1" * 20000, "a@" + "b." * 3000 + "c", "+1" + " " * 5000, "u@h.io " * 300 + "10.0.0.1 " * 200,
    "10.0.0.1 2345 6789 0123 4 4111111111111111.5.6.7",
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    noise = ["".join(rng.choices("0123456789 -.+()@aé_%", [6] * 10 + [4, 2, 3, 1, 1, 1, 1, 2, 1, 1, 1], k=rng.randint(5, 120))) for _ in range(400)]
    d = spark.createDataFrame(list(enumerate(CASES + noise)), "doc_id long, text string")
    return {r.doc_id: r for r in pii.digest(d).collect()}, CASES + noise


def test_base_spans_match_brute_force(rows):
    got, texts = rows
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in want).encode()).hexdigest(), (t, got[i].spans, want)
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x[3] == k for x in want) for k in BASE]


def test_added_kinds_need_check_or_context(rows):
    got, _ = rows
    assert got[17].spans == "iban:5:32,iban:37:59"
    assert got[17].n_iban == 2
    assert got[18].spans.startswith("ssn:4:15") and "ssn:17" not in got[18].spans
    assert got[19].spans == "local_phone:5:19" and got[20].spans == ""


def test_redaction_leaves_nothing(spark, odd_docs):
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(CASES)], "doc_id long, text string, lang string, source string, n_chars long")
    out = pii.redact(d)
    assert out.columns == d.columns
    for r in out.collect():
        assert not brute(r.text), r.text
    assert out.filter("doc_id = 14").first().text == "[PHONE]" and out.filter("doc_id = 14").first().n_chars == 7
    assert out.filter("doc_id = 5").first().text == "😀 mail [EMAIL], né@ñ.es"
    same = pii.redact(odd_docs)
    assert same.columns == odd_docs.columns and same.count() == odd_docs.count()
    assert pii.digest(odd_docs).count() == odd_docs.count() and pii.digest(odd_docs.limit(0)).count() == 0


def test_ibans_before_capitals_and_numbers(spark):
    texts = ["IBAN DE89370400440532013000 Please pay", "GB82 WEST 1234 5698 7654 32 The", "DE89370400440532013000 12 items", "NO9386011117947 A 1", "DE89370400440532013000X", "MT84MALT011000012345MTLCAST001S DE89370400440532013000 FR1420041010050500013M02606 OK"]
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.spans for r in pii.digest(d).collect()}
    assert got == {0: "iban:5:27", 1: "iban:0:27", 2: "iban:0:22", 3: "iban:0:15", 4: "", 5: "iban:0:31,iban:32:54,iban:55:82"}
    assert pii.redact(d).filter("doc_id = 2").first().text == "[IBAN] 12 items"
