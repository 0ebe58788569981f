"""Personal data, with DataFrame operations only.

Regular expressions propose spans, checksums confirm them, and words near a span move its score.

* Base kinds (email, ip, card, phone) are decided by pattern and check alone; a score never removes them.
* Added kinds: ``iban`` (mod-97; the country code gives the length, a code without a known one the longest run), ``ssn`` (valid number areas and a context word), ``local_phone`` (10 digits
  without a plus sign and a context word). An added span is kept if its score reaches ``min_score``.

The patterns are written so that a long run of one character class is scanned once (possessive repeats, and a start
only where a run starts), which keeps time linear in the text. A span's place comes from the lengths of the pieces
that split() leaves between the matches of the same pattern, so a text is never indexed character by character.
Prefix sums over those lengths go by blocks, which keeps texts with very many spans near linear.

Edge cases: a null text counts as empty and has no spans; rows are handled one by one, so null or repeated doc_ids
and repeated rows don't matter; spans of different kinds may overlap, and of ties in the start the kind listed first comes
first; a very long text is one row and is scanned whole; an empty table gives an empty one; columns beyond those named are not
read, and redact() returns them whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
#: Country codes by the length of their IBANs.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(IBAN.values()).replace(" ", "|")
_FIXED = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())
_LOCAL = "[A-Za-z0-9._%+-]"
_SEP = r"[\x20().-]"
PATTERNS = {
    "email": rf"(?:{_LOCAL}(?<!{_LOCAL}{_LOCAL})|\G{_LOCAL}){_LOCAL}*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": rf"\+[0-9](?:{_SEP}*+[0-9]){{9,14}}+(?!{_SEP}*+[0-9])",
    "iban": rf"\b(?=[A-Z]{{2}}[0-9]{{2}})(?:{_FIXED}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b(?!-)",
    "local_phone": rf"(?<![0-9+])\(?[0-9]{{3}}\)?[\x20.-][0-9]{{3}}[\x20.-][0-9]{{4}}\b",
}
#: A text without this character class can't hold the kind.
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login)\b",
    "card": r"(?i)\b(?:card|visa|credit|payment|tarjeta|carte|karte)\b",
    "phone": r"(?i)\b(?:tel|phone|call|fax|mobile|telefon|tel[eé]fono)\b",
    "iban": r"(?i)\b(?:iban|bank|account|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social|security|taxpayer)\b",
    "local_phone": r"(?i)\b(?:tel|phone|call|fax|mobile|telefon|tel[eé]fono)\b",
}
#: Score in hundredths before context: a passed checksum or full pattern stands alone, a bare number form doesn't.
PRIOR = {"email": 80, "ip": 70, "card": 90, "phone": 70, "iban": 90, "ssn": 40, "local_phone": 40}
CONTEXT_GAIN, CONTEXT_CHARS = 20, 40
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
BLOCK = 64


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    n = F.length(digits)

    def add(acc, i):
        d = F.ascii(F.substring(digits, n - i, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Does an IBAN without blanks pass ISO 7064 mod 97-10?"""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def add(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def passes(kind: str, m: Column) -> Column:
    """The check that confirms a match."""
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return luhn(F.translate(m, " -", ""))
    if kind == "iban":
        return mod97(F.translate(m, " ", ""))
    if kind == "ssn":
        return m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)")
    return F.lit(True)


def starts(pieces: Column, matches: Column) -> Column:
    """0-based code point at which each match begins."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  evaluates x one time
    blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int"))

    def ends(steps: Column, sums: Column) -> Column:
        def block(b: Column) -> Column:
            own = F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))
            before = total(F.slice(sums, F.lit(1), b))
            return once(before, lambda z: F.transform(own, lambda x, i: z + total(F.slice(steps, b * BLOCK + 1, i)) + x))

        return F.flatten(F.transform(blocks, block))

    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))
    of = lambda st: once(F.transform(blocks, lambda b: total(F.slice(st, b * BLOCK + 1, F.lit(BLOCK)))), lambda sums: ends(st, sums))
    return F.zip_with(once(steps, of), matches, lambda e, m: e - F.length(m))


def confirmed(kind: str, matches: Column, pieces: Column, at: Column) -> Column:
    """Spans of one kind that pass its check, with scores."""

    def one(x: Column, i: Column) -> Column:
        near = F.concat(F.substring(F.get(pieces, i), -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "), F.substring(F.get(pieces, i + 1), 1, CONTEXT_CHARS))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0)
        span = F.struct(x["a"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (x["a"] + F.length(x["m"])).alias("end"), score.alias("score"), F.lit(kind).alias("kind"))
        return F.when(passes(kind, x["m"]), span)

    return F.array_compact(F.transform(F.arrays_zip(matches.alias("m"), at.alias("a")), one))


def with_spans(docs: DataFrame, min_score: int = 60, out: str = "__spans", text: str = "text") -> DataFrame:
    """docs, none of whose names begin with two underscores, with an array of (start, rank, end, score, kind), in order; offsets are code points, ends exclusive.

    Matches, pieces and places are columns of their own stages, so each is computed once a row."""
    text = F.coalesce(F.col(text), F.lit(""))
    m, p, a, s = ({k: f"__{c}_{k}" for k in KINDS} for c in "mpas")
    found = lambda k: F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))
    has = lambda k: F.size(F.coalesce(F.col(m[k]), F.array())) > 0
    df = docs.withColumns({m[k]: F.when(text.contains(NEEDS[k]), found(k)) if k in NEEDS else found(k) for k in KINDS})
    df = df.withColumns({p[k]: F.when(has(k), F.split(text, PATTERNS[k], -1)) for k in KINDS})
    df = df.withColumns({a[k]: F.when(has(k), starts(F.col(p[k]), F.col(m[k]))) for k in KINDS})
    df = df.withColumns({s[k]: F.when(has(k), confirmed(k, F.col(m[k]), F.col(p[k]), F.col(a[k]))) for k in KINDS})
    none = F.array().cast("array<struct<start:int,rank:int,end:int,score:int,kind:string>>")
    keep = lambda k: F.coalesce(F.col(s[k]) if k in BASE else F.filter(F.col(s[k]), lambda x: x["score"] >= min_score), none)
    df = df.withColumn(out, F.array_sort(F.concat(*map(keep, KINDS))))
    return df.drop(*m.values(), *p.values(), *a.values(), *s.values())


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(docs: DataFrame, min_score: int = 60) -> DataFrame:
    """doc_id, counts and digests of the spans of every row."""
    df = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_score)
    spans = F.col("__spans")
    base = F.filter(spans, lambda x: x["rank"] < len(BASE))
    count = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select("doc_id", *map(count, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"), *map(count, KINDS[4:]), F.array_join(F.transform(spans, lambda x: x["score"].cast("string")), ",").alias("scores"))


def redact(docs: DataFrame, min_score: int = 60) -> DataFrame:
    """docs with each span replaced by its kind in brackets; overlapping spans become one. n_chars follows the text."""
    # columns by position while spans are added, so that no name can clash
    plain = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: plain[i] for i, c in enumerate(docs.columns)}
    text = F.col(at["text"])
    df = with_spans(docs.toDF(*plain), min_score, text=at["text"])
    spans = F.col("__spans")

    # cover: disjoint pieces (start, end, kind), overlapping spans joined under the first one's kind
    def cover(acc: Column, x: Column) -> Column:
        return F.when(x["start"] < acc["end"], F.struct(acc["out"].alias("out"), acc["start"].alias("start"), F.greatest(acc["end"], x["end"]).alias("end"), acc["kind"].alias("kind"))).otherwise(
            F.struct(F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"), acc["kind"].alias("kind")))).alias("out"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
        )

    zero = F.struct(F.array().cast("array<struct<start:int,end:int,kind:string>>").alias("out"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind"))
    joined = F.aggregate(spans, zero, cover, lambda acc: F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"), acc["kind"].alias("kind")))))
    df = df.withColumn("__cover", F.when(F.size(spans) > 0, joined))
    after = lambda x, i: F.coalesce(F.get(F.col("__cover"), i + 1)["start"], F.length(text))
    tag = lambda x: F.when(x["kind"] == "", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
    clean = F.array_join(F.transform(F.col("__cover"), lambda x, i: F.concat(tag(x), F.substring(text, x["end"] + 1, after(x, i) - x["end"]))), "")
    df = df.withColumn(at["text"], F.when(F.size(spans) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        n = F.col(at["n_chars"])
        df = df.withColumn(at["n_chars"], F.when(F.size(spans) > 0, F.length(at["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(n))
    return df.select(*plain).toDF(*docs.columns)
