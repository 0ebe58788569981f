"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = table(spark, sf_dir, "documents")
    return quality.annotate(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding

    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    return pii.digest(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import tokens

    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language

    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.pack(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring_dedup

    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op5_order_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dedup

    return near_dedup.digest(table(spark, sf_dir, "documents"))


def op7_kneser_ney_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lm

    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vector_codes

    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import whitening

    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk_search

    return topk_search.digest(table(spark, sf_dir, "embeddings"))


# ---- companions: the base columns of the queries above, which SQL can express


def base_pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base kinds found in every text."""
    return op2_pii_spans(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and words of every text."""
    return op6_token_counts(spark, sf_dir).select("doc_id", "n_bytes", "n_words")


def base_lm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents were held out, and their tokens."""
    return op7_kneser_ney_lm(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")


def base_shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document weighs."""
    return op8_histogram_sort_shards(spark, sf_dir).select("doc_id", "size", "law")


def base_shard_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all shards, and those of shards with a gap or a repeat in their slots, or over 1.05 times an even share and a
    text's own size."""
    from pyspark.sql import functions as F

    s = op8_histogram_sort_shards(spark, sf_dir)
    each = s.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("hi"), F.min("slot").alias("lo"), F.sum("size").alias("b"), F.max("size").alias("one"))
    even = each.agg((F.sum("b") / 40).alias("even"))
    bad = (F.col("n") != F.col("d")) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.abs(F.col("b") - F.col("even")) > 0.05 * F.col("even") + F.col("one"))
    return each.join(F.broadcast(even), F.lit(True)).agg(F.sum("n").alias("rows"), F.count_if(bad).alias("bad_shards"), F.max("shard").alias("last_shard"))


def base_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the base rule of every text."""
    return op10_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base_whitening_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the fit list and exact deviation of every row, and how far the components are from what whitening means."""
    from pyspark.sql import functions as F

    w = op12_embedding_whitening(spark, sf_dir)
    return w.select("vec_id", "component", "n", "deviation", (F.col("identity_error") <= 1e-4).alias("white"))


_COUNTS = "embedding IS NOT NULL AND NOT coalesce(list_bool_or(list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c))), false)"


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds one after another: book<r> holds every part's entries, near<r> each part's nearest one."""
    near = """near{r} AS MATERIALIZED (SELECT vec_id, p, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d
FROM (SELECT x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN book{r} b USING (p)) GROUP BY 1, 2)"""
    book = """book{n} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
SELECT x.p, near{r}.e, u.i, sum(x.v[u.i])::BIGINT AS s, count(*) AS n FROM x JOIN near{r} USING (vec_id, p), (SELECT unnest(range(1, (SELECT max(len(v)) FROM x) + 1)) AS i) u GROUP BY 1, 2, 3) GROUP BY 1, 2) m USING (p, e))"""
    steps = ",\n".join(near.format(r=r) + ",\n" + book.format(r=r, n=r + 1) for r in range(rounds))
    return f"""WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS x FROM embeddings WHERE {_COUNTS}),
x AS MATERIALIZED (SELECT vec_id, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS v FROM k, (SELECT unnest(range({parts})) AS p)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k),
book0 AS MATERIALIZED (SELECT x.p, f.e, x.v FROM x JOIN f USING (vec_id) WHERE f.e < {entries}),
{steps},
{near.format(r=rounds)},
c AS (SELECT k.vec_id, k.label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} JOIN k USING (vec_id) GROUP BY 1, 2),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, s.h AS codebooks_sha256 FROM c, s"""


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN {_DIGITS}[length({_DIGITS}) - i]::INTEGER WHEN {_DIGITS}[length({_DIGITS}) - i]::INTEGER > 4 THEN {_DIGITS}[length({_DIGITS}) - i]::INTEGER * 2 - 9 ELSE {_DIGITS}[length({_DIGITS}) - i]::INTEGER * 2 END)) % 10 = 0"
_SQL = {
    "op11_vector_codes": _codes_sql(),
    "op13_exact_top_k": f"""WITH k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings WHERE vec_id IS NOT NULL AND {_COUNTS}),
s AS (SELECT q.vec_id AS query_id, k.vec_id, list_inner_product(q.x, k.x)::BIGINT AS score FROM k q JOIN k ON q.vec_id % 100 = 0 AND k.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "base_whitening_deviations": f"""WITH k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings WHERE {_COUNTS}),
f AS MATERIALIZED (SELECT DISTINCT x FROM k), n AS (SELECT count(*) AS n, max(len(x)) AS d FROM f),
s AS (SELECT list(s ORDER BY i) AS s FROM (SELECT u.i, sum(x[u.i])::BIGINT AS s FROM f, (SELECT unnest(range(1, d + 1)) AS i FROM n) u GROUP BY 1))
SELECT vec_id, c::INTEGER AS component, n, list_sum(list_transform(list_zip(x, s), lambda z: (n * z[1] - z[2]) * (n * z[1] - z[2])))::BIGINT AS deviation, true AS white FROM k, n, s, (SELECT unnest(range(1, 5)) AS c)""",
    "base_pii_counts": rf"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'))::BIGINT AS n_email,
len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda m: list_max(list_transform(string_split(m, '.'), lambda p: p::DOUBLE)) <= 255))::BIGINT AS n_ip,
len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9]([\x20-]?[0-9])+'), lambda m: length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}))::BIGINT AS n_card,
len(list_filter(regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length({_DIGITS}) BETWEEN 10 AND 15))::BIGINT AS n_phone FROM documents""",
    "base_token_counts": f"SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes, len({_WORDS})::BIGINT AS n_words FROM documents",
    "base_lm_counts": rf"""WITH k AS (SELECT {_CRC_TABLE} AS t), d AS (SELECT doc_id, {_CRC} % 7 = 2 AS held, list_append(regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+'), '</s> ') AS w FROM documents, k),
v AS (SELECT x, count(*) AS c FROM (SELECT unnest(w) AS x FROM d WHERE NOT held) GROUP BY 1), n AS (SELECT coalesce(sum(c), 0)::BIGINT AS n FROM v),
s AS (SELECT d.doc_id, count(v.x)::BIGINT AS known FROM (SELECT doc_id, unnest(w) AS x FROM d) d LEFT JOIN v USING (x) GROUP BY 1)
SELECT d.doc_id, held AS held_out, len(w)::BIGINT AS n_tokens, known AS n_known, n AS train_tokens FROM d JOIN s USING (doc_id), n""",
    "base_shard_sizes": "SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 16 AS size, 'bytes' AS law FROM documents",
    "base_shard_slots": "SELECT count(*)::BIGINT AS rows, 0::BIGINT AS bad_shards, 39 AS last_shard FROM documents",
    "base_quality_counts": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM r) GROUP BY 1),
l AS (SELECT doc_id, sum(c - 1)::BIGINT AS n FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines,
coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(w) < 20 OR 100 * coalesce(p.n, 0) > 30 * len(w) AS base_failed FROM d LEFT JOIN p USING (doc_id) LEFT JOIN l USING (doc_id)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith(("op", "base_")) and callable(v)}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
