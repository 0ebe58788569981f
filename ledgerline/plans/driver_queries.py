"""Queries over the driver's tables, and their SQL. Each applies operators of this package to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import lookups, schedule, scoring, text as X, urls
from ..operators import consolidate as D, fuzzy, merge, ranking, relational as R, review
from . import model as M
from .model import table
from .registry import QUERIES, SQL, Query, query



def queries() -> dict[str, Query]:
    from . import listing_queries, page_queries, source_queries  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


# ---- joins


@query(f"""
SELECT c.source_id, c.source_record_id, c.name FROM ({M.CUSTOMERS}) c JOIN ({M.SOURCES}) s ON c.source_id = s.id
WHERE c.status = 'active' AND s.config NOT LIKE '%snapshot_excluded%'
AND NOT EXISTS (SELECT 1 FROM ({M.ORDER_FLAGS}) f WHERE f.source_id = c.source_id AND f.source_record_id = c.source_record_id AND f.status = 'open' AND f.severity = 'error')""")
def snapshot_eligible(spark: SparkSession, d: str) -> DataFrame:
    return R.eligible(M.customers(spark, d), M.sources(spark, d), M.order_flags(spark, d)).select("source_id", "source_record_id", "name")


@query("""
SELECT 'rec-' || c_custkey AS source_record_id, string_agg(o, '|' ORDER BY o) AS occurrences, count(o)::BIGINT AS n FROM customer LEFT JOIN
(SELECT o_custkey, dayofweek(o_orderdate) || '@' || lpad((o_orderkey % 1440)::VARCHAR, 4, '0') AS o FROM orders WHERE o_orderstatus = 'O') ON o_custkey = c_custkey GROUP BY c_custkey""")
def occurrence_explode_nest(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences nested into their listings, and unnested again to count them."""
    keys = ["source_record_id"]
    o = table(spark, d, "orders").filter("o_orderstatus = 'O'")
    occ = o.select(F.concat(F.lit("rec-"), "o_custkey").alias("source_record_id"), M.day_of_week(F.col("o_orderdate")).alias("day_of_week"), (F.col("o_orderkey") % 1440).cast("int").alias("start_minute"), F.lit(None).cast("int").alias("end_minute"), F.lit("UTC").alias("timezone"))
    nested = R.nest_occurrences(M.customers(spark, d).select(*keys), occ, keys)
    n = R.unnest_occurrences(nested, keys).groupBy(*keys).agg(F.count("*").alias("n"))
    line = F.array_join(F.transform("occurrences", lambda x: F.concat(x["day_of_week"].cast("string"), F.lit("@"), F.lpad(x["start_minute"].cast("string"), 4, "0"))), "|")
    return nested.join(n, keys, "left").select("source_record_id", F.nullif(line, F.lit("")).alias("occurrences"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""
SELECT source_id, source_record_id FROM ({M.CUSTOMERS}) c WHERE EXISTS (SELECT 1 FROM ({M.ORDER_FLAGS}) f WHERE f.source_id = c.source_id AND f.source_record_id = c.source_record_id AND f.status = 'open')
AND EXISTS (SELECT 1 FROM orders WHERE 'rec-' || o_custkey = c.source_record_id AND o_orderkey % 5 = 0)""")
def flagged_in_zone(spark: SparkSession, d: str) -> DataFrame:
    """Listings with an open flag and an occurrence in the fall-back zone."""
    flags = M.order_flags(spark, d).withColumn("code", F.lit("missing_timezone"))
    c = M.customers(spark, d)
    o = table(spark, d, "orders").select(F.concat(F.lit("rec-"), "o_custkey").alias("source_record_id"), F.when(F.col("o_orderkey") % 5 == 0, "UTC").otherwise("Europe/Rome").alias("timezone"))
    return R.with_flag(c, flags, o.join(c.select("source_id", "source_record_id"), "source_record_id"), "missing_timezone", "UTC").select("source_id", "source_record_id")


_ACTIVE = "SELECT o_custkey AS source, count(*)::BIGINT AS total, count(*) FILTER (o_orderstatus = 'O')::BIGINT AS active FROM orders GROUP BY 1"


@query(_ACTIVE)
def active_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.active_counts(table(spark, d, "orders").withColumnRenamed("o_custkey", "source"), "source", F.col("o_orderstatus") == "O")


@query(f"SELECT * FROM ({_ACTIVE}) ORDER BY active DESC, source LIMIT 25")
def active_counts_topk(spark: SparkSession, d: str) -> DataFrame:
    return active_counts(spark, d).orderBy(F.desc("active"), "source").limit(25)


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-04-01')")
def zero_active_sources(spark: SparkSession, d: str) -> DataFrame:
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    o = table(spark, d, "orders").filter((F.col("o_orderdate") >= day("2001-01-01")) & (F.col("o_orderdate") < day("2001-04-01")))
    return R.without_active(table(spark, d, "customer"), o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "c_name")


@query("""SELECT c_custkey, coalesce(n, 0)::BIGINT AS meetings, coalesce(n, 0) > 0 AS protected FROM customer LEFT JOIN
(SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1) ON o_custkey = c_custkey WHERE c_acctbal < 0""")
def protected_sources(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("c_custkey"))
    return R.protected(table(spark, d, "customer").filter("c_acctbal < 0").select("c_custkey"), o, "c_custkey")


_URL = "regexp_extract(url, '^([a-zA-Z]+)://([^/?#]*)([^?#]*)[?]?([^#]*)', {})"
_NORMAL = (
    f"lower({_URL.format(1)}) || '://' || lower({_URL.format(2)}) || CASE WHEN rtrim({_URL.format(3)}, '/') = '' THEN '/' ELSE rtrim({_URL.format(3)}, '/') END || "
    f"CASE WHEN {_URL.format(4)} = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split({_URL.format(4)}, '&')), '&') END"
)


@query(f"SELECT page_id, {_NORMAL} AS normalized_url FROM pages")
def normalized_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("normalized_url"))


@query(f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'aa' ELSE 'na' END || '-' || substr(sha1({_NORMAL}), 1, 12) AS source_id FROM pages")
def source_ids(spark: SparkSession, d: str) -> DataFrame:
    f = F.when(F.col("page_id") % 2 == 0, "aa").otherwise("na")
    return table(spark, d, "pages").select("page_id", urls.source_id(f, F.col("url")).alias("source_id"))


_PLAIN = f"lower({_URL.format(1)}) || '://' || lower({_URL.format(2)}) || rtrim({_URL.format(3)}, '/')"


@query(f"WITH p AS (SELECT page_id, {_PLAIN} AS u FROM pages) SELECT w.page_id, w.u AS normalized_url FROM p w WHERE w.page_id % 2 = 0 AND EXISTS (SELECT 1 FROM p l WHERE l.page_id % 2 = 1 AND l.u = w.u)")
def shadowed_listings(spark: SparkSession, d: str) -> DataFrame:
    """Pages of one half whose address (without query) the other half has too."""
    return _shadow(spark, d, R.shadowed)


@query(f"WITH p AS (SELECT page_id, {_PLAIN} AS u FROM pages) SELECT w.page_id, w.u AS normalized_url FROM p w WHERE w.page_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM p l WHERE l.page_id % 2 = 1 AND l.u = w.u)")
def unshadowed_listings(spark: SparkSession, d: str) -> DataFrame:
    return _shadow(spark, d, R.unshadowed)


def _shadow(spark: SparkSession, d: str, how: Callable) -> DataFrame:
    bare = F.regexp_replace(urls.normalize_url(F.regexp_replace("url", r"[?#].*$", "")), "(?<!:/)/$", "")
    p = table(spark, d, "pages").select("page_id", bare.alias("normalized_url"))
    return how(p.filter("page_id % 2 = 0"), p.filter("page_id % 2 = 1")).select("page_id", "normalized_url")


@query("""SELECT l_suppkey, count(*)::BIGINT AS records, bool_or(l_returnflag = 'R') AS listed, count(DISTINCT l_partkey)::BIGINT AS bodies,
count(*) >= 620 OR (count(*) >= 590 AND bool_or(l_returnflag = 'R')) AS too_broad, count(*) >= 600 AND count(DISTINCT l_partkey) >= 3 AS fallback_too_broad FROM lineitem GROUP BY 1""")
def breadth_guard(spark: SparkSession, d: str) -> DataFrame:
    return R.broad_sources(table(spark, d, "lineitem"), "l_suppkey", F.col("l_partkey"), F.col("l_returnflag") == "R", many=620, some=590, fallback=600)


@query("SELECT doc_id, sha AS content_hash FROM (SELECT doc_id, sha256(text) AS sha, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents WHERE doc_id % 2 = 1) b WHERE rn = 1 AND sha NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)")
def content_hash_insert(spark: SparkSession, d: str) -> DataFrame:
    """A batch of which only contents not stored yet are added."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    batch = ranking.first_wins(docs.filter("doc_id % 2 = 1"), ["content_hash"], ["doc_id"])
    return R.new_rows(batch, docs.filter("doc_id % 2 = 0"), ["content_hash"]).select("doc_id", "content_hash")


@query("SELECT a.event_type, a.user_id FROM (SELECT DISTINCT event_type, user_id FROM events) a WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = a.user_id AND e.event_type = a.event_type AND e.ts >= TIMESTAMP '2024-01-20')")
def unseen_records(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    keys = ["event_type", "user_id"]
    return R.unseen(e.select(*keys).distinct(), e.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")), keys)


@query("SELECT user_id, event_type, count(*)::BIGINT AS n FROM (SELECT *, min(rk) OVER (PARTITION BY user_id) AS best FROM (SELECT *, CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS rk FROM events)) WHERE rk = best GROUP BY 1, 2")
def first_productive_extractor(spark: SparkSession, d: str) -> DataFrame:
    """A union that stops at the first kind with any row."""
    rank = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).otherwise(4)
    e = table(spark, d, "events").withColumn("rk", rank)
    return R.first_productive(e, "user_id", "rk").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


# ---- consolidation

_KEYED = f"WITH p AS ({M.PART_KEYS}), k AS (SELECT *, CASE WHEN name_key IS NULL THEN 'alone' || pos ELSE fellowship || '/' || name_key || '/' || full_key END AS gk FROM p), o AS (SELECT DISTINCT * FROM ({M.PART_OCCURRENCES}))"
_CONSOLIDATED = f"""{_KEYED},
scored AS (SELECT k.*, (CASE WHEN venue_name IS NULL THEN 0 ELSE 1 END) + 2 + coalesce(n, 0) + (CASE WHEN last_verified_at IS NULL THEN 0 ELSE 1 END) AS score FROM k LEFT JOIN (SELECT pos, count(*) AS n FROM o GROUP BY 1) USING (pos)),
prim AS (SELECT *, row_number() OVER (PARTITION BY gk ORDER BY score DESC, source_id, source_record_id, pos) AS rn FROM scored),
names AS (SELECT gk, trim(name) AS nm, count(*) AS c, min(pos) AS fp FROM k GROUP BY 1, 2),
best AS (SELECT gk, nm, row_number() OVER (PARTITION BY gk ORDER BY c DESC, length(regexp_replace(nm, '[^A-Z]', '', 'g')) * 0, length(nm), lower(nm), fp) AS rn FROM names),
occ AS (SELECT gk, string_agg(s, '|' ORDER BY dow, start_minute, e, tz) AS occurrences, count(*) AS n_occ FROM (SELECT DISTINCT gk, dow, start_minute, coalesce(end_minute, 1440) AS e, tz, dow || ',' || start_minute || ',' || coalesce(end_minute::VARCHAR, '') || ',' || tz AS s FROM k JOIN o USING (pos)) GROUP BY 1),
fmt AS (SELECT gk, string_agg(f, ',' ORDER BY lower(f), f) AS formats FROM (SELECT DISTINCT gk, unnest([CASE WHEN pos % 2 = 0 THEN 'Open' ELSE 'open' END, 'F' || (pos % 4)]) AS f FROM k) GROUP BY 1),
g AS (SELECT gk, count(*) AS n, min(pos) AS pos, max(last_verified_at) AS v, string_agg(source_record_id, ',' ORDER BY source_record_id) AS members FROM k GROUP BY 1)"""


def _line(spark: SparkSession, d: str) -> DataFrame:
    out = D.consolidate(M.parts(spark, d))
    occ = F.array_join(F.transform("occurrences", lambda o: F.concat_ws(",", o["day_of_week"].cast("string"), o["start_minute"].cast("string"), F.coalesce(o["end_minute"].cast("string"), F.lit("")), o["timezone"])), "|")
    return out.select(
        "pos", "fellowship", "source_id", "source_record_id", "name", F.array_join("formats", ",").alias("formats"), F.nullif(occ, F.lit("")).alias("occurrences"),
        F.col("last_verified_at").cast("string").alias("last_verified_at"), "n_members", F.array_join("member_ids", ",").alias("member_ids"),
    )


@query(f"""{_CONSOLIDATED}
SELECT g.pos, fellowship, source_id, source_record_id, best.nm AS name, CASE WHEN g.n = 1 AND prim.name_key IS NULL THEN CASE WHEN prim.pos % 2 = 0 THEN 'Open' ELSE 'open' END || ', F' || (prim.pos % 4) ELSE fmt.formats END AS formats,
occ.occurrences, CAST(g.v AS VARCHAR) AS last_verified_at, g.n::BIGINT AS n_members, g.members AS member_ids FROM g JOIN prim USING (gk) JOIN best USING (gk) JOIN fmt USING (gk) LEFT JOIN occ USING (gk) WHERE prim.rn = 1 AND best.rn = 1""")
def consolidate_meetings(spark: SparkSession, d: str) -> DataFrame:
    """One row for each semantic group of listings; rows without a key stay as they are."""
    return _line(spark, d)


@query(f"""{_KEYED}, s AS (SELECT fellowship, gk, name_key, count(*) AS c FROM k GROUP BY 1, 2, 3)
SELECT fellowship, sum(c)::BIGINT AS original, count(*) FILTER (name_key IS NOT NULL AND c > 1)::BIGINT AS semantic_groups, coalesce(sum(c - 1) FILTER (name_key IS NOT NULL), 0)::BIGINT AS removed FROM s GROUP BY 1""")
def duplicate_metrics(spark: SparkSession, d: str) -> DataFrame:
    return D.duplicate_metrics(M.parts(spark, d, with_occurrences=False)).select("fellowship", "original", "semantic_groups", F.col("removed").cast("long").alias("removed"))


@query(f"""{_KEYED} SELECT fellowship, count(*)::BIGINT AS groups FROM (SELECT fellowship, gk, dow, start_minute, end_minute, tz, count(*) AS c FROM k JOIN o USING (pos) WHERE name_key IS NOT NULL GROUP BY ALL) WHERE c > 1 GROUP BY 1""")
def exact_occurrence_groups(spark: SparkSession, d: str) -> DataFrame:
    return D.occurrence_groups(M.parts(spark, d))


@query("SELECT 0::BIGINT AS removed, 0.0::DOUBLE AS rate")
def consolidate_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """A second consolidation removes nothing."""
    p = M.parts(spark, d, with_occurrences=False).withColumn("occurrences", F.array().cast("array<struct<day_of_week:int,start_minute:int,end_minute:int,timezone:string>>"))
    return D.residual_rate(p, D.consolidate(p)).select("removed", F.col("rate").cast("double").alias("rate"))


@query(f"""{_KEYED}, s AS (SELECT gk, count(*) AS c, min(pos) AS pos FROM k WHERE name_key IS NOT NULL GROUP BY 1) SELECT pos AS first_pos, (c - 1)::BIGINT AS removed_count FROM s WHERE c > 1 ORDER BY pos LIMIT 20""")
def merge_examples(spark: SparkSession, d: str) -> DataFrame:
    """The first groups that merging joined."""
    keyed = D.with_semantic_key(M.parts(spark, d, with_occurrences=False)).filter("name_key is not null")
    groups = keyed.groupBy(*D.KEYS).agg(F.count("*").alias("c"), F.min("pos").alias("first_pos")).filter("c > 1")
    return groups.orderBy("first_pos").limit(20).select("first_pos", (F.col("c") - 1).alias("removed_count"))


@query("""SELECT user_id, nm AS display_name FROM (SELECT user_id, nm, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, odd, length(nm), lower(nm), fp, nm) AS rn FROM
(SELECT user_id, nm, count(*) AS c, min(event_id) AS fp, CASE WHEN nm LIKE '%X' THEN 1 ELSE 0 END AS odd FROM (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN event_type || 'X' ELSE event_type END AS nm FROM events) GROUP BY 1, 2)) WHERE rn = 1""")
def display_name_mode(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("nm", F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("X"))).otherwise(F.col("event_type")))
    return D.display_names(e, ["user_id"], "nm", "event_id")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderstatus, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def primary_row(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    best = F.struct((-F.col("o_totalprice")).alias("s"), F.col("o_orderstatus").alias("t"), F.col("o_orderkey").alias("k"))
    return o.groupBy("o_custkey").agg(F.min_by(F.struct("o_orderkey", "o_orderstatus"), best).alias("r")).select("o_custkey", "r.*")


@query("""SELECT l_orderkey, string_agg(f, ',' ORDER BY lower(f), f) AS formats FROM (SELECT DISTINCT l_orderkey, unnest([l_returnflag, lower(l_linestatus), l_linestatus]) AS f FROM lineitem) GROUP BY 1""")
def merge_formats(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("f", F.array("l_returnflag", F.concat(F.lit(" "), F.lower("l_linestatus")), F.col("l_linestatus"), F.lit("")))
    return li.groupBy("l_orderkey").agg(F.array_join(D.merged_formats(F.collect_list("f")), ",").alias("formats"))


@query(f"SELECT doc_id, {M.sql_key('substr(text, 1, 80)')} AS token_key, md5({M.sql_key('text')}) AS full_key_md5 FROM documents")
def dup_token_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.key_text(F.substring("text", 1, 80)).alias("token_key"), F.md5(X.key_text(F.col("text"))).alias("full_key_md5"))


@query(f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY {M.sql_key('text')} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins_dedupe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2(X.key_text(F.col("text")), 256).alias("k"))
    return ranking.first_wins(docs, ["k"], ["doc_id"]).select("doc_id", "source")


#: The token-set score of all pairs; a longest common subsequence row by row, for pairs that Levenshtein's distance doesn't rule out.
_FUZZY = """WITH r AS MATERIALIZED (SELECT pos, city, country, list_sort(list_distinct(list_filter(string_split(concat_ws(' ', name, venue, coalesce(city, ''), coalesce(country, '')), ' '), lambda x: x <> ''))) AS t FROM ({parts})),
p AS MATERIALIZED (SELECT a.pos AS a, b.pos AS b, array_to_string(list_sort(list_intersect(a.t, b.t)), ' ') AS s, array_to_string(list_filter(a.t, lambda x: NOT list_contains(b.t, x)), ' ') AS l, array_to_string(list_filter(b.t, lambda x: NOT list_contains(a.t, x)), ' ') AS r
FROM r a JOIN r b ON a.pos < b.pos AND (a.city IS NULL OR b.city IS NULL OR lower(a.city) = lower(b.city)) AND (a.country IS NULL OR b.country IS NULL OR lower(a.country) = lower(b.country))),
n AS MATERIALIZED (SELECT *, length(s) + (s <> '')::INT AS n, 2 * (length(s) + (s <> '')::INT) + length(l) + length(r) AS total FROM p),
whole AS (SELECT a, b, 100.0::DOUBLE AS score FROM n WHERE s <> '' AND (l = '' OR r = '')),
sub AS (SELECT a, b, greatest(100 - 100 * (1 + length(l))::DOUBLE / (length(s) + n + length(l)), 100 - 100 * (1 + length(r))::DOUBLE / (length(s) + n + length(r))) AS score FROM n WHERE s <> '' AND l <> '' AND r <> ''),
near AS MATERIALIZED (SELECT *, string_split(l, '') AS x, string_split(r, '') AS y FROM n WHERE l <> '' AND r <> '' AND 100 - 100 * levenshtein(l, r)::DOUBLE / total >= {least}),
lcs AS (WITH RECURSIVE step AS (SELECT a, b, 0 AS i, [0 FOR k IN range(length(r) + 1)] AS v FROM near
UNION ALL SELECT step.a, step.b, i + 1, list_reduce(list_prepend([0], [[q] FOR q IN range(1, len(y) + 1)]), lambda done, q: list_append(done, CASE WHEN x[i + 1] = y[q[1]] THEN v[q[1]] + 1 ELSE greatest(v[q[1] + 1], done[len(done)]) END)) FROM step JOIN near USING (a, b) WHERE i < len(x))
SELECT step.a, step.b, 100 - 100 * (length(l) + length(r) - 2 * v[len(v)])::DOUBLE / total AS score FROM step JOIN near USING (a, b) WHERE i = len(x))
SELECT a::VARCHAR AS left_id, b::VARCHAR AS right_id, max(score) AS score FROM (SELECT * FROM whole UNION ALL SELECT * FROM sub UNION ALL SELECT * FROM lcs) WHERE score >= {least} GROUP BY 1, 2"""
#: part as listings with words in common: a third has no city, another third no country.
_FUZZY_PARTS = """SELECT p_partkey AS pos, p_name AS name, p_brand || ' hall ' || p_size AS venue, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS city, CASE WHEN p_partkey % 3 < 2 THEN 'Country ' || (p_size % 5) END AS country FROM part"""


@query(_FUZZY.replace("{parts}", _FUZZY_PARTS).replace("{least}", "85"))
def fuzzy_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose texts have nearly the same words, where their places agree as far as they are known."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select(
        k.alias("pos"), k.cast("string").alias("source_record_id"), F.col("p_name").alias("name"), F.concat_ws(" hall ", "p_brand", F.col("p_size").cast("string")).alias("venue_name"),
        F.when(k % 3 > 0, F.col("p_type")).alias("city"), F.when(k % 3 < 2, F.concat(F.lit("Country "), F.col("p_size") % 5)).alias("country"),
    )
    return fuzzy.fuzzy_pairs(p, 85.0)


# ---- ranking and context


@query("SELECT user_id, event_id, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS rank FROM events) WHERE rank <= 5")
def top5_pages(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.top_k(table(spark, d, "events"), ["user_id"], [F.desc("value"), F.col("ts"), F.col("event_id")], 5)
    return out.select("user_id", "event_id", "value", F.col("rank").cast("long").alias("rank"))


@query("""SELECT user_id, event_type, event_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS rank FROM
(SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, ts, event_id) AS u FROM events) WHERE u = 1) WHERE rank <= 3""")
def top3_unique_pages(spark: SparkSession, d: str) -> DataFrame:
    """The best three of each user, one of each kind."""
    out = ranking.top_k(table(spark, d, "events"), ["user_id"], [F.desc("value"), F.col("ts"), F.col("event_id")], 3, unique="event_type")
    return out.select("user_id", "event_type", "event_id", F.col("rank").cast("long").alias("rank"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1")
def latest_artifact(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return ranking.latest(e, "user_id", [F.col("ts"), (-F.col("event_id")).alias("o")]).select("user_id", "event_id", "event_type")


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END NULLS LAST, o_orderkey LIMIT 40 OFFSET 100")
def offset_limit(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return ranking.batch(table(spark, d, "orders"), [key.asc_nulls_last(), "o_orderkey"], 100, 40).select("o_orderkey", "o_orderpriority")


@query("SELECT p_name, count(*)::BIGINT AS n, min(p_partkey) AS first_pos FROM part GROUP BY 1 ORDER BY n DESC, first_pos LIMIT 10")
def most_common_names(spark: SparkSession, d: str) -> DataFrame:
    return ranking.most_common(table(spark, d, "part"), "p_name", "p_partkey", 10)


_CONTEXT = "OVER (PARTITION BY conv_id ORDER BY turn{})"


@query(f"""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) {_CONTEXT.format(' ROWS UNBOUNDED PRECEDING')} AS last_user_len,
lag(role, 1) {_CONTEXT.format('')} AS prev_1, lag(role, 2) {_CONTEXT.format('')} AS prev_2, lead(role, 1) {_CONTEXT.format('')} AS next_1 FROM conversations""")
def conversation_context(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    out = ranking.carried(c, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.length("text").cast("long")), "last_user_len")
    return ranking.neighbours(out, ["conv_id"], ["turn"], "role", 2, 1).select("conv_id", "turn", "last_user_len", "prev_1", "prev_2", "next_1")


@query("SELECT user_id, string_agg(event_type, '>' ORDER BY fp) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS fp, row_number() OVER (PARTITION BY user_id ORDER BY min(event_id)) AS rn FROM events GROUP BY 1, 2) WHERE rn <= 3 GROUP BY 1")
def unique_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The first three different kinds, in order of appearance; the list of firsts has a row for each kind only."""
    firsts = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("p"))
    kinds = F.transform(F.sort_array(F.collect_list(F.struct("p", "event_type"))), lambda s: s["event_type"])
    return firsts.groupBy("user_id").agg(F.array_join(ranking.unique_in_order(kinds, 3), ">").alias("kinds"))


# ---- issues, flags, scores

_ISSUES = {
    "short_text": ("length(text) < 200", lambda: F.length("text") < 200),
    "upper_case": ("text = upper(text)", lambda: F.col("text") == F.upper("text")),
    "symbols": ("contains(text, '%%%')", lambda: F.col("text").contains("%%%")),
    "mail": ("contains(text, '@')", lambda: F.col("text").contains("@")),
}
_ISSUE_SQL = " UNION ALL ".join(f"SELECT '{k}' AS code, lang AS fellowship, source AS source_id, doc_id FROM documents WHERE {s}" for k, (s, _) in _ISSUES.items())


def _issues(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    codes = F.array_compact(F.array(*(F.when(f(), F.lit(k)) for k, (_, f) in _ISSUES.items())))
    return docs.select(F.explode(codes).alias("code"), F.col("lang").alias("fellowship"), F.col("source").alias("source_id"), "doc_id")


@query(f"""SELECT code, fellowship, source_id, CASE grouping_id(code, fellowship, source_id) WHEN 3 THEN 'code' WHEN 1 THEN 'fellowship' ELSE 'source' END AS level, count(*)::BIGINT AS n
FROM ({_ISSUE_SQL}) GROUP BY GROUPING SETS ((code), (code, fellowship), (code, source_id))""")
def issue_counters(spark: SparkSession, d: str) -> DataFrame:
    return ranking.issue_counters(_issues(spark, d))


@query(f"SELECT code, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY doc_id) AS rn FROM ({_ISSUE_SQL})) WHERE rn <= 5")
def issue_examples(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_k(_issues(spark, d), ["code"], [F.col("doc_id")], 5).select("code", "doc_id")


@query("""SELECT c.doc_id::VARCHAR AS source_record_id, code, severity FROM (SELECT d.doc_id, unnest(list_filter([
CASE WHEN d.doc_id % 4 = 0 THEN 'missing_timezone/warning' END, CASE WHEN length(trim(d.text)) > 500 OR l.quality = 0 THEN 'location_text_artifact/error' END], lambda x: x IS NOT NULL)) AS f FROM documents d LEFT JOIN labels l USING (doc_id)) c,
LATERAL (SELECT split_part(f, '/', 1) AS code, split_part(f, '/', 2) AS severity)""")
def review_flags(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    zone = F.when(F.col("doc_id") % 4 == 0, "UTC").otherwise("Europe/Paris")
    c = docs.select(
        F.col("source").alias("source_id"), F.col("doc_id").cast("string").alias("source_record_id"), F.col("text").alias("name"), F.lit(None).cast("string").alias("venue_name"),
        F.when(F.col("quality") == 0, "Monday").alias("city"), F.lit(None).cast("string").alias("address_line1"), F.array(F.struct(zone.alias("timezone"))).alias("occurrences"),
    )
    return review.flags(c).select("source_record_id", "code", "severity")


@query("""SELECT doc_id, (nullif(trim(source), '') IS NOT NULL AND doc_id % 7 > 0 AND (lang <> 'en' OR length(text) > 400)) AS is_valid FROM documents""")
def valid_candidates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    c = docs.withColumns({
        "source_id": F.col("source"), "source_record_id": F.col("doc_id").cast("string"), "source_url": F.lit("https://x"), "name": F.when(F.col("doc_id") % 7 > 0, F.col("lang")).otherwise(F.lit("  ")),
        "address_line1": F.lit(""), "city": F.when(F.col("lang") != "en", F.col("lang")), "venue_name": F.lit(None).cast("string"), "online_url": F.lit(" "), "phone_join_info": F.lit(None).cast("string"),
        "latitude": F.when(F.length("text") > 400, F.lit(0.0)), "longitude": F.lit(None).cast("double"),
    })
    return c.select("doc_id", review.valid_candidate().alias("is_valid"))


_HAS = {"day": ("doc_id % 2 = 0", F.expr), "time": ("doc_id % 3 > 0", F.expr), "name": ("length(text) > 300", F.expr), "location": ("lang = 'en'", F.expr), "online": ("position('@' in text) > 0", F.expr), "repeated_structure": ("doc_id % 5 = 0", F.expr), "table_headers": ("doc_id % 11 = 0", F.expr), "meeting_page": ("length(text) > 2000", F.expr)}
_POINTS = "5 + " + " + ".join(f"CASE WHEN {s} THEN {scoring.GAINS[k]} ELSE 0 END" for k, (s, _) in _HAS.items()) + (
    f" - CASE WHEN doc_id % 13 = 0 THEN 14 ELSE 0 END - CASE WHEN {_HAS['day'][0]} THEN 0 ELSE 12 END - CASE WHEN {_HAS['time'][0]} THEN 0 ELSE 14 END - CASE WHEN {_HAS['location'][0]} OR {_HAS['online'][0]} THEN 0 ELSE 10 END"
)
_CONFIDENCE = f"greatest(0, least(100, {_POINTS})) / 100.0::DOUBLE"


def _confidence(spark: SparkSession, d: str) -> DataFrame:
    score, signals = scoring.confidence({k: F.expr(s) for k, (s, _) in _HAS.items()}, F.col("doc_id") % 13 == 0)
    return table(spark, d, "documents").select("doc_id", score.alias("confidence"), F.array_join(signals, ",").alias("signals"))


@query(f"""SELECT doc_id, {_CONFIDENCE} AS confidence, CASE WHEN {_CONFIDENCE} < 0.45 THEN 'scrape_very_low_confidence' WHEN {_CONFIDENCE} < 0.75 THEN 'scrape_low_confidence' END AS code,
concat_ws(',', {', '.join(f"CASE WHEN {s} THEN '{k}' END" for k, (s, _) in _HAS.items())}, CASE WHEN doc_id % 13 = 0 THEN 'text_fallback' END, CASE WHEN NOT ({_HAS['day'][0]}) THEN 'missing_day' END,
CASE WHEN NOT ({_HAS['time'][0]}) THEN 'missing_time' END, CASE WHEN NOT ({_HAS['location'][0]} OR {_HAS['online'][0]}) THEN 'missing_location' END) AS signals FROM documents""")
def confidence_score(spark: SparkSession, d: str) -> DataFrame:
    return _confidence(spark, d).withColumn("code", scoring.confidence_code(F.col("confidence")))


@query(f"SELECT decision, count(*)::BIGINT AS n FROM (SELECT CASE WHEN c < 0.45 THEN 'drop' WHEN c < 0.75 THEN 'warn' ELSE 'keep' END AS decision FROM (SELECT CASE WHEN doc_id % 17 = 0 THEN NULL ELSE {_CONFIDENCE} END AS c FROM documents)) GROUP BY 1")
def confidence_gate(spark: SparkSession, d: str) -> DataFrame:
    c = _confidence(spark, d).withColumn("confidence", F.when(F.col("doc_id") % 17 > 0, F.col("confidence")))
    return review.gate(c).groupBy("decision").agg(F.count("*").alias("n"))


@query(f"""{_KEYED}, s AS (SELECT gk, count(*) AS c FROM k GROUP BY 1) SELECT sum(c)::BIGINT AS n, (sum(c) - count(*))::BIGINT AS removed, ((sum(c) - count(*)) / sum(c))::DOUBLE AS residual_rate,
sum(c) >= 1 AND (sum(c) - count(*)) / sum(c) <= 0.005 AS passed FROM s""")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """Listings before consolidation: too many duplicates to publish."""
    m = D.duplicate_metrics(M.parts(spark, d, with_occurrences=False)).agg(F.sum("original").alias("n"), F.sum("removed").cast("long").alias("removed"))
    return review.quality_gate(m)


_LINKS = "SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)) AS href FROM pages"


@query(f"SELECT page_id, href, greatest(0, least(100, 45 * CAST(regexp_matches(rtrim(lower(href), '/'), '/(meetings|meeting-schedule|find-a-meeting)$') AS INTEGER) + 25 * (CAST(contains(lower(href) || '  ' || lower(href), 'meeting') AS INTEGER) + CAST(contains(lower(href), 'mode') AS INTEGER) + CAST(contains(lower(href), 'mote') AS INTEGER)) - 35 * CAST(contains(lower(href), 'form') AS INTEGER))) / 100.0::DOUBLE AS score FROM ({_LINKS})")
def link_score(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.select("page_id", "href", scoring.link_score(F.col("href"), F.lit("")).alias("score"))


# ---- lookups, days and times

_MINUTES = "CASE WHEN c_custkey % 4 = 0 THEN (c_custkey % 24) || ':' || lpad((c_custkey % 60)::VARCHAR, 2, '0') WHEN c_custkey % 4 = 1 THEN (c_custkey % 14) || ' pm' WHEN c_custkey % 4 = 2 THEN (c_custkey % 13) || ':30 A.M.' ELSE 'x' END"


@query(f"""WITH t AS (SELECT c_custkey, {_MINUTES} AS raw FROM customer), p AS (SELECT *, try_cast(regexp_extract(raw, '^([0-9]+)', 1) AS INTEGER) AS h, coalesce(try_cast(regexp_extract(raw, ':([0-9]+)', 1) AS INTEGER), 0) AS m FROM t),
q AS (SELECT *, CASE WHEN raw LIKE '%pm' AND h <> 12 THEN h + 12 WHEN raw LIKE '%A.M.' AND h = 12 THEN 0 ELSE h END AS hh FROM p)
SELECT c_custkey, raw, CASE WHEN hh BETWEEN 0 AND 23 THEN hh * 60 + m END AS minutes FROM q""")
def parse_time(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.concat((k % 24).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"))).when(k % 4 == 1, F.concat((k % 14).cast("string"), F.lit(" pm"))).when(k % 4 == 2, F.concat((k % 13).cast("string"), F.lit(":30 A.M."))).otherwise(F.lit("x"))
    return table(spark, d, "customer").select("c_custkey", raw.alias("raw")).withColumn("minutes", schedule.parse_time(F.col("raw")))


_DAY_VALUES = ("Sunday", " lundi ", "ŚRODA", "daily", "7", "0", "6", "8", "x", "суббота", "Every Day", "tues")


@query(f"""SELECT s_suppkey, raw, CASE lower(trim(raw)) WHEN 'sunday' THEN '0' WHEN 'lundi' THEN '1' WHEN 'środa' THEN '3' WHEN 'daily' THEN '0,1,2,3,4,5,6' WHEN 'every day' THEN '0,1,2,3,4,5,6' WHEN '7' THEN '0' WHEN '0' THEN '0' WHEN '6' THEN '6'
WHEN 'суббота' THEN '6' WHEN 'tues' THEN '2' ELSE '' END AS days FROM (SELECT s_suppkey, [{', '.join(f"'{v}'" for v in _DAY_VALUES)}][s_suppkey % {len(_DAY_VALUES)} + 1] AS raw FROM supplier)""")
def normalize_days(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", M.pick(_DAY_VALUES, F.col("s_suppkey")).alias("raw"))
    return s.withColumn("days", F.array_join(F.transform(schedule.normalize_days(F.col("raw")), lambda x: x.cast("string")), ","))


@query(f"""SELECT id, CASE lower(country) WHEN 'ireland' THEN 'Ireland' WHEN 'uk' THEN 'United Kingdom' WHEN 'usa' THEN 'United States' WHEN 'deutschland' THEN 'Germany' WHEN 'polska' THEN 'Poland' WHEN 'japan' THEN 'Japan' ELSE country END AS country,
CASE lower(country) WHEN 'ireland' THEN 'IE' WHEN 'uk' THEN 'GB' WHEN 'usa' THEN 'US' WHEN 'deutschland' THEN 'DE' WHEN 'polska' THEN 'PL' WHEN 'japan' THEN 'JP' END AS country_code FROM ({M.SOURCES})""")
def country_codes(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import location

    name = location.country_name(F.col("country"))
    return M.sources(spark, d).select("id", name.alias("country"), lookups.lookup(lookups.COUNTRY_CODES, name).alias("country_code"))


@query(r"SELECT doc_id, nullif(regexp_extract(text, '\b([0-9]{5}(?:-[0-9]{4})?)\b', 1), '') AS zip FROM documents")
def postal_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.nullif(F.regexp_extract("text", r"\b([0-9]{5}(?:-[0-9]{4})?)\b", 1), F.lit("")).alias("zip"))


# ---- merges and runs


@query("""SELECT source_id, source_record_id, price, status, missing_run_count, first_seen FROM (
SELECT coalesce(o.k, n.k) % 10 AS source_id, coalesce(o.k, n.k) AS source_record_id, CASE WHEN n.k IS NOT NULL THEN n.p ELSE o.p END AS price, CASE WHEN n.k IS NOT NULL THEN 'active' ELSE 'stale' END AS status,
CASE WHEN n.k IS NOT NULL THEN 0 ELSE 1 END AS missing_run_count, CASE WHEN o.k IS NOT NULL THEN 'old' ELSE 'new' END AS first_seen
FROM (SELECT o_orderkey AS k, o_totalprice AS p FROM orders WHERE o_orderkey % 3 < 2) o FULL JOIN (SELECT o_orderkey AS k, o_totalprice * 2 AS p FROM orders WHERE o_orderkey % 3 > 0) n ON o.k = n.k)""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_orderkey") % 10).alias("source_id"), F.col("o_orderkey").alias("source_record_id"), F.col("o_totalprice").alias("price"))
    old = o.filter("source_record_id % 3 < 2").withColumns({"status": F.lit("stale"), "missing_run_count": F.lit(1), "first_seen_at": F.lit("old"), "last_seen_at": F.lit("old"), "last_verified_at": F.lit(None).cast("string")})
    new = o.filter("source_record_id % 3 > 0").withColumn("price", F.col("price") * 2)
    return merge.upsert_candidates(old, new, F.lit("new")).select("source_id", "source_record_id", "price", "status", "missing_run_count", F.col("first_seen_at").alias("first_seen"))


@query("""SELECT n.n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'feed' ELSE 'browser' END AS adapter_type, CASE WHEN n_nationkey % 3 = 0 THEN 'old' ELSE 'new' END AS country,
CASE WHEN n_nationkey % 2 = 0 THEN '{"a":"1","b":"3","c":"4"}' ELSE '{"a":"1","b":"2"}' END AS config FROM nation n""")
def upsert_sources(spark: SparkSession, d: str) -> DataFrame:
    """A known adapter isn't lost to an unknown one, countries are only filled, configs are merged."""
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    base = {"normalized_url": k.cast("string"), "fellowship": F.lit("aa"), "id": k.cast("string"), "name": F.col("n_name"), "url": F.lit("u"), "source_type": F.lit("t"), "region": F.lit(None).cast("string"), "permission_status": F.lit("unknown"), "requires_browser": F.lit(False)}
    old = n.select(*(v.alias(c) for c, v in base.items()), F.lit("old").alias("country"), F.lit("browser").alias("adapter_type"), F.lit('{"a": "1", "b": "2"}').alias("config"))
    new = n.select(*(v.alias(c) for c, v in base.items()), F.when(k % 3 > 0, "new").alias("country"), F.when(k % 2 == 0, "feed").otherwise("unknown").alias("adapter_type"), F.when(k % 2 == 0, '{"b": "3", "c": "4"}').otherwise("{}").alias("config"))
    return merge.upsert_sources(old, new).select(F.col("id").cast("int").alias("k"), "adapter_type", "country", "config")


_RUNS = "SELECT user_id, w, EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND weekofyear(e.ts) = w AND event_type = 'error') AS seen FROM (SELECT DISTINCT user_id FROM events) u, (SELECT DISTINCT weekofyear(ts) AS w FROM events)"


@query(f"""WITH RECURSIVE r AS ({_RUNS}), s AS (SELECT user_id, w, seen, sum(seen::INTEGER) OVER (PARTITION BY user_id ORDER BY w) AS g FROM r)
SELECT user_id, w AS run, (CASE WHEN seen THEN 0 ELSE row_number() OVER (PARTITION BY user_id, g ORDER BY w) - CASE WHEN g > 0 THEN 1 ELSE 0 END END)::BIGINT AS missing_run_count FROM s""")
def missing_streaks(spark: SparkSession, d: str) -> DataFrame:
    """How many weekly runs in a row each user had no error."""
    return _streaks(spark, d).select("user_id", "run", F.col("missing_run_count").cast("long").alias("missing_run_count"))


def _streaks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.weekofyear("ts").alias("run"), "event_type")
    seen = e.groupBy("user_id", "run").agg(F.max(F.col("event_type") == "error").alias("seen"))
    # every user in every run: the runs are a handful, exploded from one array
    runs = e.agg(F.collect_set("run").alias("runs"))
    grid = e.select("user_id").distinct().join(F.broadcast(runs), F.lit(True)).select("user_id", F.explode("runs").alias("run"))
    return ranking.missing_streaks(grid.join(seen, ["user_id", "run"], "left").withColumn("seen", F.coalesce("seen", F.lit(False))), "user_id", "run", F.col("seen"))


@query("""SELECT user_id AS source_record_id, CASE WHEN seen THEN 'active' WHEN misses >= 3 THEN 'inactive' ELSE 'stale' END AS status, CASE WHEN seen THEN misses - 1 ELSE misses END AS missing_run_count FROM
(SELECT user_id, bool_or(event_type = 'error' AND ts >= TIMESTAMP '2024-01-28') AS seen, (user_id % 3 + 1)::INTEGER AS misses FROM events GROUP BY 1)""")
def mark_missing(spark: SparkSession, d: str) -> DataFrame:
    """Users unseen in the last run become stale, or inactive on the third miss."""
    e = table(spark, d, "events")
    stored = e.select(F.lit("s").alias("source_id"), F.col("user_id").alias("source_record_id")).distinct().withColumns({"status": F.lit("active"), "missing_run_count": (F.col("source_record_id") % 3).cast("int")})
    seen = e.filter((F.col("event_type") == "error") & (F.col("ts") >= F.lit("2024-01-28").cast("timestamp_ntz"))).select(F.lit("s").alias("source_id"), F.col("user_id").alias("source_record_id"))
    return merge.mark_missing(stored, seen, spark.range(1).select(F.lit("s").alias("source_id"))).select("source_record_id", "status", "missing_run_count")


@query("""WITH w AS (SELECT user_id, count(*) FILTER (weekofyear(ts) = 1) AS b, count(*) FILTER (weekofyear(ts) = 2) AS a FROM events GROUP BY 1)
SELECT user_id AS source_id, b::BIGINT AS before, a::BIGINT AS after, (b - a)::BIGINT AS dropped FROM w WHERE b > 0 AND (b - a) / b > 0.20""")
def source_drop(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("source_id"), F.weekofyear("ts").alias("w"))
    week = lambda n: e.filter(F.col("w") == n).groupBy("source_id").agg(F.count("*").alias("active"))
    return merge.source_drops(week(1), week(2)).select("source_id", "before", "after", "dropped")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"k":"' || (event_id % 5) || '","t":"' || event_type || '"}' ELSE '{"k":"' || json_extract_string(props, '$.k') || '","t":"' || event_type || '"}' END AS merged FROM events""")
def json_config_merge(spark: SparkSession, d: str) -> DataFrame:
    new = F.when(F.col("event_id") % 2 == 0, F.to_json(F.create_map(F.lit("k"), (F.col("event_id") % 5).cast("string"), F.lit("t"), F.col("event_type")))).otherwise(F.to_json(F.create_map(F.lit("t"), F.col("event_type"))))
    return table(spark, d, "events").select("event_id", F.to_json(merge.merge_json(F.col("props"), new)).alias("merged"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN z = 'UTC' AND l_orderkey % 3 > 0 THEN 'Europe/Rome' ELSE z END AS timezone FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN 'UTC' ELSE 'Asia/Tokyo' END AS z FROM lineitem)")
def cleanup_timezones(spark: SparkSession, d: str) -> DataFrame:
    """Fall-back zones give way to the zone of the source, where it has one."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), "l_linenumber", F.when(F.col("l_partkey") % 2 == 0, "UTC").otherwise("Asia/Tokyo").alias("timezone"))
    zones = table(spark, d, "orders").filter("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("source_id"), F.lit("Europe/Rome").alias("timezone"))
    return merge.repair_timezones(li, zones).select(F.col("source_id").alias("l_orderkey"), "l_linenumber", "timezone")




# ---- pages


@query(r"""SELECT page_id, pos::INTEGER AS pos, href FROM (SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages))""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import extract

    return extract.links(table(spark, d, "pages")).select("page_id", "pos", "href")


@query("""SELECT page_id, href AS url_path, count(*) OVER (PARTITION BY page_id)::BIGINT AS n FROM (SELECT page_id, unnest(list_distinct(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: x <> ''))) AS href FROM pages)""")
def source_links(spark: SparkSession, d: str) -> DataFrame:
    """Anchors as sources: absolute, the first of each; counted for each page."""
    from ..sources import discovery, extract

    p = table(spark, d, "pages")
    links = extract.links(p).withColumn("text", F.coalesce(F.nullif("text", F.lit("")), F.lit("x"))).join(p.select("page_id", "url"), "page_id").withColumnRenamed("url", "base")
    out = discovery.source_links(links, F.col("base"))
    n = out.groupBy("page_id").agg(F.count("*").alias("n"))
    return out.join(n, "page_id").select("page_id", urls.part(F.col("url"), 3).alias("url_path"), "n")


@query("SELECT page_id, i.v AS label FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1), lambda x: {'v': x})) AS i FROM pages) WHERE i.v <> ''")
def css_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a selector with a field selector."""
    from ..sources import extract

    return extract.css_rows(table(spark, d, "pages"), "nav li", {"label": "a", "href": "a::attr(href)"}).filter("label is not null").select("page_id", "label")


@query()
def page_score(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import extract

    p = table(spark, d, "pages")
    parts = extract.page_parts(p, "url")
    heading = F.concat_ws(" ", "title", "headings")
    return parts.select("page_id", scoring.page_score(F.col("url"), heading, F.col("text"), F.col("has_form"), F.col("has_table")).alias("score"))


@query()
def html_text(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import extract

    return extract.page_parts(table(spark, d, "pages")).select("page_id", "title", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@query()
def zero_source_buckets(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import extract

    p = table(spark, d, "pages")
    audited = review.zero_source(extract.page_parts(p, "html"))
    return audited.select("page_id", "bucket", "priority", F.array_join("signals", ",").alias("signals"))


@query("""SELECT -c_custkey - 1 AS page_id, 'header_table' AS kind, c_name AS name, 'Monday' AS day, '7:30 pm' AS time, CASE WHEN c_custkey % 2 = 0 THEN 0.79 ELSE 0.91 END::DOUBLE AS confidence, c_custkey % 10 <> 3 AS is_listing FROM customer""")
def extracted_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Listings in the driver's pages (prose, which holds none) and in customers written as pages: with their confidence, and
    whether they are listings (opening hours are none)."""
    from ..sources import extract
    from . import pipeline

    k = F.col("c_custkey")
    cells = F.concat(F.col("c_name"), F.lit("</td><td>Monday</td><td>7:30 pm</td><td>Hall</td><td>"), F.when(k % 10 == 3, "office hours").otherwise("welcome"), F.lit("</td><td>"), F.when(k % 2 == 0, "").otherwise("https://zoom.us/j/1"))
    html = F.concat(F.lit("<table><tr><th>Meeting<th>Day<th>Time<th>Location<th>Notes<th>Link</tr><tr><td>"), cells, F.lit("</td></tr></table>"))
    own = table(spark, d, "customer").select((-k - 1).alias("page_id"), F.lit("https://x.org/m").alias("url"), html.alias("html"))
    pages = table(spark, d, "pages").select("page_id", "url", "html").unionByName(own)
    return pipeline.confidence_of(extract.extract(pages)).select("page_id", "kind", "name", "day", "time", "confidence", "is_listing")


_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1))"


@query(f"""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), l AS (SELECT DISTINCT a.page_id AS src, b.page_id AS dst FROM pages a, n, pages b WHERE b.page_id = (a.page_id * 7 + 3) % n OR b.page_id = (a.page_id * 3 + 1) % n),
c AS (SELECT page_id AS root, page_id AS page, 0 AS depth FROM pages WHERE page_id % 50 = 0 UNION ALL SELECT c.root, l.dst, c.depth + 1 FROM c JOIN l ON l.src = c.page WHERE c.depth < 2)
SELECT root, page, min(depth)::INTEGER AS depth FROM c GROUP BY 1, 2""")
def crawl_bfs(spark: SparkSession, d: str) -> DataFrame:
    """Pages reached from some roots over two steps of a link table."""
    from ..sources import discovery

    ids = table(spark, d, "pages").select("page_id")
    n = ids.count()
    steps = F.array(F.struct((F.col("page_id") * 7 + 3) % n), F.struct((F.col("page_id") * 3 + 1) % n))
    links = ids.select(F.col("page_id").alias("src"), F.explode(F.transform(steps, lambda s: s["col1"])).alias("dst")).distinct()
    links = links.join(ids.withColumnRenamed("page_id", "dst"), "dst", "left_semi")
    return discovery.crawl(links, ids.filter("page_id % 50 = 0").withColumnRenamed("page_id", "page"), 2)


@query(f"SELECT page_id, {_HOST} AS host, array_to_string(list_slice(string_split({_HOST}, '.'), -2, -1), '.') AS site, NOT regexp_matches(lower(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)), '\\.(avi|doc|docx|gif|ics|jpg|jpeg|mp3|mp4|pdf|png|ppt|pptx|webp|xls|xlsx|zip)$') AS admissible FROM pages")
def crawl_admission(spark: SparkSession, d: str) -> DataFrame:
    """May a crawl from the page's own site root follow its address?"""
    u = F.col("url")
    root = F.concat(urls.part(u, 1), F.lit("://www."), urls.site(u), F.lit("/"))
    return table(spark, d, "pages").select("page_id", urls.host(u).alias("host"), urls.site(u).alias("site"), urls.admissible(root, u).alias("admissible"))


# ---- feeds and places


@query("""SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END, ''), 'A.A. Meeting') AS name, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'hybrid' WHEN c_custkey % 3 = 0 THEN 'online' WHEN c_custkey % 2 = 0 THEN 'in_person' ELSE 'unknown' END AS meeting_type,
CASE WHEN c_custkey % 9 < 7 AND c_custkey % 4 < 3 THEN (c_custkey % 9) || ' ' || ((c_custkey % 24) * 60 + 30) || ' ' || CASE WHEN c_custkey % 5 = 0 THEN 'UTC' ELSE 'Europe/Rome' END END AS occurrence FROM customer""")
def feed_a_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Feed A objects made of customers, read back from JSON and normalized."""
    from ..sources import feeds

    k = F.col("c_custkey")
    obj = F.to_json(F.struct(
        k.cast("string").alias("slug"), F.when(k % 7 == 0, "").otherwise(F.col("c_name")).alias("name"), F.when(k % 9 < 7, (k % 9).cast("string")).otherwise(F.lit("x")).alias("day"),
        F.when(k % 4 < 3, F.concat(k % 24, F.lit(":30"))).alias("time"), F.when(k % 5 == 0, "").otherwise(F.lit("Europe/Rome")).alias("timezone"), F.when(k % 3 == 0, "https://zoom.us/j/1").alias("conference_url"), F.when(k % 2 == 0, "1 Main St").alias("address"),
    ))
    raw = feeds.raw_records(table(spark, d, "customer").select(F.lit("s").alias("source_id"), obj.alias("payload")), ("slug", "id"), F.lit("https://x"))
    o = F.get("occurrences", F.lit(0))
    line = F.when(o.isNotNull(), F.concat_ws(" ", o["day_of_week"].cast("string"), o["start_minute"].cast("string"), o["timezone"]))
    return feeds.normalize_a(raw).select(F.col("source_record_id").cast("long").alias("c_custkey"), "name", "meeting_type", line.alias("occurrence"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN 'Europe/Rome' WHEN s_suppkey % 6 = 1 THEN 'Australia/Sydney' WHEN s_suppkey % 6 = 2 THEN 'Australia/Perth' WHEN s_suppkey % 6 = 3 THEN 'Europe/Dublin' WHEN s_suppkey % 6 = 4 THEN 'Australia/Brisbane' ELSE 'UTC' END AS timezone,
CASE WHEN s_suppkey % 4 = 0 THEN 'hybrid' WHEN s_suppkey % 4 = 1 THEN 'online' ELSE 'in_person' END AS meeting_type, CASE WHEN s_suppkey % 4 = 1 THEN 'not a url' END AS phone, 'O,C' AS formats FROM supplier""")
def feed_b_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Feed B objects made of suppliers: time zones by record, postcode, coordinates or country."""
    from ..sources import feeds

    k = F.col("s_suppkey")
    case = lambda *vs: F.get(F.array(*(F.lit(v) for v in vs)), (k % len(vs)).cast("int"))
    obj = F.to_json(F.struct(
        k.cast("string").alias("id_bigint"), F.lit("3").alias("weekday_tinyint"), F.lit("19:30:00").alias("start_time"), case("Europe/Rome", "UTC", "", "UTC", "utc", None).alias("time_zone"),
        case("", "Australia", "Australia", "Ireland", "AU", "Narnia").alias("location_nation"), case("", "2000", "", "", "4000", "").alias("location_postal_code_1"), case("", "", "-31.9", "", "", "1").alias("latitude"), case("", "", "115.8", "", "", "1").alias("longitude"),
        case("https://zoom.us/j/2", "not a url", "", None).alias("virtual_meeting_link"), case("1 Main St", None, "2 Main St", "3 Main St").alias("formatted_address"), F.lit("O, C,").alias("formats"),
    ))
    raw = feeds.raw_records(table(spark, d, "supplier").select(F.lit("s").alias("source_id"), obj.alias("payload")), ("id_bigint", "id"), F.lit("https://x"))
    zone = F.get("occurrences", F.lit(0))["timezone"]
    return feeds.normalize_b(raw).select(F.col("source_record_id").cast("long").alias("s_suppkey"), zone.alias("timezone"), "meeting_type", F.col("phone_join_info").alias("phone"), F.array_join("formats", ",").alias("formats"))


@query("""SELECT n_nationkey, CASE n_nationkey % 8 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Toronto' WHEN 3 THEN 'Australia/Perth' WHEN 4 THEN 'Europe/Dublin' WHEN 5 THEN NULL WHEN 6 THEN 'Europe/Warsaw' ELSE NULL END AS timezone,
CASE n_nationkey % 8 WHEN 0 THEN 'NY' WHEN 1 THEN 'TX' WHEN 2 THEN 'ON' WHEN 3 THEN 'WA' ELSE NULL END AS region_code FROM nation""")
def tz_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Time zones and region codes by country and region; an unknown region of a country with several zones has none."""
    from ..operators import location

    k = F.col("n_nationkey")
    country = M.pick(("USA", "us", "Canada", "Australia", "Éire", "United States", "Polska", "Narnia"), k)
    region = M.pick(("New York", "tx", "ontario", "WA", "Cork", "Narnia", "", "x"), k)
    return table(spark, d, "nation").select("n_nationkey", location.timezone_for(country, region).alias("timezone"), location.region_code(country, region).alias("region_code"))


def _placed(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    case = lambda *vs: F.get(F.array(*(F.lit(v) for v in vs)), (k % len(vs)).cast("int"))
    return table(spark, d, "supplier").select(
        F.lit("s").alias("source_id"), k.cast("string").alias("source_record_id"), F.lit("aa").alias("fellowship"), F.lit("in_person").alias("meeting_type"), F.lit(None).cast("string").alias("venue_name"),
        case("12 Main St, Tulsa, OK 74103", "5 High St, Cork, Ireland", "7 King St, Toronto, ON M5V 2T6", "1 George St, Sydney, NSW 2000", "10 Downing St, London SW1A 2AA", "Somewhere").alias("address_line1"),
        F.lit(None).cast("string").alias("address_line2"), case(None, "Co. Cork", "", "Sydney", None, "County Kerry").alias("city"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("postal_code"),
        case(None, "Éire", "Poland", None, None, "Ireland").alias("country"), F.array(F.struct(F.lit(1).alias("day_of_week"), F.lit(600).alias("start_minute"), F.lit(None).cast("int").alias("end_minute"), F.lit("America/Chicago").alias("timezone"))).alias("occurrences"),
    )


@query("""SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'United States/Oklahoma/Tulsa/74103/US/OK/America/Chicago' WHEN 1 THEN 'Ireland/Cork//' || '/IE//Europe/Dublin' WHEN 2 THEN 'Canada/Ontario/Toronto/M5V 2T6/CA/ON/America/Chicago'
WHEN 3 THEN 'Australia/New South Wales/Sydney/2000/AU/NSW/Australia/Sydney' WHEN 4 THEN 'United Kingdom///SW1A 2AA/GB//Europe/London' ELSE 'Ireland/Kerry///IE//Europe/Dublin' END AS place FROM supplier""")
def normalize_location(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import location

    out = location.normalize_location(_placed(spark, d))
    cols = [F.coalesce(F.col(c), F.lit("")) for c in ("country", "region", "city", "postal_code", "country_code", "region_code")]
    return out.select(F.col("source_record_id").cast("long").alias("s_suppkey"), F.concat_ws("/", *cols, F.get("occurrences", F.lit(0))["timezone"]).alias("place"))


@query("""SELECT code, count(*)::BIGINT AS n FROM (SELECT unnest(CASE s_suppkey % 6 WHEN 1 THEN ['city_admin_area', 'timezone_country_mismatch'] WHEN 4 THEN ['high_confidence_missing_country'] WHEN 5 THEN ['city_admin_area', 'timezone_country_mismatch'] WHEN 2 THEN ['timezone_country_mismatch'] ELSE [] END) AS code FROM supplier) GROUP BY 1""")
def location_audit(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import location

    return location.audit(_placed(spark, d)).groupBy("code").agg(F.count("*").alias("n"))
