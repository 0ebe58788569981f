"""Queries on listings: payload rules, ids and hashes, stored tables over runs, snapshots and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import schedule, text as X, urls
from ..operators import consolidate as D, location, merge, ranking, review
from ..sources import artifacts, discovery, feeds
from . import pipeline
from .model import pick, table
from .registry import query
from .source_queries import _sql_pick


def _k() -> Column:
    return F.col("c_custkey")


def _none() -> Column:
    return F.lit(None).cast("string")


def _customers(spark: SparkSession, d: str, **cols: Column) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", *(c.alias(n) for n, c in cols.items()))


# ---- payloads

NAMES = ("Hope Group", "Privacy Policy", "read more about us", "Dawn", "Office hours for Dawn", "Calendar", "Night Owls")
URLS = ("https://zoom.us/j/1", "https://facebook.com/x", "https://us02web.zoom.us/j/2", "https://x.org/donate", None)


@query(f"""WITH p AS (SELECT c_custkey, c_custkey % 2 = 0 AS dy, c_custkey % 3 < 2 AS tm, c_custkey % 5 < 3 AS pl, lower({_sql_pick(NAMES, 'c_custkey')}) AS n FROM customer)
SELECT c_custkey, n IN ('office hours for dawn', 'read more about us') AS false_positive, dy AND tm AND pl AND NOT n IN ('office hours for dawn', 'read more about us') AS listing, CASE c_custkey % 5 WHEN 0 THEN 'https://zoom.us/j/1' WHEN 2 THEN 'https://us02web.zoom.us/j/2' END AS online FROM p""")
def payload_rules(spark: SparkSession, d: str) -> DataFrame:
    """Which payloads are listings, which only look so, and which addresses are an online meeting's."""
    c = _customers(spark, d, day=F.when(_k() % 2 == 0, "Monday"), time=F.when(_k() % 3 < 2, "7 pm"), place=F.when(_k() % 5 < 3, "Hall"), name=pick(NAMES, _k()), url=pick(URLS, _k()))
    name, none = F.col("name"), _none()
    false = review.false_positive(name, none, name)
    ok = review.meeting_payload(F.col("day"), F.col("time"), [F.col("place")], name, none, name)
    return c.select("c_custkey", false.alias("false_positive"), ok.alias("listing"), review.online_url(F.col("url")).alias("online"))


SAID = ("meets 7:30 - 8:30 pm weekly", "at 19:00", "noon or 1 pm", "no clock here", "6 am sharp")


@query(f"SELECT c_custkey, {_sql_pick(('7:30pm', '19:00', 'noon', None, '6 am'), 'c_custkey')} AS first_time FROM customer")
def first_times(spark: SparkSession, d: str) -> DataFrame:
    """The first time in a text; a range takes the mark at its end."""
    return _customers(spark, d, s=pick(SAID, _k())).select("c_custkey", schedule.first_time(F.col("s")).alias("first_time"))


@query(f"SELECT c_custkey, {_sql_pick(('Hope Group', 'Dawn', 'Night Owls'), 'c_custkey')} AS cleaned, regexp_replace('+' || c_custkey || ' (0) 12-3', '[^0-9+]', '', 'g') AS phone, {_sql_pick(('https://x.org', 'http://y.org', None), 'c_custkey')} AS website FROM customer")
def cleaned_names(spark: SparkSession, d: str) -> DataFrame:
    """Names without quotes, hidden marks and notes; phones for tel: addresses; websites with a scheme."""
    c = _customers(spark, d, s=pick(('"Hope  Group" (meeting room 2)', "Dawn​", " Night Owls "), _k()), p=F.concat(F.lit("+"), _k(), F.lit(" (0) 12-3")), w=pick(("x.org", "http://y.org", " "), _k()))
    return c.select("c_custkey", X.clean_name(F.col("s")).alias("cleaned"), urls.phone_uri(F.col("p")).alias("phone"), urls.website(F.col("w")).alias("website"))


@query("""SELECT c_custkey, sha256('{"a":' || c_custkey || ',"n":"' || c_name || '"}') AS content_hash, CASE c_custkey % 3 WHEN 0 THEN 'id' || c_custkey WHEN 1 THEN substr(sha1(c_name || '|Monday|7 pm||Cork||'), 1, 16)
ELSE substr(sha1('{"z":' || c_custkey || '}'), 1, 16) END AS record_id FROM customer""")
def record_ids(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of objects whatever their key order, and ids: the record's own, by its main fields, else by all of it."""
    c = table(spark, d, "customer")
    obj = F.concat(F.lit('{"n": "'), F.col("c_name"), F.lit('", "a": '), _k(), F.lit("}"))
    own = F.concat(F.lit('{"source_record_id":"id'), _k(), F.lit('","name":"x"}'))
    main = F.concat(F.lit('{"name":"'), F.col("c_name"), F.lit('","day":"Monday","time":"7 pm","city":"Cork"}'))
    rest = F.concat(F.lit('{"z":'), _k(), F.lit("}"))
    c = c.select("c_custkey", obj.alias("payload"), F.when(_k() % 3 == 0, own).when(_k() % 3 == 1, main).otherwise(rest).alias("p"))
    return c.withColumn("content_hash", feeds.canonical_hash()).select("c_custkey", "content_hash", feeds.scraped_id(F.col("p")).alias("record_id"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'meeting_guide' WHEN 1 THEN 'bmlt' WHEN 2 THEN 'ics' WHEN 3 THEN 'pdf' WHEN 4 THEN 'html' ELSE 'unknown' END AS kind, CASE c_custkey % 4 WHEN 0 THEN 'listing' WHEN 1 THEN 'noise' WHEN 2 THEN 'external' ELSE 'noise' END AS link FROM customer""")
def site_kinds(spark: SparkSession, d: str) -> DataFrame:
    """What captured answers are, and what links of a world listing lead to."""
    body = pick(('[{"slug": "a"}]', '[{"id_bigint": "1"}]', "BEGIN:VCALENDAR", "%PDF-1.7", "<!doctype html><html>", "hello"), _k())
    link = pick(("https://ca.org/meetings/x", "https://ca.org/news", "https://area.org/x", "https://zoom.us/j/1"), _k())
    return _customers(spark, d, b=body, l=link).select("c_custkey", discovery.site_kind(F.col("b"), _none()).alias("kind"), discovery.classify_link(F.col("l"), "ca.org").alias("link"))


# ---- places

ADDRESSES = ("12 Main St, Tulsa, 74103", "5 Oak Ave, Cork, Ireland", "9 Elm Rd, Toronto, ON M5V 2T6", "3 Hill St, Perth, WA 6000", "77 Pine Rd, Austin, TX 78701")
_PLACED = (("United States", "Oklahoma", "74103", "US", "OK"), ("Ireland", "Cork", None, "IE", None), ("Canada", "Ontario", "M5V 2T6", "CA", "ON"), ("Australia", "Western Australia", "6000", "AU", "WA"), ("United States", "Texas", "78701", "US", "TX"))


@query(f"""SELECT s_suppkey, {_sql_pick(tuple(p[0] for p in _PLACED), 's_suppkey')} AS country, {_sql_pick(tuple(p[1] for p in _PLACED), 's_suppkey')} AS region, {_sql_pick(tuple(p[2] for p in _PLACED), 's_suppkey')} AS postal_code,
{_sql_pick(tuple(p[3] for p in _PLACED), 's_suppkey')} AS country_code, {_sql_pick(tuple(p[4] for p in _PLACED), 's_suppkey')} AS region_code FROM supplier""")
def placed_listings(spark: SparkSession, d: str) -> DataFrame:
    """Places found in addresses, also a region by postal code alone."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select("s_suppkey", _none().alias("venue_name"), pick(ADDRESSES, k).alias("address_line1"), _none().alias("address_line2"), _none().alias("city"), _none().alias("region"), _none().alias("postal_code"), F.when(k % 5 == 0, "USA").alias("country"))
    return location.normalize_location(s).select("s_suppkey", "country", "region", "postal_code", "country_code", "region_code")


@query("SELECT 'USA' AS \"from\", 'United States' AS \"to\", count(*)::BIGINT AS count FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 'Polska', 'Poland', count(*) FROM customer WHERE c_custkey % 4 = 1 UNION ALL SELECT 'éire', 'Ireland', count(*) FROM customer WHERE c_custkey % 4 = 3")
def alias_changes(spark: SparkSession, d: str) -> DataFrame:
    return location.alias_changes(_customers(spark, d, country=pick(("USA", "Polska", "Ireland", "éire"), _k())))


@query("""SELECT o_custkey, string_agg(DISTINCT z, ',' ORDER BY z) AS zones FROM (SELECT o_custkey, CASE o_orderkey % 3 WHEN 0 THEN 'Europe/Rome' WHEN 1 THEN 'UTC' ELSE 'Asia/Tokyo' END AS z FROM orders) GROUP BY 1""")
def listing_zones(spark: SparkSession, d: str) -> DataFrame:
    """The different zones of each listing's occurrences, sorted."""
    o = table(spark, d, "orders").select("o_custkey", pick(("Europe/Rome", "UTC", "Asia/Tokyo"), F.col("o_orderkey")).alias("z")).distinct()
    return o.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("z")), ",").alias("zones"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '1 high street cork ireland' WHEN 1 THEN 'hall cork ireland' WHEN 2 THEN 'cork ireland' WHEN 3 THEN 'geo:51.123:' || '-8.5' ELSE 'connection:https zoom us j 1' END AS place_key FROM customer""")
def place_keys(spark: SparkSession, d: str) -> DataFrame:
    """Place keys by address, venue, area, coordinates and connection."""
    m = _k() % 5
    c = _customers(
        spark, d, address_line1=F.when(m == 0, "1 High St."), venue_name=F.when(m == 1, "Hall").when(m == 0, "Ignored"), city=F.when(m < 3, "Cork"), country=F.when(m < 3, "Ireland"), latitude=F.when(m == 3, 51.1234), longitude=F.when(m == 3, -8.5),
        online_url=F.when(m == 4, "https://zoom.us/j/1"),
    )
    return D.with_place_keys(c).select("c_custkey", "place_key")


#: The double as a whole number of 2^-70, and its thousandths by integer division, half to even
_GRID = "((l_orderkey * 7 + l_linenumber) % 5760001 - 2880000) / 32000.0::DOUBLE"


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN x < 0 THEN '-' ELSE '' END || (n // 1000)::VARCHAR || '.' || CASE WHEN n % 1000 = 0 THEN '0' ELSE rtrim(lpad((n % 1000)::VARCHAR, 3, '0'), '0') END AS coordinate FROM (
SELECT *, CASE WHEN rest > half OR (rest = half AND floor_ % 2 = 1) THEN floor_ + 1 ELSE floor_ END AS n FROM (SELECT *, whole // (2 * half) AS floor_, whole % (2 * half) AS rest FROM (
SELECT l_orderkey, l_linenumber, x, (abs(x) * 1180591620717411303424.0::DOUBLE)::HUGEINT * 1000 AS whole, 590295810358705651712::HUGEINT AS half FROM (SELECT *, {_GRID} AS x FROM lineitem))))""")
def rounded_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates on a grid of 1/32 thousandths, rounded to thousandths by their binary value."""
    from ..functions.numbers import rounded

    x = (F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(5760001)) - 2880000) / F.lit(32000.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", rounded(x, 3).cast("string").alias("coordinate"))


# ---- runs


@query("""SELECT c, o, 'old' AS v FROM (SELECT o_custkey AS c, o_orderkey AS o FROM orders WHERE o_orderkey % 2 = 0) WHERE c NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 7 = 1) UNION ALL SELECT o_custkey, o_orderkey, 'new' FROM orders WHERE o_orderkey % 7 = 1""")
def replaced_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Children of the listings in a batch give way to the batch's."""
    o = table(spark, d, "orders")
    rows = lambda cond, v: o.filter(cond).select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("o"), F.lit(v).alias("v"))
    return merge.replace_children(rows("o_orderkey % 2 = 0", "old"), rows("o_orderkey % 7 = 1", "new"), ["c"])


@query("""SELECT source_id, record, CASE WHEN source_id % 2 = 0 AND st = 'open' THEN 'resolved' ELSE st END AS status FROM (SELECT o_custkey AS source_id, o_orderkey AS record, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'resolved' END AS st FROM orders WHERE o_orderkey % 3 < 2)
UNION ALL SELECT o_custkey, o_orderkey, 'open' FROM orders WHERE o_orderkey % 3 = 2 AND o_custkey % 2 = 0""")
def replaced_flags(spark: SparkSession, d: str) -> DataFrame:
    """Open flags of the sources in a run are resolved, the run's are added as open."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("record"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("resolved").alias("status"))
    new = o.filter("record % 3 = 2 and source_id % 2 = 0").drop("status")
    return merge.replace_flags(o.filter("record % 3 < 2"), new, o.filter("source_id % 2 = 0"))


@query("SELECT 'sources' AS t, count(*)::BIGINT AS n FROM nation WHERE n_nationkey % 4 > 0 UNION ALL SELECT 'listings', count(*) FROM customer WHERE c_nationkey % 4 > 0 UNION ALL SELECT 'flags', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 4 > 0")
def deleted_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources go with all that belongs to them."""
    n, c = table(spark, d, "nation").select(F.col("n_nationkey").alias("id")), table(spark, d, "customer")
    tables = {"sources": n, "listings": c.select(F.col("c_nationkey").alias("source_id"), "c_custkey")}
    tables["flags"] = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("source_id"), "o_orderkey")
    left = merge.delete_sources(tables, n.filter("id % 4 = 0"))
    counts = [df.agg(F.lit(t).alias("t"), F.count("*").alias("n")) for t, df in left.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _listings(spark: SparkSession, d: str) -> DataFrame:
    """customers as valid listings; two of a kind share name and place."""
    k = _k()
    occ = F.array(F.struct((k % 7).cast("int").alias("day_of_week"), (k % 24 * 60).cast("int").alias("start_minute"), F.lit(None).cast("int").alias("end_minute"), F.when(k % 10 == 3, "UTC").otherwise("Europe/Dublin").alias("timezone")))
    return table(spark, d, "customer").select(
        F.concat(F.lit("src-"), "c_nationkey").alias("source_id"), k.cast("string").alias("source_record_id"), F.lit("https://x.org").alias("source_url"), F.lit("aa").alias("fellowship"), F.lit("in_person").alias("meeting_type"),
        F.concat(F.lit("Group "), F.floor(k / 2)).alias("name"), F.lit("Hall").alias("venue_name"), _none().alias("address_line1"), _none().alias("address_line2"), F.lit("Cork").alias("city"), _none().alias("region"), _none().alias("postal_code"), F.lit("Éire").alias("country"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), _none().alias("online_url"), _none().alias("phone_join_info"), F.array(F.lit("O")).alias("formats"), occ.alias("occurrences"), F.lit(None).cast("date").alias("last_verified_at"),
        F.when(k % 6 == 5, 0.3).when(k % 6 == 4, 0.6).otherwise(0.9).alias("confidence"), k.alias("pos"),
    )


@query("""SELECT code, severity, count(*)::BIGINT AS n FROM (SELECT 'scrape_very_low_confidence' AS code, 'error' AS severity FROM customer WHERE c_custkey % 6 = 5
UNION ALL SELECT 'scrape_low_confidence', 'warning' FROM customer WHERE c_custkey % 6 = 4) GROUP BY 1, 2""")
def ingest_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags of a batch: rows below the gate, unsure ones; zones that don't fit the country were repaired, so none is missing."""
    return pipeline.ingest(_listings(spark, d))[1].groupBy("code", "severity").agg(F.count("*").alias("n"))


@query("""SELECT (c_custkey // 2)::BIGINT AS grp, count(*)::BIGINT AS n_members, min(c_custkey)::VARCHAR AS first_id, 'Ireland' AS country, 'IE' AS country_code FROM customer WHERE c_custkey % 9 > 0 AND c_nationkey % 7 <> 3 GROUP BY 1""")
def snapshot_build(spark: SparkSession, d: str) -> DataFrame:
    """Eligible listings of a snapshot, places repaired, duplicates merged."""
    from .model import sources

    c = _listings(spark, d).drop("confidence", "pos").withColumn("status", F.lit("active"))
    flags = c.filter(F.col("source_record_id").cast("long") % 9 == 0).select("source_id", "source_record_id", F.lit("open").alias("status"), F.lit("error").alias("severity"))
    gold = pipeline.snapshot(c, sources(spark, d), flags)
    first = F.transform("member_ids", lambda x: x.cast("long"))
    return gold.select(F.regexp_extract("name", r"(\d+)", 1).cast("long").alias("grp"), "n_members", F.array_min(first).cast("string").alias("first_id"), "country", "country_code")


@query("SELECT count(*)::BIGINT AS n, (count(*) - count(DISTINCT c_custkey // 2))::BIGINT AS removed FROM customer")
def snapshot_residual(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of a snapshot another consolidation would remove: here it wasn't consolidated, and the gate would fail."""
    return pipeline.residual(_listings(spark, d))


@query("""SELECT count(*)::BIGINT AS meetings, sum(n)::BIGINT AS members FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey // 2)""")
def snapshot_document(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot as one JSON document, read back."""
    import datetime

    gold = D.consolidate(_listings(spark, d))
    doc = pipeline.document(gold.drop("pos"), datetime.datetime(2024, 1, 1))
    rows = doc.select(F.explode(F.from_json(F.get_json_object("value", "$.meetings"), "array<struct<n_members:long>>")).alias("m"))
    return rows.agg(F.count("*").alias("meetings"), F.sum("m.n_members").alias("members"))


@query("""SELECT row_number() OVER (ORDER BY o, coalesce(country, '~~'), coalesce(city, '~~'), l_orderkey, l_linenumber)::BIGINT AS pos, l_orderkey, l_linenumber FROM (
SELECT l_orderkey, l_linenumber, l_returnflag AS o, CASE WHEN l_orderkey % 3 > 0 THEN l_linestatus END AS country, CASE WHEN l_linenumber % 4 > 0 THEN 'c' || l_suppkey END AS city FROM lineitem)""")
def snapshot_order(spark: SparkSession, d: str) -> DataFrame:
    """Line items as listings, numbered in the order of a snapshot; a third has no country, a quarter no city."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("fellowship"), F.when(F.col("l_orderkey") % 3 > 0, F.col("l_linestatus")).alias("country"), F.when(F.col("l_linenumber") % 4 > 0, F.concat(F.lit("c"), F.col("l_suppkey"))).alias("city"))
    return ranking.numbered(rows, ["fellowship", "country", "city", "l_orderkey", "l_linenumber"]).select("pos", "l_orderkey", "l_linenumber")


@query("""SELECT row_number() OVER (ORDER BY name)::BIGINT AS pos, name, n AS members, row_number() OVER (ORDER BY name) = count(*) OVER () AS is_last FROM (SELECT 'Group ' || (c_custkey // 2) AS name, count(*)::BIGINT AS n FROM customer GROUP BY 1)""")
def snapshot_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a snapshot's document, each listing read back from its line; all but the last end in a comma."""
    import datetime

    _, body, _ = pipeline.document_lines(D.consolidate(_listings(spark, d)).drop("pos"), datetime.datetime(2024, 1, 1))
    listing = F.rtrim(F.trim("value"), F.lit(","))
    return body.select("pos", F.get_json_object(listing, "$.name").alias("name"), F.get_json_object(listing, "$.n_members").cast("long").alias("members"), (~F.endswith("value", F.lit(","))).alias("is_last"))


# ---- artifacts and audits


def _summaries(spark: SparkSession, d: str) -> DataFrame:
    """customers as captured runs of their sources: three pages each, with extracted payloads."""
    payload = lambda n: F.concat(F.lit('{"name":"G'), _k(), F.lit(f'-{n}","day":"Monday","time":"7 pm"}}'))
    item = lambda n: F.struct(payload(n).alias("payload"), F.lit("m").alias("method"), F.lit(0.8).alias("confidence"), _none().alias("source_page_url"), F.array(F.lit("day")).alias("signals"), _none().alias("selector_hint"))
    page = lambda i, final, score, count, items: F.struct(F.concat(F.lit(f"https://p{i}/"), _k()).alias("url"), final.alias("final_url"), _none().alias("title"), score.alias("page_score"), F.array().cast("array<string>").alias("page_signals"), count.cast("int").alias("extracted_count"), items.alias("extracted"))
    none = F.array().cast(f"array<{artifacts.EXTRACTED}>")
    pages = F.array(
        page(1, F.lit(""), F.lit(0.5), F.lit(2), F.array(item(1), item(1)).cast(f"array<{artifacts.EXTRACTED}>")), page(2, F.concat(F.lit("https://final/"), _k()), F.lit(0.9), _k() % 3, F.when(_k() % 3 > 0, F.array(item(2)).cast(f"array<{artifacts.EXTRACTED}>")).otherwise(none)),
        page(3, _none(), F.lit(0.1), F.lit(0), none),
    )
    return table(spark, d, "customer").select(F.concat(F.lit("na-"), _k()).alias("source_id"), F.concat(F.lit("https://s/"), _k()).alias("source_url"), pages.alias("pages"), "c_custkey")


@query("""SELECT 'na-' || c_custkey AS source_id, substr(sha1('G' || c_custkey || '-1|Monday|7 pm||||'), 1, 16) AS record_id, 'https://p1/' || c_custkey AS url FROM customer
UNION ALL SELECT 'na-' || c_custkey, substr(sha1('G' || c_custkey || '-2|Monday|7 pm||||'), 1, 16), 'https://final/' || c_custkey FROM customer WHERE c_custkey % 3 > 0""")
def artifact_records(spark: SparkSession, d: str) -> DataFrame:
    """Nested captures flattened to raw records: one for each payload, with the address it was found at."""
    return artifacts.raw_records(_summaries(spark, d)).select("source_id", F.col("source_record_id").alias("record_id"), F.col("source_url").alias("url"))


@query("""SELECT 'na-' || c_custkey AS source_id, 'https://' || CASE WHEN c_custkey % 3 = 2 THEN 'final/' ELSE 'p1/' END || c_custkey AS best, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS pages FROM customer""")
def successful_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages of a capture that gave rows: most rows first, then the score."""
    p = artifacts.successful_pages(_summaries(spark, d))
    return p.groupBy("source_id").agg(F.min_by("url", "rank").alias("best"), F.count("*").alias("pages"))


@query("""SELECT 'na-' || c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'aa' ELSE 'na' END AS fellowship, CASE c_custkey % 2 WHEN 0 THEN c_name ELSE 'na-' || c_custkey END AS name, CASE c_custkey % 2 WHEN 0 THEN 'Europe/Rome' END AS timezone FROM customer""")
def artifact_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources as captures and stored metadata tell them."""
    meta = table(spark, d, "customer").select(
        F.concat(F.lit("na-"), _k()).alias("source_id"), F.when(_k() % 3 == 0, "aa").otherwise("").alias("fellowship"), F.when(_k() % 2 == 0, F.col("c_name")).alias("name"), _none().alias("country"), _none().alias("region"), _none().alias("timezone"),
        F.when(_k() % 2 == 0, '{"timezone":"Europe/Rome"}').otherwise("{}").alias("config"),
    )
    return artifacts.sources(_summaries(spark, d), meta).select("id", "fellowship", "name", "timezone")


@query("""SELECT 's' || c_custkey AS source_id, CASE WHEN c_custkey % 3 = 0 THEN 'stored' ELSE 'reported' END AS country, CASE WHEN c_custkey % 2 = 0 THEN '{"a":"1","b":"' || CASE WHEN c_custkey % 3 = 1 THEN '3' ELSE '2' END || '"}' ELSE CASE WHEN c_custkey % 3 = 1 THEN '{"b":"3"}' ELSE '{}' END END AS config FROM customer""")
def merged_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Stored and reported metadata: given reported values win, configs are merged one level deep."""
    s = _customers(spark, d, source_id=F.concat(F.lit("s"), _k()), country=F.lit("stored"), config=F.when(_k() % 2 == 0, '{"a":"1","b":"2"}')).drop("c_custkey")
    r = _customers(spark, d, source_id=F.concat(F.lit("s"), _k()), country=F.when(_k() % 3 > 0, "reported").otherwise(""), config=F.when(_k() % 3 == 1, '{"b":"3"}')).drop("c_custkey")
    return artifacts.merged_metadata(s, r)


BODIES = ("Monday 7:30 pm at the hall", "see client_interface/json", "captcha", "404 not found", "our meeting", "", "download meeting-list.pdf")
_BUCKETS = (("parser_gap_candidate", 1), ("possible_missed_structured_feed", 1), ("blocked_or_captcha", 5), ("dead_or_error_page", 5), ("meeting_keywords_only", 4), ("low_signal", 5), ("possible_pdf_or_printable", 1))
_FAILED = (("failed_timeout", 4), ("failed_tls_ssl", 4), ("failed_transport", 4))
_BUCKET_SQL = f"CASE WHEN c_custkey % 4 = 3 THEN {_sql_pick(tuple(b for b, _ in _FAILED), 'c_custkey')} ELSE {_sql_pick(tuple(b for b, _ in _BUCKETS), 'c_custkey')} END"


def _audited(spark: SparkSession, d: str) -> DataFrame:
    failed = _k() % 4 == 3
    c = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("s"), _k()).alias("id"), F.col("c_name").alias("name"), F.when(_k() % 2 == 0, "Ireland").alias("country"), F.concat(F.lit("<p>"), pick(BODIES, _k())).alias("html"), pick(BODIES, _k()).alias("text"),
        F.when(failed, "failed").otherwise("succeeded").alias("last_status"), F.when(failed, pick(("request timed out", "certificate error", "refused"), _k())).otherwise("").alias("error"),
    )
    return review.zero_source(c)


@query(f"SELECT c_custkey, {_BUCKET_SQL} AS bucket FROM customer")
def source_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Why sources gave nothing: by what their page says, or how their run failed."""
    return _audited(spark, d).select("c_custkey", "bucket")


@query(f"SELECT bucket, country, count(*)::BIGINT AS n FROM (SELECT {_BUCKET_SQL} AS bucket, CASE WHEN c_custkey % 2 = 0 THEN 'Ireland' END AS country FROM customer) GROUP BY GROUPING SETS ((bucket), (bucket, country)) HAVING grouping(country) = 1 OR country IS NOT NULL")
def bucket_counters(spark: SparkSession, d: str) -> DataFrame:
    sets = _audited(spark, d).groupingSets([["bucket"], ["bucket", "country"]], "bucket", "country").agg(F.count("*").alias("n"), F.grouping("country").alias("g"))
    return sets.filter("g = 1 or country is not null").select("bucket", "country", "n")


@query(f"SELECT 's' || c_custkey AS id FROM customer WHERE {_BUCKET_SQL} IN ('possible_missed_structured_feed', 'possible_pdf_or_printable', 'possible_embed_or_calendar', 'parser_gap_candidate')")
def retry_ids(spark: SparkSession, d: str) -> DataFrame:
    """Sources worth another try."""
    return review.retry_ids(_audited(spark, d)).select("id")


@query(f"""SELECT pos::BIGINT AS pos, id FROM (SELECT row_number() OVER (ORDER BY p, b, c, n) AS pos, id FROM (SELECT 's' || c_custkey AS id, {_BUCKET_SQL} AS b, CASE WHEN c_custkey % 2 = 0 THEN 'Ireland' ELSE '' END AS c, c_name AS n,
CASE WHEN {_BUCKET_SQL} IN ('parser_gap_candidate', 'possible_missed_structured_feed', 'possible_pdf_or_printable') THEN 1 WHEN {_BUCKET_SQL} IN ('failed_timeout', 'failed_tls_ssl', 'failed_transport', 'meeting_keywords_only') THEN 4 ELSE 5 END AS p FROM customer)) WHERE pos <= 50""")
def audit_order(spark: SparkSession, d: str) -> DataFrame:
    """The first fifty lines of the audit, by priority, bucket, country and name."""
    a = _audited(spark, d).orderBy("priority", "bucket", F.coalesce("country", F.lit("")), "name").limit(50)
    w = Window.orderBy("priority", "bucket", F.coalesce("country", F.lit("")), "name")
    return a.select(F.row_number().over(w).cast("long").alias("pos"), "id")


@query("SELECT 2 + count(*)::BIGINT + 10 AS lines FROM customer")
def audit_page(spark: SparkSession, d: str) -> DataFrame:
    """The audit's page: a title, ten buckets, a heading and a line for each source."""
    return pipeline.zero_source_page(_audited(spark, d)).agg(F.count("*").alias("lines"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY lower(CASE WHEN o_orderkey % 2 = 0 THEN 'Hope' ELSE 'HOPE' END), o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The first payload of each name, day, time and place, whatever the letters' case."""
    o = table(spark, d, "orders").withColumn("name", F.lower(F.when(F.col("o_orderkey") % 2 == 0, "Hope").otherwise("HOPE")))
    return ranking.first_wins(o, ["name", "o_custkey", "o_orderpriority"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0.3 ELSE 0.95 END::DOUBLE AS confidence FROM customer""")
def direct_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Records that a feed gave directly are kept whatever their confidence; without one they have the usual one."""
    c = _listings(spark, d).withColumn("confidence", F.when(_k_id() % 3 == 0, 0.3))
    kept, _ = pipeline.ingest_direct(c)
    return kept.select(_k_id().alias("c_custkey"), "confidence")


def _k_id() -> Column:
    return F.col("source_record_id").cast("long")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'parser_gap_candidate' WHEN 1 THEN 'possible_missed_structured_feed' WHEN 2 THEN 'low_signal' ELSE 'failed_timeout' END AS bucket FROM customer""")
def inspected_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources with the page of their last capture, else of a probe, else nothing."""
    k = _k()
    c = table(spark, d, "customer")
    sid = F.concat(F.lit("s"), k)
    sources = c.select("c_custkey", sid.alias("id"), F.col("c_name").alias("name"), _none().alias("country"), F.when(k % 4 == 3, '{"scrape":{"last_status":"failed","last_error":"timed out"}}').otherwise('{"scrape":{"last_status":"succeeded"}}').alias("config"))
    captures = c.filter("c_custkey % 4 = 0").select(sid.alias("source_id"), F.lit("<p>").alias("html"), F.lit("Monday 7:30 pm at the hall").alias("text"))
    probes = c.filter("c_custkey % 4 < 2").select(sid.alias("source_id"), F.lit("see client_interface/json").alias("html"), F.lit("x").alias("text"), _none().alias("error"))
    return review.inspected(sources, captures, probes).select("c_custkey", "bucket")
