"""Queries on sources: zones, static rows, selection, settings and world listings. Sources and pages are written from whole
driver tables, so that the expected rows follow from the same tables in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import urls, zones
from ..operators import source_rules as R
from ..sources import discovery, extract, static_html, world_listings as W
from .model import pick, table
from .registry import query


def _quoted(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _sql_pick(values: tuple, by: str) -> str:
    return f"list_extract([{', '.join(map(_quoted, values))}], ({by}) % {len(values)} + 1)"


def _values(tables: dict[str, dict[str, str]]) -> str:
    return ", ".join(f"({_quoted(k)}, {_quoted(n.lower())}, {_quoted(z)})" for k, t in tables.items() for n, z in t.items())


# ---- zones

PLACES = ("USA", "united states", "US", "Canada", "Australia", "au", "Brazil", "Mexico", "Ireland", "Czechia", "Thailand", "Narnia", None, "", " uk ", "Mexico")
AREAS = tuple(zones.US) + tuple(zones.CANADA) + tuple(zones.AUSTRALIA) + tuple(zones.BRAZIL) + tuple(zones.MEXICO) + tuple(zones.LONE_REGIONS) + ("", None, "Narnia", " texas ", "ONTARIO")
_ZONE_TABLES = {"us": zones.US, "ca": zones.CANADA, "au": zones.AUSTRALIA, "br": zones.BRAZIL, "mx": zones.MEXICO, "lone": zones.LONE_REGIONS, "country": zones.COUNTRIES}
_KIND = "CASE WHEN c IN ('united states', 'us', 'usa') AND r <> '' THEN 'us' WHEN c = 'canada' AND r <> '' THEN 'ca' WHEN c IN ('australia', 'au') AND r <> '' THEN 'au' WHEN c = 'brazil' AND r <> '' THEN 'br' WHEN c = 'mexico' AND r <> '' THEN 'mx' WHEN c = '' THEN 'lone' ELSE 'country' END"


@query(f"""WITH z(kind, name, zone) AS (VALUES {_values(_ZONE_TABLES)}), p AS (SELECT o_orderkey, lower(trim(coalesce({_sql_pick(PLACES, 'o_orderkey')}, ''))) AS c, lower(trim(coalesce({_sql_pick(AREAS, 'o_orderkey // 16')}, ''))) AS r FROM orders),
k AS (SELECT *, {_KIND} AS kind FROM p) SELECT o_orderkey, zone AS timezone FROM k LEFT JOIN z ON z.kind = k.kind AND z.name = CASE k.kind WHEN 'country' THEN c ELSE r END""")
def zones_by_place(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", zones.by_place(pick(PLACES, k), pick(AREAS, F.floor(k / 16))).alias("timezone"))


LABELS = tuple(m.upper() for m in zones.MARKERS) + ("Plain Group", None, "Berlin and Hamilton", "x Kenya y")


@query(f"""WITH p AS (SELECT c_custkey, lower(coalesce({_sql_pick(LABELS, 'c_custkey')}, '') || ' https://x.org/' || c_custkey) AS t FROM customer)
SELECT c_custkey, CASE {' '.join(f"WHEN contains(t, {_quoted(m)}) THEN {_quoted(z)}" for m, z in zones.MARKERS.items())} END AS timezone FROM p""")
def zones_by_text(spark: SparkSession, d: str) -> DataFrame:
    """The first marker of a source's name and address decides."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", zones.by_text(pick(LABELS, k), F.concat(F.lit("https://x.org/"), k)).alias("timezone"))


NAMED = tuple(f"Area of {n}" for n in (*zones.US, *zones.CANADA)) + ("Nowhere", "west virginia north")


def _longest(names: dict) -> str:
    return "CASE " + " ".join(f"WHEN contains(t, {_quoted(n.lower())}) THEN {_quoted(n)}" for n in sorted(names, key=len, reverse=True)) + " END"


@query(f"""WITH p AS (SELECT c_custkey, c_custkey % 3 AS k, lower({_sql_pick(NAMED, 'c_custkey // 3')}) AS t FROM customer)
SELECT c_custkey, CASE k WHEN 0 THEN {_longest(zones.US)} WHEN 1 THEN {_longest(zones.CANADA)} END AS region FROM p""")
def regions_in_labels(spark: SparkSession, d: str) -> DataFrame:
    """The longest region name in a source's name."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", zones.region_in_label(pick(("USA", "Canada", "Ireland"), k), pick(NAMED, F.floor(k / 3))).alias("region"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_orderkey % 7 WHEN 0 THEN 'Europe/Rome' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Toronto' WHEN 3 THEN 'America/Denver' WHEN 4 THEN 'Europe/Paris' WHEN 5 THEN 'Europe/Berlin' END AS timezone FROM lineitem""")
def zones_for_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """The seven steps to a zone for listings that fell back to UTC, over all line items."""
    k = F.col("l_orderkey") % 7
    of = lambda *v: pick(v, k)
    zone = zones.for_cleanup(
        of("Europe/Rome", "UTC", " ", None, "UTC", None, None), of("USA", "usa", None, "Narnia", None, None, None), of("Texas", "texas", "Ontario", None, None, None, None), of(None, "Canada", "Canada", "United States", None, None, None),
        of(None, None, None, "Utah", "Paris", None, None), of(None, None, None, None, "Berlin", "Berlin office", "x"), F.lit("https://x.org"),
    )
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", zone.alias("timezone"))


@query("""WITH p AS (SELECT c_custkey, c_custkey % 3 AS k FROM customer) SELECT c_custkey, 'na-' || substr(sha1('https://h' || c_custkey || '.org/'), 1, 12) AS id, 'https://h' || c_custkey || '.org/' AS normalized_url,
CASE k WHEN 0 THEN 'Ohio' WHEN 1 THEN NULL ELSE 'Quebec' END AS region, CASE k WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Africa/Nairobi' ELSE 'America/Toronto' END AS timezone FROM p""")
def sources_from_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Discovered sources as source rows: id, normalized address, region from the label, zone by place or words."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select("c_custkey", F.lit("na").alias("fellowship"), F.concat(F.lit("HTTPS://H"), k, F.lit(".org/#top")).alias("url"), pick(("Ohio Region", "Kenya Area", "Groups of Quebec"), k).alias("label"), pick(("US", None, "Canada"), k).alias("country"), F.lit(None).cast("string").alias("region"))
    out = discovery.sources_of(c)
    return out.select("c_custkey", "id", "normalized_url", "region", F.get_json_object("config", "$.timezone").alias("timezone"))


# ---- static rows

_WHERE = (("12 High St, London SW1A 1AA", "United Kingdom", None, "Europe/London", "London"), ("5 Oak Rd, Austin, TX, USA", "United States", "Texas", "America/Chicago", None), ("1 Av, CDMX", "Mexico", "Cdmx", "America/Mexico_City", None), ("9 Way, Perth WA, Australia", "Australia", "Wa", "Australia/Perth", None), ("3 Rue, Quebec QC, Canada", "Canada", "QC", "America/Toronto", None), ("7 Lane", None, None, "UTC", None))
_DAYS = (("Monday", "1"), ("daily", "0,1,2,3,4,5,6"), ("7", "0"), ("lundi", "1"), ("x", ""))
_TYPES = (("", "in_person"), ("hybrid", "hybrid"), ("online", "hybrid"), ("in-person", "in_person"))


@query(f"""WITH p AS (SELECT *, c_custkey AS k, 'Group ' || c_custkey AS nm, {_sql_pick(tuple(w[0] for w in _WHERE), 'c_custkey')} AS a, {_sql_pick(tuple(x[0] for x in _DAYS), 'c_custkey // 6')} AS dy FROM customer)
SELECT k AS c_custkey, substr(sha1(nm || '|' || dy || '|' || '7:30 pm' || '|' || a || '||'), 1, 16) AS record_id, nm AS name, {_sql_pick(tuple(t[1] for t in _TYPES), 'c_custkey')} AS meeting_type,
{_sql_pick(tuple(w[1] for w in _WHERE), 'c_custkey')} AS country, {_sql_pick(tuple(w[2] for w in _WHERE), 'c_custkey')} AS region, {_sql_pick(tuple(w[4] for w in _WHERE), 'c_custkey')} AS city,
{_sql_pick(tuple(x[1] for x in _DAYS), 'c_custkey // 6')} AS days, CASE WHEN (c_custkey // 6) % 5 < 4 THEN {_sql_pick(tuple(w[3] for w in _WHERE), 'c_custkey')} END AS timezone, 'O,C' AS formats FROM p""")
def static_html_rows(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as pages of classed rows, read back by selectors and normalized: days, places, zones, kinds."""
    k = F.col("c_custkey")
    row = lambda cls, c: F.concat(F.lit(f"<td class={cls}>"), c, F.lit("</td>"))
    html = F.concat(
        F.lit("<html><body><table><tr class=m>"), row("name", F.concat(F.lit("Group "), k)), row("day", pick(tuple(x[0] for x in _DAYS), F.floor(k / 6))), row("time", F.lit("7:30 pm")), row("address_line1", pick(tuple(w[0] for w in _WHERE), k)),
        row("attendance_option", pick(tuple(t[0] for t in _TYPES), k)), row("formats", F.lit("O, C,")), F.lit("</tr></table></body></html>"),
    )
    fields = ("name", "day", "time", "address_line1", "attendance_option", "formats")
    rows = extract.css_rows(table(spark, d, "customer").select(k.alias("page_id"), html.alias("html")), ".m", {f: f".{f}" for f in fields})
    source = spark.range(1).select(F.lit("s").alias("id"), F.lit("aa").alias("fellowship"), F.lit("https://x").alias("url"), F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"), F.lit("{}").alias("config"))
    out = static_html.normalize(rows.withColumn("source_id", F.lit("s")), source)
    days = F.array_join(F.transform("occurrences", lambda o: o["day_of_week"].cast("string")), ",")
    return out.select(F.regexp_extract("name", r"\d+", 0).cast("long").alias("c_custkey"), F.col("source_record_id").alias("record_id"), "name", "meeting_type", "country", "region", "city", days.alias("days"), F.get("occurrences", F.lit(0))["timezone"].alias("timezone"), F.array_join("formats", ",").alias("formats"))


# ---- selection and settings

ADAPTERS = ("bmlt", "meeting_guide", "static_html", "form_http", "playwright_browser", "pdf", "unknown")
KINDS = ("world_service_listing", "local_service_body", "meeting_feed", "phone", "pdf")
CONFIGS = ("{}", '{"classification":{"reason":"no list"}}', '{"classification":{"reason":" "}}', '{"scrape":{"last_status":"failed"}}', '{"scrape":{"last_status":"succeeded","last_records_extracted":0}}', '{"scrape":{"last_status":"succeeded","last_records_extracted":"4"}}')
_SOURCE = f"""SELECT c_custkey AS k, 's' || c_custkey AS id, {_sql_pick(('aa', 'na', 'ca'), 'c_custkey')} AS fellowship, {_sql_pick(ADAPTERS, 'c_custkey // 3')} AS adapter, {_sql_pick(KINDS, 'c_custkey // 2')} AS kind, c_custkey % 6 AS cfg, c_custkey % 11 = 4 AS tel FROM customer"""


def _sources(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("s"), k).alias("id"), pick(("aa", "na", "ca"), k).alias("fellowship"), F.when(k % 11 == 4, "tel:+1").otherwise(F.concat(F.lit("https://x.org/"), k)).alias("url"), pick(KINDS, F.floor(k / 2)).alias("source_type"),
        pick(ADAPTERS, F.floor(k / 3)).alias("adapter_type"), (k % 2 == 0).alias("requires_browser"), F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"), pick(CONFIGS, k).alias("config"),
    )


@query(f"""SELECT id, adapter IN ('bmlt', 'meeting_guide', 'static_html', 'form_http', 'playwright_browser') AS ingestable, cfg = 1 AS classified,
CASE WHEN kind = 'world_service_listing' THEN fellowship = 'ca' ELSE NOT (adapter = 'unknown' AND cfg = 1) AND kind NOT IN ('phone', 'pdf') AND NOT tel END AS scrapeable, CASE WHEN adapter IN ('bmlt', 'meeting_guide') THEN 'feed' ELSE 'browser' END AS route FROM ({_SOURCE})""")
def scrapeable_sources(spark: SparkSession, d: str) -> DataFrame:
    """Which sources are read at all, and which way."""
    return _sources(spark, d).select("id", R.is_ingestable().alias("ingestable"), R.has_reason().alias("classified"), R.is_scrapeable().alias("scrapeable"), R.route().alias("route"))


@query(f"SELECT id, cfg = 3 AS failed, cfg = 4 AND adapter NOT IN ('bmlt', 'meeting_guide') AS empty FROM ({_SOURCE}) WHERE cfg = 3 OR (cfg = 4 AND adapter NOT IN ('bmlt', 'meeting_guide'))")
def retry_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose last run failed or gave nothing."""
    return R.for_retry(_sources(spark, d), only_failed=True, only_empty=True).select("id", R.last_failed().alias("failed"), R.last_empty().alias("empty"))


@query("SELECT 'scrape-all --fellowship na --no-dry-run --concurrency 4 --max-pages-per-source 6 ' || string_agg('--source-id src-' || n_nationkey, ' ' ORDER BY n_nationkey) AS command FROM nation WHERE n_nationkey IN (3, 1, 20)")
def retry_command(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.concat(F.lit("src-"), "n_nationkey").alias("id"), F.col("n_nationkey").alias("pos"))
    return R.retry_command(R.by_ids(n, ["src-20", "src-3", "src-1"]), "na", 4, 6)


@query(f"""SELECT id, 'playwright_browser' AS adapter_type, CASE WHEN kind = 'world_service_listing' THEN kind ELSE 'local_service_body' END AS source_type, CASE WHEN adapter IN ('playwright_browser', 'static_html', 'form_http') THEN NULL ELSE adapter END AS previous,
CASE cfg WHEN 3 THEN 'failed' WHEN 4 THEN 'succeeded' WHEN 5 THEN 'succeeded' END AS last_status FROM ({_SOURCE})""")
def browser_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources turned into pages to scrape; the adapter they had is remembered, what the config held stays."""
    out = R.as_browser(_sources(spark, d))
    return out.select("id", "adapter_type", "source_type", F.get_json_object("config", "$.scrape.previous_adapter_type").alias("previous"), F.get_json_object("config", "$.scrape.last_status").alias("last_status"))


@query(f"""SELECT id, CASE WHEN k % 4 = 3 THEN 'failed' ELSE 'succeeded' END AS last_status, (k % 5)::VARCHAR AS records, CASE WHEN k % 4 = 3 THEN 'boom' END AS error,
CASE WHEN k % 5 > 0 AND k % 4 < 3 THEN 'https://p/' || k END AS page, CASE WHEN adapter IN ('bmlt', 'meeting_guide') THEN adapter ELSE 'playwright_browser' END AS adapter_type, CASE WHEN adapter IN ('bmlt', 'meeting_guide') THEN 'meeting_feed' WHEN kind = 'world_service_listing' THEN kind ELSE 'local_service_body' END AS source_type FROM ({_SOURCE})""")
def scrape_status(spark: SparkSession, d: str) -> DataFrame:
    """Sources after a scraping run: status and counts noted, feeds that were scraped as pages become feeds again."""
    s = R.as_browser(_sources(spark, d))
    k = F.col("c_custkey")
    fine = (k % 5 > 0) & (k % 4 < 3)
    runs = s.select(
        F.col("id").alias("source_id"), F.when(k % 4 == 3, "failed").otherwise("succeeded").alias("status"), F.lit(2).alias("pages_visited"), (k % 5).alias("records_extracted"), F.lit("").alias("artifact_dir"),
        F.when(k % 4 == 3, "boom").alias("error"), F.when(fine, F.concat(F.lit("https://p/"), k)).alias("page_url"), F.when(fine, k % 5).alias("page_records"),
    )
    get = lambda p, a: F.get_json_object("config", f"$.scrape.{p}").alias(a)
    return R.with_scrape_status(s, runs).select("id", get("last_status", "last_status"), get("last_records_extracted", "records"), get("last_error", "error"), get("last_successful_page_url", "page"), "adapter_type", "source_type")


SEEDS = ('{"city":"Cork"}', "{}", '{"metadata":{"address_text":"12 Main St, Old Town Ireland"}}', '{"metadata":{"address_text":"12 Ireland"}}')


@query(f"SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Cork' WHEN 1 THEN CASE WHEN c_custkey % 3 = 0 THEN 'Munster' ELSE 'Ireland' END WHEN 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 'Munster' ELSE 'Old Town' END ELSE CASE WHEN c_custkey % 3 = 0 THEN 'Munster' ELSE 'Ireland' END END AS seed FROM customer")
def search_seeds(spark: SparkSession, d: str) -> DataFrame:
    """What a source's page is searched for: city, region, the end of its address, or country."""
    k = F.col("c_custkey")
    s = table(spark, d, "customer").select("c_custkey", pick(SEEDS, k).alias("config"), F.when(k % 3 == 0, " Munster ").alias("region"), F.lit("Ireland").alias("country"))
    return s.select("c_custkey", R.search_seed().alias("seed"))


SETTINGS = ("{}", '{"n": 7, "b": "Yes", "wait_until": "load"}', '{"n": "x", "b": "maybe", "wait_until": "never"}', '{"n": " 12 ", "b": false}')


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 7 WHEN 3 THEN 12 END AS n, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 3 THEN false END AS b, CASE c_custkey % 4 WHEN 1 THEN 'load' WHEN 2 THEN NULL ELSE 'networkidle' END AS wait,
CASE WHEN c_custkey % 4 = 2 THEN 3 ELSE 0 END AS errors FROM customer""")
def browser_settings(spark: SparkSession, d: str) -> DataFrame:
    """Typed settings with their defaults, and errors for what can't be read."""
    s = table(spark, d, "customer").select("c_custkey", pick(SETTINGS, F.col("c_custkey")).alias("config"))
    (n, e1), (b, e2), (w, e3) = R.integer_setting("n", 5), R.boolean_setting("b", True), R.wait_setting()
    return s.select("c_custkey", n.alias("n"), b.alias("b"), w.alias("wait"), F.size(F.array_compact(F.array(e1, e2, e3))).alias("errors"))


@query(f"""SELECT id, CASE k % 3 WHEN 0 THEN 'classification failed: timeout' WHEN 1 THEN 'json feed' ELSE CASE cfg WHEN 1 THEN 'no list' WHEN 2 THEN ' ' END END AS reason, CASE k % 3 WHEN 1 THEN 'bmlt' ELSE adapter END AS adapter_type FROM ({_SOURCE})""")
def classified_sources(spark: SparkSession, d: str) -> DataFrame:
    """Classification results joined in; one source's failure is its reason and changes nothing else."""
    s = _sources(spark, d)
    k = F.col("c_custkey")
    results = s.filter(k % 3 < 2).select(F.col("id").alias("source_id"), F.when(k % 3 == 1, "bmlt").alias("adapter_type"), F.when(k % 3 == 1, "json feed").alias("reason"), F.when(k % 3 == 0, "timeout").alias("error"))
    return R.classified(s, results).select("id", F.get_json_object("config", "$.classification.reason").alias("reason"), "adapter_type")


@query("""SELECT count(*)::BIGINT AS sources, count(*) FILTER (o_orderstatus = 'O')::BIGINT AS succeeded, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS failed, sum(o_custkey)::BIGINT AS records_fetched, sum(o_custkey % 10)::BIGINT AS records_normalized,
sum(o_custkey % 3)::BIGINT AS records_failed, sum(o_orderkey % 2)::BIGINT AS flags FROM orders""")
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return R.run_totals(o.select(F.when(F.col("o_orderstatus") == "O", "succeeded").when(F.col("o_orderstatus") == "F", "failed").alias("status"), F.col("o_custkey").alias("records_fetched"), (F.col("o_custkey") % 10).alias("records_normalized"), (F.col("o_custkey") % 3).alias("records_failed"), (F.col("o_orderkey") % 2).alias("flags")))


# ---- world listings


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'https://area' || c_custkey || '.org/m' ELSE 'tel:+1555' || c_custkey END AS url, c_name || CASE c_custkey % 3 WHEN 0 THEN '' ELSE ' phoneline' END AS label,
CASE c_custkey % 4 WHEN 0 THEN 'Ireland' WHEN 1 THEN 'Canada' WHEN 2 THEN 'United States' END AS country, CASE c_custkey % 4 WHEN 1 THEN 'Nova Scotia' WHEN 2 THEN 'West Virginia' END AS region, CASE c_custkey % 3 WHEN 0 THEN 'local_service_body' ELSE 'phone' END AS source_type
FROM customer WHERE c_custkey % 3 < 2""")
def aa_listing(spark: SparkSession, d: str) -> DataFrame:
    """Customers as items of a world listing: the first link to another site, else the phone; country and region by class or text."""
    k = F.col("c_custkey")
    link = F.when(k % 3 == 0, F.concat(F.lit('<a href="/find-aa">us</a><a href="https://area'), k, F.lit('.org/m">site</a><a href="https://late.org">x</a>'))).otherwise("")
    phone = F.when(k % 3 == 1, F.concat(F.lit("<p>Helpline: +1 (555) "), k, F.lit(" call</p>"))).otherwise("")
    place = pick(('<span class="country">Ireland</span>', "<address>5 St, Nova Scotia, Canada</address>", "<address>1 Rd, West Virginia 2</address>", "<address>x</address>"), k)
    html = F.concat(F.lit('<div class="view-locations-listing"><div class="area-loc-item"><h3>'), F.col("c_name"), F.lit("</h3>"), link, place, phone, F.lit('</div><div class="area-loc-item"><p>no heading</p></div></div>'))
    pages = table(spark, d, "customer").select(k.alias("page_id"), F.lit("https://www.aa.org/find-aa?state=CA").alias("url"), html.alias("html"))
    return W.aa_candidates(pages).select(F.col("page_id").alias("c_custkey"), "url", "label", "country", "region", "source_type")


@query("""SELECT c_nationkey AS page_id, k AS key, v AS value, (row_number() OVER (PARTITION BY c_nationkey ORDER BY k DESC, v) - 1)::INTEGER AS pos FROM
(SELECT DISTINCT c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'state' ELSE 'cc' END AS k, printf('%02d', c_custkey % 30) AS v FROM customer)""")
def aa_filter_queries(spark: SparkSession, d: str) -> DataFrame:
    """The options of a listing's two filters, each once."""
    c = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 2 == 0, "state").otherwise("cc").alias("k"), F.lpad((F.col("c_custkey") % 30).cast("string"), 2, "0").alias("v")).distinct()
    option = F.concat(F.lit('<option value="'), "v", F.lit('">o</option>'))
    one = lambda k: F.array_join(F.sort_array(F.collect_list(F.when(F.col("k") == k, option))), "")
    html = F.concat(F.lit('<select name="state"><option value="All">-</option>'), one("state"), one("state"), F.lit('</select><select name="cc"><option value="">-</option>'), one("cc"), F.lit("</select>"))
    return W.filter_queries(c.groupBy(F.col("c_nationkey").cast("long").alias("page_id")).agg(html.alias("html")))


@query("""WITH l AS (SELECT n_nationkey AS n, 'https://ca.org/meetings/land-' || n_nationkey || '/' AS u FROM nation)
SELECT u AS url, 'Land ' || n AS label, 'world_service_listing' AS source_type, 'Land ' || n AS country, NULL AS region FROM l
UNION ALL SELECT 'https://group' || c_custkey || '.org/' || CASE WHEN c_custkey % 5 = 0 THEN 'list.pdf' ELSE '' END, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'pdf' ELSE 'local_service_body' END, 'Land ' || c_nationkey, NULL FROM customer WHERE c_nationkey % 4 < 3
UNION ALL SELECT 'https://moved' || n || '.org/', 'https://moved' || n || '.org/', 'local_service_body', NULL, NULL FROM l WHERE n % 4 = 3""")
def ca_listing(spark: SparkSession, d: str) -> DataFrame:
    """Nations as listing pages of a world site, customers as the links on them: read level by level from the start page; a
    listing that answers from another site is a source itself."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n"))
    url = F.concat(F.lit("https://ca.org/meetings/land-"), "n", F.lit("/"))
    final = F.when(F.col("n") % 4 == 3, F.concat(F.lit("https://moved"), "n", F.lit(".org/"))).otherwise(url)
    start = spark.range(1).select(F.lit(-1).cast("long").alias("page_id"), F.lit(W.CA_WORLD).alias("url"), F.lit(W.CA_WORLD).alias("final_url"))
    pages = n.select(F.col("n").alias("page_id"), url.alias("url"), final.alias("final_url")).unionByName(start)
    top = n.select(F.lit(-1).cast("long").alias("page_id"), F.col("n").cast("int").alias("pos"), url.alias("href"), F.concat(F.lit("Land "), "n").alias("text"))
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    out = c.select(F.col("c_nationkey").cast("long").alias("page_id"), k.cast("int").alias("pos"), F.concat(F.lit("https://group"), k, F.lit(".org/"), F.when(k % 5 == 0, "list.pdf").otherwise("")).alias("href"), F.col("c_name").alias("text"))
    noise = n.select(F.col("n").alias("page_id"), F.lit(0).alias("pos"), pick(("https://zoom.us/j/1", "mailto:x@y.z", "https://us02.zoom.us/j/2", "https://ca.org/meetings/"), F.col("n")).alias("href"), F.lit("noise").alias("text"))
    return W.ca_crawl(pages, top.unionByName(out).unionByName(noise)).select("url", "label", "source_type", "country", "region")


@query("""SELECT DISTINCT ON (k) url, label, country, region, source_type FROM (
SELECT c_nationkey AS n, c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'https://site' || c_custkey || '.org' WHEN 1 THEN 'http://site' || c_custkey || '.org' WHEN 2 THEN 'tel:+44' || c_custkey ELSE 'https://www.na.org/?ID=phoneline&id=' || c_custkey END AS url,
c_name || CASE WHEN c_custkey % 4 < 2 THEN '' ELSE ' phoneline' END AS label, 'United States' AS country, 'State ' || c_nationkey AS region, CASE WHEN c_custkey % 4 < 2 THEN 'local_service_body' ELSE 'phone' END AS source_type FROM customer) WHERE n % 5 < 4""")
def na_locator(spark: SparkSession, d: str) -> DataFrame:
    """Nations as places of a locator's index, customers as its answers; an answer for a place not in the index doesn't count."""
    n = table(spark, d, "nation")
    states = F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(F.concat(F.lit("State "), "n_nationkey").alias("state")))).alias("ll_us"), F.array().cast("array<struct<state:string>>").alias("data")))
    index = n.filter("n_nationkey % 5 < 4").agg(states.alias("payload"))
    k = F.col("c_custkey")
    item = F.struct(
        pick(("https://site", "site", None, None), k).alias("w"), F.col("c_name").alias("description"), F.lit("United States").alias("country"), F.concat(F.lit("State "), "c_nationkey").alias("state"),
        F.when(k % 4 == 0, F.concat(F.lit("https://site"), k, F.lit(".org"))).when(k % 4 == 1, F.concat(F.lit("site"), k, F.lit(".org"))).alias("website"), F.when(k % 4 == 2, F.concat(F.lit("+44 "), k)).alias("phone"), F.when(k % 4 == 3, k.cast("string")).alias("phonewebid"),
    )
    answers = table(spark, d, "customer").groupBy("c_nationkey").agg(F.to_json(F.struct(F.sort_array(F.collect_list(item)).alias("data"))).alias("payload"))
    answers = answers.select(F.lit("United States").alias("country"), F.concat(F.lit("State "), "c_nationkey").alias("state"), "payload")
    return W.na_candidates(index, answers).select("url", "label", "country", "region", "source_type")


@query("""SELECT page_id, CASE WHEN contains(url, 'zoom.us') THEN false ELSE true END AS valid FROM (SELECT page_id, CASE page_id % 6 WHEN 1 THEN 'https://us.zoom.us/j/1' ELSE url END AS url, page_id % 6 AS k FROM pages) WHERE k < 2
UNION ALL SELECT page_id, page_id % 6 IN (3) FROM pages WHERE page_id % 6 >= 2""")
def valid_ca_urls(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id")
    url = F.when(k % 6 == 0, F.col("url")).otherwise(pick((None, "https://us.zoom.us/j/1", "https://www.tinyurl.com/x", "https://ca-online.org/", "https://ca-online.org/deep", "https://x.org/newsgram/1"), k))
    return table(spark, d, "pages").select("page_id", R.valid_ca_url(url).alias("valid"))


@query("""SELECT 's' || c_custkey AS source_id, CASE c_custkey % 4 WHEN 3 THEN NULL ELSE c_name END AS name, CASE c_custkey % 4 WHEN 3 THEN NULL WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS day, CASE c_custkey % 4 WHEN 3 THEN 'unsupported adapter: pdf' END AS error FROM customer""")
def dispatched_answers(spark: SparkSession, d: str) -> DataFrame:
    """Captured answers of four kinds of sources, each read by its adapter; sources of other kinds are refused."""
    from ..sources import dispatch

    k = F.col("c_custkey")
    kinds = ("meeting_guide", "bmlt", "static_html", "pdf")
    sid = F.concat(F.lit("s"), k)
    a = F.to_json(F.array(F.struct(k.cast("string").alias("slug"), F.col("c_name").alias("name"), F.lit("1").alias("day"), F.lit("19:00").alias("time"))))
    b = F.to_json(F.array(F.struct(k.cast("string").alias("id_bigint"), F.col("c_name").alias("meeting_name"), F.lit("2").alias("weekday_tinyint"), F.lit("19:00").alias("start_time"))))
    page = F.concat(F.lit("<table><tr><th>Meeting<th>Day<th>Time<th>Location</tr><tr><td>"), F.col("c_name"), F.lit("</td><td>Wednesday</td><td>7:00 pm</td><td>Hall</td></tr></table>"))
    c = table(spark, d, "customer")
    answers = c.select(sid.alias("source_id"), F.when(k % 4 == 0, a).when(k % 4 == 1, b).otherwise(page).alias("body"))
    sources = c.select(sid.alias("id"), F.lit("aa").alias("fellowship"), F.lit("https://x").alias("url"), F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"), F.lit("{}").alias("config"), pick(kinds, k).alias("adapter_type"))
    out, refused = dispatch.candidates(answers, sources)
    rows = out.select("source_id", "name", F.get("occurrences", F.lit(0))["day_of_week"].alias("day"), F.lit(None).cast("string").alias("error"))
    return rows.unionByName(refused.select("source_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("day"), "error"))


@query("""WITH RECURSIVE p AS (SELECT count(*) AS n FROM pages), b AS (SELECT page_id AS u, CASE WHEN page_id % 10 = 9 THEN page_id - 1 ELSE page_id END AS f, length(html) % 3 AS r FROM pages),
g AS MATERIALIZED (SELECT *, r > 0 AND u % 7 = 0 AS good, r = 0 AND u % 41 = 0 AS none, r > 0 AND u % 2 = 0 AS again FROM b),
l AS MATERIALIZED (SELECT s, a, list(u ORDER BY o) AS us FROM (SELECT c_nationkey AS s, o_custkey % n AS a, o_orderkey % n AS u, min(o_orderkey) AS o FROM orders JOIN customer ON o_custkey = c_custkey, p GROUP BY 1, 2, 3) GROUP BY 1, 2),
e AS (SELECT c_nationkey AS s, c_custkey AS o, c_custkey % n AS u, -1 AS d FROM customer, p WHERE c_custkey % 17 = 0 UNION ALL SELECT n_nationkey, 1000000000, n_nationkey % n, 0 FROM nation, p),
step AS (SELECT s, list({'u': u, 'd': d} ORDER BY o) AS q, []::BIGINT[] AS seen, []::BIGINT[] AS ends, 0 AS number, NULL::BIGINT AS u, NULL::INTEGER AS d, false AS stop, false AS took FROM e GROUP BY s
UNION ALL SELECT s, CASE WHEN take AND NOT halt AND leads AND d < 3 THEN list_concat(rest, list_transform(coalesce(us, []), lambda x: {'u': x, 'd': d + 1})) ELSE rest END, CASE WHEN take THEN list_append(seen, u) ELSE seen END, CASE WHEN take THEN list_append(ends, f) ELSE ends END,
number + take::INTEGER, u, d, take AND halt, take FROM (SELECT *, CASE WHEN d < 0 AND again AND NOT waiting THEN true WHEN NOT leads THEN false WHEN d >= 0 AND none THEN true WHEN d >= 3 THEN good ELSE good AND NOT waiting END AS halt
FROM (SELECT step.s, q[2:] AS rest, seen, ends, number, q[1].u AS u, q[1].d AS d, g.f, g.good, g.none, g.again, l.us, q[1].d >= 0 OR r > 0 AS leads, len(list_filter(q[2:], lambda x: x.d < 0)) > 0 AS waiting,
g.u IS NOT NULL AND NOT list_contains(seen, q[1].u) AND NOT list_contains(ends, q[1].u) AND NOT list_contains(ends, g.f) AS take FROM step LEFT JOIN g ON g.u = q[1].u LEFT JOIN l ON l.s = step.s AND l.a = q[1].u WHERE len(q) > 0 AND number < 15 AND NOT stop)))
SELECT s AS source_id, number, u AS url, d AS depth, stop FROM step WHERE took""")
def crawl_budgets(spark: SparkSession, d: str) -> DataFrame:
    """Nations crawl the pages over links that their customers' orders make: 15 pages each, depth 3, stop rules; some customers are pages
    remembered from an earlier run."""
    from ..operators.crawl_loop import crawl_sources

    n = F.lit(table(spark, d, "pages").count())
    k, r = F.col("page_id"), F.length("html") % 3
    pages = table(spark, d, "pages").select(
        k.alias("url"), F.when(k % 10 == 9, k - 1).otherwise(k).alias("final_url"), r.alias("rows"), ((r > 0) & (k % 7 == 0)).alias("good"), ((r == 0) & (k % 41 == 0)).alias("empty"), ((r > 0) & (k % 2 == 0)).alias("as_before"), F.lit(False).alias("not_found"),
    )
    c = table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("source_id"), "c_custkey")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("source_id"))
    links = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("source_id", (F.col("o_custkey") % n).alias("page"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % n).alias("url"))
    old = c.filter("c_custkey % 17 = 0").select("source_id", F.col("c_custkey").alias("pos"), (F.col("c_custkey") % n).alias("url"), F.lit(-1).alias("depth"))
    entries = old.unionByName(nations.select("source_id", F.lit(1_000_000_000).cast("long").alias("pos"), (F.col("source_id") % n).alias("url"), F.lit(0).alias("depth")))
    nothing = links.select("source_id", "pos", "url").limit(0)
    return crawl_sources(nations.withColumn("world", F.lit(False)), entries, pages, links, nothing, nothing, max_pages=15, max_depth=3)


@query("""SELECT 'https://ca.org/meetings/land-' || i || '/' AS url, i::INTEGER AS depth FROM (SELECT unnest(range(1, (SELECT count(*) FROM nation) + 1)) AS i)""")
def ca_chain(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages in a chain, one nation after another: all are read, at whatever depth."""
    n = table(spark, d, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("n"))
    url = lambda i: F.concat(F.lit("https://ca.org/meetings/land-"), i, F.lit("/"))
    start = spark.range(1).select(F.lit(0).cast("long").alias("page_id"), F.lit(W.CA_WORLD).alias("url"), F.lit(W.CA_WORLD).alias("final_url"))
    pages = n.select(F.col("n").alias("page_id"), url(F.col("n")).alias("url"), url(F.col("n")).alias("final_url")).unionByName(start)
    links = n.select((F.col("n") - 1).alias("page_id"), F.lit(0).alias("pos"), url(F.col("n")).alias("href"), F.concat(F.lit("Land "), "n").alias("text"))
    return W.ca_crawl(pages, links).select("url", (F.col("depth") + 1).cast("int").alias("depth"))
