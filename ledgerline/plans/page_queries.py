"""Queries on pages: extractors over pages written from driver tables, and a crawl's rules over captured links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import schedule, urls
from ..operators import crawl as C, forms
from ..operators.ranking import first_wins
from ..session import spread
from ..sources import discovery, extract
from .model import pick, table
from .registry import query
from .source_queries import _sql_pick

DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_SQL_DAY = _sql_pick(DAYS, "c_custkey")
_SQL_HOUR = "(c_custkey % 11 + 1) || ':30 pm'"
_SQL_STREET = "(c_custkey % 900 + 1) || ' Oak Street'"
_SQL_NAME = "'Group ' || translate(c_custkey::VARCHAR, '0123456789', 'bcdfghjklm')"


def _k() -> Column:
    return F.col("c_custkey")


def _day() -> Column:
    return pick(DAYS, _k())


def _hour() -> Column:
    return F.concat((_k() % 11 + 1).cast("string"), F.lit(":30 pm"))


def _street() -> Column:
    return F.concat((_k() % 900 + 1).cast("string"), F.lit(" Oak Street"))


def _name() -> Column:
    return F.concat(F.lit("Group "), F.translate(_k().cast("string"), "0123456789", "bcdfghjklm"))


def _t(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _extracted(spark: SparkSession, d: str, html: Column, *cols: str, config: Column | None = None) -> DataFrame:
    pages = table(spark, d, "customer").select(_k().alias("page_id"), F.lit("https://x.org/meetings").alias("url"), html.alias("html"), (config if config is not None else F.lit(None).cast("string")).alias("config"))
    return extract.extract(pages).select(F.col("page_id").alias("c_custkey"), "kind", *cols)


_ROW = f"{_SQL_NAME} AS name, {_SQL_DAY} AS day, {_SQL_HOUR} AS time"


@query(f"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'classed_table' WHEN 1 THEN 'header_table' WHEN 2 THEN 'day_matrix' WHEN 3 THEN 'heading_table' ELSE 'classed_rows' END AS kind, {_SQL_NAME} AS name, {_SQL_DAY} AS day,
CASE c_custkey % 5 WHEN 0 THEN '1' || (c_custkey % 10) || ':15' ELSE {_SQL_HOUR} END AS time, CASE WHEN c_custkey % 5 = 2 THEN 'Cork' END AS city, CASE WHEN c_custkey % 5 IN (1, 3, 4) THEN {_SQL_STREET} END AS address_line1 FROM customer""")
def extract_tables(spark: SparkSession, d: str) -> DataFrame:
    """Five shapes of tables and rows: cells with classes, known headings, a column a day, a spanning title, classed blocks."""
    cell = lambda c, cls="": _t(f'<td class="{cls}">' if cls else "<td>", c, "</td>")
    sort = _t('<td class="time" data-sort="', (F.pmod(_k(), F.lit(7)) + 1).cast("string"), "-1", (_k() % 10).cast("string"), ':15">x</td>')
    classed = _t("<table><tr>", sort, cell(_name(), "name"), cell(F.lit("Hall"), "location"), "</tr></table>")
    headed = _t("<table><tr><th>Meeting name<th>Weekday<th>Start time<th>Address</tr><tr>", cell(_name()), cell(_day()), cell(_hour()), cell(_street()), "</tr></table>")
    days = [_t("<td>", F.when(_k() % 7 == i, _hour()).otherwise(""), "</td>") for i in range(7)]
    matrix = _t("<table><tr><th>Group", *(f"<th>{x}" for x in DAYS), "</tr><tr><td colspan=8>Cork</td></tr><tr><td>", _name(), "</td>", *days, "</tr></table>")
    titled = _t("<table><tr><th colspan=2>", _name(), " at ", _street(), "</th></tr><tr><td>", _day(), "</td><td>", _hour(), "</td></tr><tr><td>Notes</td><td>none</td></tr></table>")
    rows = _t('<div class="meeting-row"><h3>', _name(), "</h3><p>", _day(), " ", _hour(), "</p><p>", _street(), "</p></div>")
    html = F.when(_k() % 5 == 0, classed).when(_k() % 5 == 1, headed).when(_k() % 5 == 2, matrix).when(_k() % 5 == 3, titled).otherwise(rows)
    return _extracted(spark, d, html, "name", "day", "time", "city", "address_line1")


@query(f"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'coded_tabs' WHEN 1 THEN 'day_tabs' WHEN 2 THEN 'labelled' WHEN 3 THEN 'place_sections' ELSE 'japanese' END AS kind, CASE c_custkey % 5 WHEN 4 THEN '希望' || c_custkey ELSE {_SQL_NAME} END AS name, {_SQL_DAY} AS day,
CASE c_custkey % 5 WHEN 4 THEN (c_custkey % 11 + 13) || ':30' ELSE {_SQL_HOUR} END AS time, CASE c_custkey % 5 WHEN 4 THEN '東京都中野区' ELSE {_SQL_STREET} END AS address_line1, CASE c_custkey % 5 WHEN 0 THEN 'AB' || c_custkey END AS source_record_id FROM customer""")
def extract_schedules(spark: SparkSession, d: str) -> DataFrame:
    """Tabbed lines with codes, tabbed lines under days, labelled blocks, places with times, and Japanese blocks."""
    coded = _t("\tAB", _k().cast("string"), "\tx\t", _day(), "\t", _hour(), "\t", _name(), "\tHall\n\t", _street(), "\n")
    tabs = _t(_day(), "\n", _name(), "\tCork\t", _street(), "\t", _hour(), "\nloose\tline\n")
    labels = _t("Name: ", _name(), "\nDay: ", _day(), "\nTime: ", _hour(), "\nAddress: ", _street(), "\n")
    places = _t("<section><h2>Lokacija: ", _street(), "</h2><ul><li>", _name(), " čas: ", _hour(), " ", _day(), "</li><li>no label</li></ul></section>")
    japanese = _t("<p>", pick(("月", "火", "水", "木", "金", "土", "日"), _k()), "曜日</p><p>●希望", _k().cast("string"), "</p><p>午後", (_k() % 11 + 1).cast("string"), ":30</p><p>東京都中野区</p><p>●休み</p><p>休止中 10:00</p>")
    html = F.when(_k() % 5 == 0, coded).when(_k() % 5 == 1, tabs).when(_k() % 5 == 2, labels).when(_k() % 5 == 3, places).otherwise(japanese)
    return _extracted(spark, d, html, "name", "day", "time", "address_line1", "source_record_id")


@query(f"""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'day_sections' WHEN 1 THEN 'columns' WHEN 2 THEN 'paragraphs' WHEN 3 THEN 'inline' WHEN 4 THEN 'numbered_list' WHEN 5 THEN 'sequenced' ELSE 'text_block' END AS kind, {_ROW},
CASE c_custkey % 7 WHEN 2 THEN {_SQL_NAME} || ', ' || {_SQL_DAY} || ' ' || {_SQL_HOUR} || ' ' || {_SQL_STREET} ELSE {_SQL_STREET} END AS address_line1 FROM customer""")
def extract_texts(spark: SparkSession, d: str) -> DataFrame:
    """Seven shapes of running text: sections by day, one cell a line, paragraphs, inline pairs, numbered lists, names before
    times, and blocks."""
    sections = _t("<main><h2>", _day(), "</h2><p>", _hour(), " ", _name(), "</p><p>", _street(), "</p></main>")
    columns = _t("<div>", _hour(), "</div><div>", _day(), "</div><div>", _name(), "</div><div>Hall</div><div>", _street(), "</div>")
    paragraph = _t("<p>", _name(), ", ", _day(), " ", _hour(), " ", _street(), "</p>")
    inline = _t("<div>", _name(), " ", _day(), " ", _hour(), " ", _street(), "</div>")
    numbered = _t("Number found:\n1\n", _name(), "\n(1) ", _day(), "\n", _hour(), "\nIn-person\nCo. Cork\n", _street(), "\n")
    sequenced = _t("<div>", _name(), "</div><div>", _day(), " ", _hour(), "</div><div>", _street(), "</div>")
    block = _t("<div>", _name(), "</div><div>", _day(), "</div><div>", _hour(), "</div><div>", _street(), "</div>")
    html = F.when(_k() % 7 == 0, sections).when(_k() % 7 == 1, columns).when(_k() % 7 == 2, paragraph).when(_k() % 7 == 3, inline).when(_k() % 7 == 4, numbered).when(_k() % 7 == 5, sequenced).otherwise(block)
    return _extracted(spark, d, html, "name", "day", "time", "address_line1")


_ICS_DAY = _sql_pick(("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"), "c_custkey")


@query(f"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'configured' WHEN 1 THEN 'feed_json' WHEN 2 THEN 'calendar' ELSE 'printed_list' END AS kind, CASE c_custkey % 5 WHEN 4 THEN 'あさひ' || c_custkey ELSE {_SQL_NAME} END AS name, {_SQL_DAY} AS day,
CASE c_custkey % 5 WHEN 2 THEN '1' || (c_custkey % 10) || ':30' WHEN 4 THEN '1' || (c_custkey % 10) || ':30' ELSE {_SQL_HOUR} END AS time, CASE c_custkey % 5 WHEN 4 THEN '札幌市中央区' ELSE {_SQL_STREET} END AS address_line1 FROM customer""")
def extract_documents(spark: SparkSession, d: str) -> DataFrame:
    """Selectors from a source's config, listing JSON, weekly calendar events, and texts of printed lists, also Japanese ones."""
    configured = _t('<div class="m"><b>', _name(), '</b><i class="d">', _day(), '</i><i class="t">', _hour(), '</i><i class="a">', _street(), "</i></div>")
    item = F.struct(_name().alias("name"), ((_k() + 1) % 7).alias("day"), _hour().alias("time"), _street().alias("formatted_address"))
    feed = F.to_json(F.struct(F.array(item).alias("meetings")))
    event = lambda rule: _t("BEGIN:VEVENT\r\nSUMMARY:", _name(), "\r\nLOCATION:", _street(), "\r\nDTSTART:20240101T1", (_k() % 10).cast("string"), f"3000\r\nRRULE:{rule}", "\r\nEND:VEVENT\r\n")
    code = pick(("MO", "TU", "WE", "TH", "FR", "SA", "SU"), _k())
    weekly = _t("BEGIN:VEVENT\r\nSUMMARY:", _name(), "\r\nLOCATION:", _street(), "\r\nDTSTART:20240101T1", (_k() % 10).cast("string"), "3000\r\nRRULE:FREQ=WEEKLY;BYDAY=", code, "\r\nEND:VEVENT\r\n")
    ics = _t("BEGIN:VCALENDAR\r\n", event("FREQ=MONTHLY"), weekly, event("FREQ=WEEKLY;UNTIL=20230101T000000Z"), "END:VCALENDAR")
    pdf = lambda *x: _t('<div data-pdf-text-fallback="true"><pre>', *x, "</pre></div>")
    printed = pdf("AREA MEETING LIST\n", _day(), "\n", _hour(), " ", _name(), "\n", _street(), "\nwww.x.org")
    japanese = pdf(pick(("月", "火", "水", "木", "金", "土", "日"), _k()), "曜日\n1", (_k() % 10).cast("string"), ":30 あさひ", _k().cast("string"), "\n札幌市中央区\n")
    html = F.when(_k() % 5 == 0, configured).when(_k() % 5 == 1, feed).when(_k() % 5 == 2, ics).when(_k() % 5 == 3, printed).otherwise(japanese)
    config = F.when(_k() % 5 == 0, '{"selectors": {"row": ".m", "name": "b", "day": ".d", "time": ".t", "address_line1": ".a"}}').otherwise('{"as_of": "20240101"}')
    return _extracted(spark, d, html, "name", "day", "time", "address_line1", config=config)


@query(f"""SELECT c_custkey, count(*)::BIGINT AS n, string_agg(kind, ',' ORDER BY kind) AS kinds FROM (SELECT c_custkey, 'header_table' AS kind FROM customer UNION ALL SELECT c_custkey, 'cards' FROM customer UNION ALL SELECT c_custkey, 'cards' FROM customer) GROUP BY 1""")
def extractor_union(spark: SparkSession, d: str) -> DataFrame:
    """A page with a table and with cards gives the rows of both, and no fall-back's."""
    card = lambda n: _t("<article><h3>", _name(), f" {n}</h3><p>", _day(), " ", _hour(), "</p><p>", _street(), "</p></article>")
    html = _t("<table><tr><th>Meeting<th>Day<th>Time<th>Address</tr><tr><td>", _name(), "</td><td>", _day(), "</td><td>", _hour(), "</td><td>", _street(), "</td></tr></table>", card("one"), card("two"))
    rows = _extracted(spark, d, html, "name")
    return rows.groupBy("c_custkey").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("kind")), ",").alias("kinds"))


# ---- times and days in texts

CLOCKS = ("noon", "midnight", "kl. 19.30", "19h", "7p", "1930pm", "14:00 pm", "7:30 - 8:30 pm", "8")
CLEAN = ("12:00 pm", "12:00 am", "19:30", "19:00", "7pm", "19:30pm", "14:00", "7:30", "8:00")


@query(f"SELECT c_custkey, {_sql_pick(CLEAN, 'c_custkey')} AS cleaned FROM customer")
def cleaned_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", schedule.clean_time(pick(CLOCKS, _k())).alias("cleaned"))


DAY_WORDS = ("daily", "Monday", "lundi", "7", "0", "x", "воскресенье", "Сб", "sabtu")


@query(f"SELECT c_custkey, TRY_CAST({_sql_pick(('0', '1', '1', '0', '0', None, '0', None, '6'), 'c_custkey')} AS INTEGER) AS day FROM customer")
def normalized_day(spark: SparkSession, d: str) -> DataFrame:
    """The first day that a word stands for."""
    return table(spark, d, "customer").select("c_custkey", schedule.normalize_day(pick(DAY_WORDS, _k())).cast("int").alias("day"))


# ---- the crawl

SITE = "https://www.site{k}.org/area/"
_PATHS = ("area/meetings/", "area/donate", "groups/list", "news", "a.pdf", "area/x", "where-to-find", "Meeting-Schedule")
_SCORES = (90, 0, 50, 0, 0, 40, 70, 120)


def _links(spark: SparkSession, d: str) -> DataFrame:
    """orders as links from the sites of customers."""
    k = F.col("o_orderkey")
    host = F.concat(F.lit("https://www.site"), "o_custkey", F.lit(".org/"))
    return table(spark, d, "orders").select(F.concat(host, F.lit("area/")).alias("source_url"), k.alias("pos"), F.concat(host, pick(_PATHS, k), F.when(k % 3 == 0, F.concat(F.lit("?p="), k)).otherwise("")).alias("url"), F.lit("link").alias("text"), "o_orderkey")


@query(r"""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'area' WHEN 1 THEN 'area' WHEN 5 THEN 'area' ELSE '' END AS area, o_orderkey % 8 AS p FROM orders)
SELECT o_orderkey, p IN (0, 1, 5) AS child, p IN (2, 6, 7) AND p <> 2 AS common, false AS landing, p IN (0, 2, 6, 7) AS directory FROM t""")
def link_relevance(spark: SparkSession, d: str) -> DataFrame:
    """What links are to their source: below it, on a path where meetings usually are, its front page, a directory of meetings."""
    u, s = F.col("url"), F.col("source_url")
    return _links(spark, d).select("o_orderkey", C.is_child(s, u).alias("child"), C.is_common_path(s, u).alias("common"), C.is_landing(u).alias("landing"), C.is_directory(u, F.col("text")).alias("directory"))


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey)::INTEGER AS rank FROM (SELECT o_orderkey, o_custkey, list_extract([140, 40, 50, 0, 0, 40, 70, 100], o_orderkey % 8 + 1) AS score FROM orders) WHERE score > 0""")
def prioritized_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to follow, best first within each source."""
    return C.prioritized(_links(spark, d)).select("o_orderkey", "rank")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 8 = 5")
def fall_back_links(spark: SparkSession, d: str) -> DataFrame:
    """Links that say nothing for or against meetings, other than files."""
    return C.fall_backs(_links(spark, d)).select("o_orderkey")


_GUESSED = sorted({p.rstrip("/").lower() or "/" for p in C.COMMON_PATHS})


@query(f"""SELECT c_custkey, {len(C.COMMON_PATHS)} - CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS n, 'https://h' || c_custkey || '.org/' || CASE WHEN c_custkey % 2 = 0 THEN 'meetings/' ELSE 'meeting/' END AS first_url, 'meetings/find a meeting' AS third FROM customer""")
def common_path_guesses(spark: SparkSession, d: str) -> DataFrame:
    """Pages to try on each site; a site that begins at one of the paths isn't tried there again."""
    s = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("https://h"), _k(), F.lit(".org"), F.when(_k() % 2 == 0, "/meeting").otherwise("/home")).alias("source_url"))
    # sources are dealt over all cores by the key that their guesses are grouped by
    g = C.guesses(spread(s, "c_custkey"), "c_custkey")
    return g.groupBy("c_custkey").agg(F.count("*").cast("int").alias("n"), F.min_by("url", "pos").alias("first_url"), F.max(F.when(F.col("pos") == 2, F.col("text"))).alias("third"))


_CONFIG = ('{"scrape":{"successful_pages":[{"url":"https://w.org/a#x","records_extracted":8},{"url":"https://w.org/b","records_extracted":0}],"successful_page_urls":["https://w.org/a","https://w.org/c"],"last_successful_page_url":"https://w.org/d","last_successful_page_records":3}}', "{}", '{"scrape":{"successful_page_urls":["https://w.org/1","https://w.org/2","https://w.org/3","https://w.org/4","https://w.org/5","https://w.org/6"]}}')


def _remembering(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.concat(F.lit("https://w.org/?s="), _k()).alias("source_url"), pick(_CONFIG, _k()).alias("config"))


@query("""SELECT c_custkey, x AS url FROM customer, LATERAL (SELECT unnest(CASE c_custkey % 3 WHEN 0 THEN ['a', 'b', 'c', 'd'] WHEN 2 THEN ['1', '2', '3', '4', '5'] ELSE [] END) AS x)""")
def remembered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that gave rows before: three lists in turn, each page once, five at most."""
    s = _remembering(spark, d)
    return C.remembered(spread(s, "c_custkey"), "c_custkey").select("c_custkey", F.regexp_extract("url", "([^/]+)$", 1).alias("url"))


@query("""SELECT c_custkey, depth, n FROM (SELECT c_custkey, -1 AS depth, CASE c_custkey % 3 WHEN 0 THEN 4 WHEN 2 THEN 5 ELSE 0 END::BIGINT AS n FROM customer UNION ALL SELECT c_custkey, 0, 1 FROM customer) WHERE n > 0""")
def crawl_frontier(spark: SparkSession, d: str) -> DataFrame:
    """Where a crawl begins: remembered pages, then the source."""
    s = _remembering(spark, d)
    return C.first_frontier(spread(s, "c_custkey"), "c_custkey").groupBy("c_custkey", "depth").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE c_custkey % 4 WHEN 0 THEN 8 WHEN 2 THEN 3 END END AS expected FROM customer")
def expected_records(spark: SparkSession, d: str) -> DataFrame:
    """How many rows a page gave when it was last read."""
    page = pick(("https://w.org/a", "https://w.org/b", "https://w.org/d#top", "https://w.org/none"), _k())
    return _remembering(spark, d).select("c_custkey", C.expected_records(F.col("config"), page).alias("expected"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity::INTEGER % 12 AS n, l_discount * 10 AS s, l_orderkey % 3 = 0 AS land, l_partkey % 2 = 0 AS deeper, l_partkey % 5 = 0 AS branch, l_suppkey % 2 = 0 AS waiting, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 12 END AS e, l_returnflag = 'R' AS sig FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN n > 0 AND land THEN NOT deeper WHEN n > 0 AND branch THEN false ELSE n >= 3 AND s >= 0.5 END AS good, n > 0 AND NOT waiting AND (e IS NULL OR e <= 2 OR n >= greatest(1, floor(e * 0.75))) AS remembered, n <= 0 AND NOT land AND s >= 0.5 AND sig AS empty FROM p""")
def stop_rules(spark: SparkSession, d: str) -> DataFrame:
    """Three reasons to end a crawl, over all line items as pages."""
    c = F.col
    pages = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (c("l_quantity").cast("int") % 12).alias("extracted"), (c("l_discount") * 10).alias("page_score"), F.when(c("l_orderkey") % 3 == 0, "https://x.org/").otherwise("https://x.org/list").alias("url"), (c("l_partkey") % 2 == 0).alias("deeper"),
        (c("l_partkey") % 5 == 0).alias("pending_branch"), (c("l_suppkey") % 2 == 0).alias("pending_remembered"), F.when(c("l_partkey") % 3 > 0, c("l_partkey") % 12).alias("expected"), F.when(c("l_returnflag") == "R", F.array(F.lit("meeting_table"), F.lit("x"))).otherwise(F.array(F.lit("x"))).alias("signals"),
    )
    return C.stops(pages).select("l_orderkey", "l_linenumber", c("stop_good").alias("good"), c("stop_remembered").alias("remembered"), c("stop_empty").alias("empty"))


@query("""SELECT event_id, event_id % 2 = 0 AND CASE WHEN user_id % 2 = 0 THEN true WHEN event_type = 'error' THEN false ELSE event_type <> 'purchase' END AS allowed, value / 100 < 0.18 AND user_id % 3 > 0 AS vetoed FROM events""")
def search_permission(spark: SparkSession, d: str) -> DataFrame:
    """May a page's search form be sent, and is a page too unlike a meeting page to be read?"""
    signals = F.when(F.col("event_type") == "error", F.array(F.lit("meeting_form"))).when(F.col("event_type") == "purchase", F.array(F.lit("body:meeting list"))).otherwise(F.array(F.lit("text:groups")))
    return table(spark, d, "events").select("event_id", C.may_search(F.col("event_id") % 2 == 0, F.col("user_id") % 2 > 0, signals).alias("allowed"), C.below_veto(F.col("user_id") % 3 == 0, F.col("value") / 100).alias("vetoed"))


TITLES = ("Meetings", "404 error", "Page not found", "Seite nicht gefunden", None, "Страница не найдена", "Groups")


@query("SELECT o_orderkey, o_orderkey % 7 IN (1, 2, 3, 5) OR contains(o_orderkey::VARCHAR, '404') AS missing, o_orderkey % 8 NOT IN (6, 7) AS stays FROM orders")
def not_found_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that don't exist, and which waiting pages stay once a guess has failed."""
    k = F.col("o_orderkey")
    links = _links(spark, d)
    left = C.without_common_paths(links).select("o_orderkey", F.lit(True).alias("stays"))
    return links.join(left, "o_orderkey", "left").select("o_orderkey", C.not_found(pick(TITLES, k), F.concat(F.lit("https://x.org/"), k)).alias("missing"), F.coalesce("stays", F.lit(False)).alias("stays"))


FILES = (("https://x.org/Meeting_List.pdf", "get"), ("https://x.org/f.pdf", "Area newsletter"), ("https://x.org/f.pdf", "Meeting schedule"), ("https://x.org/?current-meeting-list=1", "our meeting list"), ("https://x.org/?current-meeting-list=", "meeting list"), ("https://x.org/list", "meeting list"), ("https://x.org/%E3%83%9F.pdf", "会場案内"))


@query("SELECT c_custkey, c_custkey % 7 IN (0, 2, 3, 6) AS meeting_list, c_custkey % 7 = 3 AS download FROM customer")
def meeting_list_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to meeting lists to download, by names and query."""
    u, t = pick(tuple(f[0] for f in FILES), _k()), pick(tuple(f[1] for f in FILES), _k())
    return table(spark, d, "customer").select("c_custkey", C.is_meeting_pdf(u, t).alias("meeting_list"), C.has_list_query(u).alias("download"))


QUERIES = ("", "tsml-region=cork&tsml-region=x", "tsml-district=all", "TSML-attendance_option=in_person&x=1", "q=1")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 IN (1, 2, 3) THEN 'https://x.org/wp-admin/admin-ajax.php?action=meetings' || CASE c_custkey % 5 WHEN 1 THEN '&region=cork' WHEN 3 THEN '&attendance_option=in_person' ELSE '' END END AS feed, c_custkey % 5 IN (1, 2, 3) AS is_feed FROM customer""")
def feed_urls(spark: SparkSession, d: str) -> DataFrame:
    """The feeds behind filtered pages."""
    feed = C.feed_url(F.concat(F.lit("https://x.org/list?"), pick(QUERIES, _k())))
    return table(spark, d, "customer").select("c_custkey", feed.alias("feed"), F.coalesce(C.is_feed_url(feed), F.lit(False)).alias("is_feed"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'https://calendar.google.com/calendar/ical/g' || c_custkey || '@x.org/public/basic.ics' WHEN 1 THEN 'https://calendar.google.com/calendar/ical/h' || c_custkey || '@x.org/public/basic.ics' WHEN 2 THEN 'https://calendar.google.com/calendar/ical/plain/public/basic.ics' END AS ics FROM customer""")
def calendar_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Calendar files behind frames: plain addresses, encoded ones, others as they are; other frames have none."""
    code = F.regexp_replace(F.translate(F.base64(F.concat(F.lit("h"), _k(), F.lit("@x.org")).cast("binary")), "+/", "-_"), "=+$", "")
    src = F.when(_k() % 4 == 0, F.concat(F.lit("g"), _k(), F.lit("%40x.org"))).when(_k() % 4 == 1, code).otherwise("plain")
    frame = F.concat(F.when(_k() % 4 == 3, "https://maps.google.com/embed?src=").otherwise("https://calendar.google.com/calendar/embed?mode=week&src="), src)
    html = _t('<iframe src="', frame, '"></iframe><iframe src="', frame, '"></iframe><a href="/x">x</a>')
    pages = table(spark, d, "customer").select(_k().alias("page_id"), html.alias("html"))
    frames = first_wins(extract.frames(pages), ["page_id", "src"], ["pos"])
    return frames.select(F.col("page_id").alias("c_custkey"), C.calendar_feed(F.col("src")).alias("ics"))


@query("SELECT page_id, url AS normalized_url FROM (SELECT page_id, 'https://s' || page_id || '.org/' AS url FROM pages) WHERE page_id % 3 = 0")
def admitted_links(spark: SparkSession, d: str) -> DataFrame:
    """Anchors as sources: absolute, the first of each, mail and phone left out."""
    k = F.col("page_id")
    html = F.when(k % 3 == 0, _t('<a href="https://s', k.cast("string"), '.org">a</a><a href="https://S', k.cast("string"), '.org/#x">b</a><a href="mailto:x">m</a>')).otherwise('<a href="tel:1">t</a><a href="https://y.org"></a>')
    links = extract.links(table(spark, d, "pages").select("page_id", html.alias("html")))
    out = discovery.source_links(links, F.lit("https://base.org/")).withColumn("normalized_url", urls.normalize_url(F.col("url")))
    return first_wins(out, ["page_id", "normalized_url"], ["pos"]).select("page_id", "normalized_url")


# ---- sites and captured answers

SITES = ("denmark", "columbus", "wisconsin", "thailand", "oklahoma", "maritimes", "ukraine", "other")


@query(f"""WITH d AS (SELECT unnest(['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']) AS dy), p AS (SELECT *, {_sql_pick(SITES, 'c_custkey')} AS site, {_SQL_NAME} AS nm, lpad((c_custkey % 11 + 1 + 12)::VARCHAR, 2, '0') || ':30' AS hr, {_SQL_DAY} AS dy, {_SQL_STREET} AS st FROM customer)
SELECT c_custkey, site, CASE site WHEN 'oklahoma' THEN 'The Rock Stops Here Group' ELSE nm END AS name, CASE site WHEN 'oklahoma' THEN d.dy WHEN 'ukraine' THEN 'Wednesday' ELSE p.dy END AS day, CASE site WHEN 'oklahoma' THEN CASE d.dy WHEN 'Sunday' THEN '17:30' ELSE '20:00' END ELSE hr END AS time,
CASE site WHEN 'oklahoma' THEN '6444 NW Expressway Suite 241E' WHEN 'maritimes' THEN NULL ELSE st END AS address_line1, CASE site WHEN 'denmark' THEN 'Europe/Copenhagen' WHEN 'columbus' THEN 'America/New_York' WHEN 'thailand' THEN 'Asia/Bangkok' WHEN 'maritimes' THEN 'America/Halifax' WHEN 'ukraine' THEN 'Europe/Tallinn' ELSE 'America/Chicago' END AS timezone
FROM p JOIN d ON (site = 'oklahoma' OR d.dy = 'Sunday') WHERE site <> 'other'""")
def site_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pages of eight single sites, read by their parsers; a page of another site is left to the general extractors."""
    from ..sources import site_parsers

    hour = F.concat((_k() % 11 + 13).cast("string"), F.lit(":30"))
    p = lambda *x: _t("<p>", *x, "</p>")
    pages = (
        _t("<table><tr><td>Dag<td>Navn<td>Tid<td>Sted</tr><tr><td>", _day(), "<td>&quot;", _name(), "&quot; (Åben)<td>", hour, "<td>", _street(), "</tr></table>"), _t(p(F.upper(_day())), p(_hour()), p(_name()), p("Hall"), p(_street()), p("9:00 PM"), p("No meeting")),
        _t(p("Southeastern WI"), p(F.upper(_day())), p(_name(), " - ", _hour()), p(_street()), p("This website is neither endorsed")), _t(p(_day(), " at ", hour), p("Name:"), p(_name()), p("Address:"), p(_street()), p("See Map"), p("Friday 19:00"), p("Name:"), p("x"), p("Address:"), p("y"), p("meeting is closed")),
        F.lit("<p>see the picture</p>"), _t(p(_name()), p(_day(), "s at ", _hour()), p("x")), _t('<div class="entry-content"><h2>Естонія, Таллінн</h2><ul><li>Група «', _name(), "»</li><li>", _street(), "</li><li>щосереди</li><li>", hour, "</li></ul></div>"), F.lit("<p>x</p>"),
    )
    html = pages[-1]
    for i, x in enumerate(pages[:-1]):
        html = F.when(_k() % len(pages) == i, x).otherwise(html)
    captured = table(spark, d, "customer").select(_k().alias("page_id"), F.lit("https://x.org/meetings/hua-hin-meetings/").alias("url"), html.alias("html"), pick(SITES, _k()).alias("site"))
    return site_parsers.parse_sites(captured).select(F.col("page_id").alias("c_custkey"), "site", "name", "day", "time", "address_line1", "timezone")


FOLDED = ("São  Paulo", "Fênix", "É ñ Ü", "plain")


@query(f"SELECT c_custkey, {_sql_pick(('sao paulo', 'fenix', 'e n u', 'plain'), 'c_custkey')} AS k, {_sql_pick((chr(0x43F) + chr(0x27) + 'ятниця', 'київ'.replace('ї', 'і'), 'abc', 'ні'), 'c_custkey')} AS u FROM customer")
def folded_keys(spark: SparkSession, d: str) -> DataFrame:
    """Comparison forms without accents, and with look-alike letters and apostrophes made one."""
    from ..sources import site_parsers

    c = table(spark, d, "customer").select("c_custkey", pick(FOLDED, _k()).alias("a"), pick(("П’ятниця", "КИЇВ", "abc", "Ні"), _k()).alias("b"))
    return c.select("c_custkey", site_parsers.folded("a").alias("k"), site_parsers.folded("b", site_parsers.cyrillic_key).alias("u"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'https://r' || c_custkey || '.org/main_server/client_interface/json/?switcher=GetSearchResults&services%5B%5D=' || c_custkey || '&services%5B%5D=7&recursive=1'
ELSE 'https://r' || c_custkey || '.org/main_server/client_interface/json/?switcher=GetSearchResults&a=' || c_custkey END AS endpoint FROM customer WHERE c_custkey % 3 < 2""")
def hinted_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Feeds that pages' scripts are set up with, in plain and in base64 scripts."""
    from ..sources import endpoints

    root = F.concat(F.lit('{"root_server": "https:\\/\\/r'), _k(), F.lit('.org\\/main_server\\/", '))
    plain = F.concat(F.lit("<script>var x = "), root, F.lit('"service_body": ["'), _k(), F.lit('", 7], "recurse_service_bodies": "1"}</script>'))
    script = F.concat(root, F.lit('"custom_query": "&a='), _k(), F.lit('", "service_body": [3]}'))
    coded = F.concat(F.lit('<script src="data:text/javascript;base64,'), F.regexp_replace(F.base64(script.cast("binary")), r"\s", ""), F.lit('"></script>'))
    pages = table(spark, d, "customer").select(_k().alias("page_id"), F.when(_k() % 3 == 0, plain).when(_k() % 3 == 1, coded).otherwise("<p>none</p>").alias("html"))
    return endpoints.hinted_feeds(pages).select(F.col("page_id").alias("c_custkey"), "endpoint")


@query("""SELECT 's' || c_custkey AS source_id, CASE c_custkey % 3 WHEN 2 THEN NULL ELSE c_name END AS name, CASE c_custkey % 3 WHEN 0 THEN 'Monday' END AS day, CASE c_custkey % 3 WHEN 2 THEN 1 ELSE 0 END AS failed, CASE c_custkey % 2 WHEN 0 THEN 'POST' ELSE 'GET' END AS method,
CASE c_custkey % 2 WHEN 0 THEN 'https://f/' || c_custkey ELSE 'https://s' END AS url FROM customer""")
def form_answers(spark: SparkSession, d: str) -> DataFrame:
    """What forms are asked, and the rows of their JSON answers."""
    from ..sources import endpoints

    sid = F.concat(F.lit("s"), _k())
    body = F.when(_k() % 3 == 0, F.to_json(F.array(F.struct(F.col("c_name").alias("n"), F.lit("Monday").alias("d"))))).when(_k() % 3 == 1, F.to_json(F.array(F.struct(F.col("c_name").alias("n"))))).otherwise('{"error": 1}')
    c = table(spark, d, "customer")
    rows = endpoints.form_rows(c.select(sid.alias("source_id"), body.alias("body")), {"name": ".n", "day": ".d"})
    config = F.when(_k() % 2 == 0, F.concat(F.lit('{"request": {"method": "post", "url": "https://f/'), _k(), F.lit('", "data": {"a": 1}}}'))).otherwise('{"request": {}}')
    asked = endpoints.form_requests(c.select(sid.alias("id"), F.lit("https://s").alias("url"), config.alias("config")))
    return rows.join(asked.select(F.col("id").alias("source_id"), "method", "url"), "source_id").select("source_id", "name", "day", F.col("error").isNotNull().cast("int").alias("failed"), "method", "url")


@query("""SELECT page_id, substr(sha1(html), 1, 16) AS record_id, sha256(html) AS content_hash, true AS review, false AS late FROM pages""")
def captured_documents(spark: SparkSession, d: str) -> DataFrame:
    """Pages taken as captured documents: raw records that wait for review."""
    from ..sources import endpoints

    p = table(spark, d, "pages")
    raw = endpoints.documents(p.select(F.col("page_id").cast("string").alias("source_id"), "url", F.col("html").cast("binary").alias("content"), F.lit("text").alias("text")))
    late = p.select("page_id", endpoints.renders_late(F.col("html")).alias("late"))
    out = raw.select(F.col("source_id").cast("long").alias("page_id"), F.col("source_record_id").alias("record_id"), "content_hash", (F.get_json_object("payload", "$.review_required") == "true").alias("review"))
    return out.join(late, "page_id")


@query(f"""SELECT c_custkey, CASE c_custkey % 2 WHEN 0 THEN 'printed_list' ELSE 'day_sections' END AS kind, {_SQL_NAME} AS name, {_SQL_STREET} AS address_line1 FROM customer""")
def text_pages(spark: SparkSession, d: str) -> DataFrame:
    """Texts wrapped as pages that say where they come from, and read by the extractors."""
    from ..sources import endpoints

    text = _t("AREA MEETING LIST\n", _day(), "\n", _hour(), " ", _name(), "\n", _street())
    page = _t("<main><h2>", _day(), "</h2><p>", _hour(), " ", _name(), "</p><p>", _street(), "</p></main>")
    html = F.when(_k() % 2 == 0, endpoints.as_page(text, "pdf")).otherwise(endpoints.as_page(F.lit("late <text> & more"), "rendered", page))
    return _extracted(spark, d, html, "name", "address_line1")


@query(f"""SELECT c_custkey, {_SQL_NAME} AS name, {_SQL_DAY} AS day, 'Co. Cork' AS region, '[{{"fieldName":"time","order":"ASC"}}]' AS sort FROM customer""")
def hosted_collections(spark: SparkSession, d: str) -> DataFrame:
    """Captured answers of a hosted collection, joined to a text that the list extractor reads."""
    from ..sources import endpoints

    item = F.struct(F.struct(_name().alias("title"), F.concat(F.lit("<p>"), _day(), F.lit("</p>")).alias("requirements"), _hour().alias("time"), F.lit("In-person").alias("jobType1"), F.lit("Co. Cork").alias("county"), _street().alias("location")).alias("data"))
    answers = table(spark, d, "customer").select(_k().alias("page_id"), F.lit(0).alias("offset"), F.to_json(F.struct(F.array(item).alias("dataItems"))).alias("body"))
    text = endpoints.collection_text(answers)
    rows = extract.extract(text.select("page_id", F.lit("u").alias("url"), F.col("text").alias("html")))
    return rows.select(F.col("page_id").alias("c_custkey"), "name", "day", "region", endpoints.collection_sort(F.lit('[{"time": "asc"}, {"x": "desc"}]')).alias("sort"))


@query("""SELECT c_custkey, 'https://h' || c_custkey || '.org/' || CASE WHEN c_custkey % 2 = 0 THEN 'meetings.json' ELSE 'deep/meetings.json?x=1' END AS url FROM customer WHERE c_custkey % 3 < 2""")
def probed_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Where a feed may be, by usual paths and by what pages mention, and the first address whose captured answer is one."""
    from ..sources import endpoints

    base = F.concat(F.lit("https://h"), _k(), F.lit(".org/"))
    pages = table(spark, d, "customer").select(_k().alias("page_id"), base.alias("url"), F.lit('<a href="/deep/meetings.json?x=1">feed</a><script src="/app.js"></script>').alias("html"))
    at = endpoints.probe_addresses(pages, ("/meetings.json", "/wp-json/meetings"), endpoints.GUIDE_WORDS)
    good = F.concat(base, F.when(_k() % 2 == 0, "meetings.json").otherwise("deep/meetings.json?x=1"))
    answers = table(spark, d, "customer").select(good.alias("url"), F.when(_k() % 3 < 2, '[{"slug": "a"}]').otherwise("{}").alias("payload"))
    return endpoints.probed(at, answers, F.lit(True)).select(F.col("page_id").alias("c_custkey"), "url")


@query("""SELECT o_custkey AS page_id, min(CASE o_orderpriority[1] WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 END)::INTEGER AS best FROM orders GROUP BY 1 HAVING best IS NOT NULL""")
def fall_back_origins(spark: SparkSession, d: str) -> DataFrame:
    """Of each page's rows, those of the first origin that gave any: the page, its frames, linked documents; others don't count."""
    from ..sources import endpoints

    o = table(spark, d, "orders").select(F.col("o_custkey").alias("page_id"), F.substring("o_orderpriority", 1, 1).alias("origin"))
    return endpoints.first_that_gives(o, ["1", "2", "3"]).groupBy("page_id").agg(F.max(F.col("origin").cast("int")).alias("best"))


@query("SELECT id, true AS direct FROM (VALUES " + ", ".join(f"('{k}')" for k in ("na-07fdcb08f177", "na-ff485154ee5f")) + ") t(id)")
def direct_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Sources that are read at a known feed, among all nations' and two of them."""
    from ..sources import endpoints

    n = table(spark, d, "nation").select(F.concat(F.lit("na-"), "n_nationkey").alias("id"))
    known = spark.range(2).select(pick(("na-07fdcb08f177", "na-ff485154ee5f"), F.col("id")).alias("id"))
    return endpoints.direct_feeds(n.unionByName(known)).select("id", F.col("endpoint").contains("GetSearchResults").alias("direct"))


@query("""SELECT c_custkey, 'T ' || c_custkey || ' Head Some text ' || c_custkey AS text, 'T ' || c_custkey AS title, 'Head' AS headings FROM customer""")
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """Titles, headings and texts of pages: scripts and styles left out, blanks joined."""
    k = _k().cast("string")
    html = _t("<html><head><title>T ", k, "</title><style>p {}</style></head><body><h1>Head</h1><p>Some \n  text ", k, "</p><script>no()</script><noscript>no</noscript></body></html>")
    return extract.page_parts(table(spark, d, "customer").select(_k().alias("page_id"), html.alias("html"))).select(F.col("page_id").alias("c_custkey"), "text", "title", "headings")


@query("""SELECT c_custkey, (CASE WHEN c_custkey % 2 = 0 THEN 26 ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 24 ELSE 0 END + CASE WHEN c_custkey % 5 = 0 THEN 24 ELSE 0 END) / 100.0::DOUBLE AS score FROM customer""")
def page_scores(spark: SparkSession, d: str) -> DataFrame:
    """How much pages look like meeting pages: days with times, forms that ask for meetings, tables with known headings."""
    from ..functions import scoring

    html = _t("<title>T</title><p>", F.when(_k() % 2 == 0, "Monday 7:00 pm").otherwise("hello"), "</p>", F.when(_k() % 3 == 0, '<form><input name="meeting"></form>').otherwise(""), F.when(_k() % 5 == 0, "<table><tr><th>Day<th>Time</tr></table>").otherwise(""))
    parts = extract.page_parts(table(spark, d, "customer").select(_k().alias("page_id"), html.alias("html"), F.lit("https://x.org/p").alias("url")), "url")
    score = scoring.page_score(F.col("url"), F.concat_ws(" ", "title", "headings"), F.col("text"), F.col("has_form"), F.col("has_table"))
    return parts.select(F.col("page_id").alias("c_custkey"), score.alias("score"))


# ---- forms


_FORM_IDS = ("meeting-finder", "x", "group-list", "contact", "q")
_FIELDS = ("q", "city", "s", "zip", "foo", "keyword", "email")
_SENDS = ("Search", "Go", "Find it")
_SELECTS = ("day", "z", "types")


def _with_forms(spark: SparkSession, d: str) -> DataFrame:
    """The driver's pages, each with two forms and a folded section below its own text."""
    k = F.col("page_id")
    folded = F.when(k % 3 == 0, '<div role="button" aria-expanded="false" id="d1"><div>More</div></div>').otherwise("")
    kind = F.when(k % 2 == 0, "search").otherwise("text")
    first = _t('<form id="', pick(_FORM_IDS, k), '"><p><input id=i1 name="', pick(_FIELDS, k), '" type="', kind, '"><button id=b1', F.when(k % 4 == 1, " type=submit").otherwise(""), "><b>", pick(_SENDS, F.floor(k / 5)), "</b></button></form>")
    second = _t("<form class='", F.when(F.floor(k / 2) % 2 == 0, "groups").otherwise("y"), "'><select name=", pick(_SELECTS, F.floor(k / 3)), "></select><button id=b2>Fil<i>ter</i></button></form>")
    return table(spark, d, "pages").select("page_id", _t(F.coalesce("html", F.lit("")), folded, first, second).alias("html"), F.when(k % 3 > 0, "Cork").alias("seed"))


_FORMS = f"""SELECT page_id, page_id % 2 = 0 AS search, page_id % 3 > 0 AS seeded, {_sql_pick(_FORM_IDS, 'page_id')} AS form_id, {_sql_pick(_FIELDS, 'page_id')} AS field, {_sql_pick(_SENDS, 'page_id // 5')} AS send, page_id % 4 = 1 AS submits, page_id // 2 % 2 = 0 AS groups, {_sql_pick(_SELECTS, 'page_id // 3')} AS list FROM pages"""


@query(f"""SELECT page_id, CASE WHEN fill IS NOT NULL THEN 'fill' ELSE 'submit' END AS action, coalesce(fill, submit) AS rule, CASE WHEN fill IS NOT NULL THEN 'i1' WHEN submit IN (1, 3, 8) THEN 'b1' ELSE 'b2' END AS control_id FROM (
SELECT page_id, CASE WHEN seeded THEN CASE field WHEN 'city' THEN 0 WHEN 'zip' THEN 3 WHEN 's' THEN 6 WHEN 'keyword' THEN 7 ELSE CASE WHEN search AND form_id LIKE '%meeting%' THEN 14 WHEN search AND form_id LIKE '%group%' THEN 16 END END END AS fill,
CASE WHEN form_id LIKE '%meeting%' AND sends THEN 1 WHEN form_id LIKE '%group%' AND sends THEN 3 WHEN groups THEN 4 WHEN field = 'city' AND sends THEN 8 WHEN list = 'day' THEN 9 WHEN list = 'types' THEN 10 END AS submit FROM (SELECT *, submits OR send <> 'Go' AS sends FROM ({_FORMS})))
WHERE fill IS NOT NULL OR submit IS NOT NULL""")
def form_choices(spark: SparkSession, d: str) -> DataFrame:
    """Which field is filled or which form is sent on each page."""
    return forms.form_choices(_with_forms(spark, d)).select("page_id", "action", "rule", "control_id")


@query(f"""SELECT page_id, rank, rule, control_id FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY rule)::INTEGER AS rank FROM (SELECT page_id, 1 AS rule, 'd1' AS control_id FROM ({_FORMS}) WHERE NOT seeded
UNION ALL SELECT page_id, 21, 'b1' FROM ({_FORMS}) WHERE send = 'Search' UNION ALL SELECT page_id, 23, 'b2' FROM ({_FORMS}))) WHERE rank <= 2""")
def button_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Buttons that are tried on each page, at most two."""
    return forms.button_clicks(_with_forms(spark, d), 2).select("page_id", "rank", "rule", "control_id")
