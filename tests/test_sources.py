import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import artifacts, discovery, extract, feeds, html


def test_tree_and_selectors():
    root = html.parse('<div id=a class="x y"><p>One<p>Two <b>bold</b><br>end</div><ul><li><a href="/q?a=1&amp;b=2">L</a><li>M</ul><script>no</script>')
    assert [n.text() for n in root.select("p")] == ["One", "Two bold end"]
    assert root.first("div#a.x > p b").text() == "bold"
    assert html.value(root.first("li"), "a::attr(href)") == "/q?a=1&b=2"
    assert [n.text() for n in root.select("li:nth-child(2), p + p")] == ["Two bold end", "M"]
    assert root.first("[href*='b=2']").tag == "a" and root.first("[href^='x']") is None
    assert root.lines() == ["One", "Two bold", "end", "L", "M"] and "no" not in root.text()


def found(text, url="https://x/", config=None):
    return [(kind, p) for kind, _, p in extract.payloads(text, url, config)]


def test_extractors():
    table = "<table><tr><th>Meeting<th>Day<th>Time<th>Location</tr><tr><td>Hope<td>Monday<td>7:30 pm<td>St Anne Hall</tr></table>"
    assert found(table) == [("header_table", {"name": "Hope", "day": "Monday", "time": "7:30 pm", "venue_name": "St Anne Hall"})]
    matrix = "<table><tr><th>Group<th>Monday<th>Tuesday<th>Friday</tr><tr><td colspan=4>Cork</td></tr><tr><td>Dawn<td>7am<td><td>8:15 pm Hall</tr></table>"
    assert [(p["name"], p["day"], p["time"], p["city"]) for _, p in found(matrix)] == [("Dawn", "Monday", "7am", "Cork"), ("Dawn", "Friday", "8:15 pm", "Cork")]
    cfg = {"selectors": {"row": ".m", "name": "h3", "day": ".d", "time": ".t", "online_url": "a::attr(href)"}}
    assert found('<div class=m><h3>A</h3><i class=d>Lundi</i><i class=t>19h</i><a href="https://zoom.us/j/1">z</a></div>', config=cfg)[0][1]["online_url"] == "https://zoom.us/j/1"
    feed = json.dumps([{"id": 5, "name": "F", "day": 0, "time": "09:00", "types": ["O", "C"], "formatted_address": "1 Main St"}])
    assert found(feed) == [("feed_json", {"source_record_id": "5", "name": "F", "day": "Sunday", "time": "09:00", "formats": "O, C", "address_line1": "1 Main St"})]
    sections = "<main><h2>Wednesday</h2><p>6:30 pm Early Birds</p><p>12 Oak Street</p><p>8:00 pm</p><p>Late Owls</p><p>Town Hall</p></main>"
    assert [(p["name"], p["day"], p["time"]) for _, p in found(sections)] == [("Early Birds", "Wednesday", "6:30 pm"), ("Late Owls", "Wednesday", "8:00 pm")]
    labelled = "Name: Alpha\nDay: Friday\nTime: 7 pm\nLocation: Barn\nName: Beta\nDay: Sunday\nTime: noon\nLocation: Hall"
    assert [p["name"] for _, p in found(labelled)] == ["Alpha", "Beta"]
    tabs = "Thursday\nEast Group\tLeeds\t4 Elm Road\t7:00 pm\nWest Group\tYork\t5 Elm Road\t8:00 pm"
    assert [(p["name"], p["city"]) for _, p in found(tabs)] == [("East Group", "Leeds"), ("West Group", "York")]
    japanese = "月曜日\n●希望グループ\n午後7:30\n東京都中野区\n●休みグループ 休止中\n10:00"
    assert found(japanese) == [("japanese", {"name": "希望グループ", "day": "Monday", "time": "19:30", "address_line1": "東京都中野区"})]
    assert found("<p>Just prose, no schedule.</p>") == []


def test_a_page_with_a_table_and_cards_gives_both():
    table = "<table><tr><th>Meeting<th>Day<th>Time<th>Location</tr><tr><td>Hope<td>Monday<td>7:30 pm<td>St Anne Hall</tr></table>"
    cards = "".join(f"<article><h3>{n}</h3><p>{d} 6 pm</p><p>{i} Oak Street</p></article>" for i, (n, d) in enumerate((("Dawn", "Friday"), ("Dusk", "Sunday")), 3))
    assert [(k, p["name"]) for k, p in found(table + cards)][:3] == [("header_table", "Hope"), ("cards", "Dawn"), ("cards", "Dusk")]


def test_tables_under_a_title():
    page = "<table><tr><th colspan=3>Sunrise at 9 Elm Street</tr><tr><td>Monday<td>7:00 am<td>6:30 pm</tr><tr><td>Notes<td>none</tr><tr><td>Friday<td>8 pm</tr></table>"
    assert [(p["name"], p["day"], p["time"], p["address_line1"]) for k, p in found(page) if k == "heading_table"] == [("Sunrise", d, t, "9 Elm Street") for d, t in (("Monday", "7:00 am"), ("Monday", "6:30 pm"), ("Friday", "8 pm"))]


def test_coded_tabs():
    text = "\tAB12\tx\tMonday\t7:00 pm\tHope\tHall\t\t\tTX\t\tOpen\tStep\n\t\t4 Oak Street\tAustin\n1\n\tAB13\t\tFriday\t6 pm\tDawn\tBarn\nhttps://zoom.us/j/9\n"
    (_, a), (_, b) = found(text)
    assert a == {"source_record_id": "AB12", "day": "Monday", "time": "7:00 pm", "name": "Hope", "venue_name": "Hall", "region": "TX", "formats": "Open, Step", "address_line1": "4 Oak Street", "city": "Austin"}
    assert b["source_record_id"] == "AB13" and b["online_url"] == "https://zoom.us/j/9"


def test_places_with_times():
    page = "<section><h2>Lokacija: Trg 1, Maribor</h2><p>Upanje, Monday, Thursday čas: 19:00</p><p>no time</p></section><section><h2>News</h2><p>Monday čas: 18:00</p></section>"
    assert [(p["name"], p["day"], p["address_line1"]) for k, p in found(page) if k == "place_sections"] == [("Upanje, Monday, Thursday", d, "Trg 1, Maribor") for d in ("Monday", "Thursday")]


def test_numbered_list():
    text = "Number found:\n2\nHope\n(1) Monday\n7:30 pm\nIn-person\nCo. Cork\nOpen meeting\nBlue Room\n12 Main Street\nDawn\nFriday\n6 am\nOnline\nDublin\nZoom 123 456 789\nPasscode x"
    (_, a), (_, b) = found(text)
    assert a == {"name": "Hope", "day": "Monday", "time": "7:30 pm", "attendance_option": "In-person", "region": "Co. Cork", "formats": "Open meeting", "venue_name": "Blue Room", "address_line1": "12 Main Street"}
    assert b["phone_join_info"] == "Zoom 123 456 789 Passcode x" and b["city"] == "Dublin"


def test_printed_lists():
    pdf = lambda t: f'<html><body><div data-pdf-text-fallback="true"><pre>{t}</pre></div></body></html>'
    text = "AREA MEETING LIST\nMonday\n7:00 pm Hope\n12 Main Street\nBlue Room\nAUSTIN 8:30 pm Night Owls\nBasement (rear)\nTuesday:\nDawn; Tue 6:00 am, 4 Oak Street\nFriday\nLate Group\n9 Elm Street\n12:00 pm\nwww.x.org"
    got = [p for k, p in found(pdf(text)) if k == "printed_list"]
    assert [(p["name"], p["day"], p["time"]) for p in got] == [("Hope", "Monday", "7:00 pm"), ("Night Owls", "Monday", "8:30 pm"), ("Dawn", "Tue", "6:00 am"), ("Late Group", "Friday", "12:00 pm")]
    assert got[0]["address_line1"] == "12 Main Street" and got[0]["venue_name"] == "Blue Room" and got[1]["city"] == "Austin" and got[2]["address_line1"] == "4 Oak Street" and got[3]["address_line1"] == "9 Elm Street"
    jp = "月曜日\n中央教会\n希望グループ\n19:00\n札幌市中央区北1条\n火\n10:30 あさひ\n旭川市5丁目"
    got = [p for k, p in found(pdf(jp)) if k == "printed_list"]
    assert [(p["name"], p["day"], p["time"], p["address_line1"]) for p in got] == [("希望グループ", "Monday", "19:00", "札幌市中央区北1条"), ("あさひ", "Tuesday", "10:30", "旭川市5丁目")]
    assert got[0]["venue_name"] == "中央教会"


def test_calendar_keeps_current_weekly_events():
    ics = "BEGIN:VCALENDAR\r\nX-WR-TIMEZONE:Europe/Dublin\r\n" + "".join(
        f"BEGIN:VEVENT\r\nUID:{u}\r\nSUMMARY:Step\\, group\r\nLOCATION:1 Main\r\n  St\r\nDTSTART:20240103T193000\r\nRRULE:{r}\r\nEND:VEVENT\r\n" for u, r in (("a", "FREQ=WEEKLY;BYDAY=WE"), ("b", "FREQ=MONTHLY"), ("c", "FREQ=WEEKLY;UNTIL=20230101T000000Z"))
    )
    (kind, p), = found(ics, config={"as_of": "20240101"})
    assert kind == "calendar" and p == {"source_record_id": "a", "name": "Step, group", "day": "Wednesday", "time": "19:30", "timezone": "Europe/Dublin", "address_line1": "1 Main St"}


def test_extract_in_spark_drops_repeats(spark):
    page = "<main><h3>Friday</h3><p>7 pm Dawn</p><p>9 Oak Street</p><p>7 pm Dawn</p><p>9 Oak Street</p></main>"
    rows = extract.extract(spark.createDataFrame([(1, "u", page), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")).collect()
    assert [(r.page_id, r.name, r.time) for r in rows] == [(1, "Dawn", "7 pm")]


def test_content_hash_is_canonical(spark):
    objs = ['{"b": 1, "a": "é"}', '{"a":"é","b":1}']
    df = spark.createDataFrame([(s,) for s in objs], "payload string").select(feeds.canonical_hash().alias("h"))
    want = hashlib.sha256(json.dumps(json.loads(objs[0]), sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert {r.h for r in df.collect()} == {want}


def test_feed_rows_without_id_are_errors(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"slug": "a", "day": "7", "time": "7:30 PM"}, {"name": "no id"}]')
    raw = feeds.raw_records(feeds.read_objects(spark, f"file://{tmp_path}/f.json", "s"), ("slug", "id"), F.lit("u"))
    rows = {r.source_record_id: r for r in raw.collect()}
    assert rows["a"].error is None and "slug or id" in rows[None].error
    o = feeds.normalize_a(raw.filter("error is null")).first()
    assert o.meeting_type == "unknown" and o.occurrences[0].asDict() == {"day_of_week": 0, "start_minute": 1170, "end_minute": None, "timezone": "UTC"}


@pytest.fixture
def captured(tmp_path):
    for sid, status in (("aa-1", "ok"), ("na-2", "failed")):
        d = tmp_path / sid
        d.mkdir()
        item = {"payload": {"name": "Hope", "day": "Monday", "time": "7pm"}, "method": "m", "confidence": 0.8, "signals": ["day"]}
        pages = [{"url": "https://p/1", "final_url": "", "page_score": 0.5, "extracted_count": 2, "extracted": [item, item]}, {"url": "https://p/2", "page_score": 0.9, "extracted_count": 0, "extracted": []}]
        (d / "summary.json").write_text(json.dumps({"source_id": sid, "source_url": "https://s", "status": status, "pages": [p | {"extracted": [x | {"payload": x["payload"]} for x in p["extracted"]]} for p in pages]}))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "summary.json").write_text("{oops")
    return f"file://{tmp_path}"


def test_artifacts_replay(spark, captured):
    s = artifacts.read_summaries(spark, captured)
    assert [r.source_id for r in s.collect()] == ["aa-1"]
    assert artifacts.read_summaries(spark, captured, include_failed=True).count() == 3
    (r,) = artifacts.raw_records(s).collect()  # the second payload has the same id
    assert r.source_url == "https://p/1" and json.loads(r.payload)["extraction"]["confidence"] == 0.8
    assert r.source_record_id == hashlib.sha1(b"Hope|Monday|7pm||||").hexdigest()[:16]
    assert [(x.url, x.records) for x in artifacts.successful_pages(s).collect()] == [("https://p/1", 2)]
    meta = spark.createDataFrame([("aa-1", "", "", "Ireland", None, None, '{"timezone": "Europe/Dublin"}')], "source_id string, fellowship string, name string, country string, region string, timezone string, config string")
    src = artifacts.sources(s, meta).first()
    assert (src.fellowship, src.name, src.timezone) == ("aa", "aa-1", "Europe/Dublin")
    both = artifacts.merged_metadata(meta, meta.withColumns({"country": F.lit(""), "config": F.lit('{"a": "1"}')})).first()
    assert both.country == "Ireland" and json.loads(both.config) == {"a": "1", "timezone": "Europe/Dublin"}


def test_locator(spark):
    payload = json.dumps({
        "data": [{"website": "x.org", "description": "X"}, {"website": "http://X.org/", "description": "again"}, {"phonewebid": "7", "description": "P"}, {"phone": "+1 (2) 3"}, {"description": "none"}],
        "ll_us": [{"state": "Ohio", "count": 1}], "ll_ca": [{"state": ""}], "ll_intl": [{"country": "Ireland"}],
    })
    df = spark.createDataFrame([(payload,)], "payload string")
    rows = discovery.locator_rows(df).orderBy("pos").collect()
    assert [r.url for r in rows] == ["http://x.org", f"{discovery.ORPHAN}&id=7", "tel:+123"]
    assert [(r.country, r.state) for r in discovery.location_index(df).orderBy("rank").collect()] == [("United States", "Ohio"), ("Ireland", "")]


def test_links_resolve(spark):
    page = '<a href="a/b#x">1</a><a href="/r">2</a><a href="//h/z">3</a><a href="mailto:q">4</a><a href="a/b">5</a><a href="?q=1">6</a><a href="/e"></a>'
    links = extract.links(spark.createDataFrame([(1, page)], "page_id long, html string"))
    got = discovery.source_links(links, F.lit("https://s.org/d/i.html")).orderBy("pos").collect()
    assert [r.url for r in got] == ["https://s.org/d/a/b", "https://s.org/r", "https://h/z", "https://s.org/d/i.html?q=1"]
