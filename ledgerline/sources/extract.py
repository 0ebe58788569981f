"""Extractors: table functions from captured pages and texts to listing payloads.

Each takes a page (a tree, its lines, its URL) and yields payload dictionaries. They run in Arrow batches under
mapInArrow, one page after another; within a page the steps of ``STEPS`` follow one another: their rows are joined, and
some end the page or run only where nothing was found before. Scores and first-wins dedupe follow as columns."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.lookups import DAILY_NAMES
from ..functions.scoring import WEEKDAYS
from ..functions.schedule import RANGE_WITH_MARK, TIME
from ..session import ship, spread
from . import extract_text as T
from .html import Node, parse, value

Payload = dict[str, str]
FIELDS = ("name", "day", "time", "end_time", "venue_name", "address_line1", "city", "region", "postal_code", "country", "timezone", "latitude", "longitude", "online_url", "phone_join_info", "formats", "attendance_option", "notes", "source_record_id")
# Column headings and the fields they mean.
HEADERS = {
    "name": ("meeting", "meeting name", "group", "group name", "name"), "day": ("day", "weekday", "dia", "día", "jour"), "time": ("time", "start", "start time", "hora", "horário", "horario", "heure"),
    "venue_name": ("venue", "location", "place"), "address_line1": ("address", "street"), "city": ("city", "town"), "formats": ("type", "types", "format", "formats"), "notes": ("notes", "details"), "online_url": ("online", "url", "link", "zoom"),
}
LABELS = {"name": "name", "group": "name", "meeting": "name", "day": "day", "time": "time", "location": "venue_name", "venue": "venue_name", "address": "address_line1", "city": "city", "type": "formats", "notes": "notes", "phone": "phone_join_info", "link": "online_url"}


def _one_of(words: Iterable[str]) -> str:
    """A pattern of any of the words, the longest first, that shares their beginnings and asks for one of their first characters before all."""
    tree: dict = {}
    for w in words:
        at = tree
        for ch in w:
            at = at.setdefault(ch, {})
        at[""] = {}

    def below(t: dict) -> str:
        some = [re.escape(ch) + below(x) for ch, x in t.items() if ch]
        if not some:
            return ""
        return some[0] if len(some) == 1 and "" not in t else "(?:" + "|".join(some) + ")" + ("?" if "" in t else "")

    return "(?=[" + "".join(map(re.escape, tree)) + "])" + below(tree)


DAY = re.compile(r"\b" + _one_of(d for d in (*WEEKDAYS, *DAILY_NAMES) if d != "today") + r"\b", re.I)
# A time begins with a digit, or as kl., noon or midnight do.
CLOCK = re.compile(TIME.replace(r"\b(?:", r"\b(?=[\dknm])(?:", 1))
CLOCK_RANGE = re.compile(RANGE_WITH_MARK)
ADDRESS = re.compile(r"\b\d{1,6}\s+[\w'. -]{1,60}\b(?:street|st|road|rd|avenue|ave|boulevard|blvd|drive|dr|lane|ln|way|court|ct|place|pl|parkway|pkwy)\b\.?|\b[\w'.-]+\s+(?:street|road|avenue|church|hall|cent(?:er|re)|club|school|library|hospital)\b", re.I)
LINK = re.compile(r"https?://\S+")
ENGLISH = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def first_clock(text: str) -> str | None:
    m = CLOCK_RANGE.search(text)
    if m:
        return m[1] + m[2]
    m = CLOCK.search(text)
    return m[0] if m else None


def first_day(text: str) -> str | None:
    m = DAY.search(text)
    return m[0] if m else None


def heading_day(line: str) -> str | None:
    """A short line that names a day and no time."""
    return first_day(line) if len(line) <= 32 and not CLOCK.search(line) else None


def kept(payload: dict) -> Payload:
    return {k: " ".join(str(v).split()) for k, v in payload.items() if v is not None and str(v).strip()}


def place(lines: list[str], payload: dict) -> dict:
    """The first address and link among some lines, where the payload has none."""
    for line in lines:
        if "address_line1" not in payload and ADDRESS.search(line):
            payload["address_line1"] = line
        if "online_url" not in payload and (m := LINK.search(line)):
            payload["online_url"] = m[0]
    return payload


class Page:
    def __init__(self, html: str | None, url: str, config: dict | None = None):
        self.html, self.url, self.config = html or "", url, config or {}
        self.root = parse(html) if "<" in self.html else None
        self.lines = self.root.lines() if self.root else [s for x in self.html.split("\n") if (s := x.strip())]

    def raw_lines(self) -> list[str]:
        """Lines with their tabs, also empty cells."""
        return "\n".join(self.root.strings()).split("\n") if self.root else self.html.split("\n")


def selected_rows(p: Page) -> Iterator[Payload]:
    """Rows and fields by the selectors in a source's config."""
    fields = dict(p.config.get("selectors") or {})
    row = fields.pop("row", None)
    if row and p.root:
        for n in p.root.select(row):
            yield kept({k: value(n, css) for k, css in fields.items()})


def feed_json(p: Page) -> Iterator[Payload]:
    """Listing JSON in a page: an array, or an object with meetings, also inside pre."""
    text = p.html
    if p.root and (pre := p.root.first("pre")):
        text = "".join(pre.strings())
    try:
        data = json.loads(text)
    except ValueError:
        return
    data = data.get("meetings") if isinstance(data, dict) else data
    names = {"formatted_address": "address_line1", "address": "address_line1", "location": "venue_name", "conference_url": "online_url", "conference_phone": "phone_join_info", "types": "formats", "slug": "source_record_id", "id": "source_record_id"}
    for item in data if isinstance(data, list) else []:
        if isinstance(item, dict):
            out = {}
            for k, v in item.items():
                if v not in (None, "", []):
                    out.setdefault(names.get(k, k), ", ".join(map(str, v)) if isinstance(v, list) else v)
            if str(out.get("day", "")).isdigit():
                out["day"] = ENGLISH[int(out["day"]) % 7]
            yield kept({k: v for k, v in out.items() if k in FIELDS})


def _cells(row: Node) -> list[Node]:
    return [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]


def classed_table(p: Page) -> Iterator[Payload]:
    """Rendered tables whose cells carry field names as classes (td.time[data-sort] gives the day's number)."""
    for row in p.root.select("tr") if p.root else []:
        by = {c.classes[0].removeprefix("bmlt-").replace("-", "_"): c for c in _cells(row) if c.classes}
        if "time" not in by:
            continue
        sort = by["time"].attrs.get("data-sort", "")
        out = {LABELS.get(k, k if k in FIELDS else None): c.text() for k, c in by.items()}
        out.pop(None, None)
        if m := re.match(r"(\d)-(\d\d:\d\d)", sort):
            out["day"], out["time"] = ENGLISH[int(m[1]) % 7], m[2]
        else:
            out["day"], out["time"] = first_day(by["day"].text() if "day" in by else row.text()), first_clock(by["time"].text())
        if out["day"] and out["time"]:
            yield kept(out)


def _header(cells: list[Node]) -> dict[int, str]:
    """Columns whose heading is, or else contains, a known name; each field once, from the left."""
    found: dict[int, str] = {}
    for i, c in enumerate(cells):
        t = c.text().lower()
        name = next((f for f, ns in HEADERS.items() if f not in found.values() and t in ns), None) or next((f for f, ns in HEADERS.items() if f not in found.values() and any(n in t for n in ns)), None)
        if name:
            found[i] = name
    return found


def header_table(p: Page) -> Iterator[Payload]:
    """Tables with at least two known headings."""
    for table in p.root.select("table") if p.root else []:
        rows = [_cells(r) for r in table.select("tr")]
        head = next(((i, h) for i, r in enumerate(rows[:3]) if len(h := _header(r)) >= 2), None)
        for r in rows[head[0] + 1 :] if head else []:
            if len(r) >= 2:
                out = {f: r[i].text() for i, f in head[1].items() if i < len(r)}
                if "time" in out and "day" not in out:
                    out["day"] = first_day(out["time"])
                yield kept(out)


def day_matrix(p: Page) -> Iterator[Payload]:
    """Tables with a column for each day: an unpivot; a row of one spanning cell names the city below it."""
    for table in p.root.select("table") if p.root else []:
        rows, city = [_cells(r) for r in table.select("tr")], None
        days = {i: d for i, c in enumerate(rows[0]) if (d := heading_day(c.text()))} if rows else {}
        if len(days) < 3:
            continue
        for r in rows[1:]:
            if len(r) == 1:
                city = r[0].text()
                continue
            lead = r[0].text() if 0 not in days else None
            for i, d in days.items():
                cell = r[i].text() if i < len(r) else ""
                for t in CLOCK.finditer(cell):
                    rest = (cell[: t.start()] + cell[t.end() :]).strip(" ,-")
                    yield kept({"name": lead or rest, "day": d, "time": t[0], "city": city, "address_line1": rest if lead else None})


def classed_rows(p: Page) -> Iterator[Payload]:
    """Elements of meeting classes outside tables; the day may stand in a heading above."""
    day = None
    for n in p.root.walk() if p.root else []:
        if n.tag in ("h1", "h2", "h3", "h4"):
            day = heading_day(n.text()) or day
        elif any(c in ("meeting-row", "meeting", "meeting-item", "meeting-card") for c in n.classes) and n.tag not in ("table", "tr", "td", "body"):
            t = n.text()
            head = n.first("h2, h3, h4, .name, .title, strong, b")
            out = {"name": head.text() if head else None, "day": first_day(t) or day, "time": first_clock(t)}
            out |= {LABELS.get(c, c): x.text() for x in n.walk() for c in x.classes if c in ("venue", "address", "city", "notes")}
            if out["day"] and out["time"]:
                yield kept(place(n.lines(), out))


def labelled_blocks(p: Page) -> Iterator[Payload]:
    """Blocks of Label: value lines; a repeated label begins the next block."""
    out: dict = {}
    for line in [*p.lines, "Name: "]:
        m = re.match(r"([A-Za-z ]{2,20})\s*:\s*(.*)", line)
        field = LABELS.get(m[1].strip().lower()) if m else None
        if not field:
            continue
        if field in out or not m[2]:
            if out.get("day") and out.get("time"):
                yield kept(out)
            if field in out:
                out = {}
        if m[2]:
            out[field] = m[2]


def repeated_cards(p: Page) -> Iterator[Payload]:
    """Short repeated elements that hold a day and a time."""
    for css in ("article", "li", ".card", ".event", ".vevent", "section"):
        cards = [n for n in p.root.select(css) if len(n.text()) <= 800 and DAY.search(n.text()) and CLOCK.search(n.text())] if p.root else []
        if len(cards) >= 2:
            for n in cards:
                t, head = n.text(), n.first("h2, h3, h4, strong, b, a")
                lines = n.lines()
                yield kept(place(lines, {"name": head.text() if head else lines[0][:120], "day": first_day(t), "time": first_clock(t)}))
            return


SECTIONS = ".entry-content, article, main, .panel"


def day_sections(p: Page) -> Iterator[Payload]:
    """Lines under day headings, in a page's main parts: each time begins a listing, what follows fills it."""
    for n in p.root.select(SECTIONS) if p.root else []:
        up = n.parent
        while up is not None and not up.matches(SECTIONS):
            up = up.parent
        if up is None:  # a part within a part was read with it
            yield from _day_lines([s for s in n.lines() if "\t" not in s])


def _day_lines(lines: list[str]) -> Iterator[Payload]:
    day, cur, pending = None, None, None
    for line in lines:
        if d := heading_day(line):
            if cur:
                yield kept(cur)
            day, cur, pending = d, None, None
        elif day and (t := first_clock(line)):
            if cur:
                yield kept(cur)
            rest = CLOCK.sub("", line, count=1).strip(" -|–—,:")
            cur = place([line], {"day": day, "time": t, "name": rest or pending})
            pending = None
        elif cur:
            if not cur.get("name"):
                cur["name"] = line
            elif ADDRESS.search(line) or LINK.search(line):
                place([line], cur)
            elif "venue_name" not in cur and len(line) <= 80:
                cur["venue_name"] = line
            else:
                pending = line
        else:
            pending = line
    if cur:
        yield kept(cur)


def inline_schedules(p: Page) -> Iterator[Payload]:
    """Lines with a name and one or more day and time pairs."""
    for line in p.lines:
        days, clocks = list(DAY.finditer(line)), list(CLOCK.finditer(line))
        if days and clocks and days[0].start() > 0:
            name = line[: days[0].start()].strip(" -|–—,:")
            tail = line[max(days[-1].end(), clocks[-1].end()) :].strip(" -|–—,:")
            for d in days:
                t = next((c for c in clocks if c.start() >= d.end()), clocks[-1])
                yield kept(place([tail], {"name": name, "day": d[0], "time": t[0]}))


def text_blocks(p: Page) -> Iterator[Payload]:
    """The last resort: blocks of up to 900 characters between blank lines that hold a day and a time."""
    for block in re.split(r"\n\s*\n", "\n".join(p.root.lines()) if p.root else p.html):
        if len(block) <= 900 and DAY.search(block) and CLOCK.search(block):
            lines = [s for x in block.split("\n") if (s := x.strip())]
            name = next((x for x in lines if not DAY.search(x) and not CLOCK.search(x)), lines[0])
            yield kept(place(lines, {"name": name[:120], "day": first_day(block), "time": first_clock(block)}))


def calendar(p: Page) -> Iterator[Payload]:
    """Weekly events of a calendar file, of which the rule hasn't ended at config's as_of (YYYYMMDD)."""
    if "BEGIN:VCALENDAR" not in p.html:
        return
    text = re.sub(r"\r?\n[ \t]", "", p.html)
    zone = re.search(r"^X-WR-TIMEZONE:(.+)$", text, re.M)
    clean = lambda s: s.replace("\\n", " ").replace("\\,", ",").replace("\\;", ";").strip()
    for body in re.findall(r"BEGIN:VEVENT(.*?)END:VEVENT", text, re.S):
        got = {m[1]: (m[2], m[3].strip()) for m in re.finditer(r"^([A-Z-]+)((?:;[^:\n]*)?):(.*)$", body, re.M)}
        rule = got.get("RRULE", ("", ""))[1]
        until = re.search(r"UNTIL=(\d{8})", rule)
        start = re.match(r"(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)", got.get("DTSTART", ("", ""))[1])
        if "FREQ=WEEKLY" not in rule or not start or until and until[1] < str(p.config.get("as_of", "00000000")):
            continue
        import datetime

        tz = re.search(r"TZID=([^;:]+)", got["DTSTART"][0])
        code = re.search(r"BYDAY=([A-Z]{2})", rule)
        day = ("SU", "MO", "TU", "WE", "TH", "FR", "SA").index(code[1]) if code else datetime.date(*map(int, start.groups()[:3])).isoweekday() % 7
        where = clean(got.get("LOCATION", ("", ""))[1])
        yield kept({"source_record_id": got.get("UID", ("", None))[1], "name": clean(got.get("SUMMARY", ("", ""))[1]), "day": ENGLISH[day], "time": f"{start[4]}:{start[5]}", "timezone": tz[1] if tz else zone[1].strip() if zone else None, "address_line1": where if not LINK.search(where) else None, "online_url": m[0] if (m := LINK.search(where)) else None, "notes": clean(got.get("DESCRIPTION", ("", ""))[1])})


JP_DAYS = "日月火水木金土"


def japanese_blocks(p: Page) -> Iterator[Payload]:
    """Day headings like 月曜日, and blocks that begin with a bullet; suspended ones are left out, 午後 adds twelve hours."""
    day, cur = None, None
    for line in [*p.lines, "●"]:
        if (m := re.match(rf"^[【\[]?([{JP_DAYS}])曜", line)) and len(line) <= 12:
            day = ENGLISH[JP_DAYS.index(m[1])]
            continue
        if line[:1] in "●■◆・":
            if cur and cur.get("time") and "休止" not in cur["all"]:
                yield kept({k: v for k, v in cur.items() if k != "all"})
            cur = {"name": line[1:].strip(), "day": day, "all": line} if day and line[1:].strip() else None
        if cur:
            cur["all"] += line
            if "time" not in cur and (m := re.search(r"(午前|午後)?\s*(\d{1,2})[:：時](\d{2})?", line)):
                hour = int(m[2]) + (12 if m[1] == "午後" and int(m[2]) < 12 else 0)
                cur["time"] = f"{hour}:{m[3] or '00'}"
            if "address_line1" not in cur and re.search(r"[都道府県市区町村]", line) and line[:1] not in "●■◆・":
                cur["address_line1"] = line


def listing_paragraphs(p: Page) -> Iterator[Payload]:
    """Paragraphs with a time, and the day in them or in a paragraph before."""
    day = None
    for n in p.root.select("p") if p.root else []:
        t = n.text()
        day = first_day(t) or day
        if (c := first_clock(t)) and day and len(t) <= 400:
            head = n.first("strong, b, a")
            yield kept(place(n.lines(), {"name": head.text() if head else re.split(r"[,–—|]|\s-\s", t)[0][:120], "day": day, "time": c}))


def column_text(p: Page) -> Iterator[Payload]:
    """Texts rendered one cell a line: time, day, name, venue, address, region."""
    for i, line in enumerate(p.lines[:-2]):
        if CLOCK.fullmatch(line) and heading_day(p.lines[i + 1]):
            rest = p.lines[i + 2 : i + 6]
            yield kept(dict(zip(("name", "venue_name", "address_line1", "region"), rest, strict=False)) | {"time": line, "day": p.lines[i + 1]})


def sequenced_text(p: Page) -> Iterator[Payload]:
    """A line of day and time, with the name in one of the five lines before it and the place after."""
    for i, line in enumerate(p.lines):
        d, t = first_day(line), first_clock(line)
        if d and t and len(line) <= 60:
            name = next((x for x in reversed(p.lines[max(0, i - 5) : i]) if not DAY.search(x) and not CLOCK.search(x) and not ADDRESS.search(x)), None)
            if name:
                yield kept(place(p.lines[i + 1 : i + 4], {"name": name, "day": d, "time": t}))


def _text(f: Callable) -> Callable:
    """An extractor of extract_text, which takes this module's patterns."""
    return lambda p: f(p, sys.modules[__name__])


STOP, STOP_WITH, ADD, ELSE = "stop", "stop with what was found", "add", "only if nothing was found"
#: (what follows, extractors with their least confidence). STOP: if any of them gives a listing, the page is done with
#: these alone; STOP_WITH: done with these and all before; ADD: go on; ELSE: one after the other until one gives any.
STEPS: tuple[tuple[str, tuple[tuple[str, Callable, float], ...]], ...] = (
    (STOP, (("configured", selected_rows, 0.78),)),
    (STOP, (("feed_json", feed_json, 0.86), ("calendar", calendar, 0.82))),
    (ADD, (("classed_table", classed_table, 0.82), ("header_table", header_table, 0.0), ("day_matrix", day_matrix, 0.82), ("heading_table", _text(T.heading_table), 0.82), ("classed_rows", classed_rows, 0.78))),
    (STOP_WITH, (("japanese", japanese_blocks, 0.75),)),
    (STOP_WITH, (("coded_tabs", _text(T.coded_tabs), 0.82), ("day_tabs", _text(T.day_tabs), 0.82), ("labelled", labelled_blocks, 0.82), ("place_sections", _text(T.place_sections), 0.78))),
    (ADD, (("cards", repeated_cards, 0.0), ("day_sections", day_sections, 0.75))),
    (ELSE, (
        ("printed_list", _text(T.printed_list), 0.75), ("columns", column_text, 0.78), ("paragraphs", listing_paragraphs, 0.75), ("inline", inline_schedules, 0.75), ("numbered_list", _text(T.numbered_list), 0.0),
        ("sequenced", sequenced_text, 0.0), ("text_block", text_blocks, 0.75),
    )),
)
KINDS = [k for _, fs in STEPS for k, _, _ in fs]


def is_listing(x: Payload) -> bool:
    """A day, a time, and some place or way to join."""
    return bool(x.get("day") and x.get("time") and any(x.get(f) for f in ("address_line1", "venue_name", "city", "online_url", "phone_join_info")))


def payloads(html: str | None, url: str, config: dict | None = None) -> Iterator[tuple[str, float, Payload]]:
    """(kind, least confidence, payload) of a page."""
    page = Page(html, url, config)
    found: list[tuple[str, float, Payload]] = []
    for then, kinds in STEPS:
        step: list[tuple[str, float, Payload]] = []
        for kind, f, floor in kinds:
            if then != ELSE or not (found or step):
                step += [(kind, floor, x) for x in f(page) if kind == "configured" and x or is_listing(x)]
        found = step if then == STOP and step else found + step
        if step and then in (STOP, STOP_WITH):
            break
    yield from found


#: Pages that a task turns into Python values at once.
PAGES_AT_ONCE = 256


def each_page(pages: DataFrame, one: Callable, schema: str) -> DataFrame:
    """The rows (tuples in the order of `schema`) that `one` gives for each page (its columns).

    Pages are dealt over all cores first, by a hash of the whole row. Of a batch only a few pages at a time become Python values, so
    memory doesn't follow the batch's texts."""
    kind = to_arrow_schema(StructType.fromDDL(schema))
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PAGES_AT_ONCE):
                part = b.slice(at, PAGES_AT_ONCE)
                rows = [r for page in zip(*(c.to_pylist() for c in part.columns), strict=True) for r in one(*page)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)

    return spread(pages, F.xxhash64(*pages.columns)).mapInArrow(run, schema)


OUT = "page_id long, pos int, kind string, floor double, " + ", ".join(f"{f} string" for f in FIELDS)


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, config JSON or none) to payload rows; the first of equal name, day, time and place."""

    def one(page_id: int, url: str, html: str | None, config: str | None) -> Iterator[tuple]:
        seen = set()
        for pos, (kind, floor, x) in enumerate(payloads(html, url, json.loads(config) if config else None)):
            key = tuple((x.get(k) or "").lower() for k in ("name", "day", "time")) + ((x.get("address_line1") or x.get("online_url") or "").lower(),)
            if key not in seen:
                seen.add(key)
                yield page_id, pos, kind, floor, *(x.get(f) for f in FIELDS)

    config = F.col("config") if "config" in pages.columns else F.lit(None).cast("string")
    return each_page(pages.select("page_id", "url", "html", config.alias("config")), one, OUT)


def links(pages: DataFrame) -> DataFrame:
    """Anchors of pages in document order: (page_id, pos, href, text)."""

    def one(page_id: int, html: str | None) -> Iterator[tuple]:
        return ((page_id, pos, a.attrs["href"], a.text()) for pos, a in enumerate(parse(html).select("a[href]")))

    return each_page(pages.select("page_id", "html"), one, "page_id long, pos int, href string, text string")


def css_rows(pages: DataFrame, row: str, fields: dict[str, str]) -> DataFrame:
    """Rows of a selector and its field selectors: (page_id, pos, fields...)."""

    def one(page_id: int, html: str | None) -> Iterator[tuple]:
        return ((page_id, pos, *(value(n, css) for css in fields.values())) for pos, n in enumerate(parse(html).select(row)))

    return each_page(pages.select("page_id", "html"), one, "page_id long, pos int, " + ", ".join(f"{f} string" for f in fields))


def page_parts(pages: DataFrame, *keep: str) -> DataFrame:
    """(page_id, title, headings, text, has_form, has_table) of pages, and the columns to keep, so that pages needn't be joined
    to their parts."""
    terms = ("day", "time", "meeting", "location", "address", "city", "group", "type")

    def parts(html: str | None) -> tuple:
        root = parse(html)
        title = root.first("title")
        heads = " ".join(n.text() for n in root.select("h1, h2, h3"))
        form = any("meeting" in (v := (n.text() + " " + " ".join(a for x in n.select("input, select, button") for a in x.attrs.values())).lower()) or "day" in v or "city" in v for n in root.select("form"))
        table = any(sum(t in h for t in terms) >= 2 for h in (" ".join(c.text() for c in n.select("th")).lower() for n in root.select("table")))
        return title.text() if title else "", heads, root.text(), form, table

    def one(page_id: int, html: str | None, *kept) -> Iterator[tuple]:
        yield page_id, *parts(html), *kept

    kept = "".join(f", {c} {pages.schema[c].dataType.simpleString()}" for c in keep)
    return each_page(pages.select("page_id", F.col("html").alias("__html"), *keep), one, f"page_id long, title string, headings string, text string, has_form boolean, has_table boolean{kept}")


def frames(pages: DataFrame) -> DataFrame:
    """Frames, embeds and objects of pages in document order: (page_id, pos, src)."""

    def one(page_id: int, html: str | None) -> Iterator[tuple]:
        return ((page_id, pos, src) for pos, n in enumerate(parse(html).select("iframe[src], embed[src], object[data]")) if (src := n.attrs["data" if n.tag == "object" else "src"].strip()))

    return each_page(pages.select("page_id", "html"), one, "page_id long, pos int, src string")
