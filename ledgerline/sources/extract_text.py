"""More extractors: tables under a title, tabbed schedules, places with times, and texts of documents.

A captured PDF comes here as its text layer, marked by ``data-pdf-text-fallback``."""

from __future__ import annotations

import re
from collections.abc import Iterator

from .html import Node

# Phrases of lines in printed lists that are no meeting, and of notes that are no name.
PRINT_NOISE = (
    "who is an addict", "each month", "basic text", "phone numbers", "for meeting info by phone", "call 1.", "meeting list", "helpline", "help line", "www.", "na.org", "area service committee", "public relations",
    "literature orders", "newsletter", "contributions", "changes to the meeting list", "legend", "open addicts only", "closed, addicts only", "wheel chair access", "one addict", "helping", "parallel",
)
NOTES = ("contact:", "phone", "email", "http", "closed mtg", "open", "wheelchair", "accessible", "service", "オープン", "クローズド", "本人のみ")
LIST_MARK = "Number found:"
REGION_GROUP = re.compile(r"(?i)^(?:co\.?\s+|county\s+|all\s+\w+\b)")
JOIN = re.compile(r"(?i)\b(?:zoom|meeting id|passcode|password|dial|phone|tel)\b|\+?\d[\d ()-]{8,}\d")
KANJI = re.compile(r"[぀-ヿ一-鿿]")
KANJI_PLACE = re.compile(r"(?:都|道|府|県|市|区|町|村|丁目|番地|条|西|東|南|北)\s*\d?")
POSTAL_CITY = re.compile(r"[A-Za-z'.\s-]+,?\s+[A-Z]{2}\s+\d{5}(?:-\d{4})?")


def heading_table(p, x) -> Iterator[dict]:
    """Tables whose first row spans all columns and names a group ("name at place"); below, a row for each day with times."""
    for table in p.root.select("table") if p.root else []:
        rows = table.select("tr")
        head = next((c for c in (rows[0].select("th, td") if rows else []) if c.attrs.get("colspan")), None)
        title = head.text() if head else ""
        if not title or x.CLOCK.search(title) or x.first_day(title):
            continue
        name, _, where = re.sub(r"(?i)\s+at\s+", "\0", title, count=1).partition("\0")
        base = {"name": name, "address_line1": where or (title if x.ADDRESS.search(title) else None)}
        for row in rows[1:]:
            cells = [c.text() for c in row.select("td")]
            day = x.first_day(cells[0]) if len(cells) > 1 else None
            yield from (x.kept(base | {"day": day, "time": t}) for c in cells[1:] if day and (t := x.first_clock(c)))


def coded_tabs(p, x) -> Iterator[dict]:
    """Tabbed lines with a group's code in the second cell: code, day, time, name, venue, address, city, region, then formats.
    Lines below, until the next code, complete what is missing."""
    at = {1: "source_record_id", 3: "day", 4: "time", 5: "name", 6: "venue_name", 7: "address_line1", 8: "city", 9: "region"}
    cur: dict | None = None
    for line in [*p.raw_lines(), "\tZZ0\t\tMonday\t0:00\t"]:
        cells = [c.strip() for c in line.split("\t")]
        if len(cells) >= 6 and re.fullmatch(r"[A-Z]{2}\d+", cells[1]) and x.first_day(cells[3]) and x.first_clock(cells[4]):
            if cur:
                yield x.kept(cur)
            cur = {f: cells[i] for i, f in at.items() if i < len(cells) and cells[i]}
            cur["time"] = x.first_clock(cells[4])
            if notes := [c for c in cells[11:14] if c]:
                cur["formats"] = ", ".join(notes)
        elif cur and (rest := [c for c in cells if c]) and not line.strip().isdigit():
            if m := x.LINK.search(line):
                cur.setdefault("online_url", m[0])
            elif JOIN.search(line):
                cur["phone_join_info"] = " ".join(filter(None, (cur.get("phone_join_info"), line.strip())))
            else:
                for f in ("venue_name", "address_line1", "city", "region"):
                    if f not in cur and rest:
                        cur[f] = rest.pop(0)


def day_tabs(p, x) -> Iterator[dict]:
    """Tabbed lines (name, city, address, time, formats) under a day's heading, which holds until the next one."""
    day = None
    for line in p.raw_lines():
        cells = [s for c in line.split("\t") if (s := " ".join(c.split()))]
        if "\t" not in line:
            day = (x.heading_day(cells[0]) if cells else None) or day
        elif day and len(cells) >= 4 and (t := x.first_clock(cells[3]) or x.first_clock(line)):
            yield x.kept({"name": cells[0], "day": day, "city": cells[1], "address_line1": cells[2], "time": t, "formats": cells[4] if len(cells) > 4 else None})


def place_sections(p, x) -> Iterator[dict]:
    """Sections headed by a place, with lines that name days and, after a label, a time."""
    for section in p.root.select("section, .box") if p.root else []:
        head = section.first("h1, h2, h3, header")
        title = head.text() if head else ""
        where = m[1] if (m := re.search(r"(?i)\blokacija\s*:\s*(.+)", title)) else title if x.ADDRESS.search(title) else None
        for n in section.select("p, li") if where else []:
            line = n.text()
            label = re.search(r"(?i)\b(?:čas|cas|time)\s*:", line)
            if label and (t := x.first_clock(line)):
                days = dict.fromkeys(d[0] for d in x.DAY.finditer(line))
                name = line[: label.start()].strip(" -|–—,:")
                yield from (x.kept({"name": name or "NA Meeting", "day": d, "time": t, "address_line1": where}) for d in days)


def numbered_list(p, x) -> Iterator[dict]:
    """Lines after a count of results: name, day, time, kind of attendance, area, then details, again and again."""
    lines = p.lines
    if LIST_MARK not in lines:
        return
    begin = next((i + 1 for i, s in enumerate(lines) if s.startswith("All meetings open")), lines.index(LIST_MARK) + 1)
    day_of = lambda s: x.first_day(re.sub(r"^\(\d+\)\s*", "", s))
    starts = [i for i in range(begin, len(lines) - 2) if day_of(lines[i + 1]) and x.first_clock(lines[i + 2])]
    # a line that is another start's day or time doesn't start one itself
    kept_, last = [], -3
    for i in starts:
        if i >= last + 3:
            kept_.append(i)
            last = i
    for i, j in zip(kept_, [*kept_[1:], len(lines)], strict=True):
        block = lines[i:j]
        out = {"name": block[0], "day": day_of(block[1]), "time": x.first_clock(block[2])}
        if len(block) > 3 and block[3].lower() in ("online", "in-person", "in person", "hybrid"):
            out["attendance_option"] = block[3]
        if len(block) > 4 and block[4] not in ("-", "n/a"):
            out["region" if REGION_GROUP.match(block[4]) else "city"] = block[4]
        joins = []
        for s in block[5:]:
            if s.lower().startswith("attendance is limited"):
                break
            if m := x.LINK.search(s):
                out.setdefault("online_url", m[0])
            elif JOIN.search(s):
                joins.append(s)
            elif "meeting" in s.lower() and "formats" not in out:
                out["formats"] = s
            elif x.ADDRESS.search(s):
                out.setdefault("address_line1", s)
            else:
                out.setdefault("venue_name", s)
        yield x.kept(out | {"phone_join_info": " ".join(joins) or None})


def _noise(line: str) -> bool:
    return any(w in line.lower() for w in PRINT_NOISE)


def _is_name(line: str, x) -> bool:
    low = line.lower()
    fits = (3 <= len(line) <= 90 or KANJI.search(line)) and not x.ADDRESS.search(line) and not POSTAL_CITY.fullmatch(line.strip())
    return bool(fits and not x.CLOCK.search(line) and not x.first_day(line) and not any(n in low for n in NOTES) and any(c.isalpha() for c in line))


def _day_line(line: str, x) -> str | None:
    """A line of a day and at most one word more."""
    d = x.first_day(line)
    return d if d and not x.CLOCK.search(line) and len(x.DAY.sub("", line).strip(" :/-–—").split()) <= 1 else None


def _comma(line: str) -> int:
    """Where the first comma outside parentheses stands, or -1."""
    depth = 0
    for i, c in enumerate(line):
        depth += (c == "(") - (c == ")" and depth > 0)
        if c == "," and depth == 0:
            return i
    return -1


def _begin(line: str, day: str | None, x) -> list[dict]:
    """What a line with a time starts: "name; ... time, place", "CITY day time name", or a name before or after the time."""
    m = x.CLOCK_RANGE.search(line) or x.CLOCK.search(line)
    days = list(dict.fromkeys(d[0] for d in x.DAY.finditer(line))) or ([day] if day else [])
    if not m or not days:
        return []
    clock, before, after = x.first_clock(line), line[: m.start()], re.sub(r"^\s*(?:to|[-–—〜～])?\s*\d{1,2}(?:[:.;]\d\d)?\s*(?:[ap]\.?m?\.?)?\s*$", "", line[m.end() :]).strip(" ,-|–—:")
    if ";" in before and (name := before.rsplit(";", 1)[0].strip(" -|–—,:")):
        out = {"name": name} | ({("address_line1" if x.ADDRESS.search(after) else "venue_name"): after} if after else {})
    else:
        lead = re.sub(r"(?i)\b(?:and|&|to|thru|through)\b", " ", x.DAY.sub(" ", before)).strip(" -|–—,:")
        capital = lead and lead.upper() == lead and len(lead.split()) <= 3
        out = {"name": after if after and after != "@" else "" if capital else lead, "city": lead.title() if capital and after else None}
    return [{k: v for k, v in (out | {"day": d, "time": clock}).items() if v} for d in days]


def printed_list(p, x) -> Iterator[dict]:
    """The text of a printed list: headings of days, lines that start meetings, names and places before or after them."""
    if not p.root or p.root.first("[data-pdf-text-fallback]") is None:
        return
    lines = [s for line in p.lines if (s := re.sub(r"_{3,}|\s+", " ", line).strip(" -|–—,")) and not _noise(s)]
    if any(KANJI.search(s) for s in lines):
        found = list(_japanese(lines, x))
        if found:
            yield from found
            return
    day, name, place = None, None, None
    open_: list[dict] = []
    for line in lines:
        if d := _day_line(line, x):
            yield from map(x.kept, open_)
            day, name, place, open_ = d, None, None, []
        elif new := _begin(line, day, x):
            yield from map(x.kept, open_)
            where = {("address_line1" if x.ADDRESS.search(place) else "venue_name"): place} if place else {}
            open_ = [({"name": name} if name else {}) | where | q for q in new]
            name = place = None
        elif open_:
            for q in open_:
                _detail(q, line, x)
        elif x.ADDRESS.search(line):
            place = line
        elif _is_name(line, x):
            place, name = (name, line) if name and not place else (place, line)
    yield from map(x.kept, open_)


def _detail(q: dict, line: str, x) -> None:
    """Put a line below a meeting where it belongs."""
    cut = _comma(line)
    if m := x.LINK.search(line):
        q.setdefault("online_url", m[0])
    elif JOIN.search(line) or line.lower().startswith("contact:"):
        q["phone_join_info"] = " ".join(filter(None, (q.get("phone_join_info"), line)))
    elif "name" not in q and cut > 0 and not x.ADDRESS.search(line[:cut]):
        rest = line[cut + 1 :].strip()
        q["name"] = re.sub(r"\([^)]{1,30}\)", "", line[:cut]).strip()
        if rest:
            q.setdefault("address_line1" if x.ADDRESS.search(rest) else "venue_name", rest)
    elif "name" not in q and _is_name(line, x):
        q["name"] = line
    elif x.ADDRESS.search(line):
        q.setdefault("address_line1", line)
    elif POSTAL_CITY.fullmatch(line):
        q.setdefault("city", line)
    elif _is_name(line, x):
        q.setdefault("venue_name" if "venue_name" not in q else "city", line)


def _japanese(lines: list[str], x) -> Iterator[dict]:
    """Names and venues stand up to seven lines before a time, the address up to ten lines after it."""
    day = None
    mark = [bool(_jp_day(s, x)) or bool(x.CLOCK.search(s)) for s in lines]
    fits = [bool((KANJI_PLACE.search(s) and KANJI.search(s)) or _is_name(s, x)) and not re.fullmatch(r"[０-９0-9]+\s*[Pp]?", s) for s in lines]
    for i, line in enumerate(lines):
        if d := _jp_day(line, x):
            day = d
        elif day and (m := x.CLOCK.search(line)):
            start = max([j + 1 for j in range(i) if mark[j]], default=0)
            before = [lines[j] for j in range(max(start, i - 7), i) if fits[j]][-2:]
            stop = next((j for j in range(i + 1, len(lines)) if mark[j]), len(lines))
            after = [lines[j] for j in range(i + 1, min(stop, i + 11)) if fits[j]]
            own = re.sub(r"^\s*(?:to|[-–—〜～])?\s*\d{1,2}(?::\d\d)?\s*$", "", line[m.end() :]).strip(" -|–—,:〜～")
            address = next((s for s in after if KANJI_PLACE.search(s)), None)
            venue = before[-2] if len(before) == 2 else next((s for s in after if not KANJI_PLACE.search(s)), None)
            yield x.kept({"day": day, "time": m[0], "name": own or (before[-1] if before else None), "venue_name": venue, "address_line1": address})


def _jp_day(line: str, x) -> str | None:
    if m := re.fullmatch(rf"[【\[(（]?([{x.JP_DAYS}])(?:曜日?)?[】\])）]?", line.strip()):
        return x.ENGLISH[x.JP_DAYS.index(m[1])]
    return _day_line(line, x)


def document_links(root: Node) -> list[str]:
    """Documents behind a page, in order: frames and objects, then links, each once."""
    frames = [n.attrs.get("data" if n.tag == "object" else "src", "").strip() for n in root.select("iframe[src], embed[src], object[data]")]
    return list(dict.fromkeys(u for u in (*frames, *(a.attrs["href"].strip() for a in root.select("a[href]"))) if u))
