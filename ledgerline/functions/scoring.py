"""Confidence, page and link scores: sums of integer hundredths, clamped, divided once at the end."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .schedule import TIME
from .text import once
from .urls import part

LOW, VERY_LOW = 0.75, 0.45
# Hundredths for each sign of a meeting listing.
GAINS = {"day": 18, "time": 20, "name": 12, "location": 14, "online": 12, "repeated_structure": 10, "table_headers": 10, "meeting_page": 7}
LOSSES = {"text_fallback": 14, "missing_day": 12, "missing_time": 14, "missing_location": 10}
# Terms of links and pages.
URL_TERMS = (
    "meeting", "meetings", "find-a-meeting", "find-meeting", "find-meeting/find-a-meeting", "meeting-schedule", "meetings-schedule", "schedule", "where-to-find", "locator", "location", "locations", "meeting-locations",
    "group", "groups", "aa-groups", "a-a-groups", "alcoholics-anonymous-groups", "tsml-", "reuniao", "reunioes", "reunião", "reuniões", "reunion", "reunions", "réunion", "réunions", "reuniones", "horario", "horarios",
    "horário", "horários", "calendario", "calendário", "spotkania", "spotkanie", "mityng", "mityngi", "miting", "mitingi", "møder", "moder", "møde", "mode", "moten", "möten", "mote", "möte", "moeten", "bijeenkomst",
    "bijeenkomsten", "treffen", "meetingsuche", "συναντήσεις", "συναντηση", "synantiseis", "synantisi", "встречи", "vstrechi", "การประชุม", "ประชุม", "pertemuan", "mesyuarat",
)
TEXT_TERMS = (
    "meeting list", "meeting schedule", "find a meeting", "find meeting", "find an online meeting", "find a face-to-face meeting", "meeting finder", "meeting locations", "group finder", "aa groups", "a.a. groups",
    "alcoholics anonymous groups", "search meetings", "view all meetings", "online meetings", "in-person", "presencial", "encontrar reunião", "encontrar reuniao", "procurar reunião", "procurar reuniao", "buscar reunión",
    "buscar reunion", "horário das reuniões", "horario das reunioes", "horario de reuniones", "trouver une réunion", "trouver une reunion", "réunions en ligne", "liste des réunions", "srečanja", "srecanja", "srečanje",
    "srecanje", "spotkania", "lista spotkań", "harmonogram spotkań", "mityngi", "mitingi", "find møde", "mødeliste", "mødeoversigt", "hitta möte", "möteslista", "finn møte", "møteliste", "vergaderingen", "bijeenkomsten",
    "meeting zoeken", "treffen finden", "meetingliste", "συναντήσεις", "αναζήτηση συνάντησης", "встречи", "найти встречу", "jadual mesyuarat", "cari mesyuarat", "jadwal pertemuan", "cari pertemuan", "ค้นหาการประชุม",
)
NEGATIVE_TERMS = (
    "donate", "donation", "news", "blog", "login", "signup", "privacy", "contact", "shop", "event", "events", "download", "downloads", "form", "forms", "register", "registration", "service meeting", "service-meeting",
    "service-meetings", "start-a-meeting", "update-register",
)
STRONG_SUFFIXES = (
    "/meetings", "/meeting-schedule", "/meetings-schedule", "/find-a-meeting", "/find-meeting", "/where-to-find", "/reunioes", "/reuniões", "/reuniones", "/reunions", "/srecanja", "/srečanja", "/horario", "/horários",
    "/horarios", "/spotkania", "/mityngi", "/mitingi", "/møder", "/moder", "/moten", "/möten", "/bijeenkomsten", "/treffen", "/встречи",
)
STRONG_TEXTS = ("find a meeting", "find an online meeting", "find a face-to-face meeting", "meeting schedule", "srečanja", "srecanja", "view all meetings")
STRONG_QUERIES = ("tsml-attendance_option=", "tsml-type=")
# Words for days.
WEEKDAYS = (
    "today", "sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sun", "mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "domingo", "segunda", "segunda-feira", "terça", "terca",
    "terça-feira", "terca-feira", "quarta", "quarta-feira", "quinta", "quinta-feira", "sexta", "sexta-feira", "sábado", "sabado", "lunes", "martes", "miércoles", "miercoles", "jueves", "viernes", "dimanche", "lundi",
    "mardi", "mercredi", "jeudi", "vendredi", "samedi", "codziennie", "niedziela", "poniedziałek", "poniedzialek", "wtorek", "środa", "sroda", "czwartek", "piątek", "piatek", "sobota", "søndag", "sondag", "mandag",
    "tirsdag", "onsdag", "torsdag", "fredag", "lørdag", "lordag", "söndag", "måndag", "tisdag", "lördag", "zondag", "maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag", "sonntag", "montag", "dienstag",
    "mittwoch", "donnerstag", "freitag", "samstag", "κυριακή", "κυριακη", "δευτέρα", "δευτερα", "τρίτη", "τριτη", "τετάρτη", "τεταρτη", "πέμπτη", "πεμπτη", "παρασκευή", "παρασκευη", "σάββατο", "σαββατο", "воскресенье",
    "понедельник", "вторник", "среда", "четверг", "пятница", "суббота", "вс", "пн", "вт", "ср", "чт", "пт", "сб", "nedelja", "ponedeljek", "torek", "sreda", "četrtek", "cetrtek", "petek", "minggu", "senin", "selasa",
    "rabu", "kamis", "jumat", "jumaat", "sabtu", "อาทิตย์", "จันทร์", "อังคาร", "พุธ", "พฤหัส", "ศุกร์", "เสาร์",
)
DAY = r"(?iuU)\b(?:" + "|".join(sorted(WEEKDAYS, key=len, reverse=True)) + r")\b"


def clamped(points: Column) -> Column:
    """Hundredths as a number from 0 to 1."""
    return F.greatest(F.lit(0), F.least(F.lit(100), points)) / F.lit(100.0)


def _points(flag: Column, n: int) -> Column:
    return F.when(flag, F.lit(n)).otherwise(F.lit(0))


def _terms(text: Column, terms: tuple[str, ...], n: int) -> Column:
    """n for each term that the text contains."""
    return F.size(F.filter(F.array(*map(F.lit, terms)), lambda t: text.contains(t))) * n


def confidence(has: Mapping[str, Column], text_fallback: Column) -> tuple[Column, Column]:
    """Score and list of signals of a payload; `has` gives a boolean for names in GAINS."""
    flags = {k: F.coalesce(has[k], F.lit(False)) if k in has else F.lit(False) for k in GAINS}
    lost = {"text_fallback": text_fallback, "missing_day": ~flags["day"], "missing_time": ~flags["time"], "missing_location": ~(flags["location"] | flags["online"])}
    points = F.lit(5)
    for k, n in GAINS.items():
        points = points + _points(flags[k], n)
    for k, n in LOSSES.items():
        points = points - _points(lost[k], n)
    signals = F.array_compact(F.array(*(F.when(f, F.lit(k)) for k, f in (flags | lost).items())))
    return clamped(points), signals


def confidence_code(c: Column) -> Column:
    return F.when(c < VERY_LOW, "scrape_very_low_confidence").when(c < LOW, "scrape_low_confidence")


def _link_texts(url: Column, text: Column) -> tuple[Column, Column]:
    """Path, query and text of a link in lower case, and its text alone."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.concat_ws(" ", F.lower(part(url, 3)), F.lower(part(url, 4)), low), low


def _some(words: tuple[str, ...], test) -> Column:
    """Does any of the words pass?"""
    return F.exists(F.array(*map(F.lit, words)), test)


def strong_link(url: Column, text: Column) -> Column:
    """Does a link name a public directory of meetings outright? Its parts are computed once, not for each word."""
    short, query, low = F.lower(F.regexp_replace(part(url, 3), "/+$", "")), F.lower(part(url, 4)), _link_texts(url, text)[1]
    by_path = once(short, lambda x: _some(STRONG_SUFFIXES, lambda s: x.endswith(s)))
    by_query = once(query, lambda x: _some(STRONG_QUERIES, lambda s: x.contains(s)))
    return by_path | by_query | once(low, lambda x: _some(STRONG_TEXTS, lambda s: x.contains(s)))


def negative_link(url: Column, text: Column) -> Column:
    return once(_link_texts(url, text)[0], lambda x: _some(NEGATIVE_TERMS, lambda t: x.contains(t)))


def link_points(url: Column, text: Column) -> Column:
    """Hundredths of a link; may be below 0 or above 100."""
    terms = once(_link_texts(url, text)[0], lambda x: _terms(x, URL_TERMS, 25) + _terms(x, TEXT_TERMS, 18) - _terms(x, NEGATIVE_TERMS, 35))
    return _points(strong_link(url, text), 45) + terms


def link_score(url: Column, text: Column) -> Column:
    return clamped(link_points(url, text))


def page_score(url: Column, heading: Column, text: Column, has_form: Column, has_table: Column) -> Column:
    """The link score of title and headings, and signs in the body."""
    base = F.greatest(F.lit(0), F.least(F.lit(100), link_points(url, heading)))
    low = F.lower(text)
    words = once(low, lambda x: _terms(x, TEXT_TERMS, 6) - _terms(x, NEGATIVE_TERMS, 4))
    return clamped(base + _points(low.rlike(DAY) & low.rlike(TIME), 26) + _points(has_form, 24) + _points(has_table, 24) + words)
