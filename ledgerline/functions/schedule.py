"""Days and times. A time of day is a number of minutes; days count from Sunday as 0."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lookups import DAILY_NAMES, DAY_NAMES, lookup
from .text import ustrip

_CLOCK = r"(?i)^(\d{1,2})(?::(\d{2}))?(?::\d{2})?\s*([ap]\.?m\.?)?$"


def parse_time(c: Column) -> Column:
    """Minutes of the day of H, H:MM or H:MM:SS with an optional am or pm; null otherwise. Seconds are dropped."""
    s = F.trim(c)
    hour = F.try_to_number(F.regexp_extract(s, _CLOCK, 1), F.lit("99")).cast("int")
    minute = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(s, _CLOCK, 2), F.lit("")), F.lit("99")).cast("int"), F.lit(0))
    mark = F.translate(F.lower(F.regexp_extract(s, _CLOCK, 3)), ".", "")
    hour = F.when((mark == "pm") & (hour != 12), hour + 12).when((mark == "am") & (hour == 12), 0).otherwise(hour)
    return F.when(s.rlike(_CLOCK) & hour.between(0, 23) & minute.between(0, 59), hour * 60 + minute)


def clock(minutes: Column) -> Column:
    """HH:mm:ss of a number of minutes."""
    return F.format_string("%02d:%02d:00", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"))


def normalize_days(c: Column) -> Column:
    """Day numbers of a name in one of the known languages, of 'daily', or of a digit (7 is Sunday)."""
    s = F.lower(ustrip(c.cast("string")))
    number = F.try_to_number(F.regexp_extract(s, r"^[+]?0*(\d)$", 1), F.lit("9")).cast("int")
    named = lookup(DAY_NAMES, s)
    none = F.array().cast("array<int>")
    return F.coalesce(F.when(s.isin(*DAILY_NAMES), F.array(*map(F.lit, range(7)))).when(named.isNotNull(), F.array(named)).when(number.between(0, 7), F.array(number % 7)), none)


def normalize_day(c: Column) -> Column:
    return F.get(normalize_days(c), 0)


_H = r"(?:[01]?\d|2[0-3])"
_RANGE = r"(?:to|-|–|—|〜|～)"


def clean_time(c: Column) -> Column:
    """A found time in the form that parse_time reads: noon and midnight, kl., 19h, dots, a single a or p, a range's
    end, digits run together, a mark after a 24-hour time, a bare hour."""
    s = F.trim(c)
    low = F.lower(s)
    r = s
    for pattern, to in (
        (r"(?i)^kl\.?\s*", ""),
        (rf"(?i)^({_H})h$", "$1:00"),
        (r"(?<=\d)\.(?=\d{2}\b)", ":"),
        (r"(?i)(?<=\d)\s*a\b(?!\.m)", "am"),
        (r"(?i)(?<=\d)\s*p\b(?!\.m)", "pm"),
        (rf"(?i)\s*{_RANGE}\s*\d{{1,2}}(?:[:.]\d{{2}})?\s*(?:am|pm|a\.m\.|p\.m\.)?\s*$", ""),
        (r"(?i)(?<![A-Za-z])([ap])\.m\b\.?", "$1m"),
    ):
        r = F.regexp_replace(r, pattern, to)
    late = r"(?i)^(1[3-9]|2[0-3]):([0-5]\d)\s*(?:am|pm)$"
    t = F.regexp_replace(r, r"(?i)(?<=\d)[.;](?=\d{2}\s*(?:am|pm)?\b)", ":")
    run = r"(?i)^(\d{1,2})(\d{2})\s*(am|pm)$"
    hour = F.regexp_replace(F.regexp_extract(t, rf"^0?({_H})$", 1), "^0(?=\\d)", "")
    joined = F.concat(F.regexp_replace(F.regexp_extract(t, run, 1), "^0(?=\\d)", ""), F.lit(":"), F.regexp_extract(t, run, 2), F.lower(F.regexp_extract(t, run, 3)))
    return (
        F.when(low.isin("noon", "12 noon"), "12:00 pm").when(low == "midnight", "12:00 am")
        .when(r.rlike(late), F.regexp_replace(r, late, "$1:$2")).when(t.rlike(run), joined).when(t.rlike(rf"^{_H}$"), F.concat(hour, F.lit(":00"))).otherwise(t)
    )


_MARK = r"(?:am|pm|a|p|a\.m\.|p\.m\.)"
TIME = (
    rf"(?i)\b(?:(?:\d{{1,2}}[:.;]?\d{{2}}|\d{{1,2}})\s*{_MARK}|kl\.?\s*{_H}(?:[:.][0-5]\d)?(?:\s*{_RANGE}\s*{_H}(?:[:.][0-5]\d)?)?|noon|{_H}h|{_H}\.[0-5]\d|"
    rf"{_H}:[0-5]\d(?:\s*{_RANGE}\s*{_H}:[0-5]\d)?|12\s*noon|midnight)(?=\W|$)"
)
RANGE_WITH_MARK = rf"(?i)\b(\d{{1,2}}[:.;]\d{{2}})\s*{_RANGE}\s*\d{{1,2}}[:.;]\d{{2}}\s*({_MARK})\b"


def first_time(c: Column) -> Column:
    """The first time in a text; a range whose mark stands at its end gives the mark to its start."""
    start = F.regexp_extract(c, RANGE_WITH_MARK, 1)
    return F.when(start != "", F.concat(start, F.regexp_extract(c, RANGE_WITH_MARK, 2))).otherwise(F.nullif(F.regexp_extract(c, TIME, 0), F.lit("")))
