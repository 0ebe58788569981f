"""Lookup tables as plain values, and how to look a column up in one."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

# Day names (Sunday is 0), one line a language.
DAY_NAMES = {
    "sunday": 0, "sun": 0, "monday": 1, "mon": 1, "tuesday": 2, "tue": 2, "tues": 2, "wednesday": 3, "wed": 3, "thursday": 4, "thu": 4, "thur": 4, "thurs": 4, "friday": 5, "fri": 5, "saturday": 6, "sat": 6,
    "domingo": 0, "segunda": 1, "segunda-feira": 1, "terça": 2, "terca": 2, "terça-feira": 2, "terca-feira": 2, "quarta": 3, "quarta-feira": 3, "quinta": 4, "quinta-feira": 4, "sexta": 5, "sexta-feira": 5, "sábado": 6, "sabado": 6,
    "lunes": 1, "lune": 1, "martes": 2, "marte": 2, "miércoles": 3, "miercoles": 3, "miercole": 3, "jueves": 4, "jueve": 4, "viernes": 5, "vierne": 5,
    "dimanche": 0, "lundi": 1, "mardi": 2, "mercredi": 3, "jeudi": 4, "vendredi": 5, "samedi": 6,
    "niedziela": 0, "poniedziałek": 1, "poniedzialek": 1, "wtorek": 2, "środa": 3, "sroda": 3, "czwartek": 4, "piątek": 5, "piatek": 5, "sobota": 6,
    "søndag": 0, "sondag": 0, "mandag": 1, "tirsdag": 2, "onsdag": 3, "torsdag": 4, "fredag": 5, "lørdag": 6, "lordag": 6, "söndag": 0, "måndag": 1, "tisdag": 2, "lördag": 6,
    "zondag": 0, "maandag": 1, "dinsdag": 2, "woensdag": 3, "donderdag": 4, "vrijdag": 5, "zaterdag": 6,
    "sonntag": 0, "montag": 1, "dienstag": 2, "mittwoch": 3, "donnerstag": 4, "freitag": 5, "samstag": 6,
    "κυριακή": 0, "κυριακη": 0, "δευτέρα": 1, "δευτερα": 1, "τρίτη": 2, "τριτη": 2, "τετάρτη": 3, "τεταρτη": 3, "πέμπτη": 4, "πεμπτη": 4, "παρασκευή": 5, "παρασκευη": 5, "σάββατο": 6, "σαββατο": 6,
    "воскресенье": 0, "понедельник": 1, "вторник": 2, "среда": 3, "четверг": 4, "пятница": 5, "суббота": 6,
    "minggu": 0, "senin": 1, "selasa": 2, "rabu": 3, "kamis": 4, "jumat": 5, "jumaat": 5, "sabtu": 6,
    "อาทิตย์": 0, "จันทร์": 1, "อังคาร": 2, "พุธ": 3, "พฤหัส": 4, "ศุกร์": 5, "เสาร์": 6,
}
DAILY_NAMES = ("codziennie", "daily", "every day")

# Country aliases and codes.
COUNTRY_ALIASES = {
    "au": "Australia", "australia": "Australia", "austria": "Austria", "brazil": "Brazil", "ca": "Canada", "canada": "Canada", "danmark": "Denmark", "dania": "Denmark", "denmark": "Denmark",
    "deutschland": "Germany", "eire": "Ireland", "éire": "Ireland", "germany": "Germany", "great britain": "United Kingdom", "holandia": "Netherlands", "ireland": "Ireland", "japan": "Japan",
    "nederland": "Netherlands", "netherlands": "Netherlands", "new zealand": "New Zealand", "niemcy": "Germany", "norway": "Norway", "norwegia": "Norway", "poland": "Poland", "polska": "Poland",
    "south africa": "South Africa", "sweden": "Sweden", "szwecja": "Sweden", "u.k.": "United Kingdom", "uk": "United Kingdom", "united kingdom": "United Kingdom", "united states": "United States",
    "united states of america": "United States", "us": "United States", "u.s.a.": "United States", "usa": "United States", "wielka brytania": "United Kingdom",
}
COUNTRY_CODES = {
    "Australia": "AU", "Austria": "AT", "Brazil": "BR", "Canada": "CA", "Denmark": "DK", "Germany": "DE", "Ireland": "IE", "Japan": "JP", "Netherlands": "NL", "New Zealand": "NZ",
    "Norway": "NO", "Poland": "PL", "South Africa": "ZA", "Sweden": "SE", "United Kingdom": "GB", "United States": "US",
}
TIMEZONE_PREFIXES = {
    "Australia": ("Australia/",), "Austria": ("Europe/Vienna",), "Brazil": ("America/",), "Canada": ("America/", "Canada/"), "Denmark": ("Europe/Copenhagen",), "Germany": ("Europe/Berlin",),
    "Ireland": ("Europe/Dublin",), "Japan": ("Asia/Tokyo",), "Netherlands": ("Europe/Amsterdam",), "New Zealand": ("Pacific/Auckland", "Pacific/Chatham"), "Norway": ("Europe/Oslo",),
    "Poland": ("Europe/Warsaw",), "South Africa": ("Africa/Johannesburg",), "Sweden": ("Europe/Stockholm",), "United Kingdom": ("Europe/London",), "United States": ("America/", "Pacific/Honolulu", "US/"),
}
# Abbreviations in addresses.
ADDRESS_WORDS = {"st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court", "pl": "place"}
ACCESS_PHRASES = ("not wheelchair accessible", "not wheelchair accessible.", "wheelchair accessible", "wheelchair accessible.")
PROVINCES = ("munster", "leinster", "ulster", "connacht")
# Region names, their codes and time zones.
US_REGIONS = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District Of Columbia", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan",
    "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}
CANADA_REGIONS = {
    "AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick", "NL": "Newfoundland And Labrador", "NS": "Nova Scotia", "ON": "Ontario", "PE": "Prince Edward Island", "QC": "Quebec", "SK": "Saskatchewan",
    "NT": "Northwest Territories", "NU": "Nunavut", "YT": "Yukon",
}
AUSTRALIA_REGIONS = {"ACT": "Australian Capital Territory", "NSW": "New South Wales", "NT": "Northern Territory", "QLD": "Queensland", "SA": "South Australia", "TAS": "Tasmania", "VIC": "Victoria", "WA": "Western Australia"}
UK_REGIONS = {"ENG": "England", "NIR": "Northern Ireland", "SCT": "Scotland", "WLS": "Wales"}
REGIONS = {"United States": US_REGIONS, "Canada": CANADA_REGIONS, "Australia": AUSTRALIA_REGIONS, "United Kingdom": UK_REGIONS}


def lookup(table: dict, key: Column) -> Column:
    """The table's value for a key, else null. For the small fixed tables above: a literal map, no join.

    The map is one parsed expression, which keeps building a plan cheap, and folds to a constant."""
    if not table:
        return F.lit(None)
    return F.try_element_at(F.expr(_literal(tuple(table.items()))), key)


@lru_cache(maxsize=256)
def _literal(items: tuple) -> str:
    quote = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    return "map(" + ", ".join(f"{quote(k)}, {quote(v)}" for k, v in items) + ")"
