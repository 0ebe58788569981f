"""Time zones by country and region, and by words in a source's name or address."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lookups import lookup
from .text import nonblank

# Zones of regions in countries that have several, and of countries.
US = {
    "Alabama": "America/Chicago", "Alaska": "America/Anchorage", "Arizona": "America/Phoenix", "Arkansas": "America/Chicago", "California": "America/Los_Angeles", "Colorado": "America/Denver",
    "Connecticut": "America/New_York", "Delaware": "America/New_York", "District Of Columbia": "America/New_York", "Florida": "America/New_York", "Georgia": "America/New_York", "Hawaii": "Pacific/Honolulu",
    "Idaho": "America/Boise", "Illinois": "America/Chicago", "Indiana": "America/Indiana/Indianapolis", "Iowa": "America/Chicago", "Kansas": "America/Chicago", "Kentucky": "America/New_York",
    "Louisiana": "America/Chicago", "Maine": "America/New_York", "Maryland": "America/New_York", "Massachusetts": "America/New_York", "Michigan": "America/Detroit", "Minnesota": "America/Chicago",
    "Mississippi": "America/Chicago", "Missouri": "America/Chicago", "Montana": "America/Denver", "Nebraska": "America/Chicago", "Nevada": "America/Los_Angeles", "New Hampshire": "America/New_York",
    "New Jersey": "America/New_York", "New Mexico": "America/Denver", "New York": "America/New_York", "North Carolina": "America/New_York", "North Dakota": "America/Chicago", "Ohio": "America/New_York",
    "Oklahoma": "America/Chicago", "Oregon": "America/Los_Angeles", "Pennsylvania": "America/New_York", "Rhode Island": "America/New_York", "South Carolina": "America/New_York",
    "South Dakota": "America/Chicago", "Tennessee": "America/Chicago", "Texas": "America/Chicago", "Utah": "America/Denver", "Vermont": "America/New_York", "Virginia": "America/New_York",
    "Washington": "America/Los_Angeles", "West Virginia": "America/New_York", "Wisconsin": "America/Chicago", "Wyoming": "America/Denver",
}
CANADA = {
    "Ab": "America/Edmonton", "Alberta": "America/Edmonton", "Bc": "America/Vancouver", "British Columbia": "America/Vancouver", "Mb": "America/Winnipeg", "Manitoba": "America/Winnipeg",
    "Nb": "America/Moncton", "New Brunswick": "America/Moncton", "Nl": "America/St_Johns", "Newfoundland And Labrador": "America/St_Johns", "Ns": "America/Halifax", "Nova Scotia": "America/Halifax",
    "Nt": "America/Yellowknife", "Nu": "America/Iqaluit", "On": "America/Toronto", "Ontario": "America/Toronto", "Pe": "America/Halifax", "Prince Edward Island": "America/Halifax",
    "Qc": "America/Toronto", "Quebec": "America/Toronto", "Québec": "America/Toronto", "Sk": "America/Regina", "Saskatchewan": "America/Regina", "Yt": "America/Whitehorse",
}
AUSTRALIA = {
    "Act": "Australia/Sydney", "Australian Capital Territory": "Australia/Sydney", "New South Wales": "Australia/Sydney", "Nsw": "Australia/Sydney", "Northern Territory": "Australia/Darwin", "Nt": "Australia/Darwin",
    "Queensland": "Australia/Brisbane", "Qld": "Australia/Brisbane", "South Australia": "Australia/Adelaide", "Sa": "Australia/Adelaide", "Tas": "Australia/Hobart", "Tasmania": "Australia/Hobart",
    "Victoria": "Australia/Melbourne", "Vic": "Australia/Melbourne", "Wa": "Australia/Perth", "Western Australia": "Australia/Perth",
}
BRAZIL = {"Sao Paulo": "America/Sao_Paulo", "São Paulo": "America/Sao_Paulo", "Sp": "America/Sao_Paulo"}
MEXICO = {
    "B.C.": "America/Tijuana", "B.C.S.": "America/Mazatlan", "Baja California": "America/Tijuana", "Baja California Norte": "America/Tijuana", "Baja California Sur": "America/Mazatlan", "Cdmx": "America/Mexico_City",
    "Chiapas": "America/Mexico_City", "Colima": "America/Mexico_City", "Guerrero": "America/Mexico_City", "Gto": "America/Mexico_City", "Guanajuato": "America/Mexico_City", "Jal": "America/Mexico_City",
    "Jalisco": "America/Mexico_City", "Mich": "America/Mexico_City", "Michoacán": "America/Mexico_City", "Michoacan": "America/Mexico_City", "Mexico": "America/Mexico_City", "Mexico City": "America/Mexico_City",
    "Nay": "America/Mazatlan", "Nayarit": "America/Mazatlan", "Nayarit South": "America/Mazatlan", "Nuevo Leon": "America/Monterrey", "Oax": "America/Mexico_City", "Oaxaca": "America/Mexico_City",
    "Q.R.": "America/Cancun", "Qro": "America/Mexico_City", "Queretaro": "America/Mexico_City", "Quintana Roo": "America/Cancun", "San Luis Potosi": "America/Mexico_City", "Sin": "America/Mazatlan",
    "Sinaloa": "America/Mazatlan", "Sonora": "America/Hermosillo", "Veracruz": "America/Mexico_City",
}
LONE_REGIONS = {
    "Amsterdam": "Europe/Amsterdam", "Athens": "Europe/Athens", "Auckland": "Pacific/Auckland", "Bryansk Oblast": "Europe/Moscow", "Geneva": "Europe/Zurich", "Guayas": "America/Guayaquil",
    "Ivanovo Oblast": "Europe/Moscow", "Mons": "Europe/Brussels", "Munich": "Europe/Berlin", "Oryol Oblast": "Europe/Moscow", "Paris": "Europe/Paris", "Rotterdam": "Europe/Amsterdam",
    "Rostov Oblast": "Europe/Moscow", "Stavropol Krai": "Europe/Moscow", "Vienna": "Europe/Vienna",
}
COUNTRIES = {
    "argentina": "America/Argentina/Buenos_Aires", "argentia": "America/Argentina/Buenos_Aires", "aruba": "America/Aruba", "armenia": "Asia/Yerevan", "austria": "Europe/Vienna", "bahamas": "America/Nassau",
    "bangladesh": "Asia/Dhaka", "barbados": "America/Barbados", "belgium": "Europe/Brussels", "belize": "America/Belize", "bolivia": "America/La_Paz", "botswana": "Africa/Gaborone", "bulgaria": "Europe/Sofia",
    "costa rica": "America/Costa_Rica", "cayman islands": "America/Cayman", "chile": "America/Santiago", "cyprus": "Asia/Nicosia", "czech republic": "Europe/Prague", "czechia": "Europe/Prague",
    "dominican republic": "America/Santo_Domingo", "denmark": "Europe/Copenhagen", "estonia": "Europe/Tallinn", "fiji": "Pacific/Fiji", "france": "Europe/Paris", "germany": "Europe/Berlin",
    "greece": "Europe/Athens", "ghana": "Africa/Accra", "guam": "Pacific/Guam", "guatemala": "America/Guatemala", "guyana": "America/Guyana", "hong kong": "Asia/Hong_Kong", "iceland": "Atlantic/Reykjavik",
    "india": "Asia/Kolkata", "indonesia": "Asia/Jakarta", "ie": "Europe/Dublin", "ireland": "Europe/Dublin", "israel": "Asia/Jerusalem", "italy": "Europe/Rome", "japan": "Asia/Tokyo",
    "kazakhstan": "Asia/Almaty", "kenya": "Africa/Nairobi", "jamaica": "America/Jamaica", "malaysia": "Asia/Kuala_Lumpur", "malta": "Europe/Malta", "mexico": "America/Mexico_City", "moldova": "Europe/Chisinau",
    "monaco": "Europe/Monaco", "netherlands": "Europe/Amsterdam", "nepal": "Asia/Kathmandu", "new zealand": "Pacific/Auckland", "norway": "Europe/Oslo", "oman": "Asia/Muscat", "pakistan": "Asia/Karachi",
    "panama": "America/Panama", "paraguay": "America/Asuncion", "peru": "America/Lima", "philippines": "Asia/Manila", "poland": "Europe/Warsaw", "portugal": "Europe/Lisbon",
    "puerto rico": "America/Puerto_Rico", "singapore": "Asia/Singapore", "slovenia": "Europe/Ljubljana", "south africa": "Africa/Johannesburg", "spain": "Europe/Madrid", "suriname": "America/Paramaribo",
    "switzerland": "Europe/Zurich", "sweden": "Europe/Stockholm", "thailand": "Asia/Bangkok", "trinidad and tobago": "America/Port_of_Spain", "trinidad & tobago": "America/Port_of_Spain",
    "turkey": "Europe/Istanbul", "ukraine": "Europe/Kyiv", "united arab emirates": "Asia/Dubai", "uk": "Europe/London", "united kingdom": "Europe/London", "uruguay": "America/Montevideo",
    "venezuela": "America/Caracas", "vietnam": "Asia/Ho_Chi_Minh", "virgin islands - us": "America/St_Thomas",
}
#: Words in a source's name or address, the first that fits counts.
MARKERS = {
    "aa oficina del area de p.r.": "America/Puerto_Rico", "aaparis.org": "Europe/Paris", "aastjohns.com": "America/St_Johns", "aaauckland.org": "Pacific/Auckland", "abbotsford": "America/Vancouver",
    "abu dhabi": "Asia/Dubai", "aayellowknife": "America/Yellowknife", "area82aa": "America/Halifax", "astrakhan": "Europe/Astrakhan", "ballarat": "Australia/Melbourne", "berlin": "Europe/Berlin",
    "cambodia": "Asia/Phnom_Penh", "capital federal": "America/Argentina/Buenos_Aires", "auckland": "Pacific/Auckland", "akronca.org": "America/New_York", "cayman islands": "America/Cayman", "cebu": "Asia/Manila",
    "cajakarta.com": "Asia/Jakarta", "caofpa.org": "America/New_York", "caofwa.org": "America/Los_Angeles", "clevelandca.org": "America/New_York", "cocaineanonymous.com.au": "Australia/Sydney",
    "comite de area": "America/Puerto_Rico", "cyprus": "Asia/Nicosia", "dumaguete": "Asia/Manila", "dunedin": "Pacific/Auckland", "eastern georgian bay": "America/Toronto", "greek central office": "Europe/Athens",
    "greater vancouver": "America/Vancouver", "gvís greater vancouver": "America/Vancouver", "gvis greater vancouver": "America/Vancouver", "hamilton": "America/Toronto", "huntsville, parry sound": "America/Toronto",
    "kansai": "Asia/Tokyo", "kenya": "Africa/Nairobi", "kerala": "Asia/Kolkata", "kingston jamaica": "America/Jamaica", "lanzarote": "Atlantic/Canary", "london area intergroup": "Europe/London",
    "mumbai": "Asia/Kolkata", "oficina del area de p.r.": "America/Puerto_Rico", "phuket": "Asia/Bangkok", "port elizabeth": "Africa/Johannesburg", "port of spain": "America/Port_of_Spain",
    "red deer": "America/Edmonton", "st. johns intergroup": "America/St_Johns", "orangecountyca.info": "America/Los_Angeles", "tennca.com": "America/Chicago", "ural & w siberia": "Asia/Yekaterinburg",
    "victoria/haliburton": "America/Toronto", "western cape": "Africa/Johannesburg", "western russia region": "Europe/Moscow",
}
US_NAMES, AUSTRALIA_NAMES = ("united states", "us", "usa"), ("australia", "au")
#: Countries whose regions decide alone: an unknown region of one of them has no zone.
SEVERAL = ((US_NAMES, US), (("canada",), CANADA), (AUSTRALIA_NAMES, AUSTRALIA), (("brazil",), BRAZIL), (("mexico",), MEXICO))


def _low(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def _by_name(table: dict[str, str], name: Column) -> Column:
    return lookup({k.lower(): v for k, v in table.items()}, name)


def by_place(country: Column, region: Column) -> Column:
    """The zone of a region where its country has several, else of the country; a region alone may have one too."""
    c, r = _low(country), _low(region)
    out = F.coalesce(lookup(COUNTRIES, c), F.when((c == "") & (r != ""), _by_name(LONE_REGIONS, r)))
    for names, table in reversed(SEVERAL):
        out = F.when(c.isin(*names) & (r != ""), _by_name(table, r)).otherwise(out)
    return out


def by_text(label: Column, url: Column) -> Column:
    """The zone of the first marker in a source's name and address."""
    text = F.lower(F.concat(F.coalesce(label, F.lit("")), F.lit(" "), F.coalesce(url, F.lit(""))))
    return F.coalesce(*(F.when(text.contains(m), F.lit(z)) for m, z in MARKERS.items()))


def region_in_label(country: Column, label: Column) -> Column:
    """The longest region name in a US or Canadian source's name."""
    text = F.lower(F.trim(label))
    longest = lambda table: F.coalesce(*(F.when(text.contains(r.lower()), F.lit(r)) for r in sorted(table, key=len, reverse=True)))
    c = _low(country)
    return F.when(c.isin(*US_NAMES), longest(US)).when(c == "canada", longest(CANADA))


def for_source(country: Column, region: Column, label: Column, url: Column) -> Column:
    """The zone of a discovered source: by place, else by its name and address."""
    return F.coalesce(by_place(country, region), by_text(label, url))


def for_cleanup(configured: Column, meeting_country: Column, meeting_region: Column, source_country: Column, source_region: Column, name: Column, url: Column) -> Column:
    """The zone to put in place of the fall-back: the source's own setting, then by the places of listing and source in
    seven steps, then by the source's name."""
    own, none = nonblank(configured), F.lit(None).cast("string")
    return F.coalesce(
        F.when(own != "UTC", own), by_place(meeting_country, meeting_region), by_place(source_country, meeting_region), by_place(source_country, source_region),
        by_place(none, meeting_region), by_place(none, source_region), by_text(name, url),
    )
