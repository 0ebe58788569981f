"""Rows read from static pages by selectors, as candidates: days, places, zones and kinds of meeting inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lookups as K, schedule, zones
from ..functions.lookups import lookup
from ..functions.text import nonblank
from .feeds import OCCURRENCE, given

ROW_ID = ("name", "day", "time", "address_line1", "city", "online_url")
# Short region names of Mexico, and other words for the United Kingdom.
MEXICO_SHORT = {
    "BC": "B.C.", "BCS": "B.C.S.", "CDMX": "Cdmx", "COL": "Colima", "GRO": "Guerrero", "GTO": "Gto", "JAL": "Jalisco", "MICH": "Michoacán", "NAY": "Nayarit", "OAX": "Oax", "QR": "Quintana Roo",
    "Q.R": "Quintana Roo", "QRO": "Qro", "SIN": "Sinaloa", "SON": "Sonora",
}
CANADA_SHORT = ("AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT")
AUSTRALIA_SHORT = ("Act", "Nsw", "Nt", "Qld", "Sa", "Tas", "Vic", "Wa")
UK_WORDS = ("england", "great britain", "gb", "uk", "u.k.", "united kingdom", "wielka brytania", "wielkiej brytanii")
UK_CODE = r"(?i)\b(?:GIR\s*0AA|[A-Z]{1,2}\d[A-Z\d]?\s*\d[A-Z]{2})\b"
LONDON = r"(?i)\b(?:london|londyn)\s+(?:E|EC|N|NW|SE|SW|W|WC)\d[A-Z\d]?\b"


def row_id(payload: Column) -> Column:
    """The row's own id, else 16 digits of a hash of six fields; null where all of them are blank."""
    basis = F.concat_ws("|", *(F.coalesce(nonblank(payload[n]), F.lit("")) for n in ROW_ID))
    hashed = F.when(F.translate(basis, "|", "") != "", F.substring(F.sha1(basis), 1, 16))
    return F.coalesce(nonblank(payload["source_record_id"]), hashed)


def country(c: Column) -> Column:
    """The country's name; the words for the United Kingdom become one."""
    return F.when(F.lower(c).isin(*UK_WORDS), "United Kingdom").otherwise(c)


def region(c: Column) -> Column:
    """A region that is a country's name is none."""
    return F.when(~F.lower(c).isin(*UK_WORDS), c)


def country_of_parts(parts: Column) -> Column:
    """The first part that names a country, else the United Kingdom by a postcode, else the United States by a state's name."""
    named = {"us": "United States", "usa": "United States", "united states": "United States", "united states of america": "United States", "canada": "Canada", "australia": "Australia"} | dict.fromkeys(UK_WORDS, "United Kingdom")
    one = lambda p: F.coalesce(lookup(named, F.lower(p)), F.when(F.lower(p).isin(*zones.COUNTRIES), p))
    first = F.get(F.filter(F.transform(parts, one), lambda x: x.isNotNull()), F.lit(0))
    state = F.exists(parts, lambda p: F.lower(p).isin(*(n.lower() for n in zones.US)))
    return F.coalesce(first, F.when(F.exists(parts, lambda p: p.rlike(UK_CODE)), "United Kingdom").when(state, "United States"))


def country_region(address: Column, hint: Column) -> tuple[Column, Column]:
    """(country, region) of an address: regions by their short names, those of the country that the address or else the
    hint names; a short name from Mexico always counts, and the first word that fits decides."""
    parts = F.transform(F.split(F.translate(address, "\n", ","), ","), lambda p: F.trim(p))
    own = country_of_parts(parts)
    where = F.lower(F.coalesce(own, hint, F.lit("")))
    words = F.transform(F.flatten(F.transform(parts, lambda p: F.split(p, r"\s+"))), lambda t: F.upper(F.regexp_replace(t, r"^[ .]+|[ .]+$", "")))
    us, au, ca = where.isin(*zones.US_NAMES), where == "australia", where.isin("canada", "ca")
    hit = lambda name, r: F.struct(F.lit(name).alias("country"), r.alias("region"))
    one = lambda t: F.coalesce(
        F.when(us & t.isin(*K.US_REGIONS), hit("United States", lookup(K.US_REGIONS, t))),
        F.when(au & t.isin(*(s.upper() for s in AUSTRALIA_SHORT)), hit("Australia", F.initcap(t))),
        F.when(ca & t.isin(*CANADA_SHORT), hit("Canada", t)),
        F.when(t.isin(*MEXICO_SHORT), hit("Mexico", lookup(MEXICO_SHORT, t))),
    )
    first = F.get(F.filter(F.transform(words, one), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(own, first["country"]), first["region"]


def london(venue: Column, address: Column, where: Column) -> Column:
    """London, where a British venue or address says so."""
    text = F.concat_ws(" ", venue, address)
    return F.when((F.lower(where) == "united kingdom") & (F.coalesce(F.lower(venue).isin("london", "londyn"), F.lit(False)) | text.rlike(LONDON)), "London")


def formats(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def attendance(option: Column, place: Column, online: Column) -> Column:
    """hybrid, online or in_person, by what the row says, else by whether it has a place and a way to join from afar."""
    said = F.regexp_replace(F.lower(F.coalesce(option, F.lit(""))), "_", " ")
    return (
        F.when(said.contains("hybrid"), "hybrid").when(said.contains("online"), F.when(place, "hybrid").otherwise("online"))
        .when(said.contains("in person") | said.contains("in-person"), F.when(online, "hybrid").otherwise("in_person"))
        .when(place & online, "hybrid").when(online, "online").otherwise("in_person")
    )


def normalize(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Candidates of payload rows (source_id, payload fields as columns) and their sources (id, fellowship, url, country,
    region, config). A row on several days gets an occurrence for each; one without a day or time has none.

    The zone: the row's unless UTC; the inferred one where the address names another country than the source; the source's
    setting; by country and region as given, then as inferred; else UTC."""
    s = sources.select(F.col("id").alias("source_id"), F.col("fellowship"), F.col("url").alias("source_url"), F.col("country").alias("__sc"), F.col("region").alias("__sr"), F.col("config").alias("__config"))
    text = lambda n: nonblank(F.col(n)) if n in rows.columns else F.lit(None).cast("string")
    df = rows.join(s, "source_id")
    address = F.coalesce(text("address_line1"), text("address"))
    df = df.withColumns({"__a": address, "__pc": country(text("country")), "__sc": country(nonblank(F.col("__sc")))})
    own, inferred = country_region(F.col("__a"), F.coalesce("__pc", "__sc"))
    df = df.withColumns({"__ic": own, "__ir": inferred})
    where = F.coalesce("__ic", "__pc", "__sc")
    area = region(F.coalesce(text("region"), nonblank(F.col("__sr"))))
    df = df.withColumns({"__c": where, "__r": area})
    other = F.col("__ic").isNotNull() & F.col("__sc").isNotNull() & (F.lower("__ic") != F.lower("__sc"))
    by = zones.by_place
    zone = F.coalesce(
        F.when(text("timezone") != "UTC", text("timezone")), F.when(other, F.coalesce(by(F.col("__c"), F.col("__r")), by(F.col("__c"), F.col("__ir")))), given(F.get_json_object("__config", "$.timezone")),
        by(F.col("__c"), F.col("__r")), by(F.col("__ic"), F.col("__r")), by(F.col("__ic"), F.col("__ir")), F.lit("UTC"),
    )
    start, end = schedule.parse_time(text("time")), schedule.parse_time(text("end_time"))
    days = F.when(start.isNotNull(), schedule.normalize_days(text("day")))
    df = df.withColumns({"__zone": zone, "__start": start.cast("int"), "__end": end.cast("int"), "__days": F.coalesce(days, F.array().cast("array<int>"))})
    occ = F.transform("__days", lambda d: F.struct(d.cast("int").alias("day_of_week"), F.col("__start").alias("start_minute"), F.col("__end").alias("end_minute"), F.col("__zone").alias("timezone")))
    place = F.coalesce(text("address_line1"), text("city"), text("venue_name")).isNotNull()
    online = F.coalesce(text("online_url"), text("phone_join_info")).isNotNull()
    city = F.coalesce(text("city"), given(F.get_json_object("__config", "$.city")), london(text("venue_name"), F.col("__a"), F.col("__c")))
    number = lambda n: F.try_to_number(text(n), F.lit("S999.99999999")).cast("double") if n in rows.columns else F.lit(None).cast("double")
    fields = F.struct(*(text(n).alias(n) for n in ("source_record_id", *ROW_ID)))
    return df.select(
        "source_id", row_id(fields).alias("source_record_id"), "source_url", "fellowship", F.coalesce(text("name"), F.lit("Recovery Meeting")).alias("name"), attendance(text("attendance_option"), place, online).alias("meeting_type"),
        text("venue_name").alias("venue_name"), F.col("__a").alias("address_line1"), city.alias("city"), F.coalesce("__r", region(nonblank(F.col("__sr"))), "__ir").alias("region"), text("postal_code").alias("postal_code"),
        F.col("__c").alias("country"), number("latitude").alias("latitude"), number("longitude").alias("longitude"), text("online_url").alias("online_url"), text("phone_join_info").alias("phone_join_info"),
        formats(text("formats")).alias("formats"), occ.cast(f"array<{OCCURRENCE}>").alias("occurrences"),
    )
