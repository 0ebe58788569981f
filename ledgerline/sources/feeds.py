"""JSON feeds: raw records with stable ids and hashes, and their normal form.

A feed is a table of (source_id, payload): one JSON object a row, as spark.read.text or a captured column gives it.
Objects are read with a fixed schema of strings; what isn't there is null."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import schedule
from ..functions.text import nonblank
from ..operators.location import timezone_for

OCCURRENCE = "struct<day_of_week:int,start_minute:int,end_minute:int,timezone:string>"
FEED_A = ("slug", "id", "name", "group", "day", "time", "end_time", "timezone", "location", "address", "city", "state", "postal_code", "country", "conference_url", "conference_phone")
FEED_B = (
    "id_bigint", "id", "meeting_name", "name", "weekday_tinyint", "start_time", "time_zone", "timezone", "location_text", "formatted_address", "street", "location_municipality", "location_province", "location_postal_code_1",
    "location_nation", "latitude", "longitude", "virtual_meeting_link", "url", "phone_meeting_number", "virtual_meeting_additional_info", "formats",
)


def read_objects(spark: SparkSession, path: str, source_id: str) -> DataFrame:
    """The objects of JSON-array files, one a row. Files are read whole: a feed file is one captured response."""
    text = spark.read.text(path, wholetext=True).select("value")
    items = F.from_json("value", "array<string>")
    return text.select(F.lit(source_id).alias("source_id"), F.posexplode(items).alias("pos", "payload"))


def given(c: Column) -> Column:
    """Null for empty text."""
    return F.when(c != "", c)


def canonical_hash(payload: str = "payload", ascii_only: bool = True):
    """SHA-256 of the object with sorted keys and no blanks; other letters escaped unless ascii_only is off."""
    import hashlib
    import json

    @F.pandas_udf("string")
    def digest(col: pd.Series) -> pd.Series:
        def one(s):
            if s is None:
                return None
            return hashlib.sha256(json.dumps(json.loads(s), sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only).encode()).hexdigest()

        return col.map(one)

    digest.func.__annotations__ = {}
    return digest(F.col(payload))


def raw_records(objects: DataFrame, keys: tuple[str, ...], url: Column) -> DataFrame:
    """Bronze rows: the first of the keys that is given is the record id; rows without one have an error."""
    found = F.coalesce(*(given(F.get_json_object("payload", f"$.{k}")) for k in keys))
    out = objects.select("source_id", found.alias("source_record_id"), url.alias("source_url"), "payload")
    return out.withColumn("error", F.when(F.col("source_record_id").isNull(), F.lit(f"record is missing {' or '.join(keys)}"))).withColumn("content_hash", canonical_hash())


def _fields(raw: DataFrame, names: tuple[str, ...], *arrays: str) -> DataFrame:
    schema = ", ".join([f"`{n}` string" for n in names] + [f"`{a}` array<string>" for a in arrays])
    return raw.withColumn("__o", F.from_json("payload", schema))


def _type(online: Column, place: Column, neither: str) -> Column:
    return F.when(online & place, "hybrid").when(online, "online").when(place, "in_person").otherwise(neither)


def _occurrences(day: Column, start: Column, end: Column, zone: Column) -> Column:
    one = F.struct(day.alias("day_of_week"), start.alias("start_minute"), end.cast("int").alias("end_minute"), zone.alias("timezone"))
    return F.when(day.isNotNull() & start.isNotNull(), F.array(one)).otherwise(F.array().cast(f"array<{OCCURRENCE}>"))


def _has(*cols: Column) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | (F.coalesce(c, F.lit("")) != "")
    return out


def normalize_a(raw: DataFrame, country: Column | None = None) -> DataFrame:
    """Feed A (slug, day, time, conference_url, types) as candidates; a missing time zone becomes UTC."""
    o = lambda n: F.col(f"__o.{n}")
    df = _fields(raw, FEED_A, "types")
    online, place = _has(o("conference_url"), o("conference_phone")), _has(o("address"), o("city"), o("location"))
    occ = _occurrences(schedule.normalize_day(o("day")), schedule.parse_time(o("time")), schedule.parse_time(o("end_time")), F.coalesce(given(o("timezone")), F.lit("UTC")))
    return df.select(
        "source_id", "source_record_id", "source_url", F.coalesce(given(o("name")), given(o("group")), F.lit("A.A. Meeting")).alias("name"), _type(online, place, "unknown").alias("meeting_type"),
        o("location").alias("venue_name"), o("address").alias("address_line1"), o("city").alias("city"), o("state").alias("region"), o("postal_code").alias("postal_code"),
        F.coalesce(given(o("country")), country if country is not None else F.lit(None)).alias("country"), given(o("conference_url")).alias("online_url"), given(o("conference_phone")).alias("phone_join_info"),
        F.coalesce(o("types"), F.array().cast("array<string>")).alias("formats"), occ.alias("occurrences"),
    )


def _zone(c: Column) -> Column:
    s = nonblank(c)
    return F.when(F.upper(s) != "UTC", s)


def australia_zone(postcode: Column, lat: Column, lon: Column) -> Column:
    """By the postcode's first digit, else by longitude and latitude inside the country's box."""
    code = F.regexp_extract(F.coalesce(postcode, F.lit("")), r"\b(\d{4})\b", 1)
    zones = {"1": "Sydney", "2": "Sydney", "3": "Melbourne", "8": "Melbourne", "4": "Brisbane", "5": "Adelaide", "6": "Perth", "7": "Hobart"}
    by_code = F.lit(None).cast("string")
    for digit, city in zones.items():
        by_code = F.when(code.startswith(digit), f"Australia/{city}").otherwise(by_code)
    by_code = F.when(code.rlike("^0[89]"), "Australia/Darwin").otherwise(by_code)
    box = lon.between(112, 154) & lat.between(-44, -10)
    by_place = (
        F.when(lon < 129, "Australia/Perth").when(lon < 138, F.when(lat > -26, "Australia/Darwin").otherwise("Australia/Adelaide")).when(lon < 141, "Australia/Adelaide").when(lat > -29, "Australia/Brisbane").otherwise("Australia/Sydney")
    )
    return F.coalesce(by_code, F.when(box, by_place))


def normalize_b(raw: DataFrame, country: Column | None = None, region: Column | None = None, zone: Column | None = None) -> DataFrame:
    """Feed B (id_bigint, weekday_tinyint, all values text) as candidates.

    The zone is the record's unless UTC, the source's, the place's, or UTC. A link that is no URL counts as phone info."""
    o = lambda n: F.col(f"__o.{n}")
    null = F.lit(None).cast("string")
    src_country, src_region, src_zone = (x if x is not None else null for x in (country, region, zone))
    df = _fields(raw, FEED_B)
    lat, lon = (F.expr(f"try_cast(nullif(trim(__o.{n}), '') AS double)") for n in ("latitude", "longitude"))
    nation, area = F.coalesce(given(o("location_nation")), src_country), F.coalesce(given(o("location_province")), src_region)
    by_place = F.coalesce(timezone_for(nation, area), F.when(F.lower(nation).isin("australia", "au") | (src_country == "Australia"), australia_zone(o("location_postal_code_1"), lat, lon)))
    tz = F.coalesce(_zone(o("time_zone")), _zone(o("timezone")), src_zone, by_place, F.lit("UTC"))
    link = nonblank(F.coalesce(given(o("virtual_meeting_link")), o("url")))
    url = F.when(link.rlike(r"(?i)^https?://[^\s/]+"), link)
    phone = nonblank(F.coalesce(given(o("phone_meeting_number")), o("virtual_meeting_additional_info")))
    phone = F.coalesce(phone, F.when(url.isNull(), link))
    online, place = url.isNotNull() | phone.isNotNull(), _has(o("formatted_address"), o("location_text"))
    formats = F.filter(F.transform(F.split(F.coalesce(o("formats"), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    occ = _occurrences(schedule.normalize_day(o("weekday_tinyint")), schedule.parse_time(o("start_time")), F.lit(None), tz)
    return df.select(
        "source_id", "source_record_id", "source_url", F.coalesce(given(o("meeting_name")), given(o("name")), F.lit("NA/CA Meeting")).alias("name"), _type(online, place, "in_person").alias("meeting_type"),
        o("location_text").alias("venue_name"), F.coalesce(given(o("formatted_address")), o("street")).alias("address_line1"), o("location_municipality").alias("city"), o("location_province").alias("region"),
        o("location_postal_code_1").alias("postal_code"), nation.alias("country"), lat.alias("latitude"), lon.alias("longitude"), url.alias("online_url"), phone.alias("phone_join_info"), formats.alias("formats"), occ.alias("occurrences"),
    )


def scraped_id(payload: Column) -> Column:
    """The id in a payload, else 16 digits of a hash over its main fields, else over all of it."""
    get = lambda n: F.coalesce(F.trim(F.get_json_object(payload, f"$.{n}")), F.lit(""))
    explicit = F.coalesce(given(get("source_record_id")), given(get("id")))
    basis = F.concat_ws("|", *(get(n) for n in ("name", "day", "time", "address_line1", "city", "online_url", "row_index")))
    return F.coalesce(explicit, F.substring(F.sha1(F.when(F.translate(basis, "|", "") == "", payload).otherwise(basis)), 1, 16))


def workflow_rows(objects: DataFrame) -> DataFrame:
    """Published rows of a workflow feed; Sunday (0) is a day like any other."""
    schema = "id string, published boolean, day int, startTime string, name string, location_text string, location_street string, location_municipality string, location_postal_code_1 string, latitude double, longitude double, virtual_meeting_link string, formatIds array<string>"
    o = F.from_json("payload", schema)
    names = F.array(*map(F.lit, ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")))
    return objects.withColumn("o", o).filter("o.published").select("source_id", F.col("o.id").alias("source_record_id"), F.col("o.name").alias("name"), F.get(names, F.col("o.day")).alias("day"), F.col("o.startTime").alias("time"), F.col("o.location_text").alias("venue_name"), F.col("o.location_street").alias("address_line1"), F.col("o.location_municipality").alias("city"), F.col("o.location_postal_code_1").alias("postal_code"), "o.latitude", "o.longitude", F.col("o.virtual_meeting_link").alias("online_url"), F.col("o.formatIds").alias("formats"))


