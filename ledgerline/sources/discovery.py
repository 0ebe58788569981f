"""Discovery of sources in captured listings: locator JSON, listing pages, link graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls, zones
from ..operators.ranking import first_wins
from ..session import cut_lineage
from .feeds import given

ORPHAN = "https://www.na.org/?ID=phoneline"
_LOCATOR = "struct<description:string,phone:string,phone2:string,whatsapp:string,website:string,country:string,state:string,city:string,postal_code:string,type:string,phonewebid:string,groupcode:string>"


def location_index(payloads: DataFrame) -> DataFrame:
    """(country, state) of a locator's three lists, in the order US, Canada, others."""
    kind = "struct<ll_us:array<struct<state:string>>,ll_ca:array<struct<state:string>>,ll_intl:array<struct<country:string>>>"
    df = payloads.select(F.from_json("payload", kind).alias("o"))
    one = lambda rank, col, country, state: df.select(F.lit(rank).alias("rank"), F.posexplode(col).alias("pos", "x")).select("rank", "pos", country.alias("country"), state.alias("state"))
    us = one(0, "o.ll_us", F.lit("United States"), F.col("x.state")).filter("state <> ''")
    ca = one(1, "o.ll_ca", F.lit("Canada"), F.col("x.state")).filter("state <> ''")
    intl = one(2, "o.ll_intl", F.col("x.country"), F.lit("")).filter("country <> ''")
    return us.unionByName(ca).unionByName(intl)


def locator_rows(payloads: DataFrame, orphan: str = ORPHAN) -> DataFrame:
    """Sources of a locator's data: a website, else its phone line, else a telephone; rows with none go. One row for each
    normalized URL, the first, by the payloads' order `at` where they have one."""
    at = F.col("at").cast("long") if "at" in payloads.columns else F.lit(0).cast("long")
    rows = payloads.select(at.alias("at"), F.posexplode(F.from_json(F.get_json_object("payload", "$.data"), f"array<{_LOCATOR}>")).alias("i", "x")).select((F.col("at") * (1 << 20) + F.col("i")).alias("pos"), "x.*")
    blank = lambda c: given(F.trim(F.col(c)))
    site = F.when(blank("website").rlike("^https?://"), blank("website")).otherwise(F.concat(F.lit("http://"), blank("website")))
    phone = F.coalesce(blank("phone"), blank("phone2"))
    url = F.coalesce(site, F.concat(F.lit(f"{orphan}&id="), blank("phonewebid")), F.concat(F.lit("tel:"), urls.phone_uri(phone)))
    name = F.trim(F.coalesce(given(F.col("description")), site, F.lit("NA local service body")))
    meta = F.to_json(F.struct(*(blank(c).alias(a) for c, a in (("city", "city"), ("groupcode", "na_group_code"), ("type", "na_type"), ("phone", "phone"), ("phone2", "phone2"), ("postal_code", "postal_code"), ("whatsapp", "whatsapp")))))
    out = rows.select(
        "pos", F.lit("na").alias("fellowship"), url.alias("url"), F.when(site.isNotNull(), name).otherwise(F.concat(name, F.lit(" phoneline"))).alias("label"), blank("country").alias("country"), blank("state").alias("region"),
        F.when(site.isNotNull(), "local_service_body").otherwise("phone").alias("source_type"), F.when(site.isNotNull(), "unknown").otherwise("manual_review").alias("adapter_type"), meta.alias("metadata"),
    ).filter("url is not null")
    return unique_candidates(out)


def unique_candidates(candidates: DataFrame) -> DataFrame:
    return first_wins(candidates.withColumn("normalized_url", urls.normalize_url(F.col("url"))), ["fellowship", "normalized_url"], ["pos"])


def source_links(links: DataFrame, base: Column) -> DataFrame:
    """Anchors of a page as sources: with an address and a text, no mail, phone or fragment, absolute, the first of each."""
    ok = (F.trim("href") != "") & (F.trim("text") != "") & ~F.col("href").rlike(r"(?i)^\s*(?:mailto:|tel:|#)")
    return first_wins(links.filter(ok).withColumn("url", urls.defragment(urls.join(base, F.trim("href")))), ["page_id", "url"], ["pos"])


# Hosts that are no local source.
NOISE_HOSTS = ("facebook.com", "instagram.com", "twitter.com", "youtube.com", "google.com", "apple.com", "paypal.com", "zoom.us")


def classify_link(url: Column, world_host: str) -> Column:
    """listing (a page of the world site's meetings), external (a local source), or noise."""
    site, path = urls.site(url), F.lower(urls.part(url, 3))
    return F.when(urls.host(url).endswith(world_host), F.when(path.rlike("^/meetings?(/|$)"), "listing").otherwise("noise")).when(site.isin(*NOISE_HOSTS) | path.endswith(".pdf"), "noise").otherwise("external")


def crawl(links: DataFrame, roots: DataFrame, max_depth: int | None = 2) -> DataFrame:
    """Pages reached from the roots over captured links (src, dst): (root, page, depth), each page at its least depth.

    A frontier loop, of max_depth joins or, with None, until nothing new is reached; each step drops what was reached before (an anti-join).
    Every second frontier is checkpointed (with None every one, to see if it is empty), so that plans don't double with depth."""
    seen = roots.select(F.col("page").alias("root"), "page", F.lit(0).alias("depth"))
    frontier, depth = seen, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = frontier.join(links, frontier["page"] == links["src"]).select("root", F.col("dst").alias("page")).distinct()
        frontier = step.join(seen.select("root", "page"), ["root", "page"], "left_anti").withColumn("depth", F.lit(depth))
        if max_depth is None or depth % 2 == 0 and depth < max_depth:
            frontier = cut_lineage(frontier)
            if frontier.isEmpty():
                break
        seen = seen.unionByName(frontier)
    return seen


def stop_after(page: DataFrame) -> Column:
    """Is a page's yield enough to end its source's crawl?"""
    enough = (F.col("records") >= 3) & (F.col("page_score") >= 0.5)
    if "expected_records" in page.columns:
        enough = enough | (F.col("expected_records").isNotNull() & (F.col("records") >= 0.75 * F.col("expected_records")) & (F.col("records") > 0))
    return F.coalesce(enough, F.lit(False))


def site_kind(payload: Column, content_type: Column) -> Column:
    """What a captured probe is: feed A or B, a calendar, a PDF, a page, or unknown."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(payload.rlike(r'^\s*\[\s*\{') & payload.rlike(r'"(?:slug|conference_url|end_time)"'), "meeting_guide")
        .when(payload.rlike(r'^\s*\[\s*\{') & payload.rlike(r'"(?:id_bigint|weekday_tinyint)"'), "bmlt").when(payload.startswith("BEGIN:VCALENDAR"), "ics")
        .when(kind.contains("pdf") | payload.startswith("%PDF"), "pdf").when(payload.rlike(r"(?is)<html\b|<!doctype html"), "html").otherwise("unknown")
    )


def sources_of(candidates: DataFrame) -> DataFrame:
    """Discovered sources as source rows: id and normalized URL, the region named in the label where none is given, and a zone
    in the config by place or by words."""
    region = F.coalesce("region", zones.region_in_label(F.col("country"), F.col("label")))
    out = candidates.withColumn("region", region)
    zone = zones.for_source(F.col("country"), F.col("region"), F.col("label"), F.col("url"))
    meta = F.col("metadata") if "metadata" in candidates.columns else F.lit(None).cast("string")
    config = F.concat(F.lit("{"), F.concat_ws(",", F.concat(F.lit('"metadata":'), meta), F.concat(F.lit('"timezone":"'), zone, F.lit('"'))), F.lit("}"))
    return out.withColumns({"id": urls.source_id(F.col("fellowship"), F.col("url")), "normalized_url": urls.normalize_url(F.col("url")), "config": config})
