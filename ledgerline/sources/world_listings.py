"""Discovery of sources in the listings of three world services, from captured pages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls, zones
from ..functions.text import nonblank
from ..operators.ranking import first_wins
from ..operators.relational import longest_name
from ..operators.source_rules import WORLD_HOSTS, valid_ca_url
from ..session import cut_lineage
from .discovery import crawl, location_index, locator_rows
from .extract import each_page
from .html import parse

# The listings' addresses, hosts that are no source, the queries to ask where a page names none.
AA_WORLD, CA_WORLD = "https://www.aa.org/find-aa", "https://ca.org/meetings/"
AA_NOISE = ("contribution.aa.org", "onlineliterature.aa.org", "recruiting.paylocity.com", "www.aagrapevine.org")
AA_QUERIES = (("state", "CA"), ("state", "ON"), ("cc", "IE"))
CANADA_NAMES = ("Alberta", "British Columbia", "Manitoba", "New Brunswick", "Newfoundland And Labrador", "Nova Scotia", "Ontario", "Prince Edward Island", "Quebec", "Québec", "Saskatchewan")


def filter_queries(pages: DataFrame) -> DataFrame:
    """(page_id, pos, key, value) of the state and country options of a page, each once, without "All"."""

    def one(page_id: int, html: str | None) -> Iterator[tuple]:
        root = parse(html)
        options = [(k, (o.attrs.get("value") or "").strip()) for k in ("state", "cc") for s in root.select(f"select[name='{k}']") for o in s.select("option")]
        return ((page_id, i, *kv) for i, kv in enumerate(dict.fromkeys(kv for kv in options if kv[1] not in ("", "All"))))

    return each_page(pages.select("page_id", "html"), one, "page_id long, pos int, key string, value string")


def area_items(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, label, address, country, region, text, hrefs) of a listing's items that have a heading."""

    def one(page_id: int, url: str, html: str | None) -> Iterator[tuple]:
        for pos, n in enumerate(parse(html).select(".view-locations-listing .area-loc-item")):
            of = lambda css: f.text() if (f := n.first(css)) else ""  # noqa: B023, E731
            yield page_id, url, pos, of("h3"), of("address"), of(".country"), of(".administrative-area"), n.text(), [a.attrs["href"] for a in n.select("a") if a.attrs.get("href")]

    return each_page(pages.select("page_id", "url", "html"), one, "page_id long, url string, pos int, label string, address string, country string, region string, text string, hrefs array<string>")


def aa_candidates(pages: DataFrame) -> DataFrame:
    """Sources of a listing's items: the first link to another site, else the phone; items with neither go."""
    items = area_items(pages).filter("label <> ''").withColumnRenamed("url", "page_url")
    full = F.transform("hrefs", lambda h: urls.join(F.col("page_url"), F.trim(h)))
    ok = lambda u: F.lower(urls.part(u, 1)).isin("http", "https") & ~F.lower(urls.part(u, 2)).isin("", *WORLD_HOSTS["aa"], *AA_NOISE)
    link = F.get(F.filter(full, ok), F.lit(0))
    phone = nonblank(F.regexp_extract("text", r"(?:Phone|Helpline|Answering Service):\s*([^A-Za-z]+)", 1))
    known = longest_name(F.col("address"), [*zones.US, *CANADA_NAMES])
    region = F.coalesce(nonblank(F.col("region")), known)
    country = F.coalesce(nonblank(F.col("country")), F.when(F.col("address").contains("Canada"), "Canada").when(F.col("address").contains("United States") | F.lower(region).isin(*(n.lower() for n in zones.US)), "United States"))
    out = items.select(
        "pos", F.lit("aa").alias("fellowship"), F.coalesce(link, F.concat(F.lit("tel:"), urls.phone_uri(phone))).alias("url"), F.when(link.isNull(), F.concat("label", F.lit(" phoneline"))).otherwise(F.col("label")).alias("label"),
        country.alias("country"), region.alias("region"), F.when(link.isNull(), "phone").otherwise("local_service_body").alias("source_type"), F.when(link.isNull(), "manual_review").otherwise("unknown").alias("adapter_type"),
        F.to_json(F.struct(F.lit(AA_WORLD).alias("world_source"), F.col("page_url").alias("source_listing"), nonblank(F.col("address")).alias("address_text"), phone.alias("phone"))).alias("metadata"), "page_id",
    )
    out = out.filter("url is not null")
    return first_wins(out.withColumn("normalized_url", urls.normalize_url(F.col("url"))), ["fellowship", "normalized_url"], ["page_id", "pos"])


def _folders(url: Column) -> Column:
    return F.filter(F.split(urls.part(url, 3), "/"), lambda p: p != "")


def _title(c: Column) -> Column:
    return F.initcap(F.translate(c, "-", " "))


def path_country(url: Column) -> Column:
    """/meetings/<country>/..."""
    p = _folders(url)
    return F.when((F.size(p) >= 2) & (F.get(p, F.lit(0)) == "meetings"), _title(F.get(p, F.lit(1))))


def path_region(url: Column) -> Column:
    """The last folder of /meetings/<country>/.../<region>."""
    p = _folders(url)
    return F.when((F.size(p) >= 3) & (F.get(p, F.lit(0)) == "meetings"), _title(F.element_at(p, -1)))


def is_ca_listing(url: Column) -> Column:
    path = F.concat(F.regexp_replace(urls.part(url, 3), "/+$", ""), F.lit("/"))
    return F.lower(urls.part(url, 2)).isin(*WORLD_HOSTS["ca"]) & path.startswith("/meetings/") & (path != "/meetings/")


def ca_candidates(links: DataFrame, base: Column, each_page: bool = False) -> DataFrame:
    """Links (page_id, pos, href, text) of listing pages as sources: further listings of the world site, and other sites; the
    first of each over all pages, or of each page."""
    ok = (F.trim("href") != "") & (F.trim("text") != "") & ~F.col("href").rlike("^(?:mailto:|tel:|#)")
    rows = links.filter(ok).select("page_id", "pos", F.col("text").alias("label"), base.alias("base"), urls.join(base, F.trim("href")).alias("url")).filter(F.lower(urls.part(F.col("url"), 1)).isin("http", "https"))
    u, listing = F.col("url"), is_ca_listing(F.col("url"))
    pdf = F.lower(urls.part(u, 3)).endswith(".pdf")
    out = rows.filter(listing | valid_ca_url(u)).select(
        "page_id", "pos", F.lit("ca").alias("fellowship"), "url", "label", F.when(listing, path_country(u)).otherwise(path_country(F.col("base"))).alias("country"), F.when(listing, path_region(u)).otherwise(path_region(F.col("base"))).alias("region"),
        F.when(listing, "world_service_listing").when(pdf, "pdf").otherwise("local_service_body").alias("source_type"), F.when(~listing & pdf, "pdf").otherwise("unknown").alias("adapter_type"),
        F.to_json(F.struct(F.when(listing, CA_WORLD).otherwise(F.col("base")).alias("world_source"))).alias("metadata"),
    )
    out = out.withColumn("normalized_url", urls.normalize_url(u)).filter(F.col("normalized_url") != urls.normalize_url(F.lit(CA_WORLD)))
    return first_wins(out, ["fellowship", "normalized_url", *(["page_id"] if each_page else [])], ["page_id", "pos"])


def ca_crawl(pages: DataFrame, links: DataFrame, start: str = CA_WORLD) -> DataFrame:
    """All sources reached from the start page over listings, level by level until no new page is reached; each captured page (url, final_url) is read once.
    A listing that answered from another site is a source itself and isn't read.

    Every page is parsed once; only the ids of pages go through the levels."""
    known = pages.select("page_id", urls.normalize_url(F.col("url")).alias("at"), F.col("final_url"))
    here = is_ca_listing(F.col("final_url")) | (F.col("final_url") == start)
    found = cut_lineage(ca_candidates(links.join(known.filter(here).select("page_id", "final_url"), "page_id"), F.col("final_url"), each_page=True))
    nothing = F.lit(None).cast("string")
    moved = known.filter(~here).select(
        "page_id", F.lit(-1).alias("pos"), F.lit("ca").alias("fellowship"), F.col("final_url").alias("url"), F.col("final_url").alias("label"), nothing.alias("country"), nothing.alias("region"), F.lit("local_service_body").alias("source_type"),
        F.lit("unknown").alias("adapter_type"), F.to_json(F.struct(F.col("at").alias("world_source"))).alias("metadata"), urls.normalize_url(F.col("final_url")).alias("normalized_url"),
    )
    listings = found.filter("source_type = 'world_service_listing'").select(F.col("page_id").alias("src"), F.col("normalized_url").alias("at"))
    steps = cut_lineage(listings.join(known.select("at", F.col("page_id").alias("dst")), "at").select("src", "dst").distinct())
    root = known.filter(F.col("at") == urls.normalize_url(F.lit(start))).select(F.col("page_id").alias("page"))
    read = crawl(steps, root, None).groupBy(F.col("page").alias("page_id")).agg(F.min("depth").alias("depth"))
    return first_wins(found.unionByName(moved).join(read, "page_id"), ["fellowship", "normalized_url"], ["depth", "page_id", "pos"])


def na_candidates(index: DataFrame, answers: DataFrame) -> DataFrame:
    """Sources of a locator: those of its index, then those of the answers (country, state, payload) for the places it lists;
    answers for other places don't count."""
    places = location_index(index).select("country", "state", (F.col("rank") * (1 << 16) + F.col("pos") + 1).alias("at"))
    later = answers.join(places, ["country", "state"]).select("at", "payload")
    return locator_rows(index.select(F.lit(0).cast("long").alias("at"), "payload").unionByName(later.withColumn("at", F.col("at").cast("long"))))
