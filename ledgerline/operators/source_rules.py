"""Which sources are read, how, and what their settings become after a run. Sources are rows of (id, fellowship, url,
source_type, adapter_type, requires_browser, country, region, config JSON)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls
from ..functions.text import nonblank

# Kinds of adapters and sources.
FEEDS = ("bmlt", "meeting_guide")
PAGES = ("playwright_browser", "static_html", "form_http")
INGESTABLE = ("meeting_guide", "bmlt", "static_html", "form_http", "playwright_browser")
SETTINGS = ("commit", "domcontentloaded", "load", "networkidle")
# Hosts that are no local source, and those of the world listings.
WORLD_HOSTS = {"ca": ("ca.org", "www.ca.org"), "aa": ("aa.org", "www.aa.org")}
CA_ONLINE = ("ca-online.org", "www.ca-online.org")
CA_NOISE = (
    "apps.apple.com", "calendar.google.com", "docs.google.com", "drive.google.com", "goo.gl", "maps.app.goo.gl", "meet.google.com", "play.google.com", "museum.ca.org", "superbthemes.com", "tinyurl.com", "wordpress.org",
    "zoom.us",
)
CA_NOISE_PATHS = ("newsgram", "gdpr-cookie-compliance")


def setting(path: str, config: Column | str = "config") -> Column:
    """A text in a config, stripped; null if blank or absent."""
    return nonblank(F.get_json_object(config, f"$.{path}"))


def has_reason() -> Column:
    """Was the source classified, with a reason?"""
    return setting("classification.reason").isNotNull()


def is_ingestable() -> Column:
    return F.col("adapter_type").isin(*INGESTABLE)


def is_scrapeable(include_classified: bool = False) -> Column:
    """World listings of one fellowship only; no phones and PDFs; no source that was classified as unknown, unless asked for."""
    unknown = F.lit(False) if include_classified else (F.col("adapter_type") == "unknown") & has_reason()
    return F.when(F.col("source_type") == "world_service_listing", F.col("fellowship") == "ca").otherwise(~unknown & ~F.col("source_type").isin("phone", "pdf") & ~F.col("url").startswith("tel:"))


def last_failed() -> Column:
    return F.coalesce(F.get_json_object("config", "$.scrape.last_status") == "failed", F.lit(False))


def last_empty() -> Column:
    """A page source whose last run succeeded and gave nothing."""
    number = F.get_json_object("config", "$.scrape.last_records_extracted")
    return F.coalesce(~F.col("adapter_type").isin(*FEEDS) & (F.get_json_object("config", "$.scrape.last_status") == "succeeded") & number.rlike(r"^\s*[+-]?0+\s*$"), F.lit(False))


def for_retry(sources: DataFrame, only_failed: bool = False, only_empty: bool = False) -> DataFrame:
    """Sources whose last run failed or gave nothing, as asked; all of them if neither is."""
    wanted = [c for ask, c in ((only_failed, last_failed()), (only_empty, last_empty())) if ask]
    return sources.filter(reduce(lambda x, y: x | y, wanted)) if wanted else sources


def by_ids(sources: DataFrame, ids: list[str] | None) -> DataFrame:
    """The named sources, in the order they have; all of them without names."""
    return sources.filter(F.col("id").isin(ids)) if ids else sources


def valid_ca_url(url: Column) -> Column:
    """May an address be a local source of this fellowship?"""
    host, path = F.lower(urls.part(url, 2)), F.lower(urls.part(url, 3))
    noise = host.isin(*WORLD_HOSTS["ca"], *CA_NOISE) | F.regexp_replace(host, r"^www\.", "").isin(*CA_NOISE) | host.endswith(".zoom.us")
    return ~noise & F.when(host.isin(*CA_ONLINE), path.isin("", "/")).otherwise(~path.contains(CA_NOISE_PATHS[0]) & ~path.contains(CA_NOISE_PATHS[1]))


def route() -> Column:
    """feed: read directly; browser: scraped."""
    return F.when(F.col("adapter_type").isin(*FEEDS), "feed").otherwise("browser")


def retry_command(sources: DataFrame, fellowship: str, concurrency: int, pages: int) -> DataFrame:
    """One row: the command that reads the given sources again."""
    ids = F.array_join(F.sort_array(F.collect_list(F.struct("pos", F.concat(F.lit("--source-id "), "id").alias("arg")))).getField("arg"), " ")
    return sources.agg(F.concat(F.lit(f"scrape-all --fellowship {fellowship} --no-dry-run --concurrency {concurrency} --max-pages-per-source {pages} "), ids).alias("command"))


def as_browser(sources: DataFrame) -> DataFrame:
    """Sources to be scraped as pages: other adapters are remembered in their config."""
    scrape = merged(members(F.get_json_object("config", "$.scrape")), F.create_map(F.lit("previous_adapter_type"), _text(F.col("adapter_type"))))
    config = F.when(F.col("adapter_type").isin(*PAGES), F.col("config")).otherwise(with_member(F.col("config"), "scrape", dumped(scrape)))
    kind = F.when(F.col("source_type") == "world_service_listing", F.col("source_type")).otherwise("local_service_body")
    return sources.withColumns({"config": config, "source_type": kind, "adapter_type": F.lit("playwright_browser"), "requires_browser": F.lit(True)})


def members(json: Column) -> Column:
    """The members of a JSON object as a map of variants; empty if it is none."""
    none = F.from_json(F.lit("{}"), "map<string,variant>")
    return F.coalesce(F.when(json.startswith("{"), F.from_json(json, "map<string,variant>")), none)


def _text(c: Column) -> Column:
    """A text as a variant."""
    return F.get(F.map_values(F.from_json(F.to_json(F.struct(c.alias("v"))), "map<string,variant>")), F.lit(0))


def _number(c: Column) -> Column:
    return F.try_parse_json(c.cast("string"))


def merged(old: Column, new: Column) -> Column:
    """Two maps in one; the new one's members win."""
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def dumped(m: Column) -> Column:
    """JSON of a map of variants with sorted keys."""
    by_key = lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0)
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m), by_key)))


def with_member(config: Column, key: str, value: Column) -> Column:
    """A config in which `key` holds the given JSON; the other members stay as they are."""
    return dumped(merged(members(config), F.create_map(F.lit(key), F.try_parse_json(value))))


def with_scrape_status(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """Sources after a run (source_id, status, pages_visited, records_extracted, artifact_dir, error, page_url, page_records).

    The run's counts are noted; folder and error only where given (an error in 500 characters), the best page where there
    is one; a run that succeeded with nothing forgets the pages. A scraped source that was a feed before is one again."""
    s = sources.join(runs.withColumnRenamed("source_id", "id"), "id")
    forget = (F.col("status") == "succeeded") & (F.col("records_extracted") == 0) & F.col("page_url").isNull()
    pages = ("successful_pages", "last_successful_page_url", "last_successful_page_records", "last_successful_page_signals")
    old = F.map_filter(members(F.get_json_object("config", "$.scrape")), lambda k, v: ~k.isin("last_artifact_dir", "last_error") & ~(forget & k.isin(*pages)))
    new = {
        "last_status": _text(F.col("status")), "last_pages_visited": _number(F.col("pages_visited")), "last_records_extracted": _number(F.col("records_extracted")), "last_artifact_dir": _text(nonblank(F.col("artifact_dir"))),
        "last_error": _text(F.substring(nonblank(F.col("error")), 1, 500)), "last_successful_page_url": _text(F.col("page_url")), "last_successful_page_records": _number(F.col("page_records")),
    }
    new = F.map_filter(F.create_map(*(x for k, v in new.items() for x in (F.lit(k), v))), lambda k, v: v.isNotNull())
    scrape = merged(old, new)
    before = F.get_json_object("config", "$.scrape.previous_adapter_type")
    back = (F.col("adapter_type") == "playwright_browser") & F.coalesce(before.isin(*FEEDS), F.lit(False))
    out = s.withColumns({
        "config": with_member(F.col("config"), "scrape", dumped(scrape)), "adapter_type": F.when(back, before).otherwise(F.col("adapter_type")),
        "source_type": F.when(back, "meeting_feed").otherwise(F.col("source_type")), "requires_browser": F.when(back, False).otherwise(F.col("requires_browser")),
    })
    return out.select(*sources.columns)


def search_seed() -> Column:
    """What to search a source's page for: its city, region, the last two words of its address without digits, or its country."""
    words = F.filter(F.transform(F.split(F.coalesce(setting("metadata.address_text"), F.lit("")), r"\s+"), lambda w: F.regexp_replace(w, "^,+|,+$", "")), lambda w: (w != "") & ~w.rlike(r"\d"))
    last = F.element_at(F.split(F.lower(F.trim(F.coalesce("country", F.lit("")))), r"\s+"), -1)
    kept = F.reverse(F.get(F.filter(F.transform(F.sequence(F.lit(0), F.size(words)), lambda n: F.slice(F.reverse(words), n + 1, F.size(words))), lambda x: (F.size(x) == 0) | (last == "") | (F.lower(F.get(x, F.lit(0))) != last)), F.lit(0)))
    place = F.when((F.size(words) >= 2) & (F.size(kept) >= 2), F.array_join(F.slice(kept, -2, 2), " "))
    return F.coalesce(setting("city"), nonblank(F.col("region")), place, nonblank(F.col("country")), F.lit(""))


def integer_setting(path: str, default: int) -> tuple[Column, Column]:
    """(value, error) of a number in the config."""
    raw = F.get_json_object("config", f"$.{path}")
    value = F.expr(f"try_cast(trim(get_json_object(config, '$.{path}')) AS int)")
    return F.when(raw.isNull(), default).otherwise(value), F.when(raw.isNotNull() & value.isNull(), F.lit(f"browser config {path} must be an integer"))


def boolean_setting(path: str, default: bool) -> tuple[Column, Column]:
    raw = F.lower(F.trim(F.get_json_object("config", f"$.{path}")))
    value = F.when(raw.isin("1", "true", "yes", "on"), True).when(raw.isin("0", "false", "no", "off"), False)
    return F.when(raw.isNull(), default).otherwise(value), F.when(raw.isNotNull() & value.isNull(), F.lit(f"browser config {path} must be a boolean"))


def wait_setting() -> tuple[Column, Column]:
    raw = F.coalesce(F.nullif(F.get_json_object("config", "$.wait_until"), F.lit("")), F.lit("networkidle"))
    return F.when(raw.isin(*SETTINGS), raw), F.when(~raw.isin(*SETTINGS), F.lit("browser config wait_until must be commit, domcontentloaded, load, or networkidle"))


def classified(sources: DataFrame, results: DataFrame) -> DataFrame:
    """Sources with the outcome of their classification (source_id, adapter_type, reason, error). A failure is a reason
    like another and changes no adapter, so one bad source doesn't stop the others."""
    r = results.select(F.col("source_id").alias("id"), F.col("adapter_type").alias("__new"), F.col("reason").alias("__why"), F.col("error").alias("__error"))
    why = F.when(F.col("__error").isNotNull(), F.concat(F.lit("classification failed: "), "__error")).otherwise(F.col("__why"))
    s = sources.join(r, "id", "left").withColumn("__r", why)
    config = F.when(F.col("__r").isNotNull(), with_member(F.col("config"), "classification", F.to_json(F.struct(F.col("__r").alias("reason"))))).otherwise(F.col("config"))
    return s.withColumns({"config": config, "adapter_type": F.when(F.col("__error").isNull(), F.coalesce("__new", "adapter_type")).otherwise(F.col("adapter_type"))}).select(*sources.columns)


def run_totals(runs: DataFrame) -> DataFrame:
    """Sums over a batch of runs."""
    sums = (F.sum(F.col(c)).alias(c) for c in ("records_fetched", "records_normalized", "records_failed", "flags"))
    return runs.agg(F.count("*").alias("sources"), F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"), *sums)
