"""A crawl as set logic over captured links: which pages come first, which are followed, and when it ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scoring, urls
from ..functions.text import nonblank

# Paths under which sites keep their meetings.
COMMON_PATHS = (
    "/meeting/", "/meetings/", "/meetings/find-a-meeting", "/groups/", "/aa-groups/", "/a-a-groups/", "/alcoholics-anonymous-groups/", "/meeting-schedule", "/meetings-schedule", "/meeting-list", "/meeting-list.html",
    "/meeting-locator", "/meeting-locations", "/meetings-map", "/locations", "/area-meetings", "/local-meeting-schedule", "/na-meetings", "/na-meetings.html", "/tabbed-map-search", "/tabbed-search", "/where-and-when",
    "/where-and-when.html", "/bmlt-meeting-list", "/bmlt-tabbed-search", "/find-a-meeting", "/find-meeting/find-a-meeting", "/find-meeting", "/find-meetings", "/meeting-search", "/meetings-search", "/search-meetings",
    "/where-to-find", "/schedule", "/reunioes", "/reuniões", "/reuniones", "/reunions", "/horario", "/horários", "/horarios", "/spotkania", "/mityngi", "/mitingi",
)
NOT_FOUND = ("404", "page not found", "not found", "page non trouvée", "seite nicht gefunden", "side ikke fundet", "stránka nenalezena", "страница не найдена")
BRANCHES = ("meeting", "meetings", "meeting-schedule", "groups", "aa-groups", "a-a-groups")
DIRECTORY_WORDS = ("meeting", "meetings", "group", "groups", "schedule", "møteliste", "moteliste")
STOP_SIGNALS = ("strong_public_meeting_directory", "meeting_form", "meeting_table", "tsml_json_feed")
FORM_SIGNALS = ("strong_public_meeting_directory", "meeting_form", "meeting_table", "day_and_time_text")
# What names of downloads say.
PDF_NO = (
    "agenda", "annual", "booklet", "bulletin", "bylaw", "campout", "convention", "event", "flyer", "guideline", "introduction to na meetings", "ip 29", "ip-29", "literature", "minutes", "newsletter", "newsgram", "policy",
    "poster", "report", "service", "speaker jam", "workshop", "en3129",
)
PDF_YES = ("current meeting list", "meeting list", "meeting schedule", "meetings updated", "meetings update", "na meeting", "schedule", "where and when", "ミーティングリスト", "ミーティング情報", "会場案内")
LIST_QUERY, PAGE_FILTERS = "current-meeting-list", ("attendance_option", "district", "region")


def path_key(url: Column) -> Column:
    """A path in lower case without / at its end."""
    p = F.lower(F.regexp_replace(urls.part(url, 3), "/+$", ""))
    return F.when(p == "", "/").otherwise(p)


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: text.contains(w))


def is_common_path(source: Column, url: Column) -> Column:
    keys = {p.rstrip("/").lower() for p in COMMON_PATHS}
    return (urls.host(source) == urls.host(url)) & path_key(url).isin(*keys)


def is_landing(url: Column) -> Column:
    return F.regexp_replace(urls.part(url, 3), "/+$", "") == ""


def is_child(source: Column, url: Column) -> Column:
    """Is a page below its source's path?"""
    a, b = (F.regexp_replace(urls.part(u, 3), "/+$", "") for u in (source, url))
    return (urls.host(source) == urls.host(url)) & (a != "") & (a != b) & b.startswith(F.concat(a, F.lit("/")))


def same_branch(source: Column, url: Column) -> Column:
    """On one site, sources are areas under /meeting/: only their own branch counts there."""
    parts = F.filter(F.split(urls.part(source, 3), "/"), lambda x: x != "")
    area = F.concat(F.lit("/meeting/"), F.get(parts, F.lit(1)))
    path = F.regexp_replace(urls.part(url, 3), "/+$", "")
    inside = (path == area) | path.startswith(F.concat(area, F.lit("/")))
    return F.when(urls.host(source).endswith("najapan.org") & (F.size(parts) >= 2) & (F.get(parts, F.lit(0)) == "meeting"), inside).otherwise(F.lit(True))


def is_directory(url: Column, text: Column) -> Column:
    """Does a link lead to a directory of meetings?"""
    path = F.lower(F.regexp_replace(urls.part(url, 3), "/+$", ""))
    score = scoring.link_score(url, text)
    strong = scoring.strong_link(url, text)
    named = (score >= 0.35) & _any(path, DIRECTORY_WORDS)
    return (path != "") & (strong | named | ((score >= 0.5) & _any(F.substring_index(path, "/", -1), DIRECTORY_WORDS)))


def is_branch(url: Column) -> Column:
    """Does a waiting page belong to a branch of meetings?"""
    path = F.lower(F.regexp_replace(urls.part(url, 3), "/+$", ""))
    first = F.get(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(0))
    return (path != "") & (is_directory(url, F.lit("")) | F.coalesce(first.isin(*BRANCHES), F.lit(False)))


def not_found(title: Column, url: Column) -> Column:
    return _any(F.lower(F.coalesce(title, F.lit(""))), NOT_FOUND) | F.lower(url).contains("404")


def prioritized(links: DataFrame, by: str = "source_url") -> DataFrame:
    """Links that a crawl of `by` may follow and that score above nothing, with their rank; a page below the source gains 0.4,
    and equals keep the order of the page (`pos`)."""
    s, u = F.col(by), F.col("url")
    out = links.filter(urls.admissible(s, u) & same_branch(s, u))
    out = out.withColumn("priority", (F.round(scoring.link_score(u, F.col("text")) * 100) + F.when(is_child(s, u), 40).otherwise(0)).cast("int")).filter("priority > 0")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("priority"), "pos")))


def fall_backs(links: DataFrame, by: str = "source_url") -> DataFrame:
    """Links that say nothing for or against meetings."""
    u, t = F.col("url"), F.col("text")
    return links.filter(urls.admissible(F.col(by), u) & (scoring.link_score(u, t) <= 0) & ~scoring.negative_link(u, t))


def guesses(sources: DataFrame, *keep: str) -> DataFrame:
    """(source_url, pos, url, text, columns to keep) of the common paths on each source's site, each once, other than the source itself.

    A guess has its source's scheme and authority and none of the paths is one that a crawl skips, so it may be followed if the scheme is
    http or https: a source's address is taken apart once, not once a path."""
    source = F.col("source_url")
    root = F.concat(urls.part(source, 1), F.lit("://"), urls.part(source, 2))
    paths = F.array(*(F.struct(F.lit(i).alias("pos"), F.lit(p).alias("path"), F.lit(p.rstrip("/").lower() or "/").alias("key"), F.lit(p.strip("/").replace("-", " ")).alias("text")) for i, p in enumerate(COMMON_PATHS)))
    own = sources.select("source_url", *keep, root.alias("__root"), path_key(source).alias("__own")).filter(F.lower(urls.part(source, 1)).isin("http", "https"))
    rows = own.select("source_url", *keep, "__root", "__own", F.explode(paths).alias("__p")).filter(F.col("__p.key") != F.col("__own"))
    return rows.select("source_url", "__p.pos", F.concat("__root", "__p.path").alias("url"), "__p.text", *keep)


def _remembered(most: int) -> Column:
    """The pages of a source's row that gave rows before, from the config's three lists in turn, each once, few."""
    scrape = lambda p, kind: F.coalesce(F.from_json(F.get_json_object("config", f"$.scrape.{p}"), kind), F.array().cast(kind))
    pages = F.transform(scrape("successful_pages", "array<struct<url:string>>"), lambda x: x["url"])
    last = F.array(F.get_json_object("config", "$.scrape.last_successful_page_url"))
    every = F.concat(pages, scrape("successful_page_urls", "array<string>"), last)
    u = F.filter(F.transform(every, lambda x: urls.defragment(nonblank(x))), lambda x: x.isNotNull())
    return F.slice(F.filter(F.array_distinct(u), lambda x: same_branch(F.col("source_url"), x)), 1, most)


def remembered(sources: DataFrame, *keep: str, most: int = 5) -> DataFrame:
    """(source_url, pos, url, columns to keep) of the pages that gave rows before, few for each source."""
    return sources.select("source_url", F.posexplode(_remembered(most)).alias("pos", "url"), *keep)


def first_frontier(sources: DataFrame, *keep: str) -> DataFrame:
    """(source_url, pos, url, depth, columns to keep): remembered pages that may be followed at depth -1, then the source at depth 0. All of it
    follows from a source's own row, so nothing is joined."""
    source = F.col("source_url")
    entry = lambda pos, url, depth: F.struct(pos.cast("int").alias("pos"), url.alias("url"), F.lit(depth).alias("depth"))
    old = sources.withColumn("__old", F.filter(F.transform(_remembered(5), lambda u, i: entry(i, u, -1)), lambda e: urls.admissible(source, e["url"])))
    own = F.array(entry(F.lit(1 << 20), urls.defragment(source), 0))
    again = F.coalesce(F.exists("__old", lambda e: e["url"] == urls.defragment(source)), F.lit(False))
    rows = old.select("source_url", *keep, F.explode(F.concat("__old", F.filter(own, lambda e: ~again))).alias("__e"))
    return rows.select("source_url", "__e.pos", "__e.url", "__e.depth", *keep)


def without_common_paths(frontier: DataFrame) -> DataFrame:
    """What is left to visit once a site answered that a guessed page doesn't exist."""
    return frontier.filter(~is_common_path(F.col("source_url"), F.col("url")))


def expected_records(config: Column, url: Column) -> Column:
    """How many rows a remembered page gave before; null if none are known."""
    page = urls.defragment(url)
    pages = F.coalesce(F.from_json(F.get_json_object(config, "$.scrape.successful_pages"), "array<struct<url:string,records_extracted:int>>"), F.array().cast("array<struct<url:string,records_extracted:int>>"))
    hit = F.get(F.filter(pages, lambda p: (urls.defragment(p["url"]) == page) & (p["records_extracted"] > 0)), F.lit(0))["records_extracted"]
    last = F.get_json_object(config, "$.scrape.last_successful_page_records").cast("int")
    return F.coalesce(hit, F.when((urls.defragment(F.get_json_object(config, "$.scrape.last_successful_page_url")) == page) & (last > 0), last))


def stops(pages: DataFrame, min_records: int = 3, min_score: float = 0.5) -> DataFrame:
    """Pages (url, extracted, page_score, signals, deeper, pending_branch, pending_remembered, expected) with three reasons to
    end their crawl: a good page, a remembered page that gave what it gave before (3/4 of it), an empty directory."""
    n = F.col("extracted")
    landing = is_landing(F.col("url"))
    good = F.when((n > 0) & landing, ~F.col("deeper")).when((n > 0) & F.col("pending_branch"), False).otherwise((n >= min_records) & (F.col("page_score") >= min(min_score, 0.5)))
    e = F.col("expected")
    again = (n > 0) & ~F.col("pending_remembered") & (e.isNull() | (e <= 2) | (n >= F.greatest(F.lit(1), F.floor(e * 0.75))))
    empty = (n <= 0) & ~landing & (F.col("page_score") >= min_score) & F.arrays_overlap("signals", F.array(*map(F.lit, STOP_SIGNALS)))
    return pages.withColumns({"stop_good": good, "stop_remembered": again, "stop_empty": empty})


def may_search(requested: Column, deeper: Column, signals: Column) -> Column:
    """May a page's search form be sent? Where no directory lies deeper, or the page doesn't speak of meetings itself."""
    speaks = F.exists(signals, lambda s: s.rlike("^(url_or_text|text|body):") & s.contains("meeting"))
    return requested & F.when(~deeper, True).when(F.arrays_overlap(signals, F.array(*map(F.lit, FORM_SIGNALS))), False).otherwise(~speaks)


def below_veto(world: Column, score: Column, least: float = 0.18) -> Column:
    """Is a page too unlike a meeting page to be read (world listings are read in any case)?"""
    return ~world & (score < least)


def has_list_query(url: Column) -> Column:
    return F.lower(urls.part(url, 4)).rlike(f"(^|&){LIST_QUERY}=[^&]")


def is_meeting_pdf(url: Column, text: Column) -> Column:
    """Is a link a meeting list to download?"""
    path = urls.part(url, 3)
    say = F.lower(F.translate(F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.coalesce(F.try_url_decode(F.regexp_replace(path, r"\+", "%2B")), path)), "_-", "  "))
    return F.when(F.lower(path).endswith(".pdf"), ~_any(say, PDF_NO) & _any(say, PDF_YES)).otherwise(has_list_query(url) & _any(say, ("meeting list", "meeting schedule", "schedule")))


def is_feed_url(url: Column) -> Column:
    return F.lower(url).contains("action=meetings") | F.lower(url).contains("meetings-tsml")


def feed_url(page: Column) -> Column:
    """The feed behind a page of filters: its address with the page's filters (the first of each, not blank, all or any)."""
    query = urls.part(page, 4)
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p.rlike("(?i)^tsml-[^=]*=.")), lambda p: F.struct(F.regexp_replace(F.lower(F.substring_index(p, "=", 1)), "^tsml-", "").alias("k"), F.try_url_decode(F.regexp_extract(p, "=(.*)$", 1)).alias("v")))
    ok = F.filter(pairs, lambda p: p["k"].isin(*PAGE_FILTERS) & ~F.lower(F.trim(p["v"])).isin("", "all", "any"))
    first = F.filter(ok, lambda p, i: ~F.exists(F.slice(ok, F.lit(1), i), lambda q: q["k"] == p["k"]))
    extra = F.array_join(F.transform(first, lambda p: F.concat(F.lit("&"), p["k"], F.lit("="), F.url_encode(p["v"]))), "")
    return F.when(F.lower(query).contains("tsml-"), F.concat(urls.part(page, 1), F.lit("://"), urls.part(page, 2), F.lit("/wp-admin/admin-ajax.php?action=meetings"), extra))


def calendar_id(src: Column) -> Column:
    """A calendar's address, as it is or decoded from base64 for URLs."""
    padded = F.concat(F.translate(src, "-_", "+/"), F.repeat(F.lit("="), F.pmod(F.lit(4) - F.length(src) % 4, F.lit(4)).cast("int")))
    text = F.decode(F.try_to_binary(padded, F.lit("base64")), "UTF-8")
    return F.when(src.contains("@"), src).when(F.coalesce(text.contains("@"), F.lit(False)), text).otherwise(src)


def calendar_feed(embed: Column) -> Column:
    """The calendar file behind an embedded calendar; null for other frames."""
    ok = urls.host(embed).isin("calendar.google.com", "www.google.com", "google.com") & urls.part(embed, 3).contains("calendar")
    src = F.try_url_decode(F.regexp_extract(urls.part(embed, 4), "(?:^|&)src=([^&]+)", 1))
    return F.when(ok & (src != ""), F.concat(F.lit("https://calendar.google.com/calendar/ical/"), calendar_id(src), F.lit("/public/basic.ics")))
