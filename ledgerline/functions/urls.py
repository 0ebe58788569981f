"""URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, i: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query."""
    return F.regexp_extract(F.trim(url), _URL, i)


def normalize_url(url: Column) -> Column:
    """Scheme (https if none) and host in lower case, path without / at its end, sorted query, no fragment."""
    scheme = F.coalesce(F.nullif(F.lower(part(url, 1)), F.lit("")), F.lit("https"))
    path = F.regexp_replace(F.regexp_replace(part(url, 3), ";[^/]*$", ""), "/+$", "")
    pairs = F.filter(F.split(part(url, 4), "&"), lambda p: p != "")
    # pairs sort as (name, value), both decoded
    named = F.transform(
        pairs,
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)).alias("k"),
            F.coalesce(F.try_url_decode(F.regexp_extract(p, "=(.*)$", 1)), F.regexp_extract(p, "=(.*)$", 1)).alias("v"),
        ),
    )
    query = F.array_join(F.transform(F.array_sort(named), lambda s: F.concat(F.url_encode(s["k"]), F.lit("="), F.url_encode(s["v"]))), "&")
    return F.concat(scheme, F.lit("://"), F.lower(part(url, 2)), F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def source_id(fellowship: Column, url: Column) -> Column:
    """Stable id of a source: its fellowship and 12 digits of a hash of its URL."""
    return F.concat_ws("-", fellowship, F.substring(F.sha1(normalize_url(url)), 1, 12))


def defragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def site(url: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


# What a crawl does not follow.
SKIP_SUFFIXES = (".avi", ".doc", ".docx", ".gif", ".ics", ".jpg", ".jpeg", ".mp3", ".mp4", ".pdf", ".png", ".ppt", ".pptx", ".webp", ".xls", ".xlsx", ".zip")
SKIP_MARKERS = ("/feed/bmlt2ics",)
SKIP_QUERY = ("current-meeting-list",)


def host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(part(url, 2)), "^[^@]*@", ""), ":\\d*$", "")


def admissible(source: Column, url: Column) -> Column:
    """May a crawl that began at `source` follow `url`? The source itself always; else the same host or site, and nothing skipped."""
    path = F.lower(part(url, 3))
    bad = F.lit(False)
    for s in SKIP_SUFFIXES:
        bad = bad | path.endswith(s)
    for m in SKIP_MARKERS:
        bad = bad | path.contains(m)
    for k in SKIP_QUERY:
        bad = bad | F.lower(part(url, 4)).rlike(rf"(^|&){k}(=|&|$)")
    same = (host(source) == host(url)) | ((site(source) != "") & (site(source) == site(url)))
    return F.lower(part(url, 1)).isin("http", "https") & ((defragment(url) == defragment(source)) | (~bad & same))


def join(base: Column, ref: Column) -> Column:
    """A reference resolved against a base: absolute, scheme-relative, rooted, query-only or relative to the folder."""
    root = F.concat(part(base, 1), F.lit("://"), part(base, 2))
    folder = F.regexp_replace(part(base, 3), "[^/]*$", "")
    return (
        F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(part(base, 1), F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.startswith("?"), F.concat(root, part(base, 3), ref))
        .when(ref == "", defragment(base))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), ref))
    )


def phone_uri(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9+]", "")


def website(c: Column) -> Column:
    """A website with a scheme."""
    s = F.trim(c)
    return F.when(s == "", None).when(s.rlike("(?i)^https?://"), s).otherwise(F.concat(F.lit("https://"), s))
