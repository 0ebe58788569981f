"""Captured answers of forms, documents, feeds and hosted collections, and the addresses that pages give away."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from urllib.parse import parse_qsl, quote_plus, unquote, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls
from ..functions.text import nonblank
from .html import parse

# Feeds that are read directly, by source.
FEED_QUERY = "/client_interface/json/?switcher=GetSearchResults&services[]="
DIRECT_FEEDS = {
    "na-07fdcb08f177": f"https://tomato.bmltenabled.org/main_server{FEED_QUERY}16&recursive=1", "na-41b6e1cb9842": f"https://pszfna.org/main_server{FEED_QUERY}42&recursive=1", "na-0e14cccfb90e": f"https://bmlt.wszf.org/main_server{FEED_QUERY}1150&recursive=1",
    "na-6ae02f8589f4": f"https://meetings.naworks.org/main_server{FEED_QUERY}9&recursive=1", "na-7b9dd88bb350": f"https://bmlt.wszf.org/main_server{FEED_QUERY}1152&recursive=1", "na-87c9f3b0caef": f"https://aggregator.bmltenabled.org/main_server{FEED_QUERY}1565&recursive=1",
    "na-94eed0942491": f"https://texasoklahomana.org/main_server{FEED_QUERY}1018&recursive=1", "na-a78c156fa126": f"https://metrorichna.org/BMLT/main_server{FEED_QUERY}38&recursive=1", "na-b2575093eb9d": f"https://na-hawaii.org/bmltmain{FEED_QUERY}1&recursive=1",
    "na-f89bb33e4f09": f"https://tomato.bmltenabled.org/main_server{FEED_QUERY}162", "na-ff485154ee5f": f"https://aggregator.bmltenabled.org/main_server{FEED_QUERY}1955&recursive=1",
}
COLLECTION_FIELDS = ("title", "requirements", "time", "jobType1", "county", "jobDescription", "additionalTempMeetingInfo", "location", "openClosedMeeting")
LIST_MARK = "Number found:"
GUIDE_WORDS, FEED_WORDS = ("meetings.json", "meeting-guide/v1/meetings"), ("client_interface/json", "main_server")


def direct_feeds(sources: DataFrame) -> DataFrame:
    """Sources that are read at a known feed: (id, endpoint)."""
    spark = sources.sparkSession
    known = spark.createDataFrame(list(DIRECT_FEEDS.items()), "id string, endpoint string")
    return sources.join(F.broadcast(known), "id").select("id", "endpoint")


def feed_source(source_id: Column, url: Column, country: Column) -> Column:
    """A feed as a source row."""
    return F.struct(source_id.alias("id"), F.lit("aa").alias("fellowship"), source_id.alias("name"), url.alias("url"), country.alias("country"), F.lit("meeting_feed").alias("source_type"), F.lit("meeting_guide").alias("adapter_type"))


def form_requests(sources: DataFrame) -> DataFrame:
    """(id, method, url, params, data, json, error) that sources with a form ask for, by their config."""
    get = lambda p: F.get_json_object("config", f"$.request.{p}")
    has = F.get_json_object("config", "$.request").startswith("{")
    obj = lambda p: F.when(get(p).startswith("{"), get(p))
    return sources.select(
        "id", F.upper(F.coalesce(nonblank(get("method")), F.lit("GET"))).alias("method"), F.coalesce(nonblank(get("url")), F.col("url")).alias("url"), obj("params").alias("params"), obj("data").alias("data"), obj("json").alias("json"),
        F.when(~F.coalesce(has, F.lit(False)), "form_http source config must include request").alias("error"),
    )


def form_rows(answers: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Payload rows of JSON answers (source_id, body): `fields` names the key (or the class selector `.key`) of each field; what
    an object doesn't have is null. An answer that is no array of objects gives one row with an error."""
    items = F.from_json("body", "array<map<string,string>>")
    ok = F.col("body").rlike(r"^\s*\[") & items.isNotNull()
    rows = answers.select("source_id", F.when(ok, items).alias("items"))
    bad = rows.filter("items is null").select("source_id", F.lit(None).cast("int").alias("pos"), *(F.lit(None).cast("string").alias(f) for f in fields), F.lit("form_http JSON result must be an array of objects").alias("error"))
    good = rows.select("source_id", F.posexplode("items").alias("pos", "o"))
    return good.select("source_id", "pos", *(nonblank(F.element_at("o", k.lstrip("."))).alias(f) for f, k in fields.items()), F.lit(None).cast("string").alias("error")).unionByName(bad)


def documents(files: DataFrame) -> DataFrame:
    """Captured documents (source_id, url, content, text) as raw records for review: no candidate is made of one by itself.

    The text layer comes with the capture; decoding the file is another program's work."""
    payload = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("review_required")))
    return files.select("source_id", F.substring(F.sha1("content"), 1, 16).alias("source_record_id"), F.col("url").alias("source_url"), payload.alias("payload"), F.sha2("content", 256).alias("content_hash"))


def as_page(text: Column, kind: str, html: Column | None = None) -> Column:
    """A text as a page that says where it comes from: "pdf", or "rendered" behind the page it was rendered from."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    if kind == "pdf":
        return F.concat(F.lit('<html><body><div data-pdf-text-fallback="true"><pre>'), safe, F.lit("</pre></div></body></html>"))
    return F.concat(F.coalesce(html, F.lit("")), F.lit('\n<div data-rendered-text-fallback="true"><pre>'), safe, F.lit("</pre></div>"))


def renders_late(html: Column) -> Column:
    """Does a page come to life only in a browser?"""
    low = F.lower(html)
    return low.contains("wix-viewer-model") | low.contains("wix-essential-viewer-model") | low.contains("wix-thunderbolt")


def first_that_gives(rows: DataFrame, order: list[str]) -> DataFrame:
    """Of each page's rows by where they came from (`origin`: the page, its frames, linked documents, feeds), those of the first
    origin in `order` that gave any."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("origin"))
    ranked = rows.withColumn("__rank", F.when(rank > 0, rank))
    best = ranked.filter("__rank is not null").groupBy("page_id").agg(F.min("__rank").alias("__best"))
    return ranked.join(best, "page_id").filter("__rank = __best").drop("__rank", "__best")


def collection_text(answers: DataFrame) -> DataFrame:
    """(page_id, text) of a hosted collection's captured answers (page_id, offset, body): its items' fields, one a line, in the
    order of the answers, under the mark that the list extractor knows; markup in fields becomes lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for page_id, offset, body in b.itertuples(index=False):
                try:
                    items = json.loads(body or "").get("dataItems") or []
                except (ValueError, AttributeError):
                    items = []
                lines = []
                for x in items:
                    data = x.get("data") if isinstance(x, dict) and isinstance(x.get("data"), dict) else x
                    for f in COLLECTION_FIELDS if isinstance(data, dict) else ():
                        v = str(data[f]) if data.get(f) is not None else ""
                        lines += parse(v).lines() if "<" in v and ">" in v else [s for line in v.splitlines() if (s := line.strip())]
                out.append((page_id, offset, "\n".join(lines)))
            yield pd.DataFrame(out, columns=["page_id", "offset", "text"])

    each = answers.select("page_id", F.col("offset").cast("int").alias("offset"), "body").mapInPandas(run, "page_id long, offset int, text string").filter("text <> ''")
    # a collection is read in at most twenty answers of a hundred items
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "text"))), lambda x: x["text"]), "\n")
    return each.groupBy("page_id").agg(F.concat(F.lit(f"{LIST_MARK}\n"), joined).alias("text"))


def collection_sort(config: Column) -> Column:
    """The first sort rule of a collection's config, as the query wants it: [{"fieldName": ..., "order": "ASC"}], or []."""
    rule = F.get(F.from_json(config, "array<map<string,string>>"), F.lit(0))
    name = F.get(F.map_keys(rule), F.lit(0))
    one = F.to_json(F.array(F.struct(name.alias("fieldName"), F.upper(F.element_at(rule, name)).alias("order"))))
    return F.when(name.isNotNull(), one).otherwise("[]")


_ROOT, _QUERY = re.compile(r'"root_server"\s*:\s*"([^"]+)"'), re.compile(r'"custom_query"\s*:\s*"([^"]*)"')
_RECURSE, _BODIES = re.compile(r'"recurse_service_bodies"\s*:\s*(true|false|\d+|"[^"]*")'), re.compile(r'"service_body"\s*:\s*\[([^\]]*)\]')
_DATA = re.compile(r"""(?i)<script\b[^>]*\bsrc=["']data:text/javascript;base64,([^"']+)["']""")


def hinted_feed(html: str | None) -> str | None:
    """The feed that a page's scripts are set up with, also in scripts given as base64."""
    text = html or ""
    for body in _DATA.findall(text):
        try:
            text += "\n" + base64.b64decode(unquote(body)).decode("utf-8", "ignore")
        except ValueError:
            continue
    plain = lambda s: json.loads(f'"{s}"') if "\\" in s else s
    root = _ROOT.search(text)
    if not root:
        return None
    custom = _QUERY.search(text)
    params = parse_qsl(plain(custom[1])) if custom else []
    if not params and (m := _BODIES.search(text)):
        params = [("services[]", n) for n in re.findall(r"\d+", m[1])]
    deep = (m := _RECURSE.search(text)) and m[1].strip('"').lower() in ("1", "true", "yes", "on")
    query = "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in [("switcher", "GetSearchResults"), *params, *([("recursive", "1")] if deep else [])])
    return f"{plain(root[1]).rstrip('/')}/client_interface/json/?{query}"


def hinted_feeds(pages: DataFrame) -> DataFrame:
    """(page_id, endpoint) of the pages whose scripts name a feed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, u) for i, html in b.itertuples(index=False) if (u := hinted_feed(html))]
            yield pd.DataFrame(out, columns=["page_id", "endpoint"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, endpoint string")


def probe_addresses(pages: DataFrame, paths: tuple[str, ...], words: tuple[str, ...], most: int = 20) -> DataFrame:
    """(page_id, pos, url) where a feed may be: the usual paths, then what the page mentions in links, scripts and texts with one
    of `words`; each once, whatever ends in /, and few."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for page_id, url, html in b.itertuples(index=False):
                found = [n.attrs.get("href") or n.attrs.get("src") for n in parse(html).select("a, script, link")]
                found += re.findall(r"[\"'](https?:[^\"']+|/[^\"']*\.json[^\"']*)[\"']", html or "")
                every = [urljoin(url, p) for p in paths] + [urljoin(url, u) for u in found if u and any(w in u.lower() for w in words)]
                once = {u.rstrip("/"): u for u in reversed(every) if u.startswith(("http://", "https://"))}
                kept = [once[k] for k in dict.fromkeys(u.rstrip("/") for u in every if u.startswith(("http://", "https://")))][:most]
                out += [(page_id, i, u) for i, u in enumerate(kept)]
            yield pd.DataFrame(out, columns=["page_id", "pos", "url"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, pos int, url string")


def probed(addresses: DataFrame, answers: DataFrame, kind: Column) -> DataFrame:
    """(page_id, url) of the first address whose captured answer (url, payload) is of the kind that was looked for."""
    good = answers.filter(kind & F.col("payload").rlike(r"^\s*\[\s*\{")).select("url").distinct()
    return addresses.join(good, "url", "left_semi").groupBy("page_id").agg(F.min_by("url", "pos").alias("url"))


def same_site(a: Column, b: Column) -> Column:
    return urls.site(a) == urls.site(b)
