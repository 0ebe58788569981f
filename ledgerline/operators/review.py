"""Validation, artifact and payload predicates, review flags, gates."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import nonblank

# Texts that are no listing.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ARTIFACT_VALUES = ("are listed here:", "email", "secondary menu", "printable meeting schedule", "time:")
ARTIFACT_PHRASES = ("in-person + online meetings today", "time town meeting location address type", "wordfence is a security plugin", "wordfence's blocking tools", "visit wordfence.com")
FALSE_NAMES = ("meeting information", "name", "name:", "buscar", "buscar:", "leer más", "leer mas", "leer más…..", "office is open")
FALSE_PREFIXES = ("meeting information", "need to edit or add a meeting", "meeting schedule revised")
FALSE_ADDRESSES = (r"^(?:to\s+)?\d{1,2}(?::\d{2})?\s*(?:am|pm)(?:\s+in person)?$", r"^\d+\s*:?$")
FALSE_PHRASES = (
    "generated by wordfence", "your computer's time", "attention all aa meeting seekers", "tention all aa meeting seekers", "continue reading", "read more", "office hours", "will not take place", "district committee",
    "intergroup meets", "bookstall", "business-meetings", "district 20 meetings are held", "leer más", "leer mas", "office is open", "your access to this site has been limited", "visítanos en", "visitanos en",
)
SOURCE_PHRASES = FALSE_PHRASES[:-2]
SECURITY_PHRASES = FALSE_PHRASES[:2]
OFFLINE_URL = r"(?i)apps\.apple\.com|play\.google\.com|facebook\.com|instagram\.com|youtube\.com|youtu\.be|twitter\.com|x\.com|linkedin\.com|maps\.google|paypal\.com|donate|/event/|/events/|/news/|/blog/"
ONLINE_URL = r"(?i)zoom\.|teams\.microsoft\.com|meet\.google\.com|webex\.com|jitsi|gotomeet|bluejeans"


def _any(flags: list[Column]) -> Column:
    return F.coalesce(reduce(or_, flags), F.lit(False))


def contains_any(text: Column, phrases: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return _any([low.contains(p) for p in phrases])


def given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def valid_candidate() -> Column:
    """Ids, URL and name are there, and some place or connection. A coordinate of 0.0 counts as one."""
    need = [nonblank(F.col(c)).isNotNull() for c in ("source_id", "source_record_id", "source_url", "name")]
    place = _any([nonblank(F.col(c)).isNotNull() for c in ("address_line1", "city", "venue_name", "online_url", "phone_join_info")] + [F.col(c).isNotNull() for c in ("latitude", "longitude")])
    return need[0] & need[1] & need[2] & need[3] & place


def location_artifact(name: Column, venue: Column, city: Column, address: Column) -> Column:
    """Is a listing navigation, schedule or contact text instead?"""
    flags = []
    for field, c in (("name", name), ("venue", venue), ("city", city), ("address", address)):
        v = F.lower(F.trim(c))
        flags += [F.length(v) > 500, v.isin(*ARTIFACT_VALUES), v == "about wordfence", contains_any(v, ARTIFACT_PHRASES)]
        if field in ("city", "address"):
            flags.append(F.length(v) > 200)
        if field in ("name", "city"):
            flags.append(v.isin(*WEEKDAYS))
        if field == "city":
            flags.append(c.rlike(r"[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}"))
        if field == "address":
            flags.append(v.startswith("****meeting time change"))
    return _any(flags)


def false_positive(name: Column, address: Column, everything: Column) -> Column:
    """A payload that looks like a listing and isn't."""
    n, a = F.lower(F.trim(F.coalesce(name, F.lit("")))), F.lower(F.trim(F.coalesce(address, F.lit(""))))
    return _any([n.isin(*FALSE_NAMES), *(n.startswith(p) for p in FALSE_PREFIXES), *(a.rlike(p) for p in FALSE_ADDRESSES), contains_any(everything, FALSE_PHRASES)])


def meeting_payload(day: Column, time: Column, places: list[Column], name: Column, address: Column, everything: Column) -> Column:
    return given(day) & given(time) & _any([given(p) for p in places]) & ~false_positive(name, address, everything)


def online_url(url: Column) -> Column:
    """A URL that is an online meeting's, else null."""
    return F.when(~url.rlike(OFFLINE_URL) & url.rlike(ONLINE_URL), url)


def flags(candidates: DataFrame) -> DataFrame:
    """A row for each review flag of each listing."""
    utc = F.exists("occurrences", lambda o: o["timezone"] == "UTC")
    art = location_artifact(*(F.col(c) for c in ("name", "venue_name", "city", "address_line1")))
    entry = lambda code, sev, msg: F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"), F.lit(msg).alias("message"))
    found = F.array_compact(
        F.array(
            F.when(utc, entry("missing_timezone", "warning", "candidate uses fallback UTC timezone")),
            F.when(art, entry("location_text_artifact", "error", "candidate appears to be navigation, schedule, or contact text rather than a meeting")),
        )
    )
    return candidates.select("source_id", "source_record_id", F.inline(found))


def gate(rows: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Rows with `decision`: drop below 0.45, warn below 0.75, keep otherwise or where there is no confidence."""
    c = F.col(confidence)
    return rows.withColumn("decision", F.when(c < 0.45, "drop").when(c < 0.75, "warn").otherwise("keep"))


def quality_gate(metrics: DataFrame, minimum: int = 1, max_residual: float = 0.005) -> DataFrame:
    """metrics (n, removed) with the residual rate and whether a snapshot may be published."""
    rate = F.coalesce(F.try_divide(F.col("removed"), F.col("n")), F.lit(0.0))
    return metrics.withColumn("residual_rate", rate).withColumn("passed", (F.col("n") >= minimum) & (F.col("residual_rate") <= max_residual))


# Signs of why a page gave no listing, by name.
SIGNALS = {
    "blocked": r"(?is)\b(captcha|cloudflare|access denied|forbidden|blocked|security check|verify you are human|enable javascript and cookies)\b",
    "dead_error": r"(?is)\b(404|not found|server error|internal server error|critical error|domain for sale|account suspended|site suspended|website expired|page cannot be found|temporarily unavailable)\b",
    "form": r"(?is)<form\b|<select\b|type=[\"']?search\b",
    "table": r"(?is)<table\b|class=[\"'][^\"']*(meeting|schedule|bmlt|crouton)",
    "meeting_keyword": r"(?isuU)\b(meeting|meetings|schedule|group|groups|narcotics anonymous|reunion|reuniones|grupo|grupos|расписание|групп|зустріч|모임|일정|ミーティング|会場|会議|集会)\b",
    "structured_feed": r"(?is)(client_interface/(?:json|php)|main_server|root_server|bmltenabled|crouton|meetingguide|meeting-guide|/feed/json|wp-json/[^\"']*meeting|service_body|services\[\])",
    "pdf": r"(?is)(current-meeting-list|(?:meeting|meetings|schedule|where(?:-|\s*)and(?:-|\s*)when|printable|list)[^\"'<>]{0,180}\.pdf|\.pdf[^\"'<>]{0,180}(?:meeting|meetings|schedule|where(?:-|\s*)and(?:-|\s*)when|printable|list))",
}
DAY_TIME = (
    r"(?isuU)\b(mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?|lunes|martes|miercoles|miércoles|jueves|viernes|sabado|sábado|domingo|понедельник|вторник|среда|четверг|пятница|"
    r"суббота|воскресенье|monday|화요일|수요일|목요일|금요일|토요일|일요일|월요일|月曜|火曜|水曜|木曜|金曜|土曜|日曜)\b.{0,180}\b\d{1,2}\s*(?::|\.|h|時)\s*\d{2}"
)
TIME_RANGE = r"(?isuU)\b\d{1,2}\s*(?::|\.|h|時)\s*\d{2}\s*(?:am|pm)?\s*(?:-|to|–|—|~|〜|～)"
EMBED_HINT = r"(?is)(calendar\.google|/calendar/|basic\.ics|bmlt|crouton|meeting|meetings|schedule|picker|airtable|jotform|tockify|teamup|timekit)"
FAILED = {"failed_timeout": r"(?is)(timeout|timed out)", "failed_tls_ssl": r"(?is)(ssl|tls|certificate|cert_|common name)"}


def zero_source(pages: DataFrame, html: str = "html", text: str = "text", status: str = "last_status", error: str = "error") -> DataFrame:
    """pages with signals, bucket and priority of a source that gave nothing."""
    h, t, e = (F.coalesce(F.col(c), F.lit("")) if c in pages.columns else F.lit("") for c in (html, text, error))
    s = F.lower(F.coalesce(F.col(status), F.lit(""))) if status in pages.columns else F.lit("succeeded")
    hay = F.lower(F.concat_ws("\n", h, t, e))
    at = {k: h if k in ("form", "table") else t if k == "meeting_keyword" else hay for k in SIGNALS}
    out = pages.withColumns({f"__{k}": at[k].rlike(p) for k, p in SIGNALS.items()})
    sig = {k: F.col(f"__{k}") for k in SIGNALS}
    frame = F.regexp_extract_all(h, F.lit(r"(?is)<(?:iframe|embed|object)\b[^>]*?\b(?:src|data)\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    out = out.withColumns({"__embed": F.exists(frame, lambda x: x.rlike(EMBED_HINT)), "__day": t.rlike(DAY_TIME) | (t.rlike(TIME_RANGE) & sig["meeting_keyword"])})
    sig |= {"embed": F.col("__embed"), "day_time_or_meeting_time": F.col("__day")}
    failed = s == "failed"
    cause = F.when(e != "", e).otherwise(hay)
    ladder = [
        (failed & cause.rlike(FAILED["failed_timeout"]), "failed_timeout", 4), (failed & cause.rlike(FAILED["failed_tls_ssl"]), "failed_tls_ssl", 4), (failed, "failed_transport", 4),
        (sig["structured_feed"], "possible_missed_structured_feed", 1), (sig["pdf"], "possible_pdf_or_printable", 1),
        (sig["embed"] & sig["day_time_or_meeting_time"], "possible_embed_or_calendar", 1), (sig["embed"], "possible_embed_or_calendar", 2),
        (sig["day_time_or_meeting_time"] & ~sig["dead_error"], "parser_gap_candidate", 1), (sig["blocked"], "blocked_or_captcha", 5), (sig["dead_error"], "dead_or_error_page", 5),
        (sig["meeting_keyword"], "meeting_keywords_only", 4),
    ]
    bucket, priority = F.lit("low_signal"), F.lit(5)
    for cond, name, p in reversed(ladder):
        bucket, priority = F.when(cond, name).otherwise(bucket), F.when(cond, p).otherwise(priority)
    signals = F.array_sort(F.array_compact(F.array(*(F.when(f, F.lit(k)) for k, f in sig.items()))))
    return out.withColumns({"signals": signals, "bucket": bucket, "priority": priority}).drop(*(f"__{k}" for k in SIGNALS), "__embed", "__day")


def inspected(sources: DataFrame, artifacts: DataFrame, probes: DataFrame) -> DataFrame:
    """Sources (id, name, country, config) that gave nothing, with what is known of their page: the last capture (source_id, html,
    text), else a probe's answer (source_id, html, text, error); both may be missing. The last run's status and error are in the
    config."""
    a = artifacts.select(F.col("source_id").alias("id"), F.col("html").alias("__ah"), F.col("text").alias("__at"))
    p = probes.select(F.col("source_id").alias("id"), F.col("html").alias("__ph"), F.col("text").alias("__pt"), F.col("error").alias("__pe"))
    df = sources.join(a, "id", "left").join(p, "id", "left")
    own = nonblank(F.col("__ah")).isNotNull()
    df = df.withColumns({
        "html": F.when(own, F.col("__ah")).otherwise(F.col("__ph")), "text": F.when(own, F.col("__at")).otherwise(F.col("__pt")), "last_status": F.get_json_object("config", "$.scrape.last_status"),
        "error": F.coalesce(nonblank(F.get_json_object("config", "$.scrape.last_error")), F.when(~own, F.col("__pe"))),
    })
    return zero_source(df.drop("__ah", "__at", "__ph", "__pt", "__pe"))


RETRY_BUCKETS = ("possible_missed_structured_feed", "possible_pdf_or_printable", "possible_embed_or_calendar", "parser_gap_candidate")


def retry_ids(audited: DataFrame) -> DataFrame:
    """Sources worth another try."""
    return audited.filter((F.col("priority") <= 2) & F.col("bucket").isin(*RETRY_BUCKETS))
