"""The life of a listing: feed to raw to candidate to stored table to snapshot."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scoring
from ..operators import consolidate as D, location, merge, relational, review, source_rules
from ..operators.ranking import first_wins, issue_counters, numbered, top_k
from .files import write_ordered
from .store import Store

GOLD_DROPS = ("raw_location_text", "first_seen_at", "last_seen_at", "status", "missing_run_count", "pos")


def confidence_of(payloads: DataFrame, page_score: str | None = None) -> DataFrame:
    """Extracted payload rows with confidence (not below the extractor's floor), signals, and whether they are listings."""
    given = lambda *cs: F.exists(F.array(*(F.col(c) for c in cs if c in payloads.columns)), lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    has = {"day": given("day"), "time": given("time"), "name": given("name"), "location": given("address_line1", "venue_name", "city"), "online": given("online_url", "phone_join_info"), "table_headers": F.col("kind") == "header_table", "repeated_structure": F.col("kind").isin("cards", "classed_rows")}
    if page_score:
        has["meeting_page"] = F.col(page_score) >= 0.5
    score, signals = scoring.confidence(has, F.col("kind") == "text_block")
    everything = F.concat_ws(" ", *(F.col(c) for c, t in payloads.dtypes if t == "string"))
    ok = review.meeting_payload(F.col("day"), F.col("time"), [F.col(c) for c in ("address_line1", "venue_name", "city", "online_url", "phone_join_info")], F.col("name"), F.col("address_line1"), everything)
    return payloads.withColumns({"confidence": F.greatest(score, F.col("floor")), "signals": signals, "is_listing": ok})


def ingest(candidates: DataFrame, source_country=None, source_region=None) -> tuple[DataFrame, DataFrame]:
    """Gate, validate, repair places and flag: (candidates, flags). Rows under the gate or invalid become flags only."""
    gated = review.gate(candidates) if "confidence" in candidates.columns else candidates.withColumn("decision", F.lit("keep"))
    valid = gated.withColumn("__ok", review.valid_candidate())
    kept = location.normalize_location(valid.filter("__ok and decision <> 'drop'").drop("__ok"), source_country, source_region)
    kept = first_wins(kept, ["source_id", "source_record_id"], ["pos"]) if "pos" in kept.columns else kept
    flag = lambda df, code, sev, msg: df.select("source_id", "source_record_id", F.lit(code).alias("code"), F.lit(sev).alias("severity"), F.lit(msg).alias("message"))
    flags = review.flags(kept)
    flags = flags.unionByName(flag(valid.filter("not __ok"), "scrape_normalization_failed", "error", "record can't be normalized"))
    flags = flags.unionByName(flag(valid.filter("decision = 'drop'"), "scrape_very_low_confidence", "error", "confidence below 0.45"))
    flags = flags.unionByName(flag(valid.filter("decision = 'warn'"), "scrape_low_confidence", "warning", "confidence below 0.75"))
    return kept.drop("decision"), flags


def ingest_direct(candidates: DataFrame, confidence: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """ingest() for records that a feed gave directly: trusted as far as they say themselves, else `confidence`, and kept however
    little that is."""
    own = F.col("confidence") if "confidence" in candidates.columns else F.lit(None).cast("double")
    kept, flags = ingest(candidates.drop("confidence"))
    keys = ["source_id", "source_record_id"]
    return kept.join(candidates.select(*keys, F.coalesce(own, F.lit(confidence)).alias("confidence")), keys), flags


def persist(store: Store, run: str, seen_at: str, candidates: DataFrame, flags: DataFrame, sources: DataFrame, failed: bool = False) -> dict:
    """One run as one new version of every table: upsert, missing runs, drop flags, run log. A failed run only writes the log."""
    spark = store.spark
    entry = lambda status, n: spark.createDataFrame([(run, seen_at, status, n)], "run_id string, started_at string, status string, records long")
    log = lambda e: store.read("import_runs").unionByName(e) if store.exists("import_runs") else e
    if failed:
        store.commit({"import_runs": log(entry("failed", 0))})
        return {"status": "failed"}
    base = candidates.withColumns({"status": F.lit(merge.ACTIVE), "missing_run_count": F.lit(0), "first_seen_at": F.lit(seen_at), "last_seen_at": F.lit(seen_at)})
    old = store.read("canonical_meetings") if store.exists("canonical_meetings") else base.limit(0)
    active = lambda df: relational.active_counts(df, "source_id", F.col("status") == merge.ACTIVE).select("source_id", "active")
    new = merge.mark_missing(merge.upsert_candidates(old, candidates, F.lit(seen_at)), candidates, sources)
    drops = merge.source_drops(active(old), active(new))
    drop_flags = drops.select("source_id", F.lit(None).cast("string").alias("source_record_id"), F.lit("source_large_drop").alias("code"), F.lit("error").alias("severity"), F.lit("source dropped more than 20 percent of previous active meetings").alias("message"))
    found = flags.unionByName(drop_flags)
    held = store.read("review_flags") if store.exists("review_flags") else found.withColumn("status", F.lit("open")).limit(0)
    n = candidates.count()
    store.commit({"canonical_meetings": new, "review_flags": merge.replace_flags(held, found, sources), "import_runs": log(entry("succeeded", n))})
    return {"status": "succeeded", "records": n}


def snapshot(candidates: DataFrame, sources: DataFrame, flags: DataFrame) -> DataFrame:
    """Eligible listings, places repaired, duplicates merged, without working columns."""
    rows = location.normalize_location(relational.eligible(candidates, sources, flags))
    if "pos" not in rows.columns:
        # a total order as one comparable column; no global numbering is needed for "first"
        rows = rows.withColumn("pos", F.struct(*(F.coalesce(F.col(c), F.lit("￿")).alias(c) for c in ("fellowship", "country", "city", "name", "source_id", "source_record_id"))))
    out = D.consolidate(rows)
    return out.select(*(c for c in out.columns if c not in GOLD_DROPS))


#: The order of a snapshot: nulls last, ids break ties.
SNAPSHOT_ORDER = ("fellowship", "country", "city", "name", "source_id", "source_record_id")
SNAPSHOT_SCHEMA = "generated_at string, meeting_count long, status string"


def residual(gold: DataFrame) -> DataFrame:
    """(n, removed): how many listings there are, and how many another consolidation would remove."""
    total = D.duplicate_metrics(gold).agg(F.coalesce(F.sum("original"), F.lit(0)).alias("n"), F.coalesce(F.sum("removed"), F.lit(0)).alias("removed"))
    return total.select(F.col("n").cast("long").alias("n"), F.col("removed").cast("long").alias("removed"))


def document(gold: DataFrame, as_of: datetime) -> DataFrame:
    """One row: the snapshot as one JSON text with sorted keys, made by one task. For a snapshot small enough to be one value; publish() writes
    the same text from document_lines() at any size."""
    cols = sorted(gold.columns)
    rows = gold.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("m"), F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("￿")) for c in SNAPSHOT_ORDER if c in cols)).alias("o"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "m"))), lambda x: F.concat(F.lit("    "), x["m"])), ",\n")
    return rows.agg(F.concat(F.lit(f'{{\n  "generated_at": "{as_of.isoformat()}",\n  "meeting_count": '), F.count("*").cast("string"), F.lit(',\n  "meetings": [\n'), body, F.lit("\n  ]\n}")).alias("value"))


def document_lines(gold: DataFrame, as_of: datetime) -> tuple[list[str], DataFrame, list[str]]:
    """The lines of document(): those before the listings, a row (pos, value) for each listing in order, and those after. No task has more than its
    range of the listings."""
    cols = sorted(gold.columns)
    order = [c for c in SNAPSHOT_ORDER if c in cols]
    rows = gold.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("m"), *(F.col(c).cast("string").alias(c) for c in order))
    rows = numbered(rows, order)
    n = rows.count()
    body = rows.select("pos", F.concat(F.lit("    "), "m", F.when(F.col("pos") < n, ",").otherwise("")).alias("value"))
    # no listing leaves an empty line
    return ["{", f'  "generated_at": "{as_of.isoformat()}",', f'  "meeting_count": {n},', '  "meetings": [', *([] if n else [""])], body, ["  ]", "}"]


def publish(spark: SparkSession, gold: DataFrame, path: str, as_of: datetime, minimum: int = 1, max_residual: float = 0.005, dry_run: bool = False) -> dict:
    """Write a gated snapshot: one JSON document under a stamped name and under latest. The share of listings that another
    consolidation would remove is measured here; nothing is written if the gate fails."""
    gate = review.quality_gate(residual(gold), minimum, max_residual).first()
    report = gate.asDict() | {"generated_at": as_of.isoformat()}
    if not gate.passed or dry_run:
        return report | {"written": False}
    head, body, tail = document_lines(gold, as_of)
    for name in (f"snapshot-{as_of:%Y%m%dT%H%M%S}", "latest"):
        write_ordered(body, head, tail, f"{path}/{name}/part-00000.json")
    return report | {"written": True}


def record_snapshot(store: Store, report: dict) -> None:
    """A row of the snapshot audit for what publish() reported."""
    row = store.spark.createDataFrame([(report["generated_at"], report["n"], "published" if report["written"] else "rejected")], SNAPSHOT_SCHEMA)
    store.commit({"snapshots": store.read("snapshots").unionByName(row) if store.exists("snapshots") else row})


def audit_snapshot(gold: DataFrame, examples: int = 5) -> tuple[DataFrame, DataFrame]:
    """What is wrong with a snapshot: counts of issues by code, by code and fellowship, by code and source; the first few
    listings of each issue."""
    issues = location.audit(gold)
    return issue_counters(issues), top_k(issues, ["code"], [F.col("source_id"), F.col("source_record_id")], examples)


def zero_source_report(audited: DataFrame, path: str, fellowship: str, concurrency: int = 4, pages: int = 6) -> None:
    """The audit of sources that gave nothing (id, name, country, bucket, priority, signals), for people and programs: rows by
    priority, bucket, country and name as JSON lines; a page with counts and a table; the ids to try again and the command."""
    order = ["priority", "bucket", F.coalesce("country", F.lit("")), "name"]
    audited.orderBy(*order).write.mode("overwrite").json(f"{path}/audit")
    retry = review.retry_ids(audited).withColumn("pos", F.struct("priority", "bucket", F.coalesce("country", F.lit("")), "name"))
    retry.orderBy("pos").select("id").coalesce(1).write.mode("overwrite").text(f"{path}/retry_ids")
    source_rules.retry_command(retry, fellowship, concurrency, pages).write.mode("overwrite").text(f"{path}/retry_command")
    zero_source_page(audited).coalesce(1).write.mode("overwrite").text(f"{path}/report")


def zero_source_page(audited: DataFrame) -> DataFrame:
    """Lines of a report: counts by bucket (most first), then each source in the audit's order."""
    spark = audited.sparkSession
    at = lambda part, n, a, b: F.struct(F.lit(part).alias("part"), n.cast("long").alias("n"), a.alias("a"), b.alias("b")).alias("o")
    counts = audited.groupBy("bucket").count().select(at(1, -F.col("count"), F.lit(""), F.col("bucket")), F.concat_ws("", F.lit("- "), "bucket", F.lit(": "), F.col("count").cast("string")).alias("value"))
    line = F.concat_ws(" | ", F.col("priority").cast("string"), "bucket", F.coalesce("country", F.lit("")), "name", F.array_join("signals", ", "))
    rows = audited.select(at(3, F.col("priority"), F.concat_ws("\t", "bucket", F.coalesce("country", F.lit(""))), F.col("name")), F.concat(F.lit("| "), line, F.lit(" |")).alias("value"))
    head = spark.range(1).select(at(0, F.lit(0), F.lit(""), F.lit("")), F.lit("# Zero-source audit").alias("value"))
    table = spark.range(1).select(at(2, F.lit(0), F.lit(""), F.lit("")), F.lit("| priority | bucket | country | name | signals |").alias("value"))
    return head.unionByName(counts).unionByName(table).unionByName(rows).orderBy("o").select("value")


def report(store: Store) -> str:
    """Counts of sources, active listings and open flags."""
    count = lambda t, cond: store.read(t).filter(cond).count() if store.exists(t) else 0
    return json.dumps({"sources": count("sources", "true"), "active": count("canonical_meetings", "status = 'active'"), "open_flags": count("review_flags", "status = 'open'")})
