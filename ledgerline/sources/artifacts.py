"""Captured scrape artifacts: summaries with nested pages and extracted payloads, replayed as raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import first_wins
from .feeds import canonical_hash, given, scraped_id

EXTRACTED = "struct<payload:string,method:string,confidence:double,source_page_url:string,signals:array<string>,selector_hint:string>"
PAGE = f"struct<url:string,final_url:string,title:string,page_score:double,page_signals:array<string>,extracted_count:int,extracted:array<{EXTRACTED}>>"
SUMMARY = f"source_id string, source_url string, status string, pages_visited int, records_extracted int, error_message string, pages array<{PAGE}>"


def read_summaries(spark: SparkSession, path: str, *, source_id: str | None = None, include_failed: bool = False) -> DataFrame:
    """path/*/summary.json, or one file, with the folder's name and the file's time. Unreadable files count as failed."""
    files = path if path.endswith(".json") else f"{path}/*/summary.json"
    text = spark.read.text(files, wholetext=True).select("value", "_metadata.file_path", "_metadata.file_modification_time")
    folder = F.element_at(F.split("file_path", "/"), -2)
    df = text.withColumn("s", F.from_json("value", SUMMARY)).select("s.*", folder.alias("folder"), "file_modification_time")
    df = df.withColumn("status", F.coalesce("status", F.when(F.col("source_id").isNull(), "failed")))
    if source_id is not None:
        df = df.filter(F.col("folder") == source_id)
    return df if include_failed else df.filter(~F.col("status").eqNullSafe("failed"))


def latest_by_source(summaries: DataFrame) -> DataFrame:
    """The newest summary of each source; of equal times the first folder."""
    rest = [c for c in summaries.columns if c != "source_id"]
    return first_wins(summaries, ["source_id"], [F.desc("file_modification_time"), "folder"]).select("source_id", *rest)


def report_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a report file; of rows with one id the last counts."""
    kind = "struct<source_id:string,fellowship:string,name:string,country:string,region:string,timezone:string,config:string>"
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json(F.get_json_object("value", "$.sources"), f"array<{kind}>")).alias("pos", "s")).select("pos", "s.*")
    return first_wins(rows.filter("source_id <> ''"), ["source_id"], [F.desc("pos")]).drop("pos")


def merged_metadata(stored: DataFrame, reported: DataFrame) -> DataFrame:
    """Stored and reported metadata by source: reported values win, configs are merged one level deep."""
    from ..operators.merge import merge_json

    cols = [c for c in stored.columns if c not in ("source_id", "config")]
    s = stored.select("source_id", F.col("config").alias("s_config"), *(F.col(c).alias(f"s_{c}") for c in cols))
    r = reported.select("source_id", F.col("config").alias("r_config"), *(F.col(c).alias(f"r_{c}") for c in cols))
    return s.join(r, "source_id", "full_outer").select("source_id", *(F.coalesce(given(F.col(f"r_{c}")), F.col(f"s_{c}")).alias(c) for c in cols), F.to_json(merge_json(F.col("s_config"), F.col("r_config"))).alias("config"))


def sources(summaries: DataFrame, metadata: DataFrame) -> DataFrame:
    """Sources as summaries and metadata tell them; the fellowship is the id's prefix where nothing says better."""
    j = summaries.select("source_id", F.col("source_url").alias("url")).distinct().join(metadata, "source_id", "left")
    return j.select(
        F.col("source_id").alias("id"), F.coalesce(given(F.col("fellowship")), F.substring_index("source_id", "-", 1)).alias("fellowship"), F.coalesce(given(F.col("name")), F.col("source_id")).alias("name"), "url", "country", "region",
        F.lit("local_service_body").alias("source_type"), F.lit("playwright_browser").alias("adapter_type"), F.lit(True).alias("requires_browser"), "config", F.coalesce(given(F.col("timezone")), F.get_json_object("config", "$.timezone")).alias("timezone"),
    )


def raw_records(summaries: DataFrame) -> DataFrame:
    """Pages and what was extracted from them, flattened: one row for each payload, the first of each record id.

    The page's URL is the payload's own, the item's, the page's final or first one, or the source's, in that order."""
    pages = summaries.select("source_id", "source_url", F.posexplode("pages").alias("p", "page"))
    items = pages.select("source_id", F.col("source_url").alias("base"), "p", F.coalesce(given(F.col("page.final_url")), given(F.col("page.url"))).alias("page_url"), F.posexplode("page.extracted").alias("i", "x")).filter("x.payload is not null")
    own = F.get_json_object("x.payload", "$.extraction.source_page_url")
    url = F.coalesce(given(own), given(F.col("x.source_page_url")), F.col("page_url"), F.col("base"))
    items = items.withColumn("url", url)
    meta = F.to_json(F.struct(F.col("x.method").alias("method"), F.col("x.confidence").alias("confidence"), F.col("url").alias("source_page_url"), F.coalesce("x.signals", F.array().cast("array<string>")).alias("signals"), F.col("x.selector_hint").alias("selector_hint")))
    # the item's metadata fills an object that the payload may carry already
    has = F.get_json_object("x.payload", "$.extraction").isNotNull()
    bare = F.regexp_replace("x.payload", r"\}\s*$", "")
    sep = F.when(F.trim(bare) == "{", "").otherwise(",")
    payload = F.when(has, F.col("x.payload")).otherwise(F.concat(bare, sep, F.lit('"extraction":'), meta, F.lit("}")))
    rows = items.select("source_id", scraped_id(F.col("x.payload")).alias("source_record_id"), F.col("url").alias("source_url"), payload.alias("payload"), F.col("x.confidence").alias("confidence"), "p", "i")
    return first_wins(rows, ["source_id", "source_record_id"], ["p", "i"]).drop("p", "i").withColumn("content_hash", canonical_hash())


def successful_pages(summaries: DataFrame, limit: int = 5) -> DataFrame:
    """The best pages of each source: most records, then score; one row for each URL."""
    from ..operators.ranking import top_k

    pages = summaries.select("source_id", F.posexplode("pages").alias("pos", "page"))
    rows = pages.select("source_id", "pos", F.coalesce(given(F.col("page.final_url")), given(F.col("page.url"))).alias("url"), F.coalesce("page.extracted_count", F.lit(0)).alias("records"), F.coalesce("page.page_score", F.lit(0.0)).alias("score"))
    return top_k(rows.filter("records > 0 and url is not null"), ["source_id"], [F.desc("records"), F.desc("score"), F.col("pos")], limit, unique="url")


def write_evidence(pages: DataFrame, path: str) -> None:
    """Captured pages by source, so that a replay of one source reads one folder."""
    pages.write.mode("overwrite").partitionBy("source_id").json(path)
