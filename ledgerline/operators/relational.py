"""Joins, set operations and counts between sources, listings, occurrences and flags.

Dimension tables (sources, dictionaries) are small, but no side is hinted: adaptive execution broadcasts a side whose
measured size is below spark.sql.autoBroadcastJoinThreshold and shuffles otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def eligible(candidates: DataFrame, sources: DataFrame, flags: DataFrame) -> DataFrame:
    """Active listings of sources that aren't excluded, without an open error flag of their own.

    A flag without a record id belongs to its source as a whole and blocks no row."""
    excluded = F.lower(F.coalesce(F.get_json_object("config", "$.snapshot_excluded"), F.lit("false"))) == "true"
    kept = sources.filter(~excluded).select(F.col("id").alias("source_id"))
    errors = flags.filter((F.col("status") == "open") & (F.col("severity") == "error")).select("source_id", "source_record_id")
    return candidates.filter(F.col("status") == "active").join(kept, "source_id", "left_semi").join(errors, ["source_id", "source_record_id"], "left_anti")


def nest_occurrences(candidates: DataFrame, occurrences: DataFrame, keys: list[str]) -> DataFrame:
    """Listings with their occurrences as an array by day, start, end and zone; none gives an empty array."""
    item = F.struct("day_of_week", "start_minute", "end_minute", "timezone")
    nested = occurrences.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("occurrences"))
    return candidates.join(nested, keys, "left").withColumn("occurrences", F.coalesce("occurrences", F.array().cast(nested.schema["occurrences"].dataType)))


def unnest_occurrences(candidates: DataFrame, keys: list[str]) -> DataFrame:
    return candidates.select(*keys, F.inline("occurrences"))


def with_flag(candidates: DataFrame, flags: DataFrame, occurrences: DataFrame, code: str, zone: str) -> DataFrame:
    """Listings that have an open flag `code` and an occurrence in the zone, with their source."""
    open_ = flags.filter((F.col("status") == "open") & (F.col("code") == code)).select("source_id", "source_record_id").distinct()
    at = occurrences.filter(F.col("timezone") == zone).select("source_id", "source_record_id").distinct()
    return candidates.join(open_, ["source_id", "source_record_id"], "left_semi").join(at, ["source_id", "source_record_id"], "left_semi")


def shadowed(world: DataFrame, local: DataFrame, url: str = "normalized_url") -> DataFrame:
    """World listings whose URL a local source has too."""
    return world.join(local.select(url), url, "left_semi")


def unshadowed(world: DataFrame, local: DataFrame, url: str = "normalized_url") -> DataFrame:
    return world.join(local.select(url), url, "left_anti")


def without_active(sources: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """Sources that have no active listing."""
    return sources.join(active.select(key), key, "left_anti")


def protected(invalid: DataFrame, listings: DataFrame, key: str) -> DataFrame:
    """Invalid sources with the number of their listings; those with any are protected from deletion."""
    counts = listings.groupBy(key).agg(F.count("*").alias("meetings"))
    out = invalid.join(counts, key, "left").withColumn("meetings", F.coalesce("meetings", F.lit(0)))
    return out.withColumn("protected", F.col("meetings") > 0)


def active_counts(listings: DataFrame, key: str, active: Column) -> DataFrame:
    """Listings and active listings of each source."""
    return listings.groupBy(key).agg(F.count("*").alias("total"), F.count_if(active).alias("active"))


def broad_sources(records: DataFrame, key: str, body: Column, listed: Column, *, many: int = 500, some: int = 200, fallback: int = 100, bodies: int = 3) -> DataFrame:
    """Counts of each source and whether its result is too broad: very many rows, many from a current list, or a
    fall-back feed that serves several bodies."""
    out = records.groupBy(key).agg(F.count("*").alias("records"), F.max(listed).alias("listed"), F.count_distinct(body).alias("bodies"))
    n = F.col("records")
    return out.withColumns({"too_broad": (n >= many) | ((n >= some) & F.col("listed")), "fallback_too_broad": (n >= fallback) & (F.col("bodies") >= bodies)})


def new_rows(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch whose key isn't stored yet, one for each key (insert, or do nothing)."""
    return batch.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti")


def unseen(stored: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return stored.join(seen.select(*keys), keys, "left_anti")


def first_productive(rows: DataFrame, page: str, rank: str) -> DataFrame:
    """Of each page, the rows of the first extractor that gave any."""
    best = rows.groupBy(page).agg(F.min(rank).alias("__best"))
    return rows.join(best, page).filter(F.col(rank) == F.col("__best")).drop("__best")


def first_marker(rows: DataFrame, text: Column, markers: list[tuple[str, str]], out: str) -> DataFrame:
    """The value of the first marker, in the order given, that the text contains."""
    return rows.withColumn(out, F.coalesce(*(F.when(text.contains(m), F.lit(v)) for m, v in markers)))


def longest_name(text: Column, names: list[str]) -> Column:
    """The longest of the names that a text contains, the earlier one of equals."""
    order = sorted(range(len(names)), key=lambda i: (-len(names[i]), i))
    return F.coalesce(*(F.when(F.lower(text).contains(names[i].lower()), F.lit(names[i])) for i in order))
