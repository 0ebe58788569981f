"""Versioned merges: each takes the stored table and a batch and gives the next version of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ACTIVE, STALE, INACTIVE = "active", "stale", "inactive"


def _sides(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer join with the stored columns as o_* and the batch's as n_*."""
    o = stored.select(*keys, *(F.col(c).alias(f"o_{c}") for c in stored.columns if c not in keys), F.lit(True).alias("__o"))
    n = batch.select(*keys, *(F.col(c).alias(f"n_{c}") for c in batch.columns if c not in keys), F.lit(True).alias("__n"))
    return o.join(n, keys, "full_outer")


def merge_json(old: Column, new: Column) -> Column:
    """Two flat JSON objects merged one level deep; the right one wins."""
    kind = "map<string,string>"
    left, right = (F.coalesce(F.from_json(c, kind), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))) for c in (old, new))
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, right))))


def upsert_sources(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Sources by (normalized_url, fellowship): name, url and type are overwritten; country and region only filled; a known
    adapter or permission never becomes unknown; a browser need is kept while the adapter is; configs are merged."""
    keys = ["normalized_url", "fellowship"]
    j = _sides(stored, batch, keys)
    new = F.col("__n").isNotNull()
    over = lambda c: F.when(new, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
    known = lambda c: F.when(new & ((F.col(f"n_{c}") != "unknown") | F.col(f"o_{c}").isNull()), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
    cols = {
        "id": F.coalesce("o_id", "n_id"), "name": over("name"), "url": over("url"), "source_type": over("source_type"),
        "country": F.coalesce("n_country", "o_country"), "region": F.coalesce("n_region", "o_region"),
        "adapter_type": known("adapter_type"), "permission_status": known("permission_status"),
        "requires_browser": F.when(~new, F.col("o_requires_browser")).when(F.col("n_adapter_type") != "unknown", F.col("n_requires_browser")).otherwise(F.coalesce("o_requires_browser", "n_requires_browser")),
        "config": F.when(F.col("__o").isNotNull() & new, F.to_json(merge_json(F.col("o_config"), F.col("n_config")))).otherwise(F.coalesce("n_config", "o_config")),
    }
    return j.select(*keys, *(v.alias(k) for k, v in cols.items())).select(*stored.columns)


def upsert_candidates(stored: DataFrame, batch: DataFrame, seen_at: Column) -> DataFrame:
    """Listings by (source_id, source_record_id): the batch overwrites, makes active and clears the count of missed runs;
    a verification date is only filled; first_seen_at stays."""
    keys = ["source_id", "source_record_id"]
    j = _sides(stored, batch, keys)
    new = F.col("__n").isNotNull()
    special = {
        "status": F.when(new, ACTIVE).otherwise(F.col("o_status")),
        "missing_run_count": F.when(new, 0).otherwise(F.col("o_missing_run_count")),
        "first_seen_at": F.coalesce("o_first_seen_at", seen_at),
        "last_seen_at": F.when(new, seen_at).otherwise(F.col("o_last_seen_at")),
        "last_verified_at": F.coalesce("n_last_verified_at", "o_last_verified_at") if "last_verified_at" in batch.columns else F.col("o_last_verified_at"),
    }
    out = []
    for c in stored.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in special:
            out.append(special[c].alias(c))
        elif c in batch.columns:
            out.append(F.when(new, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            out.append(F.col(f"o_{c}").alias(c))
    return j.select(*out)


def replace_children(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Children of the batch's parents give way to the batch's rows."""
    return stored.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch.distinct())


def mark_missing(stored: DataFrame, seen: DataFrame, sources: DataFrame, limit: int = 3) -> DataFrame:
    """Active and stale listings of the scanned sources that weren't seen count one more missed run: stale, and inactive
    from `limit` on. Other states stay. A source with no seen record has all its listings missed."""
    keys = ["source_id", "source_record_id"]
    marks = seen.select(*keys).distinct().withColumn("__seen", F.lit(True))
    scanned = sources.select("source_id").distinct().withColumn("__scanned", F.lit(True))
    j = stored.join(marks, keys, "left").join(scanned, "source_id", "left")
    missed = F.col("__scanned").isNotNull() & F.col("__seen").isNull() & F.col("status").isin(ACTIVE, STALE)
    n = F.col("missing_run_count") + 1
    new = {"status": F.when(missed, F.when(n >= limit, INACTIVE).otherwise(STALE)).otherwise(F.col("status")), "missing_run_count": F.when(missed, n).otherwise(F.col("missing_run_count"))}
    return j.withColumns(new).select(*stored.columns)  # both from the old status


def replace_flags(stored: DataFrame, batch: DataFrame, sources: DataFrame) -> DataFrame:
    """Open flags of the sources become resolved; the batch's are added as open."""
    scanned = sources.select("source_id").distinct().withColumn("__s", F.lit(True))
    old = stored.join(scanned, "source_id", "left").withColumn("status", F.when(F.col("__s").isNotNull() & (F.col("status") == "open"), "resolved").otherwise(F.col("status")))
    return old.select(*stored.columns).unionByName(batch.withColumn("status", F.lit("open")).select(*stored.columns))


def delete_sources(tables: dict[str, DataFrame], doomed: DataFrame) -> dict[str, DataFrame]:
    """Every table without the rows of the doomed sources (a cascade)."""
    ids = doomed.select(F.col("id").alias("source_id")).distinct()
    return {name: df.join(ids.withColumnRenamed("source_id", "id"), "id", "left_anti") if name == "sources" else df.join(ids, "source_id", "left_anti") for name, df in tables.items()}


def repair_timezones(occurrences: DataFrame, zones: DataFrame, old: str = "UTC") -> DataFrame:
    """Occurrences in the fall-back zone take their source's zone where one is known."""
    j = occurrences.join(zones.select("source_id", F.col("timezone").alias("__z")), "source_id", "left")
    return j.withColumn("timezone", F.when((F.col("timezone") == old) & F.col("__z").isNotNull(), F.col("__z")).otherwise(F.col("timezone"))).select(*occurrences.columns)


def source_drops(before: DataFrame, after: DataFrame, share: float = 0.20) -> DataFrame:
    """Sources that lost more than a share of their active listings: (source_id, before, after, dropped)."""
    j = before.select("source_id", F.col("active").alias("before")).join(after.select("source_id", F.col("active").alias("after")), "source_id", "left")
    j = j.withColumn("after", F.coalesce("after", F.lit(0))).withColumn("dropped", F.col("before") - F.col("after"))
    return j.filter((F.col("before") > 0) & (F.col("dropped") / F.col("before") > share))
