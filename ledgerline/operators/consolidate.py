"""Consolidation of duplicate listings: semantic keys, group merge, metrics, residual check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import rounded
from ..functions.text import address_key, join_present, key_text, nonblank, odd_capitals, once, place_field

#: Columns of a candidate that a merged row takes from its primary row.
SCORED = ("venue_name", "address_line1", "city", "region", "postal_code", "country", "online_url", "phone_join_info", "language", "accessibility_notes")


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def with_place_keys(df: DataFrame) -> DataFrame:
    """place_key: the address with city, code and country; else the venue; else the area; else exact coordinates; else
    the connection. Null if there is nothing to compare."""
    c = lambda n: _col(df, n)
    address, address2 = address_key(c("address_line1")), address_key(c("address_line2"))
    city = place_field(c("city"))
    region = place_field(F.coalesce(F.nullif(c("region_code"), F.lit("")), c("region")))
    country = place_field(F.coalesce(F.nullif(c("country_code"), F.lit("")), c("country")))
    postal = key_text(c("postal_code"))
    by_address = once(address, lambda a: F.when(F.coalesce(a, F.lit("")) != "", join_present(a, address2, city, postal, country)))
    physical = F.coalesce(by_address, F.when(
        F.coalesce(c("venue_name"), F.lit("")) != "", join_present(place_field(c("venue_name")), city, region, country)
    ).otherwise(join_present(city, region, country)))
    lat, lon = rounded(_col(df, "latitude", "double"), 3), rounded(_col(df, "longitude", "double"), 3)
    exact = lat.isNotNull() & lon.isNotNull() & ~F.coalesce(_col(df, "is_approximate_location", "boolean"), F.lit(False))
    geo = F.when(exact, F.concat(F.lit("geo:"), lat.cast("string"), F.lit(":"), lon.cast("string")))
    link = key_text(join_present(c("online_url"), c("phone_join_info")))
    none = lambda x: F.when(x != "", x)
    return df.withColumn("place_key", F.coalesce(once(key_text(physical), none), geo, F.concat(F.lit("connection:"), once(link, none))))


def with_semantic_key(df: DataFrame) -> DataFrame:
    """name_key and place_key, both null where either is missing: such rows stand alone."""
    out = with_place_keys(df)
    key = F.struct(once(key_text(F.col("name")), lambda x: F.when(x != "", x)).alias("n"), F.col("place_key").alias("p"))
    both = once(key, lambda k: F.when(k["n"].isNotNull() & k["p"].isNotNull(), k))
    return out.withColumn("__key", both).withColumns({"name_key": F.col("__key.n"), "place_key": F.col("__key.p")}).drop("__key")


def completeness(df: DataFrame) -> Column:
    """How much a row says: filled fields, formats, occurrences, coordinates, a verification date."""
    score = F.lit(0)
    for n in SCORED:
        score = score + F.when(F.coalesce(_col(df, n), F.lit("")) != "", 1).otherwise(0)
    for n in ("formats", "occurrences"):
        if n in df.columns:
            score = score + F.coalesce(F.array_size(n), F.lit(0))
    if {"latitude", "longitude"} <= set(df.columns):
        score = score + F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), 2).otherwise(0)
    if "last_verified_at" in df.columns:
        score = score + F.when(F.col("last_verified_at").isNotNull(), 1).otherwise(0)
    return score


def primary_order(df: DataFrame) -> Column:
    """The least of these is a group's primary row: the fullest, exact before approximate, then ids and input order."""
    return F.struct((-completeness(df)).alias("s"), F.coalesce(_col(df, "is_approximate_location", "boolean"), F.lit(False)).alias("a"), F.col("source_id").alias("i"), F.col("source_record_id").alias("r"), F.col("pos").alias("p"))


def merged_formats(c: Column) -> Column:
    """Different non-blank formats, in order whatever their case."""
    found = F.array_distinct(F.filter(F.transform(F.flatten(c), nonblank), lambda x: x.isNotNull()))
    return F.transform(F.array_sort(F.transform(found, lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))), lambda s: s["v"])


def merged_occurrences(c: Column) -> Column:
    """Different occurrences by day, start, end (none last) and time zone. Equal ones are neighbours once sorted: of structs,
    array_distinct would compare each with all found so far."""
    key = lambda o: F.struct(o["day_of_week"].alias("d"), o["start_minute"].alias("s"), F.coalesce(o["end_minute"], F.lit(24 * 60)).alias("e"), o["timezone"].alias("z"), o.alias("o"))
    found = once(F.sort_array(F.transform(F.flatten(c), key)), lambda a: F.filter(a, lambda x, i: (i == 0) | ~x["o"].eqNullSafe(F.get(a, i - 1)["o"])))
    return F.transform(found, lambda s: s["o"])


def name_order(name: Column, count: Column, first_pos: Column) -> Column:
    """The least of these is the display name: commonest, fewest odd capitals, shortest, alphabetical, first seen."""
    return F.struct((-count).alias("c"), odd_capitals(name).alias("o"), F.length(name).alias("l"), F.lower(name).alias("f"), first_pos.alias("p"), name.alias("n"))


def display_names(df: DataFrame, keys: list[str], name: str = "name", pos: str = "pos") -> DataFrame:
    """The display name of each group. Two aggregations with partial sums: no group's rows are gathered."""
    stripped = nonblank(F.col(name))
    counted = df.filter(stripped.isNotNull()).groupBy(*keys, stripped.alias("__n")).agg(F.count("*").alias("__c"), F.min(pos).alias("__p"))
    return counted.groupBy(*keys).agg(F.min(name_order(F.col("__n"), F.col("__c"), F.col("__p")))["n"].alias("display_name"))


KEYS = ["fellowship", "meeting_type", "name_key", "place_key"]


def consolidate(candidates: DataFrame) -> DataFrame:
    """One row for each semantic group and each row without a key, in order of first appearance (`pos`).

    The primary row gives every field but name, formats, occurrences and last_verified_at, which are merged;
    n_members counts the rows, member_ids lists their record ids. A first aggregation by group and name and a second by
    group give all of it in one pass over the candidates, without a join; a row without a key is a group of its own."""
    df = with_semantic_key(candidates).withColumn("__alone", F.when(F.col("name_key").isNull(), F.col("pos")))
    group = [*KEYS, "__alone"]
    own = [c for c in candidates.columns if c not in ("pos", "fellowship", "meeting_type")]
    order = primary_order(df)
    by_name = df.groupBy(*group, nonblank(F.col("name")).alias("__n")).agg(
        F.count("*").alias("__c"), F.min("pos").alias("pos"), F.min(order).alias("__o"), F.min_by(F.struct(*own), order).alias("__row"), F.max("last_verified_at").alias("__v"),
        F.collect_set("source_record_id").alias("__ids"), F.collect_set("formats").alias("__f"), F.collect_set("occurrences").alias("__occ"),
    )
    merged = by_name.groupBy(*group).agg(
        F.min(F.when(F.col("__n").isNotNull(), name_order(F.col("__n"), F.col("__c"), F.col("pos"))))["n"].alias("__name"), F.min_by("__row", "__o").alias("__row"), F.min("pos").alias("pos"), F.sum("__c").alias("n_members"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("__ids")))).alias("member_ids"), F.max("__v").alias("__v"), F.flatten(F.collect_list("__f")).alias("__f"), F.flatten(F.collect_list("__occ")).alias("__occ"),
    )
    alone = F.col("__alone").isNotNull()
    new = {"name": F.col("__name"), "formats": merged_formats(F.col("__f")), "occurrences": merged_occurrences(F.col("__occ")), "last_verified_at": F.col("__v")}
    pick = lambda c: F.when(alone, F.col(f"__row.{c}")).otherwise(new[c]).alias(c) if c in new else F.col(c) if c not in own else F.col(f"__row.{c}").alias(c)
    return merged.select(*map(pick, candidates.columns), "n_members", "member_ids")


def duplicate_metrics(candidates: DataFrame) -> DataFrame:
    """For each fellowship: rows, semantic groups of two or more, and rows that merging removes."""
    df = with_semantic_key(candidates)
    groups = df.filter("name_key is not null").groupBy(*KEYS).count()
    per = groups.groupBy("fellowship").agg(F.count_if(F.col("count") > 1).alias("semantic_groups"), F.sum(F.when(F.col("count") > 1, F.col("count") - 1).otherwise(0)).alias("removed"))
    return df.groupBy("fellowship").agg(F.count("*").alias("original")).join(per, "fellowship", "left").na.fill(0)


def occurrence_groups(candidates: DataFrame) -> DataFrame:
    """For each fellowship: (key, occurrence) pairs that come twice or more, a listing's own repeats included."""
    df = with_semantic_key(candidates).filter("name_key is not null")
    each = df.select(*KEYS, F.explode("occurrences").alias("o"))
    return each.groupBy(*KEYS, "o").count().filter("count > 1").groupBy("fellowship").agg(F.count("*").alias("groups"))


def residual_rate(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows a second consolidation would remove, as a share; 0 where there are none."""
    n, again = after.agg(F.count("*").alias("n")), consolidate(after.select(*before.columns)).agg(F.count("*").alias("m"))
    return n.join(again, F.lit(True)).select((F.col("n") - F.col("m")).alias("removed"), F.coalesce(F.try_divide(F.col("n") - F.col("m"), F.col("n")), F.lit(0.0)).alias("rate"))


def examples(candidates: DataFrame, limit: int = 20) -> DataFrame:
    """The first groups that were merged, in order of appearance."""
    return consolidate(candidates).filter("n_members > 1").orderBy("pos").limit(limit).select("fellowship", "name", "member_ids", (F.col("n_members") - 1).alias("removed_count"))
