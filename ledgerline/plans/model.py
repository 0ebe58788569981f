"""The driver's tables seen as sources, listings, occurrences, flags and runs. Each projection has a twin in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ship

ZONES = ("UTC", "Europe/London", "America/New_York", "Australia/Sydney", "Europe/Dublin")
COUNTRIES = ("Ireland", "UK", "USA", "Deutschland", "Polska", "Japan", "nowhere")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_of_week(ts) -> F.Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def pick(values: tuple[str, ...], by: F.Column) -> F.Column:
    return F.get(F.array(*map(F.lit, values)), F.pmod(by, F.lit(len(values))).cast("int"))


def sources(spark: SparkSession, d: str) -> DataFrame:
    """nation as sources; every seventh is excluded from snapshots."""
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(
        F.concat(F.lit("src-"), k).alias("id"), F.col("n_name").alias("name"), pick(COUNTRIES, k).alias("country"),
        F.when(k % 7 == 3, F.lit('{"snapshot_excluded": true}')).otherwise(F.lit("{}")).alias("config"),
    )


def customers(spark: SparkSession, d: str) -> DataFrame:
    """customer as listings of sources; every fifth is stale."""
    return table(spark, d, "customer").select(
        F.concat(F.lit("src-"), F.col("c_nationkey")).alias("source_id"), F.concat(F.lit("rec-"), F.col("c_custkey")).alias("source_record_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 5 == 4, "stale").otherwise("active").alias("status"),
    )


def order_flags(spark: SparkSession, d: str) -> DataFrame:
    """orders as flags on customers' listings: F orders of 2001 are open errors, others resolved or warnings."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("src-"), F.col("c_nationkey")).alias("source_id"), F.concat(F.lit("rec-"), F.col("c_custkey")).alias("source_record_id"),
        F.when(F.col("o_orderstatus") == "F", "error").otherwise("warning").alias("severity"), F.when(F.col("o_orderstatus") == "O", "resolved").otherwise("open").alias("status"),
    )


def part_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as occurrences of parts."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    start = (k % 24 * 60 + k % 4 * 15).cast("int")
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.struct(day_of_week(F.col("l_shipdate")).cast("int").alias("day_of_week"), start.alias("start_minute"), F.when(k % 3 > 0, start + 60).cast("int").alias("end_minute"), pick(ZONES, k).alias("timezone")).alias("o"),
    )


def parts(spark: SparkSession, d: str, with_occurrences: bool = True) -> DataFrame:
    """part as listings: brand and type make the place, so that some dozen parts share a key."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select(
        k.alias("pos"), F.when(F.col("p_size") % 2 == 0, "aa").otherwise("na").alias("fellowship"), F.lit("in_person").alias("meeting_type"),
        F.concat(F.lit("s"), k % 9).alias("source_id"), F.concat(F.lit("r"), k).alias("source_record_id"),
        F.when(k % 11 == 0, F.upper(F.split("p_name", " ")[0])).when(k % 13 == 0, F.lit("!!")).otherwise(F.split("p_name", " ")[0]).alias("name"),
        F.concat(F.col("p_brand"), F.lit(" Main St."), F.when(k % 2 == 0, ", Munster").otherwise("")).alias("address_line1"),
        F.when(k % 3 == 0, F.initcap("p_type")).otherwise(F.col("p_type")).alias("city"),
        F.when(k % 4 == 0, F.lit("D02 X285")).otherwise(F.lit("d02 x285")).alias("postal_code"), F.lit("IE").alias("country_code"),
        F.when(k % 5 == 0, F.col("p_brand")).alias("venue_name"),
        F.array(F.when(k % 2 == 0, "Open").otherwise("open"), F.concat(F.lit(" F"), k % 4)).alias("formats"),
        F.when(k % 3 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int"))).alias("last_verified_at"),
    )
    if not with_occurrences:
        return p
    # one pass over lineitem with partial sets; a part has a few dozen rows
    o = part_occurrences(spark, d).groupBy(F.col("p_partkey").alias("pos")).agg(F.sort_array(F.collect_set("o")).alias("occurrences"))
    none = F.array().cast("array<struct<day_of_week:int,start_minute:int,end_minute:int,timezone:string>>")
    return p.join(o, "pos", "left").withColumn("occurrences", F.coalesce("occurrences", none))


# ---- the same in SQL

_ZONES = "[" + ", ".join(f"'{z}'" for z in ZONES) + "]"
_COUNTRIES = "[" + ", ".join(f"'{z}'" for z in COUNTRIES) + "]"


def sql_key(text: str) -> str:
    """The comparison form of a text."""
    from ..functions.lookups import ADDRESS_WORDS

    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ADDRESS_WORDS.items())
    return f"array_to_string(list_transform(regexp_extract_all(lower(coalesce({text}, '')), '[a-z0-9]+'), lambda t: CASE t {cases} ELSE t END), ' ')"


SOURCES = f"SELECT 'src-' || n_nationkey AS id, n_name AS name, {_COUNTRIES}[n_nationkey % {len(COUNTRIES)} + 1] AS country, CASE WHEN n_nationkey % 7 = 3 THEN '{{\"snapshot_excluded\": true}}' ELSE '{{}}' END AS config FROM nation"
CUSTOMERS = "SELECT 'src-' || c_nationkey AS source_id, 'rec-' || c_custkey AS source_record_id, c_name AS name, c_mktsegment AS segment, CASE WHEN c_custkey % 5 = 4 THEN 'stale' ELSE 'active' END AS status FROM customer"
ORDER_FLAGS = (
    "SELECT 'src-' || c_nationkey AS source_id, 'rec-' || c_custkey AS source_record_id, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'warning' END AS severity, "
    "CASE WHEN o_orderstatus = 'O' THEN 'resolved' ELSE 'open' END AS status FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2001-01-01'"
)
PART_OCCURRENCES = (
    "SELECT l_partkey AS pos, dayofweek(l_shipdate) AS dow, k % 24 * 60 + k % 4 * 15 AS start_minute, CASE WHEN k % 3 > 0 THEN k % 24 * 60 + k % 4 * 15 + 60 END AS end_minute, "
    f"{_ZONES}[k % {len(ZONES)} + 1] AS tz FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem)"
)
_NAME = "split_part(p_name, ' ', 1)"
PARTS = f"""SELECT p_partkey AS pos, CASE WHEN p_size % 2 = 0 THEN 'aa' ELSE 'na' END AS fellowship, 'in_person' AS meeting_type, 's' || (p_partkey % 9) AS source_id, 'r' || p_partkey AS source_record_id,
  CASE WHEN p_partkey % 11 = 0 THEN upper({_NAME}) WHEN p_partkey % 13 = 0 THEN '!!' ELSE {_NAME} END AS name, p_brand, p_type,
  CASE WHEN p_partkey % 5 = 0 THEN p_brand END AS venue_name, CASE WHEN p_partkey % 3 > 0 THEN DATE '2024-01-01' + CAST(p_partkey % 50 AS INTEGER) END AS last_verified_at FROM part"""
#: name_key and place_key of PARTS: first comma part of the address spelled out, city, postal code, country
PART_KEYS = f"""SELECT *, nullif({sql_key('name')}, '') AS name_key, concat_ws(' ', {sql_key("p_brand || ' Main St.'")}, {sql_key('p_type')}, 'd02 x285 ie') AS full_key FROM ({PARTS})"""
