"""Shared folders, bounded samples and input shapes for the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where that is unset (tests on one machine)."""
    ship(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have in any case of letters: `name`, or `name` with a number."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)


def own_columns(df: DataFrame, *but: str) -> list[Column]:
    """The columns of `df` as they are, whatever dots their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in but]


def in_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow that workers can run wherever they were started: the package is sent before the call takes its list of files."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_whole(df: DataFrame, run, schema: StructType) -> DataFrame:
    """mapInArrow over all columns of df, whatever their names (dots break it there): `run` goes by position and keeps the
    names of its batches, and the result has `schema`."""
    ship(df.sparkSession)
    plain = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, plain).toDF(*schema.names)


def stored(df: DataFrame) -> DataFrame:
    """Written once to the shared folder and read back: what follows doesn't recompute it, and lost executors don't lose it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids that may be broadcast (some 50 MB); beyond it the join is shuffled.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """A broadcast of a stored table if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Rows of one key that a task may take beside the others before the key is spread.
HOT_ROWS = 256


def spread_join(many: DataFrame, one: DataFrame, key: str, by: Column, rows: int, counts: DataFrame | None = None) -> DataFrame:
    """Inner join of `many` with `one` (few rows a key) on `key`; a key with more rows than a task's even share is spread.

    `by` spreads the rows of such a key, `rows` is the size of `many` and `counts` (key, n) its rows a key if known.
    Hot keys have more than rows / partitions rows each, so there are fewer of them than shuffle partitions and their
    list may stand in the plan. Rows of `one` are copied once for each part of a hot key. The plan is one whether there are hot keys or not."""
    spark = many.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(HOT_ROWS, rows // parts)
    hot = []
    if rows > share:
        if counts is None:
            counts = many.groupBy(key).agg(F.count("*").alias("n"))
        hot = counts.filter(F.col("n") > share).select(key, "n").collect()
    salt = unused(many, unused(one, "salt"))
    dealt = F.when(F.col(key).isin([r[0] for r in hot]), max((-(-r[1] // share) for r in hot), default=1)).otherwise(1)
    left = many.withColumn(salt, F.pmod(by, dealt).cast("int"))
    right = one.withColumn(salt, F.explode(F.sequence(F.lit(0), dealt - 1)))
    return left.join(right, [key, salt]).drop(salt)


def unit_hash(*cols: Column) -> Column:
    """A repeatable number in [0, 1) for a row."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / F.lit(float(1 << 52))


def row_uid(doc_id: Column, text: Column) -> Column:
    """Identity of a row: rows with the same doc_id and text are one document and share every decision."""
    return F.xxhash64(doc_id, text)


def bounded_sample(rows: DataFrame, label: str, text: str, per_label: int, max_labels: int = 1000) -> DataFrame:
    """The rows of a bounded sample: some `per_label` different texts for each value of `label`, at least one, each once, with the least
    of its other values. Chosen by a hash of the text, so the choice is the same at every layout, and no class is lost whatever ids
    its rows have.

    One pre-aggregated count of rows for each label, a hash threshold and one minimum: no group meets in one task. The list of labels is
    a broadcast of at most `max_labels` rows; more labels are an error, not a silent cut."""
    u = unit_hash(F.col(text))
    counts = rows.groupBy(label).agg(F.count("*").alias("n"), F.min(u).alias("least")).limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} values of {label}")
    names = [c for c in rows.columns if c not in (label, text)]
    lines = rows.schema[label].dataType.simpleString()
    limits = rows.sparkSession.createDataFrame([(r[0], max(min(1.0, per_label / r[1]), r[2])) for r in counts], f"`{label}` {lines}, sample_limit double")
    picked = rows.join(F.broadcast(limits), label).filter(u <= F.col("sample_limit"))
    once = picked.groupBy(label, text).agg(*(F.min(c).alias(c) for c in names)) if names else picked.select(label, text).distinct()
    return once.select(*rows.columns)
