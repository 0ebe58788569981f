"""Order-dependent operators: first wins, top k, batches, counters with ties, running context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. A partial minimum runs before the exchange (a limit inside the window), so a hot key
    sends one row for each task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, unique: str | None = None) -> DataFrame:
    """The first k rows of each key, after keeping the first row of each `unique` value; `rank` counts from 1."""
    if unique:
        df = first_wins(df, [*keys, unique], order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def batch(df: DataFrame, order: Sequence[Column | str], offset: int, limit: int | None) -> DataFrame:
    """A slice of a total order; a negative offset counts as 0."""
    out = df.orderBy(*order).offset(max(0, offset))
    return out if limit is None else out.limit(limit)


def numbered(df: DataFrame, order: Sequence[str | Column], out: str = "pos") -> DataFrame:
    """All rows numbered from 1 without a gap in the given order, nulls of columns given by name last; rows and files come in that order too.

    The rows are dealt by range and sorted within, and a range's first number is the sum of the counts before it: one exchange of the rows, and one count a range on
    the driver. Rows that are equal in the order are told apart by their place in the input, so they are spread like others (and their numbers may
    differ from run to run: give a total order). The sorted rows are checkpointed, so that all ranges stay as they were counted. An empty table stays empty."""
    tie, at = _unused(df, "tie"), _unused(df, "at")
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys, F.col(tie)).sortWithinPartitions(*keys, F.col(tie)).drop(tie)
    # the id holds the range above its 33 low bits and the row's place below
    rows = cut_lineage(rows.withColumn(at, F.monotonically_increasing_id()))
    part, place = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("part")).count().collect()
    first, offsets = 0, []
    for r in sorted(counts):
        offsets.append((r["part"], first))
        first += r["count"]
    firsts = df.sparkSession.createDataFrame(offsets, "__part long, __first long")
    return rows.join(F.broadcast(firsts), part == F.col("__part")).withColumn(out, F.col("__first") + place + 1).drop(at, "__part", "__first")


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def most_common(df: DataFrame, key: str, pos: str, k: int) -> DataFrame:
    """The k commonest values; ties go to the one seen first."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos"))
    return counts.orderBy(F.desc("n"), "first_pos").limit(k)


def latest(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The row of each key with the greatest order, by a partial maximum and no sort."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(*order)).alias("r")).select(key, "r.*")


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column, out: str) -> DataFrame:
    """The last value that isn't null at or before each row (day or city headings over the lines below them)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, back: int, ahead: int) -> DataFrame:
    """Values of the rows before and after, as columns prev_1.. and next_1.. ."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"prev_{i}": F.lag(value, i).over(w) for i in range(1, back + 1)} | {f"next_{i}": F.lead(value, i).over(w) for i in range(1, ahead + 1)})


def unique_in_order(c: Column, limit: int | None = None) -> Column:
    out = F.array_distinct(F.filter(c, lambda x: x.isNotNull() & (x != "")))
    return out if limit is None else F.slice(out, 1, limit)


def issue_counters(issues: DataFrame) -> DataFrame:
    """Counts by code, code and fellowship, code and source, in one pass. `level` names the grouping."""
    sets = issues.groupingSets([["code"], ["code", "fellowship"], ["code", "source_id"]], "code", "fellowship", "source_id")
    gid = F.grouping_id("code", "fellowship", "source_id")
    out = sets.agg(F.count("*").alias("n"), gid.alias("g"))
    return out.select("code", "fellowship", "source_id", F.when(F.col("g") == 3, "code").when(F.col("g") == 1, "fellowship").otherwise("source").alias("level"), "n")


def missing_streaks(runs: DataFrame, key: str, run: str, seen: Column) -> DataFrame:
    """For each key and run, how many runs in a row it has been missing, counted within its own history."""
    w = Window.partitionBy(key).orderBy(run)
    marked = runs.withColumn("__seen", seen.cast("int")).withColumn("__grp", F.sum("__seen").over(w))
    inside = Window.partitionBy(key, "__grp").orderBy(run)
    return marked.withColumn("missing_run_count", F.row_number().over(inside) - F.when(F.col("__grp") > 0, 1).otherwise(0)).drop("__seen", "__grp")
