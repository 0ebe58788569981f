"""Columns of vectors: validity, integer components and batches as matrices, for the operators on embeddings.

A vector counts if it is not null and has neither null nor non-finite components. All vectors that count must have one length
(else ValueError); a table without any has length 0. Components are scaled to integers by floor(scale * x) in doubles, which is exact
while they stay under 2**53; ``limit`` is what an operator's own sums allow, and a component beyond it is an error, not a wrong result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ship


def counts(vec: Column) -> Column:
    """Is it a vector without null, NaN and infinite components?"""
    return vec.isNotNull() & ~F.coalesce(F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))


def usable(df: DataFrame, vec: str, **others: Column) -> DataFrame:
    """`others`, then `vec` as doubles, of the rows whose vector counts."""
    ship(df.sparkSession)
    v = F.col(vec).cast("array<double>")
    return df.select(*(c.alias(n) for n, c in others.items()), v.alias("vec")).filter(counts(F.col("vec")))


def length(rows: DataFrame) -> int:
    """The one length of the vectors of `rows` (of usable())."""
    lo, hi = rows.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if lo != hi:
        raise ValueError(f"vectors of {lo} to {hi} components in one column")
    return lo or 0


def matrix(vecs: pa.Array, scale: int, limit: int) -> np.ndarray:
    """rows x length, the integers floor(scale * x) as int64."""
    rows = len(vecs)
    x = np.floor(scale * vecs.flatten().to_numpy(zero_copy_only=False)).reshape(rows, -1) if rows else np.zeros((0, 0))
    if x.size and np.abs(x).max() > limit:
        raise ValueError(f"a component is beyond {limit} after scaling by {scale}")
    return x.astype(np.int64)


#: So many tasks' partial sums of a key are added in one step; those of more tasks first within so many groups, then over them.
SUM_GROUPS = 64
ONE_STEP = 256


def summed(partials: DataFrame, *keys: str) -> DataFrame:
    """Totals of column `v` of tasks' partial sums by `keys`, in two steps where there are many tasks, so that no task meets the rows of all of them.
    `partials` is read from files, so its number of tasks is known without a job."""
    if partials.rdd.getNumPartitions() <= ONE_STEP:
        return partials.groupBy(*keys).agg(F.sum("v").alias("v"))
    part = partials.withColumn("lot", F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS)))
    return part.groupBy("lot", *keys).agg(F.sum("v").alias("v")).groupBy(*keys).agg(F.sum("v").alias("v"))
