"""What a session needs before it runs this package's Python on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


#: Tasks for each core over which rows are dealt.
TASKS_A_CORE = 3


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """Rows dealt over all cores by a hash of `by`, before work that is dear for each row: a table of one file, or of few row groups, would be
    read by as many tasks, whatever its size."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, *by)


def cut_lineage(df: DataFrame) -> DataFrame:
    """df computed once and checkpointed to the shared folder in spark.checkpoint.dir, for loops whose plans would grow; a
    folder of our own only where that is unset and all is on one machine."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(path or "file://" + tempfile.mkdtemp(prefix="ledgerline-"))
    return df.checkpoint()
