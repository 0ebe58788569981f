"""Runs as a stream: each micro-batch of captured records is one run merged into the stored tables.

The data model has no streams of its own; this is the batch merge under foreachBatch, so a restarted query repeats a batch
with the same result (the merge is keyed, and the batch id names the run)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline
from ..plans.store import Store


def merge_stream(records: DataFrame, store: Store, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merge a stream of candidate rows (with a `seen_at` text column) run by run."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        run = f"run-{batch_id}"
        done = store.exists("import_runs") and not store.read("import_runs").filter(f"run_id = '{run}'").isEmpty()
        if done or batch.isEmpty():
            return
        seen_at = batch.selectExpr("max(seen_at)").first()[0]
        candidates, flags = pipeline.ingest(batch.drop("seen_at"))
        pipeline.persist(store, run, seen_at, candidates, flags, batch.select("source_id").distinct())

    w = records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start()
