"""Resumable day-file ingest (S11) as a Structured Streaming job.

New raw files dropped into the raw folder are picked up once: the file source
records processed files in the checkpoint, each micro-batch aggregates whole
files (a file is never split across batches), and the batch is committed to the
store as one shard per file with dynamic partition overwrite. A replayed batch
rewrites the same shards with the same rows (idempotent), and a file of a day that
is already in the store, in another batch or much later, adds its own shard. ``trigger(availableNow=True)`` processes
what is there and stops. The shards written are entered in the store's manifest, which the batch ingest shares.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..sources.manifest import adopt, list_raw
from ..sources.raw import RAW_TEXT, shape_raw
from ..sources.store import aggregate_raw, write_store


def ingest_available(spark: SparkSession, raw_dir: str, store: str, checkpoint: str,
                     max_files_per_batch: int | None = None) -> int:
    """Process every raw file not seen before; returns the number of micro-batches run."""
    t0 = time.perf_counter()
    reader = (spark.readStream.schema(RAW_TEXT).option("sep", "\t").option("header", False)
                   .option("mode", "PERMISSIVE"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    text = reader.csv(raw_dir)
    rows = shape_raw(text)
    batches = []

    def commit(batch: DataFrame, batch_id: int) -> None:
        write_store(aggregate_raw(batch), store)
        batches.append(batch_id)

    q = (rows.writeStream.foreachBatch(commit)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    if batches:
        adopt(spark, list_raw(spark, raw_dir), store, time.perf_counter() - t0)
    return len(batches)
