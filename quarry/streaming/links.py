"""Link files arriving in a folder, cleaned with Structured Streaming.

The same column expressions as the batch job (``operators.links``) run on a
``readStream.text`` source; each micro-batch appends its distinct edges to a
Parquet edge table. Duplicates across micro-batches are removed when the
table is read for ranking (``edge_set``), so the stream needs no unbounded
de-duplication state. Progress lives in a checkpoint under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.links import clean_links, edge_set
from ..session import checkpoint_dir


def link_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(src, dst)`` rows from text files landing in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return clean_links(reader.load(folder))


def ingest_links(spark: SparkSession, folder: str, edge_table: str, name: str = "links", once: bool = True):
    """Append cleaned, per-batch-distinct edges to ``edge_table``.

    ``once=True`` processes every file present now and stops (``availableNow``);
    otherwise the query keeps running. Returns the StreamingQuery.
    """
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        edge_set(batch).write.mode("append").parquet(edge_table)

    writer = link_stream(spark, folder).writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")
    return writer.start()
