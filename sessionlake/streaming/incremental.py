"""Keep a canonical conversations table current as new transcript files land.

The original tool re-reads every file on each query. Here a Structured
Streaming file source picks up *new* files, and each micro-batch runs exactly
the batch normaliser over them (``foreachBatch``), appending to a parquet
table. A micro-batch holds whole files, so per-file rules (line numbers,
back-fill, carry-forward) see complete files. Progress lives in the
checkpoint folder below the cluster's shared ``spark.checkpoint.dir``, so a
restarted or failed query resumes where it stopped. Each batch overwrites its
own ``batch=<id>`` folder, so a batch that is run again after a failure
replaces its earlier partial output instead of adding to it.
Files that grow after they were picked up are not re-read — session logs are
treated as complete when they appear."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sessionlake.session import checkpoint_dir
from sessionlake.sources.raw import text_stream


def ingest_transcripts(spark: SparkSession, input_glob: str, output: str, normalise: Callable[[DataFrame], DataFrame],
                       name: str = "transcripts", trigger_once: bool = False) -> StreamingQuery:
    """Stream ``input_glob`` (JSONL transcripts) through ``normalise`` (e.g.
    ``sessionlake.operators.claude.normalise``) into parquet at ``output``."""
    stream = (spark.readStream.format("text").option("lineSep", "\n").option("pathGlobFilter", "*.jsonl")
              .option("recursiveFileLookup", "true").load(input_glob).select("value", "_metadata"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = normalise(text_stream(batch))
        rows.write.mode("overwrite").partitionBy("source").parquet(f"{output.rstrip('/')}/batch={batch_id}")

    w = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()
