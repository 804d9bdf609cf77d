"""Incremental landing of API payload folders with Structured Streaming.

The reference refreshes by re-running its scripts by hand.  Here a folder that
keeps receiving landed JSON documents (one document per line) is read with the
streaming file source and parsed by the same parsers as the batch path; each
run appends only the documents that arrived since the last run, with
exactly-once output through the file sink's checkpoint.  ``trigger(availableNow)``
processes what is there and stops, so the job can be scheduled like a batch job
and still survive executor loss (the checkpoint and the output are in the shared
folder).
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.session import checkpoint_dir
from courtview.sources import payloads

# Parsers that are row-local (no window, no join with another stream) and so run on a stream as-is.
PARSERS = {
    "comments": payloads.comments,
    "video_stats": payloads.video_stats,
    "uploads": payloads.uploads_playlist,
    "search": payloads.channel_search,
}


def stream_payload_rows(spark: SparkSession, folder: str, kind: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of parsed rows from a folder of landed documents."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(folder).select(F.col("value").alias("json"))
    return PARSERS[kind](docs)


def land(spark: SparkSession, folder: str, kind: str, out_path: str, name: str | None = None) -> int:
    """Append the rows of documents not yet landed to ``out_path`` (Parquet); returns the documents read in the last
    100 batches (what Spark keeps of a query's progress).  Each pair of folders has a checkpoint of its own."""
    name = name or f"landing-{kind}-{hashlib.sha256(f'{folder}|{out_path}'.encode()).hexdigest()[:16]}"
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    q = (stream_payload_rows(spark, folder, kind).writeStream
         .format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.recentProgress
    return sum(int(p.get("numInputRows", 0)) for p in progress) if progress else 0
