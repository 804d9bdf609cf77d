"""Inputs published once, bucketed by their key, so that later joins on the key read them in place.

A plain join of whole texts with their statistics sends every text through an exchange, in every build. Here the
texts cross one exchange when the copy is published; each build afterwards deals only the narrow side (a few numbers
for each key) to the buckets and streams the texts past a hash table of one bucket's numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from courtview.operators.broadcast import estimated_bytes
from courtview.session import delete_at_exit, input_state, scratch_path

#: Bytes of input for one bucket (one task of the join), in a bucket count no smaller than the shuffle's own.
BUCKET_BYTES = 256 * 1024 * 1024
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

_published: dict[tuple, str] = {}


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the shuffle has partitions, more where the input's size asks for it."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-(estimated_bytes(df) or 0) // BUCKET_BYTES))


def write_bucketed(df: DataFrame, key: str, name: str) -> str:
    """A table of ``df`` hash-bucketed by ``key``, one file for each bucket; its files last as long as the application."""
    spark, n = df.sparkSession, bucket_count(df)
    table, path = f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(df.sparkSession, f"bucketed-{name}")
    with unsorted_writes(spark):
        df.repartition(n, key).write.option("path", path).option("compression", "zstd").bucketBy(n, key).saveAsTable(table)
    delete_at_exit(spark, path)
    return table


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes of rows that are dealt by their bucket already: a task keeps its few files open instead of sorting the rows by bucket.

    A sort of whole texts spills once a bucket outgrows a task's memory. A task that meets more buckets than may be open
    sorts the rest, as Spark does by default.
    """
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, "2")  # one bucket a task, and one to spare
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


def bucketed_input(df: DataFrame, folder: str, key: str, name: str) -> DataFrame:
    """``df``, a projection of tables in ``folder``, read from its bucketed copy (one for each application and state of the folder)."""
    spark = df.sparkSession
    at = (spark.sparkContext.applicationId, folder.rstrip("/"), input_state(spark, folder), key, name)
    if at not in _published:
        _published[at] = write_bucketed(df, key, name)
    return spark.table(_published[at])


def attach(bucketed: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``bucketed`` left-joined with one narrow row for each key: only ``facts`` are dealt, the bucketed side is neither dealt nor sorted."""
    return bucketed.join(facts.hint("shuffle_hash"), key, "left")
