"""Helpers shared by the operators: text keys, written intermediate tables, distributed row numbers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtview.session import checkpoint_dir, delete_at_exit, materialize, scratch_path

__all__ = ["checkpoint_dir", "materialize", "scratch_path", "text_key", "read_table", "discard", "small_batches",
           "ordered_positions", "scratch_scope", "write_scratch"]

ARROW_ROWS = "512"


def text_key(col: Column) -> Column:
    """16-byte identity of a text (half of its SHA-256); null texts count as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256)), 1, 16)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few hundred rows: texts may be very long, and a Python worker holds one batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


_open_scopes: list[list[str]] = []


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared checkpoint folder and read back, with its path (see ``discard``).

    It lasts as long as the application, or the ``scratch_scope`` it is written in.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(df.sparkSession, path)
    if _open_scopes:
        _open_scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """The paths that ``write_scratch`` writes meanwhile; those still in the list at the end are deleted."""
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield paths
    finally:
        _open_scopes.remove(paths)
        discard(spark, *paths)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete written intermediate tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def ordered_positions(df: DataFrame, order: list[str], partitions: int, name: str) -> tuple[DataFrame, int, str]:
    """``df`` with ``__pos``: the gapless 0-based rank of each row in the total order of ``order`` (nulls last).

    Rows are dealt by range and sorted, the ids that Spark numbers partitions and rows with are written beside
    them, and the counts of the partitions (one row each) give the offsets: no single task sees all rows.
    Rows that tie in ``order`` are split by a hash of a row number, so that a hot value spreads over partitions.
    Returns the frame, the number of rows and the path of the written table.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    keyed = df.withColumn("__tie", tie)
    cols = [F.col(c).asc_nulls_last() for c in order] + [F.col("__tie").asc()]
    dealt = keyed.repartitionByRange(partitions, *cols).sortWithinPartitions(*cols)
    numbered = dealt.withColumn("__row", F.monotonically_increasing_id()).drop("__tie")
    written, path = write_scratch(numbered, name)
    part = F.shiftright("__row", 33).cast("int")
    counts = written.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets, _ = write_scratch(counts.select("__part", "__n", F.coalesce(before, F.lit(0)).alias("__before")), f"{name}-parts")
    total = offsets.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    positioned = (written.withColumn("__part", part)
                  .join(F.broadcast(offsets.drop("__n")), "__part")  # as many rows as partitions
                  .withColumn("__pos", F.col("__before") + F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)))
                  .drop("__part", "__before", "__row"))
    return positioned, total, path
