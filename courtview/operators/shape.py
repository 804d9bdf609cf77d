"""Row-shape operators: per-group top-n and caps, global row index, id batches,
unions, unpivot, distinct ids, membership filters.

Per-group limits use ``row_number() <= n`` over a partitioned window, which
Spark plans as a partial ``WindowGroupLimit`` before the shuffle: every task
keeps at most n rows per group, so a group holding a third of all rows sends
only n rows per task through the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtview.session import materialize
from courtview.sources.dated import between_dates, from_date, newest_first


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (ties broken by the caller's order columns)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def newest_per_team(videos: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` videos of each team (publication time desc, video_id as tiebreak)."""
    return top_n_per_group(videos, ["team"], [newest_first(videos), F.col("video_id")], n)


def cap_per_channel(videos: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` items of each channel's upload list (newest first), before any date filter."""
    return top_n_per_group(videos, ["channel_id"], [newest_first(videos), F.col("video_id")], cap)


def collection_window(videos: DataFrame, start: date, end: date, cap: int, n: int) -> DataFrame:
    """The collection chain in the reference's order: list cap -> closed date window -> newest n per team.

    Rows before ``start`` go first: a list is newest first, so they stand after every row of the window and take no place
    of it. Rows after ``end`` do take places, and go after the cap. On a date-clustered table older months are not read.
    """
    capped = cap_per_channel(from_date(videos, start), cap)
    return newest_per_team(between_dates(capped, start, end), n)


def with_global_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """A 0-based dense position in a total order, computed without a single-partition window.

    Range-partitioned sort, per-partition counts (one row per partition), prefix
    offsets over those counts, then index = offset + position inside the partition.
    The sorted rows are written once so partition membership cannot change between
    the count and the numbering (a retried task re-reads the same files).
    """
    tagged = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "global-index")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # over #partitions rows only
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("_pid", "_off", "_first")), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first")).drop("_pid", "_mid", "_off", "_first")


def id_batches(ids: DataFrame, id_col: str = "video_id", size: int = 50) -> DataFrame:
    """Distinct ids in id order, cut into consecutive groups of ``size``, each joined by commas."""
    distinct = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    idx = with_global_index(distinct, [F.col(id_col)])
    batched = idx.withColumn("batch", F.floor(F.col("row_index") / size) + 1)
    g = batched.groupBy("batch").agg(
        F.array_join(F.array_sort(F.collect_list(id_col)), ",").alias("ids"),  # at most `size` ids per group
        F.count(F.lit(1)).alias("n_ids"))
    return g


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables of one logical schema; columns missing from a table become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_ids(df: DataFrame, col: str = "video_id") -> DataFrame:
    return df.select(col).distinct()


def has_comments(videos: DataFrame) -> DataFrame:
    """Distinct ids of videos with a non-null, positive comment count."""
    return videos.where(F.col("comment_count").isNotNull() & (F.col("comment_count") > 0)).select("video_id").distinct()


def share_of_total(grouped: DataFrame, count_col: str = "n", name: str = "pct") -> DataFrame:
    """``n / sum(n)`` over an already-grouped (small) result."""
    return grouped.withColumn(name, F.col(count_col).cast("double") / F.sum(count_col).over(Window.partitionBy()))
