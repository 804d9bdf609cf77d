"""Payload files for the ``json_*`` queries: the driver's tables landed once as folders of JSON documents.

The library parses documents that a collection job has landed; there are none among the given tables, so this step, outside
the library, lands them with Spark: ``landed(spark, sf_dir, kind)`` writes the folder of a kind once for each application
and state of the tables. No page can hold more than ``page_size`` items, whatever the id format and however skewed the
channels or videos are. Where the order of the items matters (upload lists, searches), narrow keys are numbered by a distributed
global index and a page is index div page size; elsewhere a page is a run of rows of one task, without any sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtview.functions.dates import parse_ts
from courtview.operators.shape import with_global_index
from courtview.plans.staged import raw_videos
from courtview.session import configure, delete_at_exit, input_state, scratch_path
from courtview.sources import bindings as B
from courtview.sources.payloads import CHANNELS_PAGE

_landed: dict[tuple, str] = {}


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The folder of landed documents of a kind: channels, search, playlist, stats or comments."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), input_state(spark, sf_dir), kind)
    if key not in _landed:
        docs = {"channels": lambda: channel_pages(B.commerce_channels(spark, sf_dir)), "search": lambda: search_pages(B.commerce_channels(spark, sf_dir)),
                "playlist": lambda: playlist_pages(raw_videos(spark, sf_dir, "commerce")), "stats": lambda: stats_pages(raw_videos(spark, sf_dir, "commerce")),
                "comments": lambda: comment_pages(B.content_comments(spark, sf_dir))}[kind]()
        path = scratch_path(spark, f"payloads-{kind}")
        docs.write.text(path)
        delete_at_exit(spark, path)
        _landed[key] = path
    return _landed[key]


def _paged(df: DataFrame, keys: list[str], order: list, page_size: int) -> DataFrame:
    """``df`` with row_index and page; ``keys`` (the first one unique) are all that is sorted."""
    from courtview.operators.shape import with_global_index
    idx = with_global_index(df.select(*keys), [F.col(c) if isinstance(c, str) else c for c in order])
    numbered = idx.select(keys[0], "row_index", F.floor(F.col("row_index") / page_size).alias("page"))
    return df.join(numbered, keys[0])


def _runs(df: DataFrame, page_size: int) -> DataFrame:
    """``df`` with ``page``: runs of ``page_size`` rows of one task."""
    return df.withColumn("page", F.floor(F.monotonically_increasing_id() / page_size))


def _sorted_items(item: F.Column, sort_key: F.Column) -> F.Column:
    pairs = F.array_sort(F.collect_list(F.struct(sort_key.alias("k"), item.alias("v"))))
    return F.transform(pairs, lambda e: e["v"])


def stats_pages(videos_raw: DataFrame, page_size: int = 50) -> DataFrame:
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(F.col("view_count").cast("string").alias("viewCount"),
                 F.col("like_count").cast("string").alias("likeCount"),
                 F.col("comment_count").cast("string").alias("commentCount")).alias("statistics"),
        F.struct(F.col("duration").alias("duration")).alias("contentDetails"))
    g = _runs(videos_raw, page_size).groupBy("page").agg(
        _sorted_items(item, F.col("video_id")).alias("items"))
    return g.select(F.to_json(F.struct("items")).alias("json"))


def comment_pages(comments_df: DataFrame, page_size: int = 50) -> DataFrame:
    """Comment-thread pages: at most ``page_size`` comments of one video per page."""
    item = F.struct(F.struct(F.struct(
        F.col("comment_id").alias("id"),
        F.struct(F.col("comment_text").alias("textDisplay"),
                 F.col("comment_like_count").cast("string").alias("likeCount"),
                 F.col("comment_published_at").alias("publishedAt")).alias("snippet")
    ).alias("topLevelComment")).alias("snippet"))
    g = _runs(comments_df, page_size).groupBy("video_id", "page").agg(
        _sorted_items(item, F.col("comment_id")).alias("items"))
    return g.select(F.to_json(F.struct("video_id", "items")).alias("json"))


def channel_pages(channels: DataFrame) -> DataFrame:
    """One channels-endpoint document per channel; channels without subscribers answer with no items."""
    item = F.struct(
        F.col("channel_id").alias("id"), F.struct(F.col("channel_name").alias("title")).alias("snippet"),
        F.struct(F.col("subscribers").cast("string").alias("subscriberCount")).alias("statistics"),
        F.struct(F.struct(F.concat(F.lit("UU"), F.col("channel_id")).alias("uploads")).alias("relatedPlaylists"))
        .alias("contentDetails"))
    items = F.when(F.col("subscribers") > 0, F.array(item)).otherwise(F.array().cast(T.ArrayType(item_type())))
    return channels.select(F.to_json(F.struct(items.alias("items"))).alias("json"))


def item_type() -> T.StructType:
    return CHANNELS_PAGE["items"].dataType.elementType


def search_pages(channels: DataFrame, page_size: int = 50) -> DataFrame:
    """Search documents of a conference: its channels by id, at most ``page_size`` a page, pages numbered from 0."""
    item = F.struct(F.struct(F.col("channel_id").alias("channelId")).alias("id"),
                    F.struct(F.col("channel_name").alias("title"), F.col("team").alias("description")).alias("snippet"))
    idx = with_global_index(channels.select("channel_id", "conference"), [F.col("conference"), F.col("channel_id")])
    first = idx.groupBy("conference").agg(F.min("row_index").alias("_first"))
    placed = idx.join(first, "conference").select(
        "channel_id", "row_index", F.floor((F.col("row_index") - F.col("_first")) / page_size).alias("page"))
    g = channels.join(placed, "channel_id").groupBy("conference", "page").agg(_sorted_items(item, F.col("row_index")).alias("items"))
    return g.select(F.to_json(F.struct(F.col("conference").alias("query"), "page", "items")).alias("json"))


def playlist_pages(videos_raw: DataFrame, page_size: int = 50) -> DataFrame:
    """Upload-list pages per channel, newest first, at most ``page_size`` per page; all but a channel's last name the next one."""
    item = F.struct(
        F.struct(F.col("video_id").alias("videoId"), F.col("published_at").alias("videoPublishedAt")).alias("contentDetails"),
        F.struct(F.col("channel_title").alias("channelTitle"), F.col("video_title").alias("title"),
                 F.col("video_description").alias("description")).alias("snippet"))
    paged = _paged(videos_raw, ["video_id", "channel_id", "published_at"],
                   ["channel_id", parse_ts("published_at").desc_nulls_last(), "video_id"], page_size)
    last = paged.groupBy(F.col("channel_id").alias("_channel")).agg(F.max("page").alias("_last"))
    g = paged.groupBy("channel_id", "page").agg(_sorted_items(item, F.col("row_index")).alias("items"))
    token = F.when(F.col("page") < F.col("_last"), F.concat(F.lit("page-"), (F.col("page") + 1).cast("string")))
    g = g.join(last, F.col("channel_id").eqNullSafe(F.col("_channel"))).withColumn("nextPageToken", token)
    return g.select(F.to_json(F.struct("channel_id", "page", "nextPageToken", "items")).alias("json"))
