"""Landed API payloads (JSON documents) -> rows.

The collection stage is not rebuilt (no HTTP); instead its responses are read
as landed JSON - folders of files, one document per request and line - with explicit schemas.  Nested
item lists are flattened with ``inline``/``posexplode``; leaf access is NULL-safe
and numbers arrive as text, so they go through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CHANNELS_PAGE = _st(("items", T.ArrayType(_st(
    ("id", S), ("snippet", _st(("title", S))), ("statistics", _st(("subscriberCount", S))),
    ("contentDetails", _st(("relatedPlaylists", _st(("uploads", S)))))))))
SEARCH_PAGE = _st(("query", S), ("page", T.LongType()), ("items", T.ArrayType(_st(
    ("id", _st(("channelId", S))), ("snippet", _st(("title", S), ("description", S)))))))
PLAYLIST_PAGE = _st(("channel_id", S), ("page", T.LongType()), ("nextPageToken", S), ("items", T.ArrayType(_st(
    ("contentDetails", _st(("videoId", S), ("videoPublishedAt", S))),
    ("snippet", _st(("channelTitle", S), ("title", S), ("description", S)))))))
STATS_PAGE = _st(("items", T.ArrayType(_st(
    ("id", S), ("statistics", _st(("viewCount", S), ("likeCount", S), ("commentCount", S))),
    ("contentDetails", _st(("duration", S)))))))
_COMMENT = _st(("id", S), ("snippet", _st(("textDisplay", S), ("likeCount", S), ("publishedAt", S))))
COMMENTS_PAGE = _st(("video_id", S),
                    ("items", T.ArrayType(_st(("snippet", _st(("topLevelComment", _COMMENT),)),))))


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a landed folder, one line each, as a text column ``json``."""
    return spark.read.text(folder).select(F.col("value").alias("json"))


def parse(docs: DataFrame, schema: T.StructType, col: str = "json") -> DataFrame:
    """JSON text column -> struct column ``doc``; malformed documents give NULL (0 rows downstream)."""
    return docs.select(F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("doc"))


# ---------------------------------------------------------------------------
# parsers
# ---------------------------------------------------------------------------
def channel_check(docs: DataFrame, requested: DataFrame) -> DataFrame:
    """One row per requested channel id: title, subscriber count, valid flag (empty items -> invalid)."""
    p = parse(docs, CHANNELS_PAGE).where(F.col("doc").isNotNull())
    first = p.select(F.get(F.col("doc.items"), 0).alias("it"), F.size("doc.items").alias("n"))
    found = first.where(F.col("n") > 0).select(
        F.col("it.id").alias("checked_channel_id"), F.col("it.snippet.title").alias("channel_title"),
        F.col("it.statistics.subscriberCount").try_cast("double").alias("subscriber_count"))
    found = found.withColumn("valid_channel", F.lit(True))
    out = requested.select(F.col("channel_id").alias("checked_channel_id")).join(found, "checked_channel_id", "left")
    return out.withColumn("valid_channel", F.coalesce(F.col("valid_channel"), F.lit(False)))


def uploads_playlist(docs: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """(channel_id, uploads) from channel pages; with ``requested``, one row per requested id, NULL for an empty page."""
    p = parse(docs, CHANNELS_PAGE).where(F.col("doc").isNotNull())
    it = F.get(F.col("doc.items"), 0)  # NULL-safe, unlike items[0] under ANSI
    found = p.where(F.size("doc.items") > 0).select(
        it.getField("id").alias("channel_id"),
        it.getField("contentDetails").getField("relatedPlaylists").getField("uploads").alias("uploads_playlist_id"))
    return found if requested is None else requested.select("channel_id").join(found, "channel_id", "left")


def channel_search(docs: DataFrame, max_results: int = 5) -> DataFrame:
    """Search pages -> (query, channel_title, channel_id, channel_description), at most ``max_results`` per query.

    They come from the query's first page (page 0, or the only one of a query without page numbers).
    """
    p = parse(docs, SEARCH_PAGE).where(F.col("doc").isNotNull() & (F.coalesce("doc.page", F.lit(0)) == 0))
    ex = p.select(F.col("doc.query").alias("query"), F.posexplode("doc.items").alias("pos", "it"))
    return ex.where(F.col("pos") < max_results).select(
        "query", F.col("it.snippet.title").alias("channel_title"), F.col("it.id.channelId").alias("channel_id"),
        F.col("it.snippet.description").alias("channel_description"))


def playlist_items(docs: DataFrame, max_results: int = 100) -> DataFrame:
    """Each channel's upload list in page then position order, first ``max_results`` kept.

    A list is read as a client pages through it: it ends before its first empty page, and with its first page that names no
    next page. The end of each list is found from its pages' numbers alone.
    """
    from courtview.operators.shape import top_n_per_group
    p = parse(docs, PLAYLIST_PAGE).where(F.col("doc").isNotNull())
    page, empty = F.col("doc.page"), F.coalesce(F.size("doc.items"), F.lit(0)) <= 0
    ends = p.groupBy(F.col("doc.channel_id").alias("_channel")).agg(
        F.min(F.when(empty, page)).alias("_empty"), F.min(F.when(F.col("doc.nextPageToken").isNull(), page)).alias("_last"))
    p = p.join(ends, F.col("doc.channel_id").eqNullSafe(F.col("_channel"))).where(
        (F.col("_empty").isNull() | (page < F.col("_empty"))) & (F.col("_last").isNull() | (page <= F.col("_last"))))
    ex = p.select(F.col("doc.channel_id").alias("channel_id"), F.col("doc.page").alias("page"),
                  F.posexplode("doc.items").alias("pos", "it"))
    kept = top_n_per_group(ex, ["channel_id"], [F.col("page"), F.col("pos")], max_results)
    return kept.select(
        "channel_id", F.col("it.contentDetails.videoId").alias("video_id"),
        F.col("it.contentDetails.videoPublishedAt").alias("published_at"),
        F.col("it.snippet.channelTitle").alias("channel_title"), F.col("it.snippet.title").alias("video_title"),
        F.col("it.snippet.description").alias("video_description"))


def upload_pages(docs: DataFrame) -> DataFrame:
    """Per-row nested tables (upload-list pages) to rows, outer columns repeated, no cap: (channel_id, page, video_id)."""
    p = parse(docs, PLAYLIST_PAGE)
    return p.select(F.col("doc.channel_id").alias("channel_id"), F.col("doc.page").alias("page"),
                    F.inline("doc.items")).select("channel_id", "page", F.col("contentDetails.videoId").alias("video_id"))


def video_stats(docs: DataFrame) -> DataFrame:
    """Stats pages -> (video_id, view_count, like_count, comment_count, duration); absent leaf -> NULL."""
    p = parse(docs, STATS_PAGE).where(F.col("doc").isNotNull())
    ex = p.select(F.inline("doc.items"))
    return ex.select(
        F.col("id").alias("video_id"),
        F.col("statistics.viewCount").try_cast("bigint").alias("view_count"),
        F.col("statistics.likeCount").try_cast("bigint").alias("like_count"),
        F.col("statistics.commentCount").try_cast("bigint").alias("comment_count"),
        F.col("contentDetails.duration").alias("duration"))


def comments(docs: DataFrame) -> DataFrame:
    """Comment-thread pages -> one row per top-level comment; bad or empty payloads give 0 rows."""
    p = parse(docs, COMMENTS_PAGE).where(F.col("doc").isNotNull())
    ex = p.select(F.col("doc.video_id").alias("video_id"), F.explode("doc.items").alias("it"))
    c = F.col("it.snippet.topLevelComment")
    return ex.select(
        "video_id", c.getField("id").alias("comment_id"),
        c.getField("snippet").getField("textDisplay").alias("comment_text"),
        c.getField("snippet").getField("likeCount").try_cast("bigint").alias("comment_like_count"),
        c.getField("snippet").getField("publishedAt").alias("comment_published_at"))
