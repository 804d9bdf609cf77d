"""Named report queries over the staged table (SQL report family and QA summaries).

Each function takes the staged DataFrame (and params where a threshold is
involved) and returns a DataFrame.  Ratios are ratios of sums; every division
is NULL-safe; top-k sorts carry ``video_id`` as a unique tiebreak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.functions.numeric import mean, round_to, weighted_rate
from courtview.functions.text import priority_rank
from courtview.params import PRIORITY_STANDARD, Params


def _r(col: str, digits: int, alias: str | None = None) -> F.Column:
    return round_to(col, digits).alias(alias or col)


def _avg(col: str, digits: int, alias: str) -> F.Column:
    return round_to(mean(col), digits).alias(alias)


def _wer() -> F.Column:
    return weighted_rate(F.sum("engagement_count"), F.sum("view_count")).alias("weighted_engagement_rate")


def _n() -> F.Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------------------
# practice queries
# ---------------------------------------------------------------------------
def q00_preview(stg: DataFrame, n: int = 10) -> DataFrame:
    return stg.orderBy("video_id").limit(n)


def q00_top_viewed(stg: DataFrame, k: int = 20) -> DataFrame:
    return (stg.orderBy(F.desc_nulls_last("view_count"), "video_id").limit(k)
            .select("team", "video_title", "view_count", "like_count_clean", "comment_count_clean"))


def q00_team_kpi(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("team").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("engagement_count").alias("total_engagements"), _wer())
        .orderBy(F.desc_nulls_last("total_views")))


def s05_team_kpi(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("team").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("like_count_clean").alias("total_likes"), F.sum("comment_count_clean").alias("total_comments"),
        F.sum("engagement_count").alias("total_engagements"), _wer(),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"))
        .orderBy(F.desc_nulls_last("total_views")))


def s05_content_perf(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("content_type").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("engagement_count").alias("total_engagements"), _wer(),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))
        .orderBy(F.desc_nulls_last("total_views")))


def s05_monitoring(stg: DataFrame) -> DataFrame:
    return (stg.where(F.col("monitoring_priority") != PRIORITY_STANDARD)
            .orderBy(F.desc_nulls_last("view_count"), "video_id")
            .select("team", "video_title", "content_type", "message_theme", "view_count",
                    _r("engagement_rate", 4), _r("negative_comment_pct", 4), "monitoring_priority"))


# ---------------------------------------------------------------------------
# analysis queries
# ---------------------------------------------------------------------------
def q01_exec_kpi(stg: DataFrame) -> DataFrame:
    return stg.agg(
        _n().alias("total_videos"), F.countDistinct("team").alias("total_teams"),
        F.sum("view_count").alias("total_views"), F.sum("like_count_clean").alias("total_likes"),
        F.sum("comment_count_clean").alias("total_comments"), F.sum("engagement_count").alias("total_engagements"),
        _wer(), _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"),
        _avg("positive_comment_pct", 4, "avg_positive_comment_pct"),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))


def q01_team_perf(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("team", "conference").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("like_count_clean").alias("total_likes"), F.sum("comment_count_clean").alias("total_comments"),
        F.sum("engagement_count").alias("total_engagements"), _wer(),
        _avg("views_per_day", 2, "avg_views_per_day"),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"),
        _avg("positive_comment_pct", 4, "avg_positive_comment_pct"),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))
        .orderBy(F.desc_nulls_last("total_views")))


def q01_content_perf(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("content_type").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("engagement_count").alias("total_engagements"), _wer(),
        _avg("views_per_day", 2, "avg_views_per_day"),
        _avg("comments_per_1k_views", 2, "avg_comments_per_1k_views"),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"),
        _avg("positive_comment_pct", 4, "avg_positive_comment_pct"),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))
        .orderBy(F.desc_nulls_last("total_views")))


def q01_theme_perf(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("message_theme").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        F.sum("engagement_count").alias("total_engagements"), _wer(),
        _avg("views_per_day", 2, "avg_views_per_day"),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))
        .orderBy(F.desc_nulls_last("total_views")))


def q01_top_views(stg: DataFrame, k: int = 25) -> DataFrame:
    return (stg.orderBy(F.desc_nulls_last("view_count"), "video_id").limit(k)
            .select("team", "video_title", "content_type", "message_theme", "published_date", "view_count",
                    "like_count_clean", "comment_count_clean", "engagement_count",
                    _r("engagement_rate", 4), _r("avg_comment_sentiment", 4)))


def q01_top_engagement(stg: DataFrame, params: Params, k: int = 25) -> DataFrame:
    """Minimum-views filter, then top-k by the *rounded* rate (ORDER BY binds to the alias)."""
    return (stg.where(F.col("view_count") >= params.min_views)
            .select("video_id", "team", "video_title", "content_type", "message_theme", "published_date",
                    "view_count", "engagement_count", _r("engagement_rate", 4),
                    _r("positive_comment_pct", 4), _r("negative_comment_pct", 4))
            .orderBy(F.desc_nulls_last("engagement_rate"), "video_id").limit(k)
            .drop("video_id"))


def _sentiment_summary(stg: DataFrame, key: str) -> DataFrame:
    return (stg.groupBy(key).agg(
        _n().alias("total_videos"),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"),
        _avg("positive_comment_pct", 4, "avg_positive_comment_pct"),
        _avg("neutral_comment_pct", 4, "avg_neutral_comment_pct"),
        _avg("negative_comment_pct", 4, "avg_negative_comment_pct"))
        .orderBy(F.desc_nulls_last("avg_comment_sentiment")))


def q01_sentiment_team(stg: DataFrame) -> DataFrame:
    return _sentiment_summary(stg, "team")


def q01_sentiment_content(stg: DataFrame) -> DataFrame:
    return _sentiment_summary(stg, "content_type")


def q01_monitoring(stg: DataFrame) -> DataFrame:
    """Not Standard; CASE rank of the priority, then views."""
    return (stg.where(F.col("monitoring_priority") != PRIORITY_STANDARD)
            .orderBy(priority_rank("monitoring_priority"), F.desc_nulls_last("view_count"), "video_id")
            .select("team", "video_title", "content_type", "message_theme", "published_date", "view_count",
                    _r("engagement_rate", 4), _r("negative_comment_pct", 4), _r("avg_comment_sentiment", 4),
                    "monitoring_priority"))


def q01_hour_perf(stg: DataFrame, params: Params) -> DataFrame:
    return (stg.groupBy("published_hour").agg(
        _n().alias("total_videos"), F.sum("view_count").alias("total_views"),
        _avg("views_per_day", 2, "avg_views_per_day"), _wer(),
        _avg("avg_comment_sentiment", 4, "avg_comment_sentiment"))
        .where(F.col("total_videos") >= params.min_group)
        .orderBy(F.desc_nulls_last("avg_views_per_day")))


# ---------------------------------------------------------------------------
# export queries
# ---------------------------------------------------------------------------
def q02_video_export(stg: DataFrame) -> DataFrame:
    return stg.select(
        "video_id", "team", "team_abbreviation", "conference", "channel_title", "video_title", "published_date",
        "published_hour", "published_month", "duration", "content_type", "message_theme", "view_count",
        "like_count_clean", "comment_count_clean", "engagement_count", _r("engagement_rate", 4),
        _r("likes_per_1k_views", 2), _r("comments_per_1k_views", 2), _r("views_per_day", 2), "comments_pulled",
        _r("avg_comment_sentiment", 4), _r("positive_comment_pct", 4), _r("neutral_comment_pct", 4),
        _r("negative_comment_pct", 4), "sentiment_bucket", "monitoring_priority")


def q02_monitoring_export(stg: DataFrame) -> DataFrame:
    return (stg.where(F.col("monitoring_priority") != PRIORITY_STANDARD)
            .orderBy(F.desc_nulls_last("view_count"), "video_id")
            .select("team", "video_title", "content_type", "message_theme", "published_date", "view_count",
                    "engagement_count", _r("engagement_rate", 4), _r("views_per_day", 2),
                    _r("positive_comment_pct", 4), _r("negative_comment_pct", 4), _r("avg_comment_sentiment", 4),
                    "monitoring_priority"))


def s06_monitoring(stg: DataFrame) -> DataFrame:
    return (stg.where(F.col("monitoring_priority") != PRIORITY_STANDARD)
            .orderBy(F.desc_nulls_last("view_count"), "video_id")
            .select("team", "video_title", "content_type", "message_theme", "published_date", "view_count",
                    _r("engagement_rate", 4), _r("negative_comment_pct", 4), _r("avg_comment_sentiment", 4),
                    "monitoring_priority"))


# ---------------------------------------------------------------------------
# QA summaries printed by the scripts
# ---------------------------------------------------------------------------
def qa_raw(videos_raw: DataFrame) -> DataFrame:
    return videos_raw.agg(
        _n().alias("total_videos"), F.countDistinct("team").alias("teams"),
        F.coalesce(F.sum("view_count"), F.lit(0)).alias("total_views"),
        F.coalesce(F.sum("like_count"), F.lit(0)).alias("total_likes"),
        F.coalesce(F.sum("comment_count"), F.lit(0)).alias("total_comments"),
        F.count_if(F.col("view_count").isNull()).alias("missing_view_count"),
        F.count_if(F.col("like_count").isNull()).alias("missing_like_count"),
        F.count_if(F.col("comment_count").isNull()).alias("missing_comment_count"))


def _shown(df: DataFrame, k: int | None) -> DataFrame:
    """The whole table, or the first ``k`` rows for a display."""
    return df if k is None else df.limit(k)


def qa_raw_list(videos_raw: DataFrame, k: int | None = None) -> DataFrame:
    return (_shown(videos_raw.orderBy(F.desc_nulls_last("view_count"), "video_id"), k)
            .select("team", "video_title", "published_at", "view_count", "like_count", "comment_count", "duration"))


def qa_negative(summary: DataFrame, k: int | None = None) -> DataFrame:
    return _shown(summary.orderBy(F.desc_nulls_last("negative_comment_pct"), "video_id"), k)


def qa_clean(stg: DataFrame) -> DataFrame:
    return stg.agg(
        _n().alias("total_videos"), F.countDistinct("team").alias("teams"),
        F.coalesce(F.sum("view_count"), F.lit(0)).alias("total_views"),
        F.coalesce(F.sum("engagement_count"), F.lit(0)).alias("total_engagements"),
        round_to(mean("engagement_rate"), 8).alias("avg_engagement_rate"),
        round_to(mean("avg_comment_sentiment"), 8).alias("avg_sentiment"))


def count_sorted(df: DataFrame, key: str) -> DataFrame:
    """Frequency table, most frequent first (``count(x, sort = TRUE)``)."""
    return df.groupBy(key).agg(_n().alias("n")).orderBy(F.desc("n"), key)


def qa_types(stg: DataFrame) -> DataFrame:
    return count_sorted(stg, "content_type")


def qa_themes(stg: DataFrame) -> DataFrame:
    return count_sorted(stg, "message_theme")


def qa_priorities(stg: DataFrame) -> DataFrame:
    return count_sorted(stg, "monitoring_priority")


def qa_fast(stg: DataFrame, k: int | None = None) -> DataFrame:
    return (_shown(stg.orderBy(F.desc_nulls_last("views_per_day"), "video_id"), k)
            .select("team", "video_title", "content_type", "message_theme", "view_count", "views_per_day",
                    "engagement_rate", "negative_comment_pct", "monitoring_priority"))


def qa_count_by_team(videos: DataFrame) -> DataFrame:
    return (videos.groupBy("team").agg(_n().alias("videos_collected"))
            .orderBy(F.asc_nulls_last("team")))


def cat_rowcount(stg: DataFrame) -> DataFrame:
    return stg.agg(_n().alias("total_rows"))
