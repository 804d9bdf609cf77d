"""Video features: engagement, rates, timing, rule classes, buckets, p90 flags, priority.

``video_features`` is one projection over ``videos_raw`` left-joined with the
sentiment summary (both keyed by video_id, so the join is co-partitioned with
the summary's aggregation).  ``add_flags`` compares each row with two global
thresholds; the thresholds are scalars, so the comparison is a plain
projection - no join, no window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.functions.dates import date_parts, parse_ts
from courtview.functions.numeric import rate_per_day, safe_ratio, try_whole
from courtview.functions.text import html_decode, label_3way, lower, rules_first_match, squish
from courtview.operators.quantile import exact_quantiles
from courtview.params import (PRIORITY_BOTH, PRIORITY_ENGAGEMENT, PRIORITY_NEGATIVE, PRIORITY_STANDARD,
                              Params)
from courtview.schemas import STAGED_COLUMNS

SENTIMENT_FILL = {
    "positive_comment_pct": 0.0, "neutral_comment_pct": 0.0, "negative_comment_pct": 0.0,
    "avg_comment_sentiment": 0.0, "comments_pulled": 0,
}


SUMMARY_COLUMNS = ("comments_pulled", "avg_comment_sentiment", "positive_comment_pct", "neutral_comment_pct",
                   "negative_comment_pct")


def join_sentiment(videos_raw: DataFrame, summary: DataFrame | None) -> DataFrame:
    """Left join of the summary; it only counts for videos whose comments were pulled
    (non-null, positive comment_count), as in the collection step.

    ``summary=None`` means the summary columns were already joined by the binding
    (one aggregate for statistics and sentiment); they are masked the same way.
    """
    if summary is None:
        pulled = F.col("comment_count") > 0
        return videos_raw.withColumns({c: F.when(pulled, F.col(c)) for c in SUMMARY_COLUMNS})
    s = summary.withColumnRenamed("video_id", "s_video_id")
    j = videos_raw.join(s, (videos_raw.video_id == s.s_video_id) & (videos_raw.comment_count > 0), "left")
    return j.drop("s_video_id")


def engagement_block(df: DataFrame, params: Params) -> DataFrame:
    like_c = F.coalesce(F.col("like_count"), F.lit(0))
    comment_c = F.coalesce(F.col("comment_count"), F.lit(0))
    df = df.withColumns({
        "view_count": try_whole("view_count"),
        "like_count": try_whole("like_count"),
        "comment_count": try_whole("comment_count"),
    })
    df = df.withColumns({"like_count_clean": like_c, "comment_count_clean": comment_c})
    df = df.withColumn("engagement_count", F.col("like_count_clean") + F.col("comment_count_clean"))
    return df.withColumns({
        "engagement_rate": safe_ratio("engagement_count", "view_count"),
        "likes_per_1k_views": safe_ratio("like_count_clean", "view_count", 1000),
        "comments_per_1k_views": safe_ratio("comment_count_clean", "view_count", 1000),
        "views_per_day": rate_per_day("view_count", "days_since_published"),
    })


def video_features(videos_raw: DataFrame, summary: DataFrame, params: Params) -> DataFrame:
    """Every staged column except the two flags and the priority."""
    df = join_sentiment(videos_raw, summary)
    df = df.withColumns({
        "video_title": html_decode("video_title"),
        "video_description": html_decode("video_description"),
        "published_at": parse_ts("published_at"),
    })
    df = df.withColumns(date_parts("published_at", params.as_of))
    df = engagement_block(df, params)
    df = df.na.fill(SENTIMENT_FILL)
    df = df.withColumn("_title_clean", squish(lower("video_title")))  # once per row, shared by both rule sets
    title_clean = F.col("_title_clean")
    df = df.withColumns({
        "content_type": rules_first_match(title_clean, F.col("duration"), params.content_rules, params.content_default),
        "message_theme": rules_first_match(title_clean, None, params.theme_rules, params.theme_default),
        "sentiment_bucket": label_3way("avg_comment_sentiment", float(params.label_threshold)),
    })
    return df.select(*[c for c in STAGED_COLUMNS if c != "monitoring_priority"])


def priority(high_engagement: F.Column, high_negative: F.Column) -> F.Column:
    """Two flags -> four levels; a NULL flag falls through to the next rule."""
    return (F.when(high_engagement & high_negative, F.lit(PRIORITY_BOTH))
            .when(high_negative, F.lit(PRIORITY_NEGATIVE))
            .when(high_engagement, F.lit(PRIORITY_ENGAGEMENT))
            .otherwise(F.lit(PRIORITY_STANDARD)))


def flag_thresholds(features: DataFrame, params: Params) -> tuple[float | None, float | None]:
    """Global p-quantiles of engagement rate and negative share (exact, distributed)."""
    q = exact_quantiles(features, {"eng": ("engagement_rate", params.quantile),
                                   "neg": ("negative_comment_pct", params.quantile)})
    return q["eng"], q["neg"]


def flag_columns(eng_threshold: float | None, neg_threshold: float | None, params: Params) -> dict:
    def ge(col: str, t: float | None) -> F.Column:
        return F.col(col) >= F.lit(t).cast("double")
    high_eng = ge("engagement_rate", eng_threshold)
    high_neg = ge("negative_comment_pct", neg_threshold) & (F.col("comments_pulled") >= params.min_comments)
    return {"high_engagement_flag": high_eng, "high_negative_sentiment_flag": high_neg}


def add_flags(features: DataFrame, params: Params, thresholds=None, keep_flags: bool = False) -> DataFrame:
    eng_t, neg_t = thresholds if thresholds is not None else flag_thresholds(features, params)
    df = features.withColumns(flag_columns(eng_t, neg_t, params))
    df = df.withColumn("monitoring_priority",
                       priority(F.col("high_engagement_flag"), F.col("high_negative_sentiment_flag")))
    cols = list(STAGED_COLUMNS) + (["high_engagement_flag", "high_negative_sentiment_flag"] if keep_flags else [])
    return df.select(*cols)

