"""Explicit schemas of the model tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CHANNELS = _st(("team", S), ("team_abbreviation", S), ("conference", S), ("seed", I),
               ("channel_id", S), ("channel_name", S))

VIDEOS_RAW = _st(("team", S), ("team_abbreviation", S), ("conference", S), ("channel_id", S),
                 ("video_id", S), ("published_at", S), ("channel_title", S), ("video_title", S),
                 ("video_description", S), ("view_count", L), ("like_count", L), ("comment_count", L),
                 ("duration", S))

COMMENTS = _st(("video_id", S), ("comment_id", S), ("comment_text", S), ("comment_like_count", L),
               ("comment_published_at", S))

LEXICON = _st(("word", S), ("value", T.DecimalType(9, 4)))

VIDEO_SENTIMENT_SUMMARY = _st(("video_id", S), ("comments_pulled", L), ("avg_comment_sentiment", D),
                              ("positive_comment_pct", D), ("neutral_comment_pct", D),
                              ("negative_comment_pct", D))

STAGED = _st(
    ("video_id", S), ("team", S), ("team_abbreviation", S), ("conference", S), ("channel_id", S),
    ("channel_title", S), ("video_title", S), ("video_description", S), ("published_at", T.TimestampNTZType()),
    ("published_date", T.DateType()), ("published_hour", I), ("published_month", T.DateType()),
    ("duration", S), ("content_type", S), ("message_theme", S), ("view_count", L), ("like_count", L),
    ("comment_count", L), ("like_count_clean", L), ("comment_count_clean", L), ("engagement_count", L),
    ("engagement_rate", D), ("likes_per_1k_views", D), ("comments_per_1k_views", D), ("views_per_day", D),
    ("comments_pulled", L), ("avg_comment_sentiment", D), ("positive_comment_pct", D),
    ("neutral_comment_pct", D), ("negative_comment_pct", D), ("sentiment_bucket", S),
    ("monitoring_priority", S),
)
STAGED_COLUMNS = tuple(f.name for f in STAGED.fields)
