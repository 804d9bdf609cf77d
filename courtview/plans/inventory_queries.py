"""Keys that isolate one inventory operator each.

Most operators of the inventory also run inside the staged build or a report;
these keys expose each one on its own output so it is checked on its own.
Every key runs over the whole bound tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtview.functions.dates import date_to_text, day_trunc, parse_ts
from courtview.functions.numeric import bi, round_to, try_numeric, weighted_rate
from courtview.functions.text import manual_order_key, priority_rank, priority_short, strip_newlines
from courtview.operators import shape
from courtview.operators.features import add_flags, join_sentiment
from courtview.operators.sentiment import matched_comment_scores, rollup_scores, units_to_decimal, video_sentiment
from courtview.params import PRIORITY_BOTH, PRIORITY_ENGAGEMENT, PRIORITY_NEGATIVE, PRIORITY_SHORT_ORDER
from courtview.plans import dashboards as D
from courtview.plans import reports as R
from courtview.plans.staged import PARAMS, published_features, raw_videos, staged, thresholds
from courtview.sources import bindings as B
from courtview.sources import files

C, T = "commerce", "content"


def _stg(b: str):
    def wrap(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(staged(spark, sf, b))
        run.__name__ = fn.__name__
        return run
    return wrap


# ---------------------------------------------------------------------------
# projections and fills
# ---------------------------------------------------------------------------
def prj_select(spark: SparkSession, sf: str) -> DataFrame:
    """The ordered 9-column base projection of the collected videos."""
    from courtview.plans.operator_queries import BASE_COLUMNS
    return raw_videos(spark, sf, C).select(*BASE_COLUMNS)


def prj_across_str(spark: SparkSession, sf: str) -> DataFrame:
    """One expression applied to every text column (CR/LF runs -> one space)."""
    stg = staged(spark, sf, T)
    return stg.select(*[strip_newlines(f.name).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
                        for f in stg.schema.fields])


def prj_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    vr = raw_videos(spark, sf, T)
    return vr.select("video_id", F.coalesce("channel_title", "team").alias("channel_name"))


@_stg(T)
def prj_fill(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "like_count", "like_count_clean", "comment_count", "comment_count_clean",
                      "comments_pulled", "avg_comment_sentiment", "negative_comment_pct")


@_stg(T)
def prj_preview(stg: DataFrame) -> DataFrame:
    return R.q00_preview(stg)


@_stg(C)
def flt_members(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("monitoring_priority").isin(PRIORITY_ENGAGEMENT, PRIORITY_BOTH, PRIORITY_NEGATIVE)).select(
        "video_id", "monitoring_priority")


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------
def join_sentiment_key(spark: SparkSession, sf: str) -> DataFrame:
    """Videos left-joined with the comment summary, before zero-fill (NULL where not pulled)."""
    vr = raw_videos(spark, sf, T)
    summary = video_sentiment(B.content_comments(spark, sf), B.fixture_lexicon(spark), PARAMS[T].label_threshold)
    return join_sentiment(vr, summary).select("video_id", "comment_count", "comments_pulled", "avg_comment_sentiment",
                                              "negative_comment_pct")


def join_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """Comment tokens matched to the broadcast lexicon, summed per comment (matching comments only)."""
    m = matched_comment_scores(B.content_comments(spark, sf), B.fixture_lexicon(spark))
    return m.select("video_id", "comment_id", units_to_decimal(F.col("score_units")).alias("sentiment_score"))


@_stg(C)
def semi_topn_members(stg: DataFrame) -> DataFrame:
    top = F.broadcast(D.top_titles(stg, PARAMS[C].top_titles))  # at most top_titles rows
    return stg.join(top, "video_title", "left_semi").select("video_id", "video_title", "team")


def cross_scalar(spark: SparkSession, sf: str) -> DataFrame:
    """Every row against the one-row threshold table (broadcast, one row by construction)."""
    eng, neg = thresholds(spark, sf, C)
    t = spark.createDataFrame([(eng, neg)], "eng_threshold double, neg_threshold double")
    feats = published_features(spark, sf, C)
    j = feats.crossJoin(F.broadcast(t))
    return j.select("video_id", (F.col("engagement_rate") >= F.col("eng_threshold")).alias("at_or_above_eng"),
                    (F.col("negative_comment_pct") >= F.col("neg_threshold")).alias("at_or_above_neg"))


# ---------------------------------------------------------------------------
# aggregations and windows
# ---------------------------------------------------------------------------
def agg_cond_share(spark: SparkSession, sf: str) -> DataFrame:
    return rollup_scores(B.commerce_scored_comments(spark, sf), PARAMS[C].label_threshold).select(
        "video_id", "positive_comment_pct", "neutral_comment_pct", "negative_comment_pct")


def agg_missing(spark: SparkSession, sf: str) -> DataFrame:
    vr = raw_videos(spark, sf, T)
    return vr.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}")
                    for c in ("view_count", "like_count", "comment_count", "published_at")])


@_stg(C)
def agg_weighted_rate(stg: DataFrame) -> DataFrame:
    return stg.groupBy("conference").agg(weighted_rate(F.sum("engagement_count"), F.sum("view_count"))
                                         .alias("weighted_engagement_rate"))


@_stg(C)
def agg_attr(stg: DataFrame) -> DataFrame:
    return stg.groupBy("video_title").agg(D.attr("team").alias("attr_team"), D.attr("conference").alias("attr_conference"))


@_stg(C)
def agg_count_sort(stg: DataFrame) -> DataFrame:
    return R.count_sorted(stg, "sentiment_bucket")


@_stg(T)
def agg_having(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("team", "content_type").agg(F.count(F.lit(1)).alias("total_videos"))
    return g.where(F.col("total_videos") >= PARAMS[T].min_group)


@_stg(C)
def win_pct_total(stg: DataFrame) -> DataFrame:
    return shape.share_of_total(stg.groupBy("content_type").agg(F.count(F.lit(1)).alias("n")))


@_stg(C)
def win_reference_avg(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("team").agg(D.sheet_mean("negative_comment_pct").alias("avg_negative_comment_pct"))
    w = Window.partitionBy()  # over the grouped marks (one row per team) only
    ref = bi(F.avg("avg_negative_comment_pct").over(w))
    return g.withColumn("ref_negative_comment_pct", ref)


def win_flag_quantile(spark: SparkSession, sf: str) -> DataFrame:
    feats = published_features(spark, sf, T)
    return add_flags(feats, PARAMS[T], thresholds(spark, sf, T), keep_flags=True).select(
        "video_id", "high_engagement_flag", "high_negative_sentiment_flag")


# ---------------------------------------------------------------------------
# sorts
# ---------------------------------------------------------------------------
@_stg(T)
def srt_topk(stg: DataFrame) -> DataFrame:
    return R.q01_top_views(stg)


@_stg(T)
def srt_case_rank(stg: DataFrame) -> DataFrame:
    return (stg.where(F.col("monitoring_priority") != "Standard")
            .select("video_id", "monitoring_priority", priority_rank("monitoring_priority").alias("priority_rank"),
                    "view_count")
            .orderBy("priority_rank", F.desc_nulls_last("view_count"), "video_id"))


@_stg(C)
def srt_manual(stg: DataFrame) -> DataFrame:
    g = stg.groupBy(priority_short("monitoring_priority").alias("monitoring_priority_short")).agg(
        F.count(F.lit(1)).alias("n"))
    g = g.withColumn("sort_order", manual_order_key("monitoring_priority_short", PRIORITY_SHORT_ORDER))
    return g.orderBy(F.asc_nulls_last("sort_order"))


@_stg(C)
def srt_by_measure(stg: DataFrame) -> DataFrame:
    """Teams ordered by a measure that is not shown (total engagements), as a rank column."""
    g = stg.groupBy("team").agg(F.count(F.lit(1)).alias("total_videos"), F.sum("engagement_count").alias("_e"))
    w = Window.orderBy(F.desc_nulls_last("_e"), "team")  # over one row per team
    return g.withColumn("sort_rank", F.row_number().over(w)).drop("_e").orderBy("sort_rank")


@_stg(T)
def srt_multi_qa(stg: DataFrame) -> DataFrame:
    return R.qa_fast(stg)


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------
def fn_parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    vr = raw_videos(spark, sf, T)
    return vr.select("video_id", "published_at", parse_ts("published_at").alias("published_ts"))


def fn_day_trunc(spark: SparkSession, sf: str) -> DataFrame:
    return B.read_table(spark, sf, "events").select("event_id", day_trunc("ts").alias("day"))


@_stg(T)
def fn_iso_bound(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", F.concat(F.date_format("published_date", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
                      .alias("day_start"))


def fn_try_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Quarter counts landed as text (``NA`` for missing) parsed back to numbers, fractions kept."""
    vr = raw_videos(spark, sf, T)
    as_text = F.coalesce((F.col("view_count") / 4).cast("string"), F.lit("NA"))
    return vr.select("video_id", try_numeric(as_text).alias("view_count"))


@_stg(T)
def fn_date_to_text(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", date_to_text("published_date").alias("published_date_text"),
                      date_to_text("published_month").alias("published_month_text"))


@_stg(T)
def fn_safe_ratio(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "engagement_rate", "likes_per_1k_views", "comments_per_1k_views")


@_stg(T)
def fn_rate_per_day(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "view_count", "views_per_day")


@_stg(T)
def fn_round(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", round_to("engagement_rate", 4).alias("engagement_rate"),
                      round_to("views_per_day", 2).alias("views_per_day"))


@_stg(T)
def fn_label_3way(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "avg_comment_sentiment", "sentiment_bucket")


@_stg(T)
def fn_rules_first_match(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "duration", "content_type", "message_theme")


@_stg(C)
def fn_recode(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "monitoring_priority",
                      priority_short("monitoring_priority").alias("monitoring_priority_short"))


def fn_bool_combine(spark: SparkSession, sf: str) -> DataFrame:
    return add_flags(published_features(spark, sf, T), PARAMS[T], thresholds(spark, sf, T), keep_flags=True).select(
        "video_id", "high_engagement_flag", "high_negative_sentiment_flag", "monitoring_priority")


# ---------------------------------------------------------------------------
# feature blocks
# ---------------------------------------------------------------------------
@_stg(C)
def feat_engagement(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "like_count_clean", "comment_count_clean", "engagement_count", "engagement_rate",
                      "likes_per_1k_views", "comments_per_1k_views", "views_per_day")


@_stg(C)
def feat_content_type(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "content_type")


@_stg(C)
def feat_message_theme(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "message_theme")


@_stg(C)
def feat_sentiment_bucket(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "sentiment_bucket")


@_stg(T)
def feat_priority(stg: DataFrame) -> DataFrame:
    return stg.select("video_id", "monitoring_priority")


# ---------------------------------------------------------------------------
# sinks, QA, dashboards
# ---------------------------------------------------------------------------
def snk_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A report written to CSV (as the analysis script saves its outputs) and read back typed."""
    from courtview.session import scratch_path
    rep = R.s06_monitoring(staged(spark, sf, C))
    path = files.write_csv(rep, scratch_path(spark, "report-csv"))
    return files.read_csv(spark, path, rep.schema)


def qa_channels(spark: SparkSession, sf: str) -> DataFrame:
    from courtview.plans.operator_queries import json_channels
    ch = B.commerce_channels(spark, sf)
    check = json_channels(spark, sf)
    j = ch.join(check, ch.channel_id == check.checked_channel_id, "left")
    return (j.select("team", "team_abbreviation", "channel_id", "channel_title", "subscriber_count", "valid_channel")
            .orderBy("channel_id"))


INVENTORY_QUERIES = {
    "prj_select": prj_select, "prj_across_str": prj_across_str, "prj_coalesce": prj_coalesce, "prj_fill": prj_fill,
    "prj_preview": prj_preview, "flt_members": flt_members, "join_sentiment": join_sentiment_key,
    "join_lexicon": join_lexicon, "semi_topn_members": semi_topn_members, "cross_scalar": cross_scalar,
    "agg_cond_share": agg_cond_share, "agg_missing": agg_missing, "agg_weighted_rate": agg_weighted_rate,
    "agg_attr": agg_attr, "agg_count_sort": agg_count_sort, "agg_having": agg_having, "win_pct_total": win_pct_total,
    "win_reference_avg": win_reference_avg, "win_flag_quantile": win_flag_quantile, "srt_topk": srt_topk,
    "srt_case_rank": srt_case_rank, "srt_manual": srt_manual, "srt_by_measure": srt_by_measure,
    "srt_multi_qa": srt_multi_qa, "fn_parse_ts": fn_parse_ts, "fn_day_trunc": fn_day_trunc,
    "fn_iso_bound": fn_iso_bound, "fn_try_numeric": fn_try_numeric, "fn_date_to_text": fn_date_to_text,
    "fn_safe_ratio": fn_safe_ratio, "fn_rate_per_day": fn_rate_per_day, "fn_round": fn_round,
    "fn_label_3way": fn_label_3way, "fn_rules_first_match": fn_rules_first_match, "fn_recode": fn_recode,
    "fn_bool_combine": fn_bool_combine, "feat_engagement": feat_engagement, "feat_content_type": feat_content_type,
    "feat_message_theme": feat_message_theme, "feat_sentiment_bucket": feat_sentiment_bucket,
    "feat_priority": feat_priority, "snk_csv": snk_csv, "qa_channels": qa_channels,
}
