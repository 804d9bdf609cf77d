"""Dashboard worksheets as DataFrame queries, and the three dashboards as bundles.

A worksheet is: dimension filters -> grouping by the shelf dimensions ->
aggregations -> sort -> reference lines.  Sums and means are native double
aggregates published at 1e-10 resolution, so a mark's value does not depend
on the order rows reach the aggregate.  Reference lines are means over the *marks* (group
values), computed by a global partial aggregate and attached by a one-row
broadcast - never by a window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtview.functions.numeric import bi, mean
from courtview.functions.text import manual_order_key, priority_short
from courtview.operators.broadcast import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, broadcast_if_bounded, fits
from courtview.params import (PRIORITY_BOTH, PRIORITY_ENGAGEMENT, PRIORITY_NEGATIVE, PRIORITY_SHORT_ORDER,
                              Params)
from courtview.session import materialize

SHARES = ("positive_comment_pct", "neutral_comment_pct", "negative_comment_pct")


def sheet_sum(col: str) -> F.Column:
    """SUM of a double measure, published at sheet resolution."""
    return bi(F.sum(col))


def sheet_mean(col: str) -> F.Column:
    """AVG of a measure, published at sheet resolution."""
    return bi(mean(col))


def wer() -> F.Column:
    """Weighted engagement rate: SUM(engagements) / SUM(views), NULL on a zero or missing denominator."""
    return F.try_divide(F.sum("engagement_count").cast("double"),
                        F.nullif(F.sum("view_count"), F.lit(0)).cast("double"))


def attr(col: str) -> F.Column:
    """The BI ``ATTR``: the value when a mark holds one distinct value, ``*`` otherwise."""
    c = F.col(col).cast("string")
    return F.when(F.min(c) == F.max(c), F.min(c)).when(F.min(c).isNotNull(), F.lit("*"))


def mean_over_marks(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Attach reference lines: the mean of each mark value over all marks (one broadcast row)."""
    ref = df.agg(*[sheet_mean(src).alias(name) for name, src in cols.items()])
    return df.crossJoin(F.broadcast(ref))


def _unpivot(df: DataFrame, ids: list[str], measures: list[str], order: list[str] | None = None) -> DataFrame:
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    long = wide.unpivot(ids, measures, "measure_name", "measure_value")
    if order:
        long = long.withColumn("measure_order", manual_order_key("measure_name", order))
    return long


# ---------------------------------------------------------------------------
# cards
# ---------------------------------------------------------------------------
def v_avg_sentiment(stg: DataFrame) -> DataFrame:
    return stg.agg(sheet_mean("avg_comment_sentiment").alias("avg_comment_sentiment"))


def v_neg_card(stg: DataFrame) -> DataFrame:
    return stg.agg(sheet_mean("negative_comment_pct").alias("avg_negative_comment_pct"))


def v_engagements_card(stg: DataFrame) -> DataFrame:
    return stg.agg(F.sum("engagement_count").alias("total_engagements"))


def v_views_card(stg: DataFrame) -> DataFrame:
    return stg.agg(F.sum("view_count").alias("total_views"))


def v_wer_card(stg: DataFrame) -> DataFrame:
    return stg.agg(wer().alias("weighted_engagement_rate"))


# ---------------------------------------------------------------------------
# bar sheets
# ---------------------------------------------------------------------------
def v_sentiment_mix(stg: DataFrame) -> DataFrame:
    """Per content type: mean of the three shares; reference line = mean of the type means."""
    g = stg.groupBy("content_type").agg(*[sheet_mean(c).alias(f"avg_{c}") for c in SHARES])
    w = Window.partitionBy()  # over the handful of grouped marks only
    for c in SHARES:
        a = f"avg_{c}"
        g = g.withColumn(f"ref_{c}", bi(F.avg(a).over(w)))
    return g.orderBy(F.desc_nulls_last("avg_neutral_comment_pct"), "content_type")


def v_sentiment_mix_long(stg: DataFrame) -> DataFrame:
    g = stg.groupBy("content_type").agg(*[sheet_mean(c).alias(c) for c in SHARES])
    return _unpivot(g, ["content_type"], list(SHARES), list(SHARES))


def _mean_by(stg: DataFrame, key: str, col: str, alias: str) -> DataFrame:
    return stg.groupBy(key).agg(sheet_mean(col).alias(alias)).orderBy(F.desc_nulls_last(alias), key)


def v_neg_by_team(stg: DataFrame) -> DataFrame:
    return _mean_by(stg, "team", "negative_comment_pct", "avg_negative_comment_pct")


def v_neg_by_type(stg: DataFrame) -> DataFrame:
    return _mean_by(stg, "content_type", "negative_comment_pct", "avg_negative_comment_pct")


def v_discussion_by_type(stg: DataFrame) -> DataFrame:
    return _mean_by(stg, "content_type", "comments_per_1k_views", "avg_comments_per_1k_views")


def v_views_by_type(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("content_type").agg(
        F.sum("view_count").alias("total_views"), F.count("video_id").alias("n_videos"),
        sheet_sum("avg_comment_sentiment").alias("sum_avg_comment_sentiment"),
        wer().alias("weighted_engagement_rate"), attr("content_type").alias("attr_content_type"))
        .orderBy(F.desc_nulls_last("total_views"), "content_type"))


def v_wer_by_type(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("content_type").agg(
        wer().alias("weighted_engagement_rate"), F.sum("view_count").alias("total_views"),
        F.count("video_title").alias("n_titles"))
        .orderBy(F.desc_nulls_last("weighted_engagement_rate"), "content_type"))


def v_views_by_theme(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("message_theme").agg(
        F.sum("view_count").alias("total_views"), F.count("video_title").alias("n_titles"),
        wer().alias("weighted_engagement_rate"),
        sheet_sum("avg_comment_sentiment").alias("sum_avg_comment_sentiment"))
        .orderBy(F.desc_nulls_last("total_views"), "message_theme"))


def v_views_by_team(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("team").agg(F.sum("view_count").alias("total_views"))
            .orderBy(F.desc_nulls_last("total_views"), "team"))


def v_wer_by_team(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("team").agg(wer().alias("weighted_engagement_rate"))
            .orderBy(F.desc_nulls_last("weighted_engagement_rate"), "team"))


def v_views_by_day(stg: DataFrame) -> DataFrame:
    return (stg.groupBy(F.to_date("published_at").alias("published_day")).agg(
        F.sum("view_count").alias("total_views"), F.countDistinct("video_id").alias("n_videos"))
        .orderBy(F.asc_nulls_last("published_day")))


# ---------------------------------------------------------------------------
# monitoring sheets
# ---------------------------------------------------------------------------
def v_priority_breakdown(stg: DataFrame) -> DataFrame:
    """Short label x priority: distinct videos, in the manual order of the short labels."""
    g = (stg.groupBy(priority_short("monitoring_priority").alias("monitoring_priority_short"), "monitoring_priority")
         .agg(F.countDistinct("video_id").alias("n_videos")))
    g = g.withColumn("sort_order", manual_order_key("monitoring_priority_short", PRIORITY_SHORT_ORDER))
    return g.orderBy(F.asc_nulls_last("sort_order"), F.desc("n_videos"))


FLAGGED = (PRIORITY_ENGAGEMENT, PRIORITY_BOTH, PRIORITY_NEGATIVE)
PRIORITY_VIDEO_MEASURES = ("view_count", "engagement_rate", "negative_comment_pct")


def title_digest() -> F.Column:
    """The grouping key of a title: 32 bytes, however long the title is."""
    return F.unhex(F.sha2(F.col("video_title").cast("binary"), 256))


def priority_videos_wide(stg: DataFrame) -> DataFrame:
    """Title x priority x team for the flagged priorities; SUM of three measures.

    Grouping is by title (as the sheet does), so same-title videos of one team merge; the exchange deals by the
    title's digest, never by a whole text.
    """
    return (stg.where(F.col("monitoring_priority").isin(*FLAGGED))
            .groupBy(title_digest().alias("_title"), "monitoring_priority", "team").agg(
                F.any_value("video_title").alias("video_title"), F.sum("view_count").alias("view_count"),
                sheet_sum("engagement_rate").alias("engagement_rate"),
                sheet_sum("negative_comment_pct").alias("negative_comment_pct"))
            .select("video_title", "monitoring_priority", "team", *PRIORITY_VIDEO_MEASURES))


def v_priority_videos(stg: DataFrame) -> DataFrame:
    """The priority-videos sheet in long form (Measure Names / Measure Values), most viewed first."""
    dims = ["video_title", "monitoring_priority", "team"]
    wide = priority_videos_wide(stg).withColumn("_views", F.col("view_count"))
    long = _unpivot(wide, [*dims, "_views"], list(PRIORITY_VIDEO_MEASURES), list(PRIORITY_VIDEO_MEASURES))
    return long.orderBy(F.desc_nulls_last("_views"), *dims, "measure_order").drop("_views")


def v_scatter(stg: DataFrame) -> DataFrame:
    """One mark per (priority, video): rate vs negative share, sized by views, with mean lines."""
    return mean_over_marks(_scatter_marks(stg), {"ref_engagement_rate": "sum_engagement_rate",
                                                 "ref_negative_comment_pct": "sum_negative_comment_pct"})


def _scatter_marks(stg: DataFrame) -> DataFrame:
    """The marks of the scatter. A video of one row is its own mark, its whole title crosses no exchange; only rows of a video that
    has more of them are grouped. Where those videos are too many to be broadcast, all rows are grouped."""
    keys = ["monitoring_priority", "video_id"]
    again = materialize(stg.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]), "repeated-videos")
    if not fits(again, DEFAULT_MAX_ROWS, DEFAULT_MAX_BYTES):
        return _grouped_marks(stg, keys)
    same = F.col(keys[0]).eqNullSafe(F.col(f"_{keys[0]}")) & F.col(keys[1]).eqNullSafe(F.col(f"_{keys[1]}"))
    rows = stg.select(*keys, "engagement_rate", "negative_comment_pct", "view_count", "video_title", "team")
    alone = rows.join(F.broadcast(again), same, "left_anti").select(
        *keys, bi(F.lit(0.0) + F.col("engagement_rate")).alias("sum_engagement_rate"),
        bi(F.lit(0.0) + F.col("negative_comment_pct")).alias("sum_negative_comment_pct"), F.col("view_count").alias("sum_view_count"),
        F.col("video_title").cast("string").alias("attr_video_title"), F.col("team").cast("string").alias("attr_team"))
    if again.isEmpty():
        return alone
    return alone.unionByName(_grouped_marks(rows.join(F.broadcast(again), same, "left_semi"), keys))


def _grouped_marks(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        sheet_sum("engagement_rate").alias("sum_engagement_rate"),
        sheet_sum("negative_comment_pct").alias("sum_negative_comment_pct"),
        F.sum("view_count").alias("sum_view_count"),
        attr("video_title").alias("attr_video_title"), attr("team").alias("attr_team"))


def _reached_titles(stg: DataFrame, n: int) -> DataFrame:
    """(_title, _tv) of the titles whose SUM(view_count) reaches the n-th largest one, ties included; by digest, no text is read."""
    sums = stg.groupBy(title_digest().alias("_title")).agg(F.sum("view_count").alias("_tv"))
    cut = sums.orderBy(F.desc_nulls_last("_tv")).limit(n).agg(F.min("_tv").alias("_least"), F.count_if(F.col("_tv").isNull()).alias("_missing"))
    return sums.join(F.broadcast(cut), (F.col("_missing") > 0) | (F.col("_tv") >= F.col("_least"))).select("_title", "_tv")  # one row


def _rows_of_top_titles(rows: DataFrame, n: int) -> DataFrame:
    """Rows (video_title, _tv, ...) of the n titles with the largest ``_tv``, title as tiebreak.

    The rank is a group limit: a task hands on the rows of its own n best titles, however many tie at the last place.
    """
    order = Window.orderBy(F.desc_nulls_last("_tv"), F.asc_nulls_last("video_title"))
    return rows.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= n).drop("_rank")


def _join_reached(stg: DataFrame, n: int) -> DataFrame:
    """The rows of the titles that reach the n-th largest sum.

    Those titles' digests are written first, so that their size is known before the rows are read: as a rule they are few and
    broadcast, and no whole text of another title crosses an exchange.
    """
    reached = broadcast_if_bounded(materialize(_reached_titles(stg, n), "reached-titles").withColumnRenamed("_title", "_reached"))
    return stg.withColumn("_title", title_digest()).join(reached, F.col("_title").eqNullSafe(F.col("_reached"))).drop("_reached")


def top_titles(stg: DataFrame, n: int) -> DataFrame:
    """The n titles with the largest SUM(view_count) (title as tiebreak)."""
    named = _join_reached(stg.select("video_title", "view_count"), n).groupBy("_title").agg(
        F.any_value("video_title").alias("video_title"), F.any_value("_tv").alias("_tv"))
    return _rows_of_top_titles(named, n).orderBy(F.desc_nulls_last("_tv"), F.asc_nulls_last("video_title")).select("video_title")


def v_top_videos(stg: DataFrame, params: Params) -> DataFrame:
    """Top-N titles (filter evaluated before the row grouping), then title x team measures.

    Two scans: the sums by digest, then the rows of the titles that reach the last place, whose measures are
    taken before the ties are cut. A missing title takes its place among the N but is no mark.
    """
    marks = _join_reached(stg, params.top_titles).groupBy("_title", "team").agg(
        F.any_value("video_title").alias("video_title"), F.any_value("_tv").alias("_tv"),
        F.sum("view_count").alias("total_views"), wer().alias("weighted_engagement_rate"),
        sheet_sum("negative_comment_pct").alias("sum_negative_comment_pct"),
        sheet_mean("negative_comment_pct").alias("avg_negative_comment_pct"))
    return (_rows_of_top_titles(marks, params.top_titles).where(F.col("video_title").isNotNull()).drop("_title", "_tv")
            .orderBy(F.desc_nulls_last("total_views"), "video_title", "team")
            .select("video_title", "team", "total_views", "weighted_engagement_rate", "sum_negative_comment_pct", "avg_negative_comment_pct"))


# ---------------------------------------------------------------------------
# dashboards: bundles of sheets over the published staged table
# ---------------------------------------------------------------------------
def d_content(stg: DataFrame) -> dict[str, DataFrame]:
    return {"views_by_type": v_views_by_type(stg), "sentiment_mix": v_sentiment_mix(stg),
            "views_by_theme": v_views_by_theme(stg), "discussion_by_type": v_discussion_by_type(stg),
            "wer_by_type": v_wer_by_type(stg)}


def d_monitoring(stg: DataFrame) -> dict[str, DataFrame]:
    return {"priority_breakdown": v_priority_breakdown(stg), "neg_by_team": v_neg_by_team(stg),
            "scatter": v_scatter(stg), "priority_videos": v_priority_videos(stg)}


def d_overview(stg: DataFrame) -> dict[str, DataFrame]:
    return {"avg_sentiment": v_avg_sentiment(stg), "neg_card": v_neg_card(stg),
            "engagements_card": v_engagements_card(stg), "views_card": v_views_card(stg),
            "wer_card": v_wer_card(stg), "views_by_team": v_views_by_team(stg),
            "wer_by_team": v_wer_by_team(stg), "views_by_day": v_views_by_day(stg)}


# ---------------------------------------------------------------------------
# dashboard extracts: every mark of a dashboard's sheets in one long table
# ---------------------------------------------------------------------------
MONITORING_SHEETS = {
    "priority_breakdown": (v_priority_breakdown, ["monitoring_priority_short", "monitoring_priority"]),
    "neg_by_team": (v_neg_by_team, ["team"]),
    "scatter": (v_scatter, ["monitoring_priority", "video_id"]),
    "priority_videos": (priority_videos_wide, ["video_title", "monitoring_priority", "team"]),
}

TEXT_MARKS = {"views_by_type": ["attr_content_type"], "scatter": ["attr_video_title", "attr_team"]}


def sheet_measures(df: DataFrame, dims: list[str]) -> list[str]:
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields if f.name not in dims and isinstance(f.dataType, NumericType)]


def long_marks(df: DataFrame, dims: list[str], sheets: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """(sheet, mark, measure_name, measure_value, measure_text) of all ``sheets``, which share the marks of ``df``.

    ``sheets``: name to its numeric measures and its text marks; ``mark`` joins the dimension values with ``|``.
    """
    mark = F.concat_ws("|", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims]) if dims else F.lit("")
    number = lambda sheet, m: F.struct(F.lit(sheet).alias("sheet"), F.lit(m).alias("measure_name"),
                                       F.col(m).cast("double").alias("measure_value"), F.lit(None).cast("string").alias("measure_text"))
    text = lambda sheet, m: F.struct(F.lit(sheet).alias("sheet"), F.lit(m).alias("measure_name"),
                                     F.lit(None).cast("double").alias("measure_value"), F.col(m).alias("measure_text"))
    marks = [number(name, m) for name, (numbers, _) in sheets.items() for m in numbers] + \
        [text(name, m) for name, (_, texts) in sheets.items() for m in texts]
    return df.select(mark.alias("mark"), F.inline(F.array(*marks))).select("sheet", "mark", "measure_name", "measure_value", "measure_text")


def dashboard_extract(stg: DataFrame, sheets: dict) -> DataFrame:
    """Every measure and text mark of every sheet; each sheet is its own aggregate over the staged table."""
    out = None
    for name, (build, dims) in sheets.items():
        df = build(stg)
        part = long_marks(df, dims, {name: (sheet_measures(df, dims), TEXT_MARKS.get(name, []))})
        out = part if out is None else out.unionByName(part)
    return out


def d_content_extract(stg: DataFrame) -> DataFrame:
    """Four sheets share the content types: one aggregate serves them, another one the themes."""
    types = stg.groupBy("content_type").agg(
        F.sum("view_count").alias("total_views"), F.count("video_id").alias("n_videos"), F.count("video_title").alias("n_titles"),
        sheet_sum("avg_comment_sentiment").alias("sum_avg_comment_sentiment"), wer().alias("weighted_engagement_rate"),
        sheet_mean("comments_per_1k_views").alias("avg_comments_per_1k_views"), attr("content_type").alias("attr_content_type"),
        *[sheet_mean(c).alias(f"avg_{c}") for c in SHARES])
    w = Window.partitionBy()  # over the handful of grouped marks only
    types = types.select("*", *[bi(F.avg(f"avg_{c}").over(w)).alias(f"ref_{c}") for c in SHARES])
    by_type = long_marks(types, ["content_type"], {
        "views_by_type": (["total_views", "n_videos", "sum_avg_comment_sentiment", "weighted_engagement_rate"], ["attr_content_type"]),
        "sentiment_mix": ([f"{a}_{c}" for a in ("avg", "ref") for c in SHARES], []),
        "discussion_by_type": (["avg_comments_per_1k_views"], []),
        "wer_by_type": (["weighted_engagement_rate", "total_views", "n_titles"], [])})
    return by_type.unionByName(dashboard_extract(stg, {"views_by_theme": (v_views_by_theme, ["message_theme"])}))


def d_monitoring_extract(stg: DataFrame) -> DataFrame:
    return dashboard_extract(stg, MONITORING_SHEETS)


def d_overview_extract(stg: DataFrame) -> DataFrame:
    """One aggregate for the five cards, one for the two team sheets, one for the days."""
    cards = stg.agg(sheet_mean("avg_comment_sentiment").alias("avg_comment_sentiment"), sheet_mean("negative_comment_pct").alias("avg_negative_comment_pct"),
                    F.sum("engagement_count").alias("total_engagements"), F.sum("view_count").alias("total_views"), wer().alias("weighted_engagement_rate"))
    teams = stg.groupBy("team").agg(F.sum("view_count").alias("total_views"), wer().alias("weighted_engagement_rate"))
    parts = [long_marks(cards, [], {"avg_sentiment": (["avg_comment_sentiment"], []), "neg_card": (["avg_negative_comment_pct"], []),
                                    "engagements_card": (["total_engagements"], []), "views_card": (["total_views"], []),
                                    "wer_card": (["weighted_engagement_rate"], [])}),
             long_marks(teams, ["team"], {"views_by_team": (["total_views"], []), "wer_by_team": (["weighted_engagement_rate"], [])}),
             dashboard_extract(stg, {"views_by_day": (v_views_by_day, ["published_day"])})]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
