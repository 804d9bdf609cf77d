"""Operator-level queries: each exercises one operator of the inventory on the
bound driver tables (whole tables, whole texts) and returns a DataFrame.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.functions.dates import date_parts, iso_text, parse_ts
from courtview.functions.text import html_decode, lower, regex_detect, rules_first_match, squish, strip_newlines
from courtview.operators import shape
from courtview.operators.bloom import may_match
from courtview.operators.sketch import rank_error, rank_of
from courtview.operators.skew import skew_split_join
from courtview.operators.features import add_flags
from courtview.operators.sentiment import label_counts, score_comments, video_sentiment
from courtview.params import (REFERENCE_CONTENT_DEFAULT, REFERENCE_CONTENT_RULES, REFERENCE_THEME_DEFAULT,
                              REFERENCE_THEME_RULES)
from courtview.plans.dashboards import top_titles
from courtview.plans.staged import PARAMS, dated_videos, published_features, raw_videos, sketched_quantiles, staged, thresholds
from courtview.schemas import STAGED_COLUMNS
from courtview.sources import bindings as B
from courtview.sources import files, landed, payloads
from courtview.sources.dated import between_dates

C, T = "commerce", "content"


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------
def src_inline(spark: SparkSession, sf: str) -> DataFrame:
    return B.commerce_channels(spark, sf).drop("subscribers")


def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Staged table -> CSV (header, NA for NULL) -> typed read."""
    return files.csv_round_trip(staged(spark, sf, C))


def src_csv_content(spark: SparkSession, sf: str) -> DataFrame:
    """Same round trip over whole documents (quotes, commas, newlines inside fields)."""
    return files.csv_round_trip(staged(spark, sf, T))


def exp_video_safe(spark: SparkSession, sf: str) -> DataFrame:
    """The newline-free export, written as CSV and read back."""
    return files.csv_round_trip(files.safe_export(staged(spark, sf, T)), "safe-export")


def src_typed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Typed BI source: 32 declared columns + 3 spare ones, read PERMISSIVE, spares dropped."""
    from courtview.session import scratch_path
    stg = staged(spark, sf, C)
    spare = [F.lit(None).cast("string").alias(c) for c in files.SPARE_COLUMNS]
    path = files.write_csv(stg.select(*STAGED_COLUMNS, *spare), scratch_path(spark, "typed-source"))
    return files.read_typed_source(spark, path)


def src_extract(spark: SparkSession, sf: str) -> DataFrame:
    return files.parquet_snapshot(staged(spark, sf, C))


def snk_table(spark: SparkSession, sf: str) -> DataFrame:
    return files.write_table(staged(spark, sf, C), "stg_videos")


# captions as a BI tool shows them, with the cases that the naming rules are for
CAPTIONS = {"video_id": "VideoID", "team": "\u00c9quipe", "conference": "Team's Conf.", "channel_title": "Conf Team", "engagement_rate": "Engagement Rate (%)",
            "likes_per_1k_views": "1k Views: Likes", "comments_pulled": "# Comments Pulled", "published_month": "YYYYMonth", "published_hour": "Video ID"}


def _captions(columns: list[str]) -> list[str]:
    return [" ".join(w[:1].upper() + w[1:] for w in c.split("_")) for c in columns]


def prj_clean_names(spark: SparkSession, sf: str) -> DataFrame:
    """Display captions (``Video Id``, ``Likes Per 1k Views`` ...) back to snake case."""
    stg = staged(spark, sf, C)
    return files.clean_names(stg.toDF(*_captions(stg.columns)))


def prj_clean_captions(spark: SparkSession, sf: str) -> DataFrame:
    """Captions with symbols, accents, acronyms, leading digits and a repeated name to snake case."""
    picked = staged(spark, sf, C).select(*CAPTIONS)
    return files.clean_names(picked.toDF(*CAPTIONS.values()))


# ---------------------------------------------------------------------------
# payloads
# ---------------------------------------------------------------------------
def _pages(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The documents of a kind, read from their landed folder (landed outside the library, see ``fixtures/``)."""
    from fixtures.payload_files import landed as landed_folder
    return payloads.read_pages(spark, landed_folder(spark, sf, kind))


def json_channels(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.channel_check(_pages(spark, sf, "channels"), B.commerce_channels(spark, sf))


def json_uploads_id(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.uploads_playlist(_pages(spark, sf, "channels"), B.commerce_channels(spark, sf))


def json_channel_search(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.channel_search(_pages(spark, sf, "search"))


def json_playlist_items(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.playlist_items(_pages(spark, sf, "playlist"), PARAMS[C].list_cap)


def json_video_stats(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.video_stats(_pages(spark, sf, "stats"))


def json_comments(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.comments(_pages(spark, sf, "comments"))


def unnest_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Per-row nested tables (upload-list pages) to rows, outer columns repeated, no cap."""
    return payloads.upload_pages(_pages(spark, sf, "playlist"))


def json_event_props(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON column of the events, parsed with a schema: a missing or non-numeric leaf and bad JSON give NULL."""
    ev = B.read_table(spark, sf, "events")
    doc = F.from_json("props", "k string")
    return ev.select("event_id", doc.getField("k").try_cast("bigint").alias("prop_k"))


def set_union(spark: SparkSession, sf: str) -> DataFrame:
    """Text comments and scored comments, landed as files of differing columns, read back in one scan; missing columns become NULL."""
    text = B.content_comments(spark, sf).select("video_id", "comment_id", "comment_text")
    scored = B.commerce_scored_comments(spark, sf).select("video_id", "comment_id", "sentiment_score")
    schema = shape.union_all([text, scored]).schema
    return landed.good_rows(landed.read_landed(spark, landed.land([text, scored], "comments"), schema))


# ---------------------------------------------------------------------------
# shape, filters, windows
# ---------------------------------------------------------------------------
BASE_COLUMNS = ("team", "team_abbreviation", "conference", "channel_id", "video_id", "published_at",
                "channel_title", "video_title", "video_description")


def feat_windowed_build(spark: SparkSession, sf: str) -> DataFrame:
    """The staged table in the reference's order: list cap, date window, newest per team, then statistics and features."""
    return staged(spark, sf, C, replace(PARAMS[C], apply_collection_window=True)).select(*STAGED_COLUMNS)


def win_topn_group(spark: SparkSession, sf: str) -> DataFrame:
    p = PARAMS[C]
    vr = dated_videos(spark, sf, C)
    return shape.collection_window(vr, p.start_date, p.as_of, p.list_cap, p.top_n_per_team).select(*BASE_COLUMNS)


def win_cap_group(spark: SparkSession, sf: str) -> DataFrame:
    return shape.cap_per_channel(dated_videos(spark, sf, C), PARAMS[C].list_cap).select(*BASE_COLUMNS)


def flt_daterange(spark: SparkSession, sf: str) -> DataFrame:
    p = PARAMS[T]
    return between_dates(dated_videos(spark, sf, T), p.start_date, p.as_of).select("video_id", "team", "published_at")


def prj_id_batches(spark: SparkSession, sf: str) -> DataFrame:
    return shape.id_batches(raw_videos(spark, sf, C), "video_id", PARAMS[C].batch_size)


def flt_has_comments(spark: SparkSession, sf: str) -> DataFrame:
    return shape.has_comments(raw_videos(spark, sf, C))


def prj_distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return shape.distinct_ids(B.content_comments(spark, sf))


def join_video_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Base metadata left-joined with statistics (built from the tables, not the published copy)."""
    return B.commerce_videos_raw(spark, sf)


def srt_topn_members(spark: SparkSession, sf: str) -> DataFrame:
    stg = staged(spark, sf, C)
    top = top_titles(stg, PARAMS[C].top_titles)
    return (stg.join(F.broadcast(top), "video_title", "left_semi").groupBy("video_title")
            .agg(F.sum("view_count").alias("total_views")))


def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, C).groupBy("conference").agg(F.countDistinct("team").alias("n_teams"))


def agg_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """The two p90 thresholds found by the distributed exact search (one row per binding)."""
    rows = []
    for b in (C, T):
        eng, neg = thresholds(spark, sf, b)
        rows.append((b, eng, neg))
    df = spark.createDataFrame(rows, "binding string, engagement_p90 double, negative_p90 double")
    return df.select("binding", F.round("engagement_p90", 12).alias("engagement_p90"),
                     F.round("negative_p90", 12).alias("negative_p90"))


def agg_quantile_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The two p90 thresholds from merged monthly sketches: whether each is within the sketch's rank error of p, by exact counts."""
    out = []
    for b in (C, T):
        feats = published_features(spark, sf, b)
        for r in sketched_quantiles(spark, sf, b).collect():  # two measures
            lo, hi = rank_of(feats, r["column"], r["quantile"])
            p, e = PARAMS[b].quantile, rank_error()
            out.append((b, r["column"], r["n"], lo - e <= p <= hi + e))
    return spark.createDataFrame(out, "binding string, measure string, n bigint, within_bound boolean")


def feat_flags(spark: SparkSession, sf: str) -> DataFrame:
    feats = published_features(spark, sf, C)
    return add_flags(feats, PARAMS[C], thresholds(spark, sf, C), keep_flags=True).select(
        "video_id", "high_engagement_flag", "high_negative_sentiment_flag", "monitoring_priority")


# ---------------------------------------------------------------------------
# sentiment
# ---------------------------------------------------------------------------
def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return score_comments(B.content_comments(spark, sf), B.fixture_lexicon(spark), PARAMS[T].label_threshold)


def sent_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("video_id", "comment_id", "sentiment_score")


def sent_label(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("video_id", "comment_id", "sentiment_label")


def sent_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return video_sentiment(B.content_comments(spark, sf), B.fixture_lexicon(spark), PARAMS[T].label_threshold)


def qa_labels(spark: SparkSession, sf: str) -> DataFrame:
    return label_counts(_scored(spark, sf))


def qa_negative(spark: SparkSession, sf: str) -> DataFrame:
    from courtview.plans.reports import qa_negative as top_negative
    return top_negative(sent_rollup(spark, sf))


def join_comment_video(spark: SparkSession, sf: str) -> DataFrame:
    """Comments of videos whose comments were pulled, with six video attributes."""
    vr = raw_videos(spark, sf, T)
    pulled = vr.where(F.col("comment_count") > 0).select(
        "video_id", "team", "team_abbreviation", "conference", "channel_title", "video_title", "published_at")
    return _with_video(B.content_comments(spark, sf), pulled)


def _with_video(comments: DataFrame, pulled: DataFrame) -> DataFrame:
    """Comments of the pulled videos with the videos' attributes.

    A Bloom filter of the pulled ids drops the others at their scan; whole texts cross the exact join's exchange only.
    """
    return skew_split_join(may_match(comments, pulled.select("video_id"), "video_id"), pulled, "video_id", "inner")


def comments_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """The comment-level table: 14 columns, one row per pulled comment, scored row by row."""
    vr = raw_videos(spark, sf, T)
    pulled = vr.where(F.col("comment_count") > 0).select(
        "video_id", "team", "team_abbreviation", "conference", "channel_title", "video_title", "published_at")
    scored = score_comments(_with_video(B.content_comments(spark, sf), pulled), B.fixture_lexicon(spark), PARAMS[T].label_threshold)
    return scored.select("video_id", "comment_id", "comment_text", "comment_like_count", "comment_published_at", "team", "team_abbreviation",
                         "conference", "channel_title", "video_title", "published_at", "comment_text_clean", "sentiment_score", "sentiment_label")


# ---------------------------------------------------------------------------
# scalar functions over whole texts
# ---------------------------------------------------------------------------
def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return B.read_table(spark, sf, "documents")


def fn_squish(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", squish("text").alias("text_squished"))


def fn_lower(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", lower("text").alias("text_lower"))


def fn_strip_newlines(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", strip_newlines("text").alias("text_one_line"))


def fn_html_decode(spark: SparkSession, sf: str) -> DataFrame:
    return B.read_table(spark, sf, "pages").select("page_id", html_decode("html").alias("html_decoded"))


def fn_regex_detect(spark: SparkSession, sf: str) -> DataFrame:
    rules = PARAMS[T].content_rules[1:]
    t = squish(lower("text"))
    return _docs(spark, sf).select("doc_id", *[regex_detect(t, p).alias(f"hit_{i}") for i, (_, p, _) in
                                              enumerate(rules, start=1)])


def fn_reference_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's own rule sets over whole documents."""
    t = squish(lower("text"))
    return _docs(spark, sf).select(
        "doc_id", rules_first_match(t, None, REFERENCE_CONTENT_RULES, REFERENCE_CONTENT_DEFAULT).alias("content_type"),
        rules_first_match(t, None, REFERENCE_THEME_RULES, REFERENCE_THEME_DEFAULT).alias("message_theme"))


def fn_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    ev = B.read_table(spark, sf, "events")
    ts = parse_ts(iso_text("ts"))
    return ev.select("event_id", ts.alias("published_at"),
                     *[c.alias(n) for n, c in date_parts(ts, PARAMS[T].as_of).items()])


OPERATOR_QUERIES = {
    "src_inline": src_inline, "src_csv": src_csv, "src_csv_content": src_csv_content,
    "exp_video_safe": exp_video_safe, "src_typed_csv": src_typed_csv, "src_extract": src_extract,
    "snk_table": snk_table, "prj_clean_names": prj_clean_names, "prj_clean_captions": prj_clean_captions,
    "json_channels": json_channels, "json_uploads_id": json_uploads_id, "json_channel_search": json_channel_search,
    "json_playlist_items": json_playlist_items, "json_video_stats": json_video_stats, "json_comments": json_comments,
    "unnest_nested": unnest_nested, "set_union": set_union, "json_event_props": json_event_props,
    "feat_windowed_build": feat_windowed_build, "fn_reference_rules": fn_reference_rules,
    "win_topn_group": win_topn_group, "win_cap_group": win_cap_group, "flt_daterange": flt_daterange,
    "prj_id_batches": prj_id_batches, "flt_has_comments": flt_has_comments, "prj_distinct_ids": prj_distinct_ids,
    "join_video_stats": join_video_stats, "srt_topn_members": srt_topn_members,
    "agg_count_distinct": agg_count_distinct, "agg_quantile": agg_quantile, "agg_quantile_sketch": agg_quantile_sketch, "feat_flags": feat_flags,
    "sent_score": sent_score, "comments_sentiment": comments_sentiment, "sent_label": sent_label, "sent_rollup": sent_rollup, "qa_labels": qa_labels,
    "qa_negative": qa_negative, "join_comment_video": join_comment_video,
    "fn_squish": fn_squish, "fn_lower": fn_lower, "fn_strip_newlines": fn_strip_newlines,
    "fn_html_decode": fn_html_decode, "fn_regex_detect": fn_regex_detect, "fn_date_parts": fn_date_parts,
}
