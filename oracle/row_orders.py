"""The row order of every sorted key, as an ORDER BY list over its own columns.

Plain text, written apart from the queries. Rows that tie in it may come in any order. ``FACTS`` holds sort values
that a key does not show, as an expression over its rows.
"""

VIEWS = "view_count DESC NULLS LAST"
TOTAL_VIEWS = "total_views DESC NULLS LAST"
SENTIMENT = "avg_comment_sentiment DESC NULLS LAST"
#: The monitoring report's rank of the priorities.
PRIORITY = ("CASE monitoring_priority WHEN 'High Engagement / High Negative Sentiment' THEN 1 WHEN 'High Negative Sentiment' THEN 2 "
            "WHEN 'High Engagement' THEN 3 ELSE 4 END")
#: The manual order of the short labels on the sheets.
SHORT = ("CASE monitoring_priority_short WHEN 'High Eng. + High Neg.' THEN 1 WHEN 'High Neg. Sentiment' THEN 2 "
         "WHEN 'High Engagement' THEN 3 WHEN 'Standard' THEN 4 END NULLS LAST")

ROW_ORDERS = {
    # practice and report statements
    "q00_preview": "video_id", "q00_top_viewed": VIEWS, "q00_team_kpi": TOTAL_VIEWS,
    "s05_team_kpi": TOTAL_VIEWS, "s05_content_perf": TOTAL_VIEWS, "s05_monitoring": VIEWS,
    "q01_team_perf": TOTAL_VIEWS, "q01_content_perf": TOTAL_VIEWS, "q01_theme_perf": TOTAL_VIEWS,
    "q01_top_views": VIEWS, "q01_top_engagement": "engagement_rate DESC NULLS LAST",
    "q01_sentiment_team": SENTIMENT, "q01_sentiment_content": SENTIMENT,
    "q01_monitoring": f"{PRIORITY}, {VIEWS}", "q01_hour_perf": "avg_views_per_day DESC NULLS LAST",
    "q02_monitoring_export": VIEWS, "s06_monitoring": VIEWS,
    "q01_team_perf_content": TOTAL_VIEWS, "q01_content_perf_content": TOTAL_VIEWS, "q01_theme_perf_content": TOTAL_VIEWS,
    "q01_monitoring_content": f"{PRIORITY}, {VIEWS}", "q01_top_engagement_content": "engagement_rate DESC NULLS LAST",
    # displays of the scripts
    "qa_raw_list": VIEWS, "qa_negative": "negative_comment_pct DESC NULLS LAST", "qa_fast": "views_per_day DESC NULLS LAST",
    "qa_types": "n DESC", "qa_themes": "n DESC", "qa_priorities": "n DESC", "agg_count_by_team": "team NULLS LAST",
    "srt_topk": VIEWS, "srt_case_rank": f"{PRIORITY}, {VIEWS}", "srt_manual": SHORT, "srt_by_measure": "sort_rank",
    # sheets
    "v_sentiment_mix": "avg_neutral_comment_pct DESC NULLS LAST", "v_neg_by_team": "avg_negative_comment_pct DESC NULLS LAST",
    "v_neg_by_type": "avg_negative_comment_pct DESC NULLS LAST", "v_discussion_by_type": "avg_comments_per_1k_views DESC NULLS LAST",
    "v_views_by_type": TOTAL_VIEWS, "v_wer_by_type": "weighted_engagement_rate DESC NULLS LAST", "v_views_by_theme": TOTAL_VIEWS,
    "v_views_by_team": TOTAL_VIEWS, "v_wer_by_team": "weighted_engagement_rate DESC NULLS LAST", "v_views_by_day": "published_day NULLS LAST",
    "v_priority_breakdown": SHORT, "v_priority_videos": "fact DESC NULLS LAST", "v_top_videos": TOTAL_VIEWS,
    "v_wer_by_team_content": "weighted_engagement_rate DESC NULLS LAST", "v_views_by_day_content": "published_day NULLS LAST",
    "v_priority_breakdown_content": SHORT, "v_top_videos_content": TOTAL_VIEWS,
}

FACTS = {"v_priority_videos": "max(measure_value) FILTER (measure_name = 'view_count') OVER (PARTITION BY video_title, monitoring_priority, team)"}
