"""Key -> (Spark query, DuckDB oracle) registry behind ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtview.plans import reports as R
from courtview.plans.staged import PARAMS, raw_videos, staged
from courtview.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _stg(fn, binding: str = "commerce", with_params: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = staged(spark, sf_dir, binding)
        return fn(df, PARAMS[binding]) if with_params else fn(df)
    run.__name__ = fn.__name__
    return run


def _raw(fn, binding: str = "commerce") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(raw_videos(spark, sf_dir, binding))
    run.__name__ = fn.__name__
    return run


# (key, Spark query, binding, oracle key in the SQL family or None)
def _report_keys() -> list[tuple[str, Query, str, str]]:
    c, t = "commerce", "content"
    ident = lambda df: df
    ident.__name__ = "feat_video_clean"
    return [
        ("q00_preview", _stg(R.q00_preview), c, "q00_preview"),
        ("q00_top_viewed", _stg(R.q00_top_viewed), c, "q00_top_viewed"),
        ("q00_team_kpi", _stg(R.q00_team_kpi), c, "q00_team_kpi"),
        ("s05_team_kpi", _stg(R.s05_team_kpi), c, "s05_team_kpi"),
        ("s05_content_perf", _stg(R.s05_content_perf), c, "s05_content_perf"),
        ("s05_monitoring", _stg(R.s05_monitoring), c, "s05_monitoring"),
        ("q01_exec_kpi", _stg(R.q01_exec_kpi), c, "q01_exec_kpi"),
        ("q01_team_perf", _stg(R.q01_team_perf), c, "q01_team_perf"),
        ("q01_content_perf", _stg(R.q01_content_perf), c, "q01_content_perf"),
        ("q01_theme_perf", _stg(R.q01_theme_perf), c, "q01_theme_perf"),
        ("q01_top_views", _stg(R.q01_top_views), c, "q01_top_views"),
        ("q01_top_engagement", _stg(R.q01_top_engagement, c, True), c, "q01_top_engagement"),
        ("q01_sentiment_team", _stg(R.q01_sentiment_team), c, "q01_sentiment_team"),
        ("q01_sentiment_content", _stg(R.q01_sentiment_content), c, "q01_sentiment_content"),
        ("q01_monitoring", _stg(R.q01_monitoring), c, "q01_monitoring"),
        ("q01_hour_perf", _stg(R.q01_hour_perf, t, True), t, "q01_hour_perf"),
        ("q02_video_export", _stg(R.q02_video_export), c, "q02_video_export"),
        ("q02_monitoring_export", _stg(R.q02_monitoring_export), c, "q02_monitoring_export"),
        ("s06_monitoring", _stg(R.s06_monitoring), c, "s06_monitoring"),
        ("qa_clean", _stg(R.qa_clean), c, "qa_clean"),
        ("qa_types", _stg(R.qa_types), c, "qa_types"),
        ("qa_themes", _stg(R.qa_themes), c, "qa_themes"),
        ("qa_priorities", _stg(R.qa_priorities), c, "qa_priorities"),
        ("qa_fast", _stg(R.qa_fast), c, "qa_fast"),
        ("cat_rowcount", _stg(R.cat_rowcount), c, "cat_rowcount"),
        ("feat_video_clean", _stg(ident), c, "feat_video_clean"),
        ("qa_raw", _raw(R.qa_raw), c, "qa_raw"),
        ("qa_raw_list", _raw(R.qa_raw_list), c, "qa_raw_list"),
        ("agg_count_by_team", _raw(R.qa_count_by_team), c, "qa_count_by_team"),
        # the same reports over the text binding: NULL views, NULL dates, degenerate p90
        ("q01_exec_kpi_content", _stg(R.q01_exec_kpi, t), t, "q01_exec_kpi"),
        ("q01_team_perf_content", _stg(R.q01_team_perf, t), t, "q01_team_perf"),
        ("q01_content_perf_content", _stg(R.q01_content_perf, t), t, "q01_content_perf"),
        ("q01_theme_perf_content", _stg(R.q01_theme_perf, t), t, "q01_theme_perf"),
        ("q01_monitoring_content", _stg(R.q01_monitoring, t), t, "q01_monitoring"),
        ("q01_top_engagement_content", _stg(R.q01_top_engagement, t, True), t, "q01_top_engagement"),
        ("q02_video_export_content", _stg(R.q02_video_export, t), t, "q02_video_export"),
        ("feat_video_clean_content", _stg(ident, t), t, "feat_video_clean"),
        ("qa_raw_content", _raw(R.qa_raw, t), t, "qa_raw"),
    ]


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def query_table() -> dict[str, Query]:
    out = {k: fn for k, fn, _, _ in _report_keys()}
    out.update(_extra_queries())
    return {k: _configured(fn) for k, fn in out.items()}


def oracle_statements() -> dict[str, str]:
    from oracle import duckdb_sql as O
    fam = {b: {**O.report_sql(b), **O.raw_sql(b)} for b in ("commerce", "content")}
    out = {}
    for key, _, binding, okey in _report_keys():
        if okey is not None:
            out[key] = fam[binding][okey]
    out.update(_extra_sql())
    return out


DASH_KEYS = ("v_avg_sentiment", "v_sentiment_mix", "v_sentiment_mix_long", "v_neg_by_team", "v_discussion_by_type",
             "v_views_by_type", "v_wer_by_type", "v_views_by_theme", "v_priority_breakdown", "v_neg_card",
             "v_neg_by_type", "v_priority_videos", "v_scatter", "v_top_videos", "v_engagements_card",
             "v_views_card", "v_views_by_day", "v_views_by_team", "v_wer_card", "v_wer_by_team")
DASH_WITH_PARAMS = {"v_top_videos"}
# sheets also run over the text binding (NULL views and dates, colliding titles)
DASH_CONTENT = ("v_top_videos", "v_views_by_day", "v_scatter", "v_priority_breakdown", "v_wer_by_team")


def _dash_keys() -> list[tuple[str, Query, str, str]]:
    from courtview.plans import dashboards as D
    out = []
    for k in DASH_KEYS:
        fn = getattr(D, k)
        out.append((k, _stg(fn, "commerce", k in DASH_WITH_PARAMS), "commerce", k))
    for k in DASH_CONTENT:
        fn = getattr(D, k)
        out.append((f"{k}_content", _stg(fn, "content", k in DASH_WITH_PARAMS), "content", k))
    return out



def _extra_queries() -> dict[str, Query]:
    from courtview.plans.inventory_queries import INVENTORY_QUERIES
    from courtview.plans.operator_queries import OPERATOR_QUERIES
    out = {k: fn for k, fn, _, _ in _dash_keys()}
    out.update(OPERATOR_QUERIES)
    out.update(INVENTORY_QUERIES)
    from courtview.plans import dashboards as D
    out["d_content"] = _stg(D.d_content_extract)
    out["d_monitoring"] = _stg(D.d_monitoring_extract)
    out["d_overview"] = _stg(D.d_overview_extract)
    return out


def _extra_sql() -> dict[str, str]:
    from oracle import duckdb_sql as O
    fam = {b: O.dash_sql(b) for b in ("commerce", "content")}
    out = {k: fam[b][ok] for k, _, b, ok in _dash_keys()}
    out.update(O.operator_sql())
    out.update(O.inventory_sql())
    out.update(O.extract_sql("commerce"))
    return out
