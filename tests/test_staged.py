from pyspark.sql import functions as F

from conftest import SF_SMALL

from courtview.operators.features import add_flags
from courtview.plans import reports as R
from courtview.plans.staged import PARAMS, published_features, staged
from courtview.schemas import STAGED


def test_staged_schema(spark):
    for b in ("commerce", "content"):
        df = staged(spark, SF_SMALL, b)
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in STAGED.fields]


def test_group_totals_equal_grand_total(spark):
    stg = staged(spark, SF_SMALL, "commerce")
    total = R.q01_exec_kpi(stg).first()
    for fn in (R.q01_team_perf, R.q01_content_perf, R.q01_theme_perf):
        rows = fn(stg).collect()
        assert sum(r.total_videos for r in rows) == total.total_videos
        assert sum(r.total_views for r in rows) == total.total_views
        assert sum(r.total_engagements for r in rows) == total.total_engagements
    assert total.total_likes + total.total_comments == total.total_engagements


def test_priority_partition_and_shares(spark):
    for b in ("commerce", "content"):
        stg = staged(spark, SF_SMALL, b)
        n = stg.count()
        assert sum(r.n for r in R.qa_priorities(stg).collect()) == n
        bad = stg.where((F.col("comments_pulled") > 0) & (F.abs(
            F.col("positive_comment_pct") + F.col("neutral_comment_pct") + F.col("negative_comment_pct") - 1) > 1e-12))
        assert bad.count() == 0
        zero = stg.where(F.col("comments_pulled") == 0)
        assert zero.where(F.col("neutral_comment_pct") != 0).count() == 0


def flags_by_percentile(features, params):
    """The same flags with Spark's exact percentile (one task: small tables only)."""
    t = features.agg(F.percentile("engagement_rate", params.quantile), F.percentile("negative_comment_pct", params.quantile)).first()
    return add_flags(features, params, (t[0], t[1]))


def test_flags_match_in_plan_percentile(spark):
    for b in ("commerce", "content"):
        a = staged(spark, SF_SMALL, b).select("video_id", "monitoring_priority")
        c = flags_by_percentile(published_features(spark, SF_SMALL, b), PARAMS[b]).select(
            "video_id", "monitoring_priority")
        assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_hour_report_having(spark):
    stg = staged(spark, SF_SMALL, "content")
    assert all(r.total_videos >= PARAMS["content"].min_group for r in R.q01_hour_perf(stg, PARAMS["content"]).collect())


def test_collection_window_option(spark):
    import dataclasses
    from courtview.functions.dates import parse_ts  # noqa: F401
    p = dataclasses.replace(PARAMS["commerce"], apply_collection_window=True, top_n_per_team=7)
    df = staged(spark, SF_SMALL, "commerce", p)
    per_team = {r.team: r.n for r in df.groupBy("team").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_team and max(per_team.values()) <= 7
    assert df.where(~F.col("published_date").between(p.start_date, p.as_of)).count() == 0
    full = staged(spark, SF_SMALL, "commerce")
    assert df.count() < full.count()


def test_publish_staged_equals_lazy_path(spark):
    from courtview.operators.features import video_features
    from courtview.operators.sentiment import video_sentiment
    from courtview.plans.staged import publish_staged
    from courtview.sources import bindings as B
    p = PARAMS["content"]
    vr = B.content_videos_raw(spark, SF_SMALL)
    summary = video_sentiment(B.content_comments(spark, SF_SMALL), B.fixture_lexicon(spark), p.label_threshold)
    a = publish_staged(vr, summary, p)
    b = flags_by_percentile(video_features(vr, summary, p), p)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
