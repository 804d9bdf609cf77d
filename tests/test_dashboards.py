from dataclasses import replace

from conftest import SF_SMALL

from courtview.plans import dashboards as D
from courtview.plans.staged import PARAMS, staged


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bundles_equal_their_sheets(spark):
    stg = staged(spark, SF_SMALL, "commerce")
    bundles = {"content": D.d_content(stg), "monitoring": D.d_monitoring(stg), "overview": D.d_overview(stg)}
    assert set(bundles["content"]) == {"views_by_type", "sentiment_mix", "views_by_theme", "discussion_by_type",
                                       "wer_by_type"}
    assert set(bundles["monitoring"]) == {"priority_breakdown", "neg_by_team", "scatter", "priority_videos"}
    assert len(bundles["overview"]) == 8
    assert same(bundles["content"]["views_by_type"], D.v_views_by_type(stg))
    assert same(bundles["monitoring"]["scatter"], D.v_scatter(stg))
    assert same(bundles["overview"]["views_by_day"], D.v_views_by_day(stg))
    stg.unpersist()


def test_reference_line_is_mean_of_marks(spark):
    stg = staged(spark, SF_SMALL, "commerce")
    rows = D.v_sentiment_mix(stg).collect()
    for c in ("positive_comment_pct", "negative_comment_pct"):
        marks = [r[f"avg_{c}"] for r in rows]
        assert abs(rows[0][f"ref_{c}"] - sum(marks) / len(marks)) < 1e-9


def test_top_videos_keep_only_top_titles(spark):
    stg = staged(spark, SF_SMALL, "content")
    top = {r.video_title for r in D.top_titles(stg, PARAMS["content"].top_titles).collect()}
    got = D.v_top_videos(stg, PARAMS["content"]).collect()
    assert {r.video_title for r in got} == top and len(top) == PARAMS["content"].top_titles
    assert all(r.attr_video_title != "*" for r in D.v_scatter(stg).collect())


def test_top_titles_with_ties_and_missing_titles(spark):
    rows = [("b", 5), ("a", 5), ("c", 5), (None, 9), ("d", None), ("b", 1)]
    df = spark.createDataFrame(rows, "video_title string, view_count long")
    pick = lambda n: [r.video_title for r in D.top_titles(df, n).collect()]
    assert pick(1) == [None]
    assert pick(3) == [None, "b", "a"]
    assert pick(9) == [None, "b", "a", "c", "d"]


def test_extracts_carry_text_marks(spark):
    stg = staged(spark, SF_SMALL, "commerce")
    names = {(r.sheet, r.measure_name) for r in D.d_monitoring_extract(stg).where("measure_text is not null").select("sheet", "measure_name").distinct().collect()}
    assert names == {("scatter", "attr_video_title"), ("scatter", "attr_team")}
    types = D.d_content_extract(stg).where("measure_text is not null").collect()
    assert {(r.sheet, r.measure_name) for r in types} == {("views_by_type", "attr_content_type")} and all(r.mark == r.measure_text for r in types)


def test_top_videos_equal_a_plain_ranking(spark):
    """Ties at the last place, a missing title that takes a place, missing teams and sums."""
    rows = [("b", "x", 5), ("a", "x", 3), ("a", "y", 2), ("c", "x", 5), (None, "x", 9), ("d", None, None), ("e", None, 5), ("b", "x", 1)]
    df = spark.createDataFrame([(t, team, v, v and v * 2, 0.5) for t, team, v in rows],
                               "video_title string, team string, view_count long, engagement_count long, negative_comment_pct double")
    sums = {}
    for t, _, v in rows:
        sums[t] = None if v is None and sums.get(t) is None else (sums.get(t) or 0) + (v or 0)
    ranked = sorted(sums, key=lambda t: (sums[t] is None, -(sums[t] or 0), t is None, t or ""))
    for n in range(1, 8):
        want = {(t, team) for t, team, _ in rows if t is not None and t in ranked[:n]}
        got = D.v_top_videos(df, replace(PARAMS["commerce"], top_titles=n)).collect()
        assert {(r.video_title, r.team) for r in got} == want and len(got) == len(want), n
        assert all(r.total_views == sum(v or 0 for t, team, v in rows if (t, team) == (r.video_title, r.team)) for r in got if r.total_views is not None)


def test_top_videos_ties_are_cut_by_a_group_limit(spark):
    from test_plans import plan_of
    stg = staged(spark, SF_SMALL, "commerce")
    plan = plan_of(D.v_top_videos(stg, PARAMS["commerce"])).split("Initial Plan")[-1]
    assert "WindowGroupLimit" in plan
