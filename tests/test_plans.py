"""Plan properties that matter at scale, checked on every registered key."""
import re

from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_on_any_query_path(spark):
    from courtview.registry import query_table as queries
    bad = [k for k, fn in queries().items() if any(n in plan_of(fn(spark, SF_SMALL)) for n in PYTHON_NODES)]
    assert bad == []


def test_reports_read_only_needed_columns(spark):
    from courtview.registry import query_table as queries
    q = queries()
    for key, wanted in {"q01_team_perf": 10, "v_views_by_team": 3, "q01_exec_kpi": 10, "v_wer_card": 3}.items():
        df = q[key](spark, SF_SMALL)
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _formatted(df))
        assert schemas, key
        assert max(len(s.split(",")) for s in schemas) <= wanted, (key, schemas)


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_group_limit_is_partial(spark):
    from courtview.registry import query_table as queries
    plan = plan_of(queries()["win_topn_group"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_landed_pages_need_no_sort_of_full_rows(spark):
    from courtview.registry import query_table as queries
    for key in ("json_video_stats", "json_comments"):
        assert "rangepartitioning" not in plan_of(queries()[key](spark, SF_SMALL)), key


def test_window_comes_before_the_line_items(spark):
    from dataclasses import replace
    from courtview.plans.staged import PARAMS, features_table
    plan = plan_of(features_table(spark, SF_SMALL, "commerce", replace(PARAMS["commerce"], apply_collection_window=True)))
    lines = plan.splitlines()
    at = {i: len(x) - len(x.lstrip(" :+-")) for i, x in enumerate(lines)}
    join = next(i for i, x in enumerate(lines) if "Join" in x)  # the outermost join, with the line items
    limit = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x)
    assert limit > join and at[limit] > at[join] and any("lineitem" in x for x in lines[join:])


def test_commerce_build_exchanges_at_scale_shape(spark):
    """With broadcasts off (as at 100 TB), the feature build needs 4 hash exchanges and one line-item pass."""
    from courtview.plans.staged import features_table
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(features_table(spark, SF_SMALL, "commerce"))
        assert plan.count("Exchange hashpartitioning") == 4, plan
        assert len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", plan)) == 1, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def _nodes(plan, above=()):
    """(node, nodes above it) of a physical plan, with adaptive stages opened."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan() if plan.isFinalPlan() else plan.initialPlan(), above)
        return
    yield plan, above
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i), (*above, plan))


def test_content_build_reads_texts_in_place(spark):
    """No exchange and no sort stands above the scan of the documents' texts, and no exchange carries a text."""
    from courtview.plans.staged import PARAMS, features_table
    from courtview.registry import query_table
    from courtview.sources.bindings import content_videos_raw
    query_table()["feat_video_clean_content"](spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (features_table(spark, SF_SMALL, "content", PARAMS["content"]), content_videos_raw(spark, SF_SMALL)):
            nodes = list(_nodes(df._jdf.queryExecution().executedPlan()))
            scans = [above for p, above in nodes if "documents" in p.nodeName() and "Scan" in p.nodeName()]
            assert len(scans) == 1
            assert not [a.nodeName() for a in scans[0] if "Exchange" in a.nodeName() or a.nodeName() == "Sort"], plan_of(df)
            for p, _ in nodes:
                if "Exchange" in p.nodeName():
                    names = {p.output().apply(i).name() for i in range(p.output().size())}
                    assert not names & {"text", "video_title", "video_description", "comment_text"}, names
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _files_read(df):
    """Files that the scans of an executed DataFrame opened."""
    df.collect()
    scans = [p for p, _ in _nodes(df._jdf.queryExecution().executedPlan()) if "Scan parquet" in p.nodeName()]
    return sum(p.metrics().apply("numFiles").value() for p in scans)


def test_date_windows_read_fewer_files(spark):
    from datetime import date

    from courtview.operators.shape import collection_window
    from courtview.plans.staged import PARAMS, dated_videos
    from courtview.registry import query_table
    from courtview.sources.dated import between_dates
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = dated_videos(spark, SF_SMALL, "commerce")
        all_files = len(table.inputFiles())
        for df in (between_dates(table, date(1996, 3, 5), date(1996, 4, 2)).select("video_id"),
                   collection_window(table, date(1997, 6, 1), date(1997, 7, 1), 100, 20).select("video_id")):
            text = _formatted(df)
            assert re.search(r"PartitionFilters: \[[^\]]*published_month", text) and re.search(r"PushedFilters: \[[^\]]*published_date", text), text
            assert 0 < _files_read(df) < all_files
        assert PARAMS["commerce"].start_date > date(1992, 1, 1)
        assert "published_month" in _formatted(query_table()["win_topn_group"](spark, SF_SMALL)).split("PartitionFilters:")[1].split("\n")[0]
        assert "published_month" in _formatted(query_table()["flt_daterange"](spark, SF_SMALL)).split("PartitionFilters:")[1].split("\n")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
