"""Published copies hold a text once, and exchanges carry neither whole texts nor derived names."""

import pytest
from conftest import SF_SMALL
from test_plans import _nodes

from courtview.functions.text import rules_first_match
from courtview.plans import dashboards as D
from courtview.plans.staged import PARAMS, features_table, published_features, raw_videos, staged
from courtview.sources import colocated

MARKS = "monitoring_priority string, video_id string, engagement_rate double, negative_comment_pct double, view_count long, video_title string, team string"


@pytest.fixture
def no_auto_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def _exchanged(df):
    """Names of the columns that cross an exchange of rows (broadcasts aside)."""
    names = set()
    for p, _ in _nodes(df._jdf.queryExecution().executedPlan()):
        if p.nodeName() == "Exchange":
            names |= {p.output().apply(i).name() for i in range(p.output().size())}
    return names


def test_published_content_holds_a_text_once(spark):
    for table in (published_features(spark, SF_SMALL, "content"), raw_videos(spark, SF_SMALL, "content")):
        stored = spark.read.parquet(*table.inputFiles()).columns
        assert "video_title" in stored and "video_description" not in stored
        assert "video_description" in table.columns
        assert table.where("not (video_title <=> video_description)").isEmpty() and not table.where("video_title is not null").isEmpty()


def test_bucketed_copy_keeps_rows_and_is_written_unsorted(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(str(i % 40) if i % 7 else None, f"t{i}") for i in range(300)], "k string, text string").write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.conf.get(colocated.OPEN_FILES)
    with pytest.raises(ZeroDivisionError), colocated.unsorted_writes(spark):
        assert int(spark.conf.get(colocated.OPEN_FILES)) > 0  # Spark sorts by bucket unless files may stay open
        raise ZeroDivisionError
    assert spark.conf.get(colocated.OPEN_FILES) == before
    table = spark.table(colocated.write_bucketed(df, "k", "rows"))
    assert sorted(table.collect(), key=str) == sorted(df.collect(), key=str)


def test_commerce_exchanges_carry_the_tables_own_columns(spark, no_auto_broadcast):
    names = _exchanged(features_table(spark, SF_SMALL, "commerce"))
    assert "o_orderkey" in names and not names & {"video_id", "team", "n_name", "r_name", "published_at", "channel_id"}, names


def test_scatter_deals_no_title_of_a_video_with_one_row(spark, no_auto_broadcast):
    assert "video_title" not in _exchanged(D.v_scatter(staged(spark, SF_SMALL, "content")))


def test_scatter_marks_equal_a_plain_grouping(spark):
    rows = [("p", "a", 0.5, 0.25, 3, "x", "t"), ("p", "b", None, -0.0, None, None, None), ("p", "c", 1.0, 1.0, 1, "y", "t"), ("p", "c", 2.0, None, 2, "z", "t"),
            ("q", "c", 2.0, 0.0, 2, "z", "u"), ("p", None, 1.0, 0.0, 1, "n", "t"), ("p", None, 1.0, 0.0, 1, None, "u"), ("q", None, 0.1, 0.2, 1, "m", "u"),
            ("p", "d", 0.1, 0.2, 1, "s", "t"), ("p", "d", 0.2, 0.4, 1, "s", "t")]
    for some in (rows, rows[:3], []):
        df = spark.createDataFrame(some, MARKS)
        got, want = D._scatter_marks(df), D._grouped_marks(df, ["monitoring_priority", "video_id"])
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_scatter_groups_all_rows_where_repeated_videos_are_many(spark, monkeypatch):
    rows = [("p", str(i // 2), 0.5, 0.5, i, f"t{i % 3}", "t") for i in range(40)]
    df = spark.createDataFrame(rows, MARKS)
    want = sorted(D._scatter_marks(df).collect(), key=str)
    monkeypatch.setattr(D, "DEFAULT_MAX_ROWS", 5)
    assert sorted(D._scatter_marks(df).collect(), key=str) == want and len(want) == 20


def test_top_titles_are_broadcast_to_the_rows(spark, no_auto_broadcast):
    stg = staged(spark, SF_SMALL, "content")
    names = [p.nodeName() for p, _ in _nodes(D.v_top_videos(stg, PARAMS["content"])._jdf.queryExecution().executedPlan())]
    assert "BroadcastHashJoin" in names and "SortMergeJoin" not in names, names


def test_plain_words_are_found_as_by_the_pattern(spark):
    rules = (("one", "best plays|recap", None), ("two", " los | die ", None), ("three", "ción", None), ("four", "[0-9]+|^x", None), ("five", None, "^PT[0-9]+S$"))
    titles = ["the best plays", "a recap", "in los x", "el die", "nación", "x1", "xyz", "", None, "none"]
    df = spark.createDataFrame([(t, d) for t in titles for d in ("PT5S", "PT1M5S", None)], "t string, d string")
    import re
    got = df.select("t", "d", rules_first_match("t", "d", rules, "rest").alias("r")).collect()
    for r in got:
        hit = [n for n, p, dp in rules if (p and r.t is not None and re.search(p, r.t)) or (dp and r.d and re.search(dp, r.d))]
        assert r.r == (hit[0] if hit else "rest"), r
    plan = df.select(rules_first_match("t", "d", rules[:3], "rest"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan
