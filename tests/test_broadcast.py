from conftest import SF_SMALL

from courtview.operators.broadcast import broadcast_if_bounded, estimated_bytes, row_count_at_most
from courtview.plans.staged import raw_videos
from courtview.sources import bindings as B


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_prove_small_dimension(spark):
    region = B.read_table(spark, SF_SMALL, "region")
    assert 0 < estimated_bytes(region) < 1_000_000
    nation = B.read_table(spark, SF_SMALL, "nation")
    j = nation.join(broadcast_if_bounded(region), nation.n_regionkey == region.r_regionkey)
    assert "BroadcastHashJoin" in plan_of(j)


def test_probe_bounds_and_refuses(spark):
    df = spark.range(0, 1000)
    assert row_count_at_most(df, 1000) == 1000
    assert row_count_at_most(df, 999) is None
    # a side that cannot be proven small is left to the optimizer (no hint)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint could broadcast now
    try:
        big = spark.range(0, 5000).toDF("k")
        other = spark.range(0, 5000).toDF("k")
        refused = other.join(broadcast_if_bounded(big, max_rows=100, max_bytes=1), "k")
        assert "BroadcastHashJoin" not in plan_of(refused)
        proven = other.join(broadcast_if_bounded(big, max_rows=10_000, max_bytes=200_000), "k")
        assert "BroadcastHashJoin" in plan_of(proven)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_raw_videos_published_once(spark):
    a = raw_videos(spark, SF_SMALL, "commerce")
    b = raw_videos(spark, SF_SMALL, "commerce")
    assert a is b
    assert "FileScan parquet" in plan_of(a) or "Scan parquet" in plan_of(a)
    assert a.count() == B.commerce_videos_raw(spark, SF_SMALL).count()


def test_bucketed_tables_join_without_exchange(spark):
    from courtview.sources.files import write_table
    docs = spark.range(0, 2000).selectExpr("cast(id as string) AS video_id", "repeat('x', 50) AS text")
    stats = spark.range(0, 2000).selectExpr("cast(id as string) AS video_id", "id % 7 AS n_view")
    a = write_table(docs, "t_docs_bucketed", bucket_by="video_id", buckets=8)
    b = write_table(stats, "t_stats_bucketed", bucket_by="video_id", buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b, "video_id", "left")
        plan = plan_of(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
