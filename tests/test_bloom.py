"""The Bloom filter, and the comment join behind it."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from courtview.operators import bloom
from courtview.operators.bloom import filter_size, may_match
from courtview.plans.operator_queries import _with_video


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 4000, 2)] + [("k0",), (None,)], "video_id string").repartition(3)
    df = spark.createDataFrame([(f"k{i}", i) for i in range(40_000)] + [(None, -1)], "video_id string, n long").repartition(4)
    passed = {r.n for r in may_match(df, keys, "video_id").collect()}
    true = set(range(0, 4000, 2))
    assert true <= passed and -1 not in passed
    assert len(passed - true) < 0.05 * 38_000
    small = {r.n for r in may_match(df, keys, "video_id", max_bits=4096).collect()}  # two bits a key: many pass by chance
    assert true <= small and len(small) > len(passed)
    assert may_match(df, keys, "video_id", max_bits=1024).count() == 40_000  # too few bits: no filter
    assert may_match(df, keys.limit(0), "video_id").count() == 0


def test_size_is_bounded():
    assert filter_size(0)[0] == 64
    for n in (1, 100, 10 ** 6, 10 ** 12):
        bits, hashes = filter_size(n)
        assert bits <= bloom.MAX_BITS and 1 <= hashes <= bloom.MAX_HASHES
        assert bits >= min(bloom.MAX_BITS, bloom.BITS_PER_KEY * n)


def _tables(spark):
    rnd = random.Random(8)
    comments = [(rnd.choice(["hot", f"v{rnd.randint(0, 400)}", None]), f"c{i}", f"text {i} " * 20) for i in range(3000)]
    pulled = [("hot", "a"), *((f"v{i}", f"t{i}") for i in range(0, 100)), ("v7", "again"), (None, "none"), ("unseen", "x")]
    return (spark.createDataFrame(comments, "video_id string, comment_id string, comment_text string").repartition(5),
            spark.createDataFrame(pulled, "video_id string, team string"))


@pytest.mark.parametrize("max_bits", [None, 64, 256])
def test_join_removes_false_positives(spark, monkeypatch, max_bits):
    comments, pulled = _tables(spark)
    want = sorted(tuple(r) for r in comments.join(pulled, "video_id").select("comment_id", "comment_text", "team").collect())
    if max_bits:
        monkeypatch.setattr(bloom, "MAX_BITS", max_bits)
    got = sorted(tuple(r) for r in _with_video(comments, pulled).select("comment_id", "comment_text", "team").collect())
    assert got == want and len({c for c, *_ in got}) < len(got)


def test_texts_cross_one_exchange(spark):
    from test_plans import _nodes

    from courtview.registry import query_table
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = query_table()["join_comment_video"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
        nodes = list(_nodes(plan))
        scans = [above for p, above in nodes if "Scan" in p.nodeName() and any(p.output().apply(i).name() == "text" for i in range(p.output().size()))]
        assert scans
        for above in scans:
            assert sum("Exchange" in a.nodeName() for a in above) <= 1
            assert any("NestedLoopJoin" in a.nodeName() for a in above)  # the filter's row, below the exchange
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filter_is_merged_map_side(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("video_id"))
    plan = bloom.bloom_row(keys, "video_id", 1 << 14, 6)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan
