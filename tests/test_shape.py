import random

from pyspark.sql import functions as F

from courtview.operators.shape import id_batches, top_n_per_group, union_all, with_global_index


def test_global_index_is_dense_and_ordered(spark):
    rnd = random.Random(1)
    keys = rnd.sample(range(1_000_000), 5000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    rows = with_global_index(df, [F.col("k")]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(5000))
    assert [r.k for r in rows] == sorted(keys)


def test_id_batches(spark):
    ids = [f"{i:05d}" for i in range(123)]
    df = spark.createDataFrame([(i,) for i in ids + ids[:10]], "video_id string")
    rows = sorted(id_batches(df, "video_id", 50).collect())
    assert [r.n_ids for r in rows] == [50, 50, 23]
    assert ",".join(r.ids for r in rows) == ",".join(ids)


def test_top_n_per_group_with_hot_group(spark):
    data = [("hot", i) for i in range(3000)] + [(f"g{i % 40}", i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v long").repartition(8)
    got = top_n_per_group(df, ["g"], [F.col("v").desc()], 3)
    want = {}
    for g, v in data:
        want.setdefault(g, []).append(v)
    want = {g: sorted(vs, reverse=True)[:3] for g, vs in want.items()}
    have = {}
    for r in got.collect():
        have.setdefault(r.g, []).append(r.v)
    assert {g: sorted(vs, reverse=True) for g, vs in have.items()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "TakeOrderedAndProject" in plan


def test_union_all_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, 0.5)], "id long, b double")
    e = spark.createDataFrame([], "id long")
    rows = sorted(union_all([a, b, e]).collect(), key=lambda r: r.id)
    assert rows[0].asDict() == {"id": 1, "a": "x", "b": None}
    assert rows[1].asDict() == {"id": 2, "a": None, "b": 0.5}


def test_skew_split_join_equals_plain_join(spark):
    from courtview.operators.skew import hot_keys, skew_split_join
    big_rows = [("hot", i) for i in range(3000)] + [(f"k{i % 300}", i) for i in range(6000)] + [(None, -1)]
    big = spark.createDataFrame(big_rows, "k string, v long").repartition(8)
    small = spark.createDataFrame([(f"k{i}", i) for i in range(0, 300, 2)] + [("hot", 7)], "k string, w long")
    assert hot_keys(big, "k", 0.05) == ["hot"]
    assert hot_keys(big.where("k != 'hot'"), "k", 0.05) == []  # candidates that the exact count does not confirm
    for how in ("inner", "left"):
        got = skew_split_join(big, small, "k", how, support=0.05)
        want = big.join(small, "k", how)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_default_support_follows_partitions(spark):
    from courtview.operators.skew import default_support
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert default_support(spark) == 0.01
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        assert default_support(spark) == 0.001
        spark.conf.set("spark.sql.shuffle.partitions", "400000")
        assert default_support(spark) == 1e-4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
