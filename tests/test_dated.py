"""Date-clustered tables and windows against the plain filter on ISO text."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from courtview.operators.shape import collection_window
from courtview.sources.dated import between_dates, write_dated


def _videos(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        day = datetime(2023, 11, 20) + timedelta(days=rnd.choice([30, 30, rnd.randint(0, 120)]), seconds=rnd.randint(0, 86399))
        text = rnd.choice([day.strftime("%Y-%m-%dT%H:%M:%SZ")] * 9 + [None, "soon", ""])
        rows.append((f"v{i}", f"t{rnd.choice([0, 0, 0, 1, 2, 3])}", f"c{rnd.randint(0, 9)}", text))
    return spark.createDataFrame(rows, "video_id string, team string, channel_id string, published_at string").repartition(5)


def test_windows_equal_the_filter_on_text(spark):
    videos = _videos(spark)
    dated = write_dated(videos, "test")
    assert dated.count() == 3000 and dated.where("published_month IS NULL").count() == videos.where("try_to_timestamp(published_at) IS NULL").count()
    for a, b in ((date(2023, 12, 20), date(2023, 12, 20)), (date(2023, 12, 31), date(2024, 1, 1)), (date(2020, 1, 1), date(2030, 1, 1)), (date(2024, 2, 2), date(2024, 1, 1))):
        want = {r.video_id for r in videos.where(F.to_date(F.try_to_timestamp("published_at")).between(F.lit(a), F.lit(b))).collect()}
        for df in (dated, videos):
            got = [r.video_id for r in between_dates(df, a, b).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_old_rows_may_go_before_the_list_cap(spark):
    """The cap, then the window, then the newest: the same rows when rows before the window go first."""
    videos = _videos(spark)
    ts = F.try_to_timestamp("published_at")
    sizes = []
    for cap, n, a, b in ((5, 3, date(2023, 12, 1), date(2024, 1, 10)), (60, 3, date(2024, 2, 1), date(2024, 3, 10)), (200, 20, date(2024, 1, 1), date(2024, 1, 31)), (40, 1000, date(2023, 1, 1), date(2023, 12, 20))):
        rank = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(ts.desc_nulls_last(), "video_id"))
        plain = videos.withColumn("r", rank("channel_id")).where(F.col("r") <= cap).where(F.to_date(ts).between(F.lit(a), F.lit(b))).withColumn("r", rank("team")).where(F.col("r") <= n)
        want = sorted(r.video_id for r in plain.collect())
        sizes.append(len(want))
        for df in (videos, write_dated(videos, "test-window")):
            assert sorted(r.video_id for r in collection_window(df, a, b, cap, n).collect()) == want
    assert sizes[0] == 0 and sizes[1] > 0 and sizes[2] > 0  # a short list may hold nothing but rows after the window


def test_a_hot_day_spreads_over_files(spark):
    rows = [(f"v{i}", "2024-01-01T00:00:00Z" if i % 3 else f"2024-01-{i % 28 + 1:02d}T01:00:00Z") for i in range(6000)]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dated = write_dated(spark.createDataFrame(rows, "video_id string, published_at string"), "hot")
        sizes = [r["count"] for r in dated.groupBy(F.col("_metadata.file_path")).count().collect()]
        assert len(sizes) >= 6 and max(sizes) < 6000 / 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
