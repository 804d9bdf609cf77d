import os
import tempfile

from conftest import SF_SMALL

from courtview.sources import bindings as B
from courtview.sources import payloads as P
from courtview.streaming.landing import land
from fixtures import payload_files as fx


def write_docs(docs, folder, name):
    rows = [r.json for r in docs.collect()]
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(rows) + "\n")
    return len(rows)


def test_incremental_landing_appends_only_new_documents(spark):
    src = tempfile.mkdtemp(prefix="cv-land-src-")
    out = tempfile.mkdtemp(prefix="cv-land-out-")
    docs = fx.comment_pages(B.content_comments(spark, SF_SMALL))
    first = docs.where("substring(json, 1, 20) < '{\"video_id\":\"5'")
    second = docs.subtract(first)
    write_docs(first, src, "part-1.json")
    land(spark, src, "comments", out, name=f"t-{os.path.basename(out)}")
    got1 = spark.read.parquet(out)
    assert got1.count() == P.comments(first).count() > 0
    write_docs(second, src, "part-2.json")
    land(spark, src, "comments", out, name=f"t-{os.path.basename(out)}")
    got = spark.read.parquet(out)
    want = P.comments(docs)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_landing_video_stats_equals_batch_parse(spark):
    from courtview.plans.staged import raw_videos
    src = tempfile.mkdtemp(prefix="cv-land-stats-src-")
    out = tempfile.mkdtemp(prefix="cv-land-stats-out-")
    docs = fx.stats_pages(raw_videos(spark, SF_SMALL, "commerce"))
    write_docs(docs, src, "stats.json")
    n = land(spark, src, "video_stats", out, name=f"s-{os.path.basename(out)}")
    got = spark.read.parquet(out)
    want = P.video_stats(docs)
    assert n == docs.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
