from courtview.sources import payloads as P
from fixtures import payload_files as fx


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json string")


def test_empty_and_malformed_pages(spark):
    d = docs(spark, '{"video_id": "v", "items": []}', "{not json", '{"video_id": "w", "items": [{"snippet": '
             '{"topLevelComment": {"id": "c1", "snippet": {"textDisplay": "hi", "likeCount": "3"}}}}]}')
    rows = P.comments(d).collect()
    assert [(r.video_id, r.comment_id, r.comment_like_count, r.comment_published_at) for r in rows] == \
        [("w", "c1", 3, None)]


def test_channel_check_and_uploads(spark):
    req = spark.createDataFrame([("A",), ("B",)], "channel_id string")
    d = docs(spark, '{"items": [{"id": "A", "snippet": {"title": "Team A"}, "statistics": {"subscriberCount": '
             '"12"}, "contentDetails": {"relatedPlaylists": {"uploads": "UUA"}}}]}', '{"items": []}')
    got = {r.checked_channel_id: r for r in P.channel_check(d, req).collect()}
    assert got["A"].valid_channel and got["A"].subscriber_count == 12.0
    assert not got["B"].valid_channel and got["B"].channel_title is None
    assert sorted(tuple(r) for r in P.uploads_playlist(d, req).collect()) == [("A", "UUA"), ("B", None)]


def test_stats_absent_leaf_is_null(spark):
    d = docs(spark, '{"items": [{"id": "v1", "statistics": {"viewCount": "10"}, "contentDetails": {}}]}')
    r = P.video_stats(d).first()
    assert (r.view_count, r.like_count, r.comment_count, r.duration) == (10, None, None, None)


def test_playlist_cap_in_page_order(spark):
    def page(p, ids):
        items = ",".join('{"contentDetails": {"videoId": "%s"}}' % i for i in ids)
        return '{"channel_id": "c", "page": %d, "nextPageToken": "t%d", "items": [%s]}' % (p, p, items)
    d = docs(spark, page(1, ["d", "e"]), page(0, ["a", "b", "c"]))
    assert [r.video_id for r in P.playlist_items(d, 4).orderBy("video_id").collect()] == ["a", "b", "c", "d"]


def test_playlist_stops_at_an_empty_page(spark):
    item = '{"contentDetails": {"videoId": "%s"}}'
    page = '{"channel_id": "c", "page": %d, "nextPageToken": "t", "items": [%s]}'
    d = docs(spark, page % (0, item % "a"), page % (1, ""), page % (2, item % "b"), '{"channel_id": "e", "page": 0, "items": []}')
    assert [r.video_id for r in P.playlist_items(d).collect()] == ["a"]


def test_comment_pages_hold_a_bounded_number(spark):
    rows = [("hot", f"c{i}", "t", 1, None) for i in range(230)] + [("v", None, "t", 1, None)]
    c = spark.createDataFrame(rows, "video_id string, comment_id string, comment_text string, comment_like_count long, comment_published_at string")
    pages = fx.comment_pages(c, 50)
    assert pages.count() >= 6
    assert max(len(P.parse(docs(spark, r.json), P.COMMENTS_PAGE).first().doc["items"]) for r in pages.collect()) <= 50
    assert sorted(map(str, (r.comment_id for r in P.comments(pages).collect()))) == sorted(str(r[1]) for r in rows)


def test_playlist_ends_with_a_page_without_a_token(spark):
    item = '{"contentDetails": {"videoId": "%s"}}'
    page = '{"channel_id": "%s", "page": %d, %s"items": [%s]}'
    token = '"nextPageToken": "n", '
    d = docs(spark, page % ("c", 0, token, item % "a"), page % ("c", 1, "", item % "b"), page % ("c", 2, token, item % "stale"),
             page % ("d", 0, '"nextPageToken": null, ', item % "x"), page % ("d", 1, "", item % "stale"), page % ("e", 0, token, item % "y"))
    assert sorted((r.channel_id, r.video_id) for r in P.playlist_items(d).collect()) == [("c", "a"), ("c", "b"), ("d", "x"), ("e", "y")]


def test_search_takes_the_first_page(spark):
    item = '{"id": {"channelId": "%s"}, "snippet": {"title": "t"}}'
    many = ",".join(item % f"c{i}" for i in range(9))
    d = docs(spark, '{"query": "q", "page": 0, "items": [%s]}' % many, '{"query": "q", "page": 1, "items": [%s]}' % (item % "late"), '{"query": "r", "items": [%s]}' % (item % "z"))
    assert sorted((r.query, r.channel_id) for r in P.channel_search(d).collect()) == [("q", f"c{i}") for i in range(5)] + [("r", "z")]


def test_landed_folders_are_read_by_ordinary_scans(spark):
    from conftest import SF_SMALL

    from courtview.registry import query_table
    for key in ("json_video_stats", "json_comments", "unnest_nested", "json_channel_search"):
        plan = query_table()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" in plan and "Exchange" not in plan, key


def test_landed_pages_are_bounded(spark):
    from conftest import SF_SMALL

    from courtview.registry import query_table
    pages = P.read_pages(spark, fx.landed(spark, SF_SMALL, "playlist"))
    sizes = [len(r.doc["items"]) for r in P.parse(pages, P.PLAYLIST_PAGE).collect()]
    assert max(sizes) <= 50 and sum(sizes) == query_table()["unnest_nested"](spark, SF_SMALL).count()
