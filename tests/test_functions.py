from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtview.functions.dates import date_parts, iso_bound, parse_ts
from courtview.functions.numeric import bi, mean, rate_per_day, round_to, safe_ratio, try_numeric, try_whole, weighted_rate
from courtview.functions.text import (html_decode, label_3way, manual_order_key, priority_rank, priority_short,
                                      rules_first_match, squish, strip_newlines)
from courtview.operators.features import priority
from courtview.params import PRIORITY_SHORT_ORDER, REFERENCE_CONTENT_RULES
from courtview.sources.files import clean_name


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_squish_unicode_and_nulls(spark):
    data = [(" a  b\t\tc \n",), ("",), (None,), ("x y",), ("p\x0bq",)]
    got = one(spark, squish("s"), data, "s string")
    # vertical tab is not whitespace for the reference's squish
    assert got == ["a b c", "", None, "x y", "p\x0bq"]


def test_strip_newlines(spark):
    assert one(spark, strip_newlines("s"), [("a\r\n\nb\rc",)], "s string") == ["a b c"]


def test_html_decode_cases(spark):
    data = [("Tom &amp; Jerry &#39;s &#x27;q&#X27; &copy;",), ("&amp;lt;",), ("&nosuch; &",), ("plain",),
            (None,), ("&#0; &#xD800;",),
            ("&#0000000065;&#x000000041; &check; &lbrace; &#99999999999999999999;",)]
    got = one(spark, html_decode("s"), data, "s string")
    assert got == ["Tom & Jerry 's 'q' ©", "&lt;", "&nosuch; &", "plain", None, "&#0; &#xD800;",
                   "AA \u2713 { &#99999999999999999999;"]


def test_label_boundaries_are_strict(spark):
    data = [(Decimal("0.15"),), (Decimal("0.1500001"),), (Decimal("-0.15"),), (Decimal("-0.2"),), (None,)]
    got = one(spark, label_3way("x", Decimal("0.15")), data, "x decimal(18,7)")
    assert got == ["Neutral", "Positive", "Neutral", "Negative", "Neutral"]


def test_safe_ratio_and_rate(spark):
    df = spark.createDataFrame([(10, 0, 5), (10, None, 0), (3, 4, None), (8, 2, 4)], "a long, v long, d int")
    rows = df.select(safe_ratio("a", "v").alias("r"), safe_ratio("a", "v", 1000).alias("k"),
                     rate_per_day("v", "d").alias("p")).collect()
    assert rows[0] == (None, None, 0.0)          # zero views -> NULL ratio; positive age
    assert rows[1] == (None, None, None)         # NULL views
    assert rows[2] == (0.75, 750.0, None)        # missing age -> NULL rate
    assert rows[3] == (4.0, 4000.0, 0.5)


def test_rate_age_zero_keeps_views(spark):
    df = spark.createDataFrame([(7, 0), (7, -1)], "v long, d int")
    assert [r[0] for r in df.select(rate_per_day("v", "d")).collect()] == [7.0, 7.0]


def test_try_numeric(spark):
    assert one(spark, try_numeric("s"), [("12",), ("NA",), (None,), ("12.7",), ("1e3",)], "s string") == [12.0, None, None, 12.7, 1000.0]
    assert one(spark, try_whole("s"), [("12",), ("1e3",), ("12.7",), ("NA",)], "s string") == [12, 1000, None, None]


def test_round_ties_and_weighted_rate(spark):
    df = spark.createDataFrame([(84189.0 / 2280,), (0.16874999999999998,), (0.00005,)], "x double")
    got = [r[0] for r in df.select(round_to("x", 2)).collect()]
    assert got[:2] == [36.93, 0.17]
    df = spark.createDataFrame([(126463, 3662798), (5, 0)], "e long, v long")
    got = [r[0] for r in df.select(weighted_rate(F.col("e"), F.col("v"))).collect()]
    assert got == [0.0345, None]


def test_published_mean_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e-9, 0.7, 1 / 3, 2 / 3] * 50
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7).agg(bi(mean("x"))).first()[0]
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1).agg(bi(mean("x"))).first()[0]
    assert a == b


def test_priority_null_flag_falls_through(spark):
    df = spark.createDataFrame([(True, True), (None, True), (True, None), (None, False), (False, False)],
                               "e boolean, n boolean")
    got = [r[0] for r in df.select(priority(F.col("e"), F.col("n"))).collect()]
    assert got == ["High Engagement / High Negative Sentiment", "High Negative Sentiment", "High Engagement",
                   "Standard", "Standard"]


def test_recode_manual_order_and_case_rank(spark):
    labels = ["High Engagement / High Negative Sentiment", "High Negative Sentiment", "High Engagement",
              "Standard", "Something else"]
    df = spark.createDataFrame([(x,) for x in labels], "p string")
    rows = df.select(priority_short("p").alias("s"), priority_rank("p").alias("r")).collect()
    assert [r.s for r in rows] == list(PRIORITY_SHORT_ORDER) + ["Standard"]
    assert [r.r for r in rows] == [1, 2, 3, 4, 4]
    keys = [r[0] for r in spark.createDataFrame([("High Engagement",), ("zzz",)], "s string")
            .select(manual_order_key("s", PRIORITY_SHORT_ORDER)).collect()]
    assert keys == [3, None]


def test_date_parts_and_parse(spark):
    df = spark.createDataFrame([("2026-04-20T15:30:00Z",), ("bad",), (None,)], "s string")
    parts = date_parts(parse_ts("s"), __import__("datetime").date(2026, 4, 20))
    rows = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert rows[0].published_hour == 15 and rows[0].days_since_published == 0
    assert str(rows[0].published_month) == "2026-04-01"
    assert rows[1].published_date is None and rows[2].published_date is None
    assert spark.range(1).select(iso_bound(__import__("datetime").date(2026, 4, 18))).first()[0] == \
        "2026-04-18T00:00:00Z"


def python_first_match(title, duration, rules, default):
    import re
    for label, tp, dp in rules:
        if (tp and title is not None and re.search(tp, title)) or (dp and duration is not None and re.search(dp, duration)):
            return label
    return default


WORDS = ["shorts", "#shorts", "highlight", "recap", "interview", "behind", "mic", "hype", "promo", "dynamic",
         "game", "night", "press conference", "x"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(WORDS), max_size=4),
                          st.sampled_from(["PT45S", "PT1M2S", None, "PT10M"])), min_size=1, max_size=20))
def test_rules_first_match_equals_python_fold(spark, rows):
    data = [(" ".join(ws) if ws else None, d) for ws, d in rows]
    got = one(spark, rules_first_match(F.col("t"), F.col("d"), REFERENCE_CONTENT_RULES, "Other"), data,
              "t string, d string")
    want = [python_first_match(t, d, REFERENCE_CONTENT_RULES, "Other") for t, d in data]
    assert got == want


def test_clean_name_rules():
    """Symbols, accents, acronyms, leading digits, quotes, letters without an ASCII form, names without a word."""
    from courtview.sources.files import unique_names
    want = {"Win %": "win_percent", "# of Views": "number_of_views", "%": "percent", "2 Points": "x2_points", "3PT%": "x3_pt_percent", "1k Views": "x1k_views",
            "Équipe Préférée": "equipe_preferee", "Straße": "strasse", "Łódź Ærø": "lodz_aero", "ÆRØ Œuvre": "aero_oeuvre", "HTMLPage": "html_page", "VideoID": "video_id", "YYYYMonth": "yyyy_month",
            "parseJSONFile": "parse_json_file", "Q4Results": "q4_results", "ABC": "abc", "don't Know": "dont_know", "\u201cQuoted\u201d \"Name\"": "quoted_name",
            "__a..b__": "a_b", "": "x", "---": "x", "日本": "x", "µ Level": "u_level", "A1b2C3": "a1b2_c3"}
    assert {n: clean_name(n) for n in want} == want
    assert unique_names(["a", "a", "a_2", "a", "b"]) == ["a", "a_2", "a_2_2", "a_3", "b"]


def test_clean_name():
    assert clean_name("Video Id") == "video_id"
    assert clean_name("likeCount") == "like_count"
    assert clean_name("Likes Per 1k Views") == "likes_per_1k_views"
    assert clean_name("  weird--Name!! ") == "weird_name"


def test_cluster_conf_sizes_partitions():
    from courtview.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    splits = 100 * 1024 ** 4 // int(big["spark.sql.files.maxPartitionBytes"])
    assert 8000 <= int(big["spark.sql.shuffle.partitions"]) <= 24000    # 1 to 3 waves of cores
    assert splits * int(big["spark.sql.shuffle.partitions"]) <= 2_000_000_000
    wide = cluster_conf(10 * 1024 ** 4, executors=100, cores_per_executor=8, exchange_bytes=2 * 1024 ** 4)
    assert int(wide["spark.sql.shuffle.partitions"]) == 8192             # 256 MB per reducer
    small = cluster_conf(10 * 1024 ** 2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24              # at least 3 waves of cores
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
