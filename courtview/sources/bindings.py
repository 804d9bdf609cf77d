"""Bindings: the driver's tables -> the model tables the operators are written against.

``content``  documents + events + conversations: text paths, sparse joins, NULLs.
``commerce`` orders + customer + nation + region + lineitem: the scale binding.

Each binding returns ``videos_raw`` (base metadata left-joined with statistics,
published_at as ISO text, the shape the collection stage lands) and
``comments``.  Content comments carry text and are scored against a lexicon;
commerce comments carry a ready score.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtview.functions.dates import iso_text
from courtview.operators.broadcast import broadcast_if_bounded
from courtview.operators.features import SUMMARY_COLUMNS
from courtview.operators.shape import collection_window
from courtview.operators.skew import skew_split_join
from courtview.params import FIXTURE_LEXICON, Params
from courtview.schemas import LEXICON
from courtview.sources.colocated import attach, bucketed_input

VIDEO_RAW_COLUMNS = (
    "team", "team_abbreviation", "conference", "channel_id", "video_id", "published_at",
    "channel_title", "video_title", "video_description",
    "view_count", "like_count", "comment_count", "duration",
)
# Dimension tables are broadcast only below this many rows.
DIMENSION_MAX_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------------------
# content
# ---------------------------------------------------------------------------
def content_event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item (keyed like the model's video_id, so later joins on video_id share its partitioning)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return ev.groupBy(F.col("user_id").cast("string").alias("video_id")).agg(
        F.min("ts").alias("first_ts"),
        F.count_if(F.col("event_type") == "view").alias("n_view"),
        F.count_if(F.col("event_type") == "click").alias("n_click"),
        F.count_if(F.col("event_type") == "signup").alias("n_signup"),
    )


def content_videos_raw(spark: SparkSession, sf_dir: str, summary: DataFrame | None = None) -> DataFrame:
    """Documents with their event statistics (and the sentiment columns of ``summary``, for items that have statistics).

    The numbers of an item are joined first; whole texts are read in place from the bucketed copy of the documents.
    """
    docs = bucketed_input(read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"), "text", "lang", "source", "n_chars"), sf_dir, "video_id", "documents")
    facts = content_event_stats(spark, sf_dir)
    if summary is not None:
        facts = facts.join(summary.select("video_id", *SUMMARY_COLUMNS), "video_id", "left")
    j = attach(docs, facts, "video_id")
    n = F.col("n_chars")
    duration = F.when(n < 60, F.concat(F.lit("PT"), n.cast("string"), F.lit("S"))).otherwise(
        F.concat(F.lit("PT"), F.floor(n / 60).cast("string"), F.lit("M"), (n % 60).cast("string"), F.lit("S")))
    return j.select(
        F.col("source").alias("team"),
        F.upper("source").alias("team_abbreviation"),
        F.col("lang").alias("conference"),
        F.concat(F.lit("CH-"), F.col("source")).alias("channel_id"),
        F.col("video_id"),
        iso_text("first_ts").alias("published_at"),
        F.col("source").alias("channel_title"),
        # title and description are the whole document (rules and groupings see every word)
        F.col("text").alias("video_title"),
        F.col("text").alias("video_description"),
        F.col("n_view").alias("view_count"),
        F.col("n_click").alias("like_count"),
        F.col("n_signup").alias("comment_count"),
        duration.alias("duration"),
        *(SUMMARY_COLUMNS if summary is not None else ()),
    )


def content_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return conv.select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("comment_id"),
        F.col("text").alias("comment_text"),
        F.col("turn").alias("comment_like_count"),
        F.lit(None).cast("string").alias("comment_published_at"),
    )


def fixture_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w, Decimal(v)) for w, v in FIXTURE_LEXICON], LEXICON)


# ---------------------------------------------------------------------------
# commerce
# ---------------------------------------------------------------------------
def commerce_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region: a dimension."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(broadcast_if_bounded(region, DIMENSION_MAX_ROWS),
                       nation.n_regionkey == region.r_regionkey, "left")


def commerce_line_rollup(spark: SparkSession, sf_dir: str, threshold=Decimal("0.15")) -> DataFrame:
    """One pass over lineitem per order (keyed by l_orderkey, a number: eight bytes to deal and compare): the comment
    sentiment roll-up plus the two engagement counts.  Statistics and sentiment both select from this one
    aggregate, so the plan scans and shuffles lineitem once (the exchange is reused) and
    both arrive hash-partitioned on the order for the join that follows."""
    from courtview.operators.sentiment import rollup_scores
    scored = commerce_scored_comments(spark, sf_dir, with_quantity=True)
    return rollup_scores(scored, threshold, extra={
        "n_like": F.sum(F.col("l_quantity").cast("bigint")),
        "n_comment": F.count(F.lit(1)),
    }, key="l_orderkey")


def commerce_videos_raw(spark: SparkSession, sf_dir: str, line_rollup: DataFrame | None = None,
                        keep_summary: bool = False, window: Params | None = None) -> DataFrame:
    """Orders with customer geography and line statistics.

    With ``keep_summary`` the per-order sentiment columns of the same line-item
    aggregate ride along, so lineitem is aggregated and joined exactly once. With ``window`` the collection
    window's limits apply before the statistics are joined.

    Only the tables' own narrow columns cross the exchanges; names of nations, texts and dates are derived from them
    after the last one (before the window, which ranks by them).
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    if window is not None:  # takes no place of a list that is newest first (see ``collection_window``)
        orders = orders.where(F.col("o_orderdate") >= F.lit(window.start_date).cast("timestamp_ntz"))
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    geo = broadcast_if_bounded(commerce_geography(spark, sf_dir), DIMENSION_MAX_ROWS)
    rollup = line_rollup if line_rollup is not None else commerce_line_rollup(spark, sf_dir)
    stats = rollup.select(F.col("l_orderkey").alias("o_orderkey"), "n_like", "n_comment", *(SUMMARY_COLUMNS if keep_summary else ()))
    # a customer may hold a large share of all orders: its orders join a broadcast of its one row
    j = skew_split_join(orders, cust, "o_custkey", "left")

    def named(rows: DataFrame) -> DataFrame:
        return (rows.join(geo, rows.c_nationkey == geo.n_nationkey, "left")
                .withColumns({"video_id": F.col("o_orderkey").cast("string"), "team": F.col("n_name"), "published_at": iso_text("o_orderdate"),
                              "channel_id": F.concat(F.lit("CH-"), F.col("n_nationkey").cast("string"))}))

    if window is not None:
        j = collection_window(named(j), window.start_date, window.as_of, window.list_cap, window.top_n_per_team)
        j = j.join(stats, "o_orderkey", "left")
    else:
        j = named(j.join(stats, "o_orderkey", "left"))
    k = F.col("o_orderkey")
    duration = F.when(k % 3 == 0, F.concat(F.lit("PT"), (k % 60).cast("string"), F.lit("S"))).otherwise(
        F.concat(F.lit("PT"), (F.lit(1) + k % 20).cast("string"), F.lit("M"), (k % 60).cast("string"), F.lit("S")))
    return j.select(
        F.col("team"),
        F.upper(F.substring("n_name", 1, 3)).alias("team_abbreviation"),
        F.col("r_name").alias("conference"),
        F.col("channel_id"),
        F.col("video_id"),
        F.col("published_at"),
        F.col("n_name").alias("channel_title"),
        F.concat_ws(" ", F.col("c_mktsegment"), F.col("o_orderpriority")).alias("video_title"),
        F.col("c_name").alias("video_description"),
        F.floor("o_totalprice").cast("bigint").alias("view_count"),
        F.col("n_like").alias("like_count"),
        F.col("n_comment").alias("comment_count"),
        duration.alias("duration"),
        *(SUMMARY_COLUMNS if keep_summary else ()),
    )


def commerce_scored_comments(spark: SparkSession, sf_dir: str, with_quantity: bool = False) -> DataFrame:
    """One comment per line item with a ready score in -0.25 .. 0.25, steps of 0.05."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity")
    score = F.expr("CAST((CAST(ROUND(l_discount * 100) AS INT) - 5) * 0.05 AS DECIMAL(9,4))")
    steps = F.round(F.col("l_discount") * 100).cast("int") - 5  # score = steps * 0.05 = steps * 500 units
    cols = [
        F.col("l_orderkey").cast("string").alias("video_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("comment_id"),
        score.alias("sentiment_score"),
        (steps * 500).cast("bigint").alias("score_units"),
    ]
    if with_quantity:
        cols += ["l_orderkey", "l_quantity"]
    return li.select(*cols)


def commerce_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel reference table (one channel per nation) with its subscriber count (customers)."""
    from pyspark.sql import Window
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    subs = read_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("subscribers"))
    j = (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
         .join(subs, nation.n_nationkey == subs.c_nationkey, "left"))
    seed = F.row_number().over(Window.partitionBy("r_name").orderBy("n_nationkey"))  # 25-row dimension
    return j.select(
        F.col("n_name").alias("team"), F.upper(F.substring("n_name", 1, 3)).alias("team_abbreviation"),
        F.col("r_name").alias("conference"), seed.alias("seed"),
        F.concat(F.lit("CH-"), F.col("n_nationkey").cast("string")).alias("channel_id"),
        F.col("n_name").alias("channel_name"), F.coalesce(F.col("subscribers"), F.lit(0)).alias("subscribers"))
