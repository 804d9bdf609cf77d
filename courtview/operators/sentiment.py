"""Lexicon sentiment: per-comment scores, labels and the per-video roll-up.

Scoring follows the lexicon method the reference calls: lower-case the text,
split on every run of characters other than ``a-z`` and ``'``, and add the
value of each lexicon word that occurs (once per text, however often it
repeats).  A text without lexicon words scores 0.

Plan shape (designed for a comments table far larger than memory):
  * a lexicon of bounded size (rows and bytes, checked) becomes a hashed literal: an array of
    buckets, each a map of a few words. Every word of a text is looked up inside the row, so a
    comment's score is a projection: no exchange, no copy, no row number;
  * a lexicon beyond that bound is joined: distinct words are exploded per comment and joined to
    it; words that hold more than a reducer's share of all tokens are salted, and their lexicon
    rows repeated once for each salt. Only there the numbered rows are written, so that scores
    come back to their rows;
  * comment scores roll up per video in one algebraic aggregate that combines map-side, so a hot
    video with a third of all comments sends one row per task.
"""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.functions.text import squish
from courtview.operators.broadcast import fits
from courtview.operators.skew import salted_join
from courtview.session import materialize

TOKEN_SPLIT = "[^a-z']+"
LEXICON_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: A lexicon up to this size travels inside the plan; the words of one bucket are few at any size.
INLINE_MAX_ROWS = 100_000
INLINE_MAX_BYTES = 8 * 1024 * 1024
WORDS_PER_BUCKET = 2
DEFAULT_THRESHOLD = Decimal("0.15")
ROW = "_comment_row"


def tokens(text_col) -> F.Column:
    """Distinct lower-case words of a text (array<string>)."""
    return F.array_distinct(F.split(F.lower(text_col), TOKEN_SPLIT))


# Scores are exact multiples of 1e-4 (lexicon values are DECIMAL(9,4)).  Inside the
# plan they travel as integer units of 1e-4: sums of longs are exact, order-free
# and run on the fast path, where a DECIMAL sum of this width would fall back to
# BigDecimal arithmetic for every comment row.
SCORE_SCALE = 10_000


def score_units(threshold: Decimal) -> int:
    units = threshold * SCORE_SCALE
    if units != int(units):
        raise ValueError(f"threshold {threshold} is not a multiple of 1/{SCORE_SCALE}")
    return int(units)


def units_to_decimal(units: F.Column) -> F.Column:
    return (units.cast("decimal(18,0)") / F.lit(SCORE_SCALE)).cast("decimal(18,4)")


def word_units(lexicon: DataFrame) -> DataFrame:
    """(word, units): one row per word (duplicate words add up)."""
    return lexicon.where(F.col("word").isNotNull()).groupBy("word").agg((F.sum("value") * F.lit(SCORE_SCALE)).cast("bigint").alias("units"))


def inline_lexicon(lexicon: DataFrame, max_rows: int = INLINE_MAX_ROWS, max_bytes: int = INLINE_MAX_BYTES) -> tuple[F.Column, int] | None:
    """The lexicon as a constant array of buckets (word -> units) and their number, or None if it is beyond the bounds.

    Its size is checked by a probe that reads ``max_rows + 1`` rows at most. A word's bucket is its XXH64 modulo the
    number of buckets, computed by Spark on either side.
    """
    words = word_units(lexicon)
    if not fits(words, max_rows, max_bytes):
        return None
    rows = words.where(F.col("units").isNotNull()).select("word", "units", F.xxhash64("word").alias("h")).collect()  # at most max_rows
    n = max(1, len(rows) // WORDS_PER_BUCKET)
    buckets: list[dict[str, int]] = [{} for _ in range(n)]
    for r in rows:
        buckets[r["h"] % n][r["word"]] = r["units"]
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,bigint>>"), n  # folded to a constant by the optimizer


def text_units(text_col: F.Column, inline: tuple[F.Column, int]) -> F.Column:
    """The score of a text in units, by looking its distinct words up in an ``inline_lexicon`` (null texts: 0)."""
    buckets, n = inline
    place = lambda w: F.pmod(F.xxhash64(w), F.lit(n).cast("bigint")).cast("int")
    value = lambda w: F.coalesce(F.get(buckets, place(w))[w], F.lit(0).cast("bigint"))
    return F.coalesce(F.aggregate(tokens(text_col), F.lit(0).cast("bigint"), lambda total, w: total + value(w)), F.lit(0).cast("bigint"))


def matched_comment_scores(comments: DataFrame, lexicon: DataFrame,
                           keys=("video_id", "comment_id"), text_col: str = "comment_text") -> DataFrame:
    """(keys..., score_units) for comments with at least one lexicon word, one row per comment row.

    Rows are told apart by a number given before the words are exploded, so that
    comments with a missing or repeated id keep scores of their own. Where the lexicon is too large to be
    broadcast, heavy words are salted by that number.
    """
    numbered = comments.withColumn(ROW, F.monotonically_increasing_id()) if ROW not in comments.columns else comments
    toks = numbered.select(*keys, ROW, F.explode(tokens(F.col(text_col))).alias("word"))
    words = word_units(lexicon)
    if fits(words, LEXICON_MAX_ROWS, BROADCAST_MAX_BYTES):
        hits = toks.join(F.broadcast(words), "word", "inner")
    else:
        hits = salted_join(toks, words, "word", F.col(ROW))
    return hits.groupBy(*keys, ROW).agg(F.sum("units").alias("score_units"))


def comment_units(comments: DataFrame, lexicon: DataFrame, text_col: str = "comment_text", keep: list[str] | None = None) -> DataFrame:
    """``comments`` (or the ``keep`` columns of it) with ``score_units`` of each row."""
    inline = inline_lexicon(lexicon)
    keep = comments.columns if keep is None else keep
    if inline is not None:
        return comments.select(*keep, text_units(F.col(text_col), inline).alias("score_units"))
    # the numbered rows are written once, so that the join back by row number reads the same numbers
    base = materialize(comments.select(*dict.fromkeys([*keep, text_col])).withColumn(ROW, F.monotonically_increasing_id()), "comments")
    scores = matched_comment_scores(base, lexicon, (), text_col)
    return base.join(scores, ROW, "left").select(*keep, F.coalesce("score_units", F.lit(0).cast("bigint")).alias("score_units"))


def score_comments(comments: DataFrame, lexicon: DataFrame,
                   threshold: Decimal = DEFAULT_THRESHOLD) -> DataFrame:
    """comments + comment_text_clean, sentiment_score, sentiment_label (the comment-level table)."""
    t = score_units(threshold)
    out = comment_units(comments.withColumn("comment_text_clean", squish("comment_text")), lexicon, "comment_text_clean")
    u = F.col("score_units")
    return out.withColumns({
        "sentiment_score": units_to_decimal(u),
        "sentiment_label": F.when(u > t, F.lit("Positive")).when(u < -t, F.lit("Negative")).otherwise(F.lit("Neutral")),
    }).drop("score_units")


def _summary(n: F.Column, units_sum: F.Column, pos: F.Column, neg: F.Column) -> list[F.Column]:
    nd = n.cast("double")
    return [
        n.alias("comments_pulled"),
        (F.coalesce(units_sum, F.lit(0)).cast("double") / F.lit(float(SCORE_SCALE)) / nd)
        .alias("avg_comment_sentiment"),
        (F.coalesce(pos, F.lit(0)).cast("double") / nd).alias("positive_comment_pct"),
        ((n - F.coalesce(pos, F.lit(0)) - F.coalesce(neg, F.lit(0))).cast("double") / nd).alias("neutral_comment_pct"),
        (F.coalesce(neg, F.lit(0)).cast("double") / nd).alias("negative_comment_pct"),
    ]


def _unit_aggs(t: int) -> list[F.Column]:
    u = F.col("score_units")
    return [F.sum(u).alias("units_sum"), F.count_if(u > t).alias("pos"), F.count_if(u < -t).alias("neg")]


def rollup_scores(scored: DataFrame, threshold: Decimal = DEFAULT_THRESHOLD,
                  extra: dict[str, F.Column] | None = None, key: str = "video_id") -> DataFrame:
    """Per-video summary from (video_id, score_units | sentiment_score) rows.

    ``extra`` adds more per-video aggregates to the same pass (one scan, one shuffle); ``key`` names another
    column that tells the videos apart.
    """
    if "score_units" not in scored.columns:
        scored = scored.withColumn("score_units", (F.col("sentiment_score") * F.lit(SCORE_SCALE)).cast("bigint"))
    extra = extra or {}
    agg = scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *_unit_aggs(score_units(threshold)),
        *[c.alias(k) for k, c in extra.items()],
    )
    return agg.select(key, *_summary(F.col("n"), F.col("units_sum"), F.col("pos"), F.col("neg")), *extra)


def video_sentiment(comments: DataFrame, lexicon: DataFrame,
                    threshold: Decimal = DEFAULT_THRESHOLD) -> DataFrame:
    """Per-video summary straight from comment text: one aggregate over the scored rows."""
    return rollup_scores(comment_units(comments, lexicon, keep=["video_id"]), threshold)


def label_counts(scored: DataFrame) -> DataFrame:
    """Label frequency table with share of the total (QA summary)."""
    g = scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    shares = g.withColumn("pct", F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()))  # over one row per label
    return shares.orderBy(F.desc("n"), "sentiment_label")
