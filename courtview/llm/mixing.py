"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

``source_targets``: the sources, by code point and null last, weigh ``weights`` in turn and share all words in
proportion. A source's target stops at ``max_epochs`` times its size; the excess is dealt again by weight to the
others until none is above its cap. ``mix_sources`` then takes whole repetitions of every document and, for what
is left of the target, one more repetition of a seeded choice.

The choice: a document's draw is a hash of seed, doc_id and text. Each source gets one cut on the draw such that the
documents up to it hold the words wanted, found by refining ten bits of the draw at a time: sums for 1,024 buckets of
each source, then for 1,024 parts of the one bucket the cut falls into, then the few draws left. No task sees all rows
of a source, however large. The document on which a cut falls is left out. What is then missing is filled from the
documents left, in the same way, by those of at most half the missing size: each such pass takes all of them or halves what is
missing at least. It ends where less than ``near`` of the target is missing or no such document is left; then the one
document (with its equal rows) that brings the source nearest to its target is taken, if any does. Equal rows (same doc_id
and text) share one draw.

Defined results: a null text has size 0 and its row takes 0 words; null sources are one source, the last;
null doc_ids draw by their text; an empty table gives an empty result. Other columns are not read; names
with two leading underscores are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtview.llm.common import ordered_positions, write_scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20240229
NEAR = 0.001
LAST_DRAW = (1 << 63) - 1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str, text: str, seed: int) -> Column:
    """A number of 63 bits, from the row alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)), 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to those and weight, target: capped water-filling over any number of sources."""
    spark = sizes.sparkSession
    ranked, _, _ = ordered_positions(sizes.select("source", "source_size"), ["source"], 8, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__pos") % len(weights) + 1).cast("int"))
    table, _ = write_scratch(ranked.select("source", "source_size", weight.alias("weight"),
                                           (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap")), "mix-weights")
    total, free = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).first()
    level, clamped = total / free, -1
    while True:  # each round clamps at least one more source, or is the last
        over = F.col("cap") < F.lit(level) * F.col("weight")
        n, held, free = table.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
                                  F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == clamped or not free:
            break
        level, clamped = max(level, (total - held) / free), n
    return table.select("source", "source_size", "weight", F.least(F.col("cap"), F.lit(float(level)) * F.col("weight")).alias("target"))


def _taken(cuts: str, size: Column, draw_col: Column) -> Column:
    """Whether one of the source's cuts takes a document once more."""
    return F.exists(cuts, lambda c: (size <= c["most"]) & (draw_col >= c["low"]) & (draw_col <= c["high"]))


def _pass(left: DataFrame) -> DataFrame:
    """(source, high, held): the longest run of draws of the source's ``left`` rows that holds no more than ``missing``."""
    def buckets(part: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
        sums = part.groupBy(*keys, "missing", bucket.alias("__bucket")).agg(F.sum("size").alias("__size"))
        upto = F.sum("__size").over(Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0))
        return sums.withColumn("__upto", upto)

    def crossed(part: DataFrame, keys: list[str], bucket: Column, name: str) -> DataFrame:
        """The bucket in which the running sum passes what is missing, if any, with what is missing before it."""
        before = F.col("__upto") - F.col("__size")
        here = (F.col("__upto") > F.col("missing")) & (before <= F.col("missing"))
        return buckets(part, keys, bucket).filter(here).select(*keys, F.col("__bucket").alias(name), (F.col("missing") - before).alias("missing"))

    top, next_bits = F.shiftright("draw", 53), F.shiftright("draw", 43).bitwiseAND(F.lit(1023))
    rows = left.select(F.col("source").alias("__source"), "size", "draw")
    whole = left.groupBy("source").agg(F.sum("size").alias("__all"))
    first, _ = write_scratch(crossed(left, ["source"], top, "b1"), "mix-cut1")
    in_first = rows.join(first, F.col("__source").eqNullSafe(F.col("source")) & (top == F.col("b1")))
    second, _ = write_scratch(crossed(in_first, ["source", "b1"], next_bits, "b2"), "mix-cut2")
    in_second = rows.join(second, F.col("__source").eqNullSafe(F.col("source")) & (top == F.col("b1")) & (next_bits == F.col("b2")))
    fits = F.col("__upto") <= F.col("missing")
    third = buckets(in_second, ["source", "b1", "b2"], F.col("draw")).groupBy("source", "b1", "b2", "missing").agg(
        F.max(F.when(fits, F.col("__bucket"))).alias("__last"), F.coalesce(F.max(F.when(fits, F.col("__upto"))), F.lit(0)).alias("__held"))
    below = F.shiftleft("b1", 53) + F.shiftleft("b2", 43) - 1  # below every draw of the part
    cut = third.select(F.col("source").alias("__cut_source"), F.coalesce("__last", below).alias("high"), (F.col("missing") - F.col("__held")).alias("rest"))
    # a source whose rows never pass what is missing gives them all
    return whole.join(cut, F.col("source").eqNullSafe(F.col("__cut_source")), "left").select(
        F.col("source").alias("__cut_source"), F.coalesce("high", F.lit(LAST_DRAW)).alias("high"), "rest", "__all")


def _cuts(rows: DataFrame, targets: DataFrame, near: float) -> DataFrame:
    """targets with ``whole`` repetitions, the ``cuts`` that repeat a document once more, and what is ``missing``."""
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    cuts_type = "array<struct<most:bigint,low:bigint,high:bigint>>"
    whole = F.floor(epochs)
    plan, _ = write_scratch(targets.select("source", "source_size", "target", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("missing"),
                                           F.array().cast(cuts_type).alias("cuts"), F.lit(LAST_DRAW).alias("most")), "mix-plan")
    named = rows.filter(F.col("size") > 0).withColumnRenamed("source", "__source")

    def left(plan: DataFrame) -> DataFrame:
        wanting = plan.filter((F.col("missing") > 0) & (F.col("missing") > near * F.col("target")))
        return named.join(wanting, F.col("__source").eqNullSafe(F.col("source"))).filter((F.col("size") <= F.col("most")) & ~_taken("cuts", F.col("size"), F.col("draw"))) \
            .select("source", "missing", "size", "draw", "most")

    # From the second pass on either all documents that may fill it are taken or what is missing halves; where equal rows
    # hold more together than is missing, and nothing is taken, the size allowed halves instead.
    while True:
        found, _ = write_scratch(_pass(left(plan)), "mix-pass")
        if found.isEmpty():
            break
        missing = F.coalesce("rest", F.col("missing") - F.col("__all"), "missing")
        cut = F.struct(F.col("most"), F.lit(0).cast("long").alias("low"), F.col("high"))
        plan, _ = write_scratch(plan.join(found, F.col("source").eqNullSafe(F.col("__cut_source")), "left").select(
            "source", "source_size", "target", "whole", missing.alias("missing"),
            F.when(F.col("high").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array(cut))).alias("cuts"),
            F.floor(F.when(missing < F.col("missing"), missing).otherwise(F.least(missing, F.col("most"))) / 2).alias("most")), "mix-plan")
    # one document more, all its equal rows together: the one that comes nearest, if it comes nearer than none
    single = left(plan.withColumn("most", F.least(F.lit(float(LAST_DRAW >> 1)), 2 * F.col("missing")).cast("long"))).groupBy("source", "missing", "draw").agg(F.sum("size").alias("size"))
    off = F.abs(F.col("missing") - F.col("size"))
    best = single.filter(off < F.col("missing")).groupBy(F.col("source").alias("__cut_source")).agg(F.min(F.struct(off.alias("off"), "draw")).alias("best"))
    cut = F.struct(F.lit(LAST_DRAW).alias("most"), F.col("best.draw").alias("low"), F.col("best.draw").alias("high"))
    return plan.join(best, F.col("source").eqNullSafe(F.col("__cut_source")), "left").select(
        "source", "source_size", "target", "whole", F.when(F.col("best").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array(cut))).alias("cuts"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
                id_col: str = "doc_id", keep_columns: bool = False, near: float = NEAR) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, source and ``repeats``; with ``keep_columns``, those of
    ``docs`` and ``__repeats`` only (see ``repeat_rows``)."""
    facts = docs.select(F.col(id_col).alias("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), draw(id_col, "text", seed).alias("draw"))
    rows, _ = write_scratch(facts, "mix-rows")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    plan, _ = write_scratch(_cuts(rows, targets, near), "mix-targets")
    by_source = plan.withColumnRenamed("source", "__plan_source")
    if keep_columns:
        wide = docs.withColumns({"__draw": draw(id_col, "text", seed), "__size": word_count(F.col("text"))})
        same = F.col("source").eqNullSafe(F.col("__plan_source"))
        again = _taken("__cuts", F.col("__size"), F.col("__draw")).cast("int")
        return wide.join(by_source.select("__plan_source", F.col("whole").alias("__whole"), F.col("cuts").alias("__cuts")), same) \
            .select(*[F.col(c) for c in docs.columns], (F.col("__whole") + again).cast("int").alias("__repeats"))
    repeats = (F.col("whole") + _taken("cuts", F.col("size"), F.col("draw")).cast("int")).cast("int")
    return rows.join(by_source, F.col("source").eqNullSafe(F.col("__plan_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), "source", repeats.alias("repeats"))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Every row ``__repeats`` times, with the columns of the documents."""
    again = mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__repeats"))))
    return again.drop("__repeats", "__copy")
