"""Hot-key split for joins where one key may hold a large share of the big side.

``hot_keys`` finds every key that may hold at least ``support`` of the rows with
``freqItems`` (one distributed pass over the key column, bounded memory per task,
at most about 1/support candidates, never missing a frequent one) and keeps those that an
exact count confirms.  ``skew_split_join`` then routes the rows of those keys through a
broadcast join with their (few) small-side rows, and everything else through the
ordinary shuffle join; each big-side row is in exactly one branch, so the result
equals the plain join.  ``salted_join`` is for two large sides: the hot keys' rows are dealt to salts, and
the other side's rows of those keys repeated for each.  No task ever receives a hot key's whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.operators.broadcast import DEFAULT_MAX_BYTES, fits

MAX_SUPPORT = 0.01
MIN_SUPPORT = 1e-4
SMALL_SIDE_MAX_ROWS = 1_000_000
#: Salts for each fair share of rows that a hot key holds; several small ones spread more evenly than one large one.
SALTS_PER_SHARE = 8


def default_support(spark) -> float:
    """A key is hot when it would hold ~4 reducers' fair share: clamp(4 / shuffle partitions, 1e-4, 1e-2).

    At 400k partitions any key above 0.01 % of the rows is split off (at most ~10k hot keys); whatever
    skew remains below that is left to AQE's skew-join splitting.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_SUPPORT, max(MIN_SUPPORT, 4.0 / max(parts, 1)))


def key_counts(df: DataFrame, key: str, support: float | None = None) -> tuple[dict, int]:
    """Rows of each key that holds at least ``support`` of the rows of ``df`` (null keys left out), and of all keys.

    A sketch finds the candidates (at most about ``1 / support``), an exact count confirms them.
    """
    support = support if support is not None else default_support(df.sparkSession)
    keys = df.select(key).where(F.col(key).isNotNull())
    row = keys.stat.freqItems([key], support).first()
    candidates = list(row[0]) if row is not None and row[0] else []
    if not candidates:
        return {}, 0
    counted = keys.groupBy(F.when(F.col(key).isin(candidates), F.col(key)).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counted)  # one row per candidate, and one for the rest
    return {r["k"]: r["n"] for r in counted if r["k"] is not None and r["n"] >= support * total}, total


def hot_keys(df: DataFrame, key: str, support: float | None = None) -> list:
    """Keys that hold at least ``support`` of the rows of ``df``."""
    return list(key_counts(df, key, support)[0])


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: F.Column, support: float | None = None, partitions: int | None = None) -> DataFrame:
    """Inner join on ``key`` where neither side need be small: hot keys of ``big`` are dealt to as many salts as fair shares they hold.

    A row's salt is the hash of ``spread`` (a value that differs within a key). The rows of ``small`` that have a hot key are
    repeated once for each of its salts: about ``2 * partitions`` copies in all, however the keys are spread.
    """
    spark = big.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # half a fair share and more counts as hot: what stays whole adds little to the task it falls in
    found, total = key_counts(big, key, max(MIN_SUPPORT, 0.5 / partitions) if support is None else support)
    if not found:
        return big.join(small, key, "inner")
    share = max(1, total // (SALTS_PER_SHARE * partitions))
    key_type = big.schema[key].dataType.simpleString()
    salts = F.broadcast(spark.createDataFrame([(k, -(-n // share)) for k, n in found.items()], f"`{key}` {key_type}, _salts bigint"))  # 1/support rows
    one = F.lit(1).cast("bigint")
    dealt = (big.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", one))).drop("_salts"))
    repeated = (small.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", one) - 1))).drop("_salts"))
    return dealt.join(repeated, [key, "_salt"], "inner").drop("_salt")


def skew_split_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                    support: float | None = None) -> DataFrame:
    """``big.join(small, key, how)`` with hot and missing keys of ``big`` split off (how: inner or left)."""
    if how not in ("inner", "left"):
        raise ValueError("skew_split_join supports inner and left joins")
    with_key, parts = big.where(F.col(key).isNotNull()), []
    if how == "left":  # missing keys match nothing: they stay out of the shuffle
        missing = big.where(F.col(key).isNull())
        parts.append(missing.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields if f.name != key]))
    hot = hot_keys(big, key, support)
    if hot:
        spark = big.sparkSession
        key_type = big.schema[key].dataType
        hot_df = F.broadcast(spark.createDataFrame([(k,) for k in hot], f"`{key}` {key_type.simpleString()}"))  # 1/support rows
        small_hot = small.join(hot_df, key, "left_semi")
        if fits(small_hot, SMALL_SIDE_MAX_ROWS, DEFAULT_MAX_BYTES):
            parts.append(with_key.join(hot_df, key, "left_semi").join(F.broadcast(small_hot), key, how))
            with_key = with_key.join(hot_df, key, "left_anti")
        # else the hot keys are not rare on the small side: adaptive execution splits them
    out = with_key.join(small, key, how)
    for part in parts:
        out = out.unionByName(part)
    return out
