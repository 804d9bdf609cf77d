"""A Bloom filter of join keys, built and applied by Spark, in front of an exact join.

Rows whose key is surely not on the other side are dropped at their scan, before they cross an exchange; the few that
pass by chance are removed by the exact join that follows. The filter is an array of 64-bit words in a single row: bits are
set by a partial ``bit_or`` for each word, so tasks merge theirs, and the row has at most ``MAX_BITS / 64`` words however
many keys there are. Where that is too few bits for the keys there is no filter, and the join is as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
MAX_BITS = 1 << 26  # 8 MB
MAX_HASHES = 6
WORDS = "_bloom_words"


def filter_size(n_keys: int, max_bits: int | None = None) -> tuple[int, int]:
    """(bits, hashes) for ``n_keys``: ``BITS_PER_KEY`` bits for each, in a power of two up to the bound."""
    bits = 64
    while bits < BITS_PER_KEY * n_keys and bits < (max_bits or MAX_BITS):
        bits *= 2
    return bits, max(1, min(MAX_HASHES, round(0.69 * bits / max(1, n_keys))))


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits).cast("bigint")) for i in range(hashes)]


def bloom_row(keys: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    """One row: the words of the filter of all non-null keys."""
    spark = keys.sparkSession
    at = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits, hashes))).alias("p"))
    words = at.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("b"))
    dense = spark.range(bits // 64).withColumnRenamed("id", "w").join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("bigint")).alias("b"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias(WORDS))  # bits / 64 words


def may_match(df: DataFrame, keys: DataFrame, key: str, max_bits: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among those of ``keys``: all that are, and few others. Null keys match nothing."""
    n = keys.where(F.col(key).isNotNull()).select(key).count()
    bits, hashes = filter_size(n, max_bits)
    known = df.where(F.col(key).isNotNull())
    if bits < 2 * n:  # nearly every bit would be set
        return known
    hit = None
    for p in _positions(F.col(key), bits, hashes):
        bit = F.getbit(F.get(F.col(WORDS), F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64).cast("bigint")).cast("int")) == 1
        hit = bit if hit is None else hit & bit
    return known.join(F.broadcast(bloom_row(keys, key, bits, hashes)), hit, "left_semi")  # one row of at most 8 MB
