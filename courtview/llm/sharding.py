"""Sharding along a Hilbert curve (DataFrame functions only).

Several metadata dimensions are quantised to ``bits`` bits each, the cells are ordered by their index on the Hilbert
curve, and the order is cut into runs: neighbours on the curve are near in every dimension, so each shard spans a
small box and files of it can be pruned by any of them. Law ``rows``: counts differ by one at most.

Dimensions: log-scale size, language, source, position of the id between the least and the greatest one.
Strings are quantised by a hash, numbers monotonically. Ties on the curve go by text checksum, size and doc_id; full
ties by row number, so that a hot cell spreads over tasks. Positions come from a range-dealt sort and one count for
each partition; a shard is never one task.

Defined results: null text: size 1 (no bytes plus 1), checksum 0; null lang, source or doc_id: cell 0 of that
dimension; an empty table gives an empty result; repeated rows each get a slot of their own. Other columns are
carried only if asked for, names with two leading underscores are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import ordered_positions

SHARDS = 8
BITS = 8


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def hashed_cell(value: Column, bits: int) -> Column:
    """Cell 0 for null, else one of the others by hash."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value), F.lit((1 << bits) - 1)).cast("int") + 1)


def log_cell(value: Column, bits: int) -> Column:
    """Steps of an eighth of a doubling at 8 bits, up to 2**32."""
    top = (1 << bits) - 1
    return F.least(F.floor(F.log2(value.cast("double")) * (top / 32.0)).cast("int"), F.lit(top))


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of cells of ``bits`` bits each (Skilling's transpose, folded over its steps)."""
    n = len(cells)
    steps = F.array(*[F.struct(F.lit(1 << q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        low = q - 1
        first, here = F.get(x, F.lit(0)), F.get(x, i)
        swap = first.bitwiseXOR(here).bitwiseAND(low)
        inverted = here.bitwiseAND(q) != 0

        def at(k: int) -> Column:
            mine = F.get(x, F.lit(k))
            if k == 0:
                return F.when(inverted, first.bitwiseXOR(low)).otherwise(F.when(i == 0, first).otherwise(first.bitwiseXOR(swap)))
            return F.when((i == k) & ~inverted, mine.bitwiseXOR(swap)).otherwise(mine)

        return F.array(*[at(k) for k in range(n)])

    def gray(x: Column) -> Column:
        """Running XOR over the dimensions, then the correction from the last one."""
        run = F.aggregate(x, F.array().cast("array<int>"), lambda acc, v: F.concat(
            acc, F.array(v.bitwiseXOR(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))))))
        with_fix = F.struct(run.alias("r"))
        fix = lambda r: F.aggregate(F.array(*[F.lit(1 << q) for q in range(bits - 1, 0, -1)]), F.lit(0),
                                    lambda t, q: F.when(F.get(r, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return F.get(F.transform(F.array(with_fix), lambda s: F.transform(s["r"], lambda v: v.bitwiseXOR(fix(s["r"])))), F.lit(0))

    start = F.array(*[c.cast("int") for c in cells])
    transposed = gray(F.aggregate(steps, start, undo))
    planes = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, -1, -1) for i in range(n)])

    def gather(acc: Column, p: Column) -> Column:
        bit = F.call_function("shiftright", F.get(acc["x"], p["i"]), p["q"]).bitwiseAND(F.lit(1))
        return F.struct(acc["x"].alias("x"), (acc["h"] * 2 + bit.cast("long")).alias("h"))

    return F.aggregate(planes, F.struct(transposed.alias("x"), F.lit(0).cast("long").alias("h")), gather)["h"]



def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, keep_columns: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve; with ``keep_columns``, the other columns of ``docs`` too."""
    span = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()  # two numbers
    top = (1 << bits) - 1
    lo, width = (span["lo"] or 0), max(1, (span["hi"] or 0) - (span["lo"] or 0))
    place = F.coalesce(F.floor((F.col("doc_id") - lo) * (top / width)).cast("int"), F.lit(0))
    own = {"size": byte_size(F.col("text")), "text_crc32": text_crc32(F.col("text"))}
    carried = [c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")] if keep_columns else []
    facts = docs.select("doc_id", *carried, F.col("lang").alias("__lang"), F.col("source").alias("__source"), place.alias("__place"), *[v.alias(k) for k, v in own.items()])
    cells = [log_cell(F.col("size"), bits), hashed_cell(F.col("__lang"), bits), hashed_cell(F.col("__source"), bits), F.col("__place")]
    keyed = facts.withColumn("curve", hilbert_index(cells, bits)).drop("__lang", "__source", "__place")
    n_parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed, total, _ = ordered_positions(keyed, ["curve", "text_crc32", "size", "doc_id"], n_parts, "shard-order")
    shard = F.expr(f"cast(__pos * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as long) * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", (F.col("__pos") - first).cast("long")).drop("__pos").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve", *carried)


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder for each shard, rows along the curve, so that the files' min and max prune on every dimension."""
    sharded.sortWithinPartitions("shard", "slot").write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
