"""SimHash near-duplicates found with pivot distance tables.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, all 3-word shingles (fewer words: the whole
sequence as one shingle; no word, empty or null text: fingerprint zero), XXH64 with seed 42 of each; a bit is set if
it is set in more than half of the hashes. Documents whose fingerprints differ in at most ``max_bits`` bits are
linked; a component is named by its smallest doc_id.

Search over the distinct fingerprints only (copies collapse before any pairing):

1. each fingerprint gets a pivot row: its Hamming distances to ``PIVOTS`` fixed reference fingerprints;
2. the 64 bits are cut into ``max_bits + 3`` blocks; two fingerprints within ``max_bits`` bits agree in at least
   three of them, so every choice of three blocks is a bucket key that loses no pair;
3. inside a bucket, pairs whose pivot rows differ by more than ``max_bits`` in any coordinate are discarded
   (triangle inequality), the rest is verified by the distance itself. A bucket gives a spanning forest,
   never all its pairs;
4. buckets of more than ``bucket_limit`` fingerprints take an exact way without pairs: two fingerprints within
   two bits share a point one bit away from both, so each is dealt to itself and its 64 neighbours and linked
   within those points, which hold 65 fingerprints at most.

Null doc_ids: such rows have a fingerprint and link others; they never name a component that has another id.
Repeated rows stay, each with its component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import small_batches, write_scratch
from courtview.llm.components import connected_components

SEED = 42
PIVOTS = 24
BUCKET_LIMIT = 1024
_UPPER = {i: i + 32 for i in range(65, 91)}
_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | bytes | None, words: int = 3, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text."""
    if not text:
        return 0
    raw = text.encode() if isinstance(text, str) else text
    parts = [w for w in raw.translate(_SPACE).translate(_LOWER).split(b" ") if w]
    if not parts:
        return 0
    if len(parts) < words:
        grams = [b" ".join(parts)]
    else:
        grams = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def pivots(n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """Fixed reference fingerprints, from a seeded rule."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) for i in range(n)], dtype=np.uint64)


def pivot_rows(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def with_fingerprints(docs: DataFrame, words: int = 3, seed: int = SEED, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__fp`` (the fingerprint's bits as a signed long)."""
    spark = docs.sparkSession
    small_batches(spark)

    @F.pandas_udf("long")
    def fp(texts):  # one Arrow batch at a time
        import pandas as pd
        return pd.Series(np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn("__fp", fp(F.col(text)))


def _block_masks(max_bits: int) -> list[int]:
    """Masks of every choice of three of ``max_bits + 3`` blocks of the 64 bits."""
    n = max_bits + 3
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, 3)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, rows: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the members of one bucket which the distance connects (a spanning forest)."""
    n, links, root = len(fps), [], np.arange(len(fps))
    order = np.argsort(rows[:, 0], kind="stable")
    fps, rows = fps[order], rows[order]
    first = rows[:, 0]
    ends = np.searchsorted(first, first + max_bits, side="right")
    for i in range(n - 1):
        hi = int(ends[i])
        if hi <= i + 1:
            continue
        near = np.abs(rows[i + 1:hi] - rows[i]).max(axis=1) <= max_bits  # the pivot table's bound
        if not near.any():
            continue
        js = np.flatnonzero(near) + i + 1
        js = js[np.bitwise_count(fps[js] ^ fps[i]) <= max_bits]  # verification
        for j in js:
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                links.append((int(fps[i]), int(fps[j])))
    return links


def _bucket_links(max_bits: int):
    refs = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; the last bucket of a batch waits for the next one."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(which, key, fps) -> pa.RecordBatch | None:
            new = np.flatnonzero((which[1:] != which[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate(([0], new)), np.concatenate((new, [len(key)]))
            out: list[tuple[int, int]] = []
            for k in np.flatnonzero(ends - starts > 1):
                part = fps[starts[k]:ends[k]]
                out += _forest(part, pivot_rows(part, refs), max_bits)
            if not out:
                return None
            pairs = np.array(out, dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("which", "key", "fp")]
            cols[2] = cols[2].view(np.uint64)
            held.append(tuple(cols))
            which, key, fps = (np.concatenate(x) for x in zip(*held, strict=True))
            same = (which == which[-1]) & (key == key[-1])
            cut = len(key) - int(same.sum())
            if cut and (out := links(which[:cut], key[:cut], fps[:cut])) is not None:
                yield out
            held = [(which[cut:], key[cut:], fps[cut:])]
        if held and (out := links(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
            yield out

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = 2, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column ``fp`` that connect what ``max_bits`` connects."""
    masks = [_signed(m) for m in _block_masks(max_bits)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("which", "mask")) \
        .select("fp", "which", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    full = keyed.groupBy("which", "key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    buckets, _ = write_scratch(full, "simhash-buckets")
    member = keyed.join(buckets, ["which", "key"])
    spark = distinct.sparkSession
    usual = member.filter(F.col("n") <= bucket_limit).select("which", "key", "fp")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiled = usual.repartition(n_parts, "which", "key").sortWithinPartitions("which", "key", "fp")
    found = tiled.mapInArrow(_bucket_links(max_bits), "a long, b long")
    crowded = member.filter(F.col("n") > bucket_limit).select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    points = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    if max_bits != 2:
        raise ValueError("the way for crowded buckets links through points one bit away: max_bits must be 2")
    star = points.groupBy("point").agg(F.sort_array(F.collect_set("fp")).alias("near")).filter(F.size("near") > 1) \
        .select(F.col("near")[0].alias("a"), F.explode(F.slice("near", 2, 64)).alias("b"))  # 65 members at most
    return found.unionByName(star).distinct()


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                       bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, ``fp`` (long) and component_id of every row."""
    marked = with_fingerprints(docs.select(id_col, "text"), words).select(F.col(id_col).alias("doc_id"), F.col("__fp").alias("fp"))
    marked, _ = write_scratch(marked, "simhash-fp")
    per_fp, _ = write_scratch(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    named = per_fp.join(component_roots(per_fp.select("fp"), max_bits, bucket_limit), "fp")
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names, _ = write_scratch(named.select("fp", "root").join(first, "root").select("fp", "component_id"), "simhash-names")
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")


def component_roots(distinct: DataFrame, max_bits: int, bucket_limit: int) -> DataFrame:
    """(fp, root) of each distinct fingerprint; one without links is its own root."""
    fps, _ = write_scratch(distinct, "simhash-fps")
    roots = connected_components(fingerprint_links(fps, max_bits, bucket_limit), "simhash")  # over a written table
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """The columns of ``docs``, one row of each component: the least doc_id (null last), its first text and one row of it.

    The choice is made on narrow rows; only the texts' keys are joined back, and a component's rows are never
    brought together.
    """
    own = docs.withColumn("__row", F.monotonically_increasing_id())
    marked, _ = write_scratch(with_fingerprints(own, words), "simhash-docs")
    narrow = marked.select(F.col("doc_id"), F.col("__fp").alias("fp"), "__row")
    roots = component_roots(narrow.select("fp").distinct(), max_bits, bucket_limit)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    per_fp = narrow.groupBy("fp").agg(F.min(place).alias("first"))
    kept = per_fp.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.__row").alias("__kept"))
    chosen, _ = write_scratch(kept, "simhash-kept")
    chosen = chosen.hint("merge")  # the same plan at every size: rows by id, in one shuffle that can be split
    return marked.join(chosen, F.col("__row") == F.col("__kept"), "left_semi").select(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
