"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes if it is covered by a ``length``-byte string that starts anywhere else too (overlaps and the same document
included; copies of a document are elsewhere). Buckets hold positions that share a string; they start from q-grams
and are refined by the bucket identifiers at later offsets, never by reading the bytes again:

1. identifiers of 1, 2, 4, ... q = 64 bytes are doubled by pairing the identifier of a position with the one
   half a string later (64-bit mixing gives the pair its new identifier). A string's anchor is the position of its least
   q-gram; two equal strings have equal anchors. Anchors whose q-gram occurs at one place only are dropped;
2. the surviving buckets are refined in blocks of 32 starts around the anchor: the identifier of the bytes that all
   strings of the block share must recur (else none does); if the identifier of all bytes that any of them covers
   recurs, all do;
3. the starts of the blocks in between are refined one by one to ``length`` bytes.

Identifiers of longer strings reuse those of the shorter ones at a later offset; a bucket carries the q-gram's
identifier besides its own, 128 bits together. Each distinct text is refined once: copies are counted first, and a text
with copies goes whole if it is long enough. Spans refer to the input, not to what is left.

Null and empty texts have 0 bytes and lose none, as have texts under ``length`` bytes; rows may repeat; very
long texts are cut into overlapping pieces; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import discard, small_batches, text_key, write_scratch

LENGTH = 400
Q = 64
BLOCK = 32
PIECE = 1 << 19
PLACE_BITS = 22
_M1, _M2, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)
_FIRST = ((np.arange(1, 257, dtype=np.uint64) * _M1) ^ (np.arange(1, 257, dtype=np.uint64) * _M2 >> _S)) * _M2
_ANCHOR = np.dtype([("gram", "<u8"), ("pos", "<i8"), ("lo", "<i4"), ("hi", "<i4")])


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of a pair of identifiers."""
    x = a * _M1
    x ^= x >> _S
    x += b
    x *= _M2
    x ^= x >> _S
    return x


def identifiers(data: np.ndarray, size: int) -> np.ndarray:
    """Identifier of the ``size`` bytes (a power of two) from each position."""
    ids, have = _FIRST[data], 1
    while have < size:
        ids = _mix(ids[:-have], ids[have:]) if len(ids) > have else ids[:0]
        have *= 2
    return ids


def _power(ids: np.ndarray, have: int, at: np.ndarray, size: int) -> np.ndarray:
    """Identifier of ``size`` bytes (a power of two, ``have`` at least) from the positions ``at``."""
    if size == have:
        return ids[at]
    return _mix(_power(ids, have, at, size // 2), _power(ids, have, at + size // 2, size // 2))


def _longer(ids: np.ndarray, have: int, at: np.ndarray, size: int) -> np.ndarray:
    """Identifier of any ``size`` bytes: those of the power of two that fits, from both ends of the string."""
    fits = have
    while 2 * fits <= size:
        fits *= 2
    head = _power(ids, have, at, fits)
    return head if fits == size else _mix(head, _power(ids, have, at + (size - fits), fits))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    pad = np.full((-n) % width, np.iinfo(values.dtype).max, values.dtype)
    rows = np.concatenate([values, pad]).reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], upto[width - 1:n])


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, q: int = Q) -> np.ndarray:
    """Anchors of all strings of ``length`` bytes in texts laid end to end (``starts`` has their offsets and the end).

    Rows (gram, pos, lo, hi): the strings from pos - hi to pos - lo have their least q-gram at pos.
    """
    if len(data) < length:
        return np.zeros(0, _ANCHOR)
    ids = identifiers(data, q)
    mask = np.uint64((1 << PLACE_BITS) - 1)  # the same for all pieces, so that equal strings rank alike
    ranked = (ids & ~mask) | np.arange(len(ids), dtype=np.uint64)  # ties go to the leftmost
    least = (_least(ranked, length - q + 1) & mask).astype(np.int64)
    inside = np.zeros(len(least), bool)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a >= length:
            inside[a:b - length + 1] = True
    first = np.flatnonzero(inside)
    if not len(first):
        return np.zeros(0, _ANCHOR)
    pos = least[first]
    new = np.concatenate(([True], (pos[1:] != pos[:-1]) | (first[1:] != first[:-1] + 1)))
    at = np.flatnonzero(new)
    out = np.zeros(len(at), _ANCHOR)
    out["pos"], out["gram"] = pos[at], ids[pos[at]]
    out["hi"] = pos[at] - first[at]
    out["lo"] = pos[at] - first[np.concatenate((at[1:] - 1, [len(first) - 1]))]
    return out


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Texts laid end to end in pieces of about PIECE bytes: bytes, offsets, (row, offset in its text) of each part."""
    held, size = [], 0
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[at:at + PIECE + length - 1] if len(t) > PIECE else t
            held.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield _laid(held)
                held, size = [], 0
            if len(t) <= PIECE:
                break
    if held:
        yield _laid(held)


def _laid(held: list) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(p) for _, _, p in held]))).astype(np.int64), [(r, a) for r, a, _ in held]


def _raw(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _one_a_place(rows: np.ndarray) -> np.ndarray:
    """Rows of one text in the order of their places; those of one anchor, seen from two pieces, become one."""
    first = np.flatnonzero(np.concatenate(([True], rows["pos"][1:] != rows["pos"][:-1])))
    out = rows[first].copy()
    out["lo"], out["hi"] = np.minimum.reduceat(rows["lo"], first), np.maximum.reduceat(rows["hi"], first)
    return out


def _find_anchors(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _raw(batch.column("text"))
            found: list[list[np.ndarray]] = [[] for _ in texts]
            for data, starts, parts in _pieces(texts, length):
                rows = anchors(data, starts, length, q)
                which = np.searchsorted(starts, rows["pos"], side="right") - 1
                cut = np.searchsorted(which, np.arange(len(parts) + 1))
                for k, (row, at) in enumerate(parts):
                    mine = rows[cut[k]:cut[k + 1]]
                    if len(mine):
                        mine = mine.copy()
                        mine["pos"] += at - starts[k]
                        found[row].append(mine)
            packed = [_one_a_place(np.concatenate(f)).tobytes() if f else b"" for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(packed, pa.binary())],
                                             names=["key", "doc_id", "n_bytes", "anchors"])

    return run


def _explode_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            raws = part.column("anchors").to_pylist()
            rows = np.frombuffer(b"".join(raws), _ANCHOR)
            if not len(rows):
                continue
            owner = np.repeat(np.arange(len(raws)), [len(r) // _ANCHOR.itemsize for r in raws])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["gram"].copy().view(np.int64)), part.column("key").take(pa.array(owner)),
                 pa.array(rows["pos"].copy()), pa.array(rows["lo"].copy()), pa.array(rows["hi"].copy())], names=["gram", "key", "pos", "lo", "hi"])


def _blocks(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of starts around each surviving anchor: identifiers of the shared and of the covered bytes."""
        for batch in batches:
            texts = _raw(batch.column("text"))
            keys = batch.column("key")
            lists = batch.column("marks").to_pylist()
            for i, (t, marks) in enumerate(zip(texts, lists, strict=True)):
                data = np.frombuffer(t, np.uint8)
                ids = identifiers(data, q)
                m = np.array([(x["gram"], x["pos"], x["lo"], x["hi"]) for x in marks], np.int64)
                out = []
                for k in range(int(m[:, 2].min()) // BLOCK, int(m[:, 3].max()) // BLOCK + 1):
                    lo, hi = k * BLOCK, k * BLOCK + BLOCK - 1
                    mine = m[(m[:, 2] <= hi) & (m[:, 3] >= lo)]
                    if not len(mine):
                        continue
                    a, b = np.maximum(mine[:, 2], lo), np.minimum(mine[:, 3], hi)
                    core = _core(ids, q, mine[:, 1], lo, hi, length)
                    full = _full(ids, q, mine[:, 1], lo, hi, length, len(data))
                    out.append(np.column_stack([mine[:, 0], np.full(len(mine), k), core, full, mine[:, 1] - b, mine[:, 1] - a]))
                if out:
                    o = np.concatenate(out)
                    yield pa.RecordBatch.from_arrays([keys.slice(i, 1).take(pa.array(np.zeros(len(o), np.int64))), *[pa.array(o[:, c].copy()) for c in range(6)]],
                                                     names=["key", "gram", "block", "core", "whole", "first", "last"])

    return run


def _core(ids, q, pos, lo, hi, length) -> np.ndarray:
    """Identifier of the bytes in every string of the block; they lie in the text whenever one of its strings does."""
    return _longer(ids, q, pos - lo, length - (hi - lo)).view(np.int64)


def _full(ids, q, pos, lo, hi, length, n) -> np.ndarray:
    """Identifier of the bytes in any string of the block, or 0 where they reach beyond the text."""
    ok = (pos - hi >= 0) & (pos - lo + length <= n)
    out = np.zeros(len(pos), np.int64)
    if ok.any():
        out[ok] = _longer(ids, q, pos[ok] - hi, length + hi - lo).view(np.int64)
    return out


def _singles(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The identifier of ``length`` bytes for each start of the open blocks."""
        for batch in batches:
            texts, keys = _raw(batch.column("text")), batch.column("key")
            for i, (t, open_) in enumerate(zip(texts, batch.column("open").to_pylist(), strict=True)):
                ids = identifiers(np.frombuffer(t, np.uint8), q)
                starts = np.concatenate([np.arange(x["first"], x["last"] + 1) for x in open_])
                grams = np.concatenate([np.full(x["last"] - x["first"] + 1, x["gram"], np.int64) for x in open_])
                own = _longer(ids, q, starts, length).view(np.int64)
                yield pa.RecordBatch.from_arrays([keys.slice(i, 1).take(pa.array(np.zeros(len(starts), np.int64))), pa.array(grams), pa.array(own), pa.array(starts)],
                                                 names=["key", "gram", "own", "start"])

    return run


def merge_spans(first: np.ndarray, last: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings that start from ``first`` to ``last`` (both included)."""
    order = np.argsort(first, kind="stable")
    out: list[list[int]] = []
    for a, b in zip(first[order].tolist(), (last[order] + length).tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _raw(batch.column("text"))
            removed, spans, shas, lists = [], [], [], []
            for t, runs in zip(texts, batch.column("runs").to_pylist(), strict=True):
                merged = merge_spans(np.array([x["first"] for x in runs], np.int64), np.array([x["last"] for x in runs], np.int64), length)
                kept, at = hashlib.sha256(), 0
                for a, b in merged:
                    kept.update(t[at:a])
                    at = b
                kept.update(t[at:])
                removed.append(sum(b - a for a, b in merged))
                spans.append(len(merged))
                shas.append(kept.hexdigest())
                lists.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string()),
                                              pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=["key", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def _at_two_places(rows: DataFrame, bucket: list[str], place: list[str]) -> DataFrame:
    """Buckets that hold more than one place."""
    where = F.xxhash64(*place)
    return rows.groupBy(*bucket).agg(F.min(where).alias("lo"), F.max(where).alias("hi")).filter("lo != hi").select(*bucket)


def repeated_spans(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """One row for each distinct text that loses bytes: key, n_removed, n_spans, kept_sha256, spans (bytes)."""
    if length - BLOCK + 1 < q:
        raise ValueError(f"length must be {q + BLOCK - 1} or more")
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").filter(F.octet_length("text") >= length) \
        .withColumn("key", text_key(F.col("text")))
    per_row = keyed.mapInArrow(_find_anchors(length, q), "key binary, doc_id string, n_bytes long, anchors binary")
    # copies collapse to one row before any bucket is made; the least id names the copy that is read again
    texts, _ = write_scratch(per_row.groupBy("key").agg(F.first("anchors").alias("anchors"), F.first("n_bytes").alias("n_bytes"),
                                                        F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "repeat-anchors")
    flat = texts.select("key", "anchors").mapInArrow(_explode_anchors, "gram long, key binary, pos long, lo int, hi int")
    grams, grams_path = write_scratch(_at_two_places(flat, ["gram"], ["key", "pos"]), "repeat-grams")
    marks = flat.join(grams, "gram").groupBy("key").agg(F.collect_list(F.struct("gram", "pos", "lo", "hi")).alias("marks"))
    named, named_path = write_scratch(marks.join(texts.select("key", "first_id"), "key"), "repeat-marks")
    suspects, suspects_path = write_scratch(keyed.join(named, "key").filter("doc_id = first_id").drop("doc_id", "first_id"), "repeat-texts")
    discard(spark, named_path, grams_path)

    rows = suspects.mapInArrow(_blocks(length, q), "key binary, gram long, block long, core long, whole long, first long, last long")
    blocks, blocks_path = write_scratch(rows, "repeat-blocks")
    place = ["key", "first", "last"]
    cores, cores_path = write_scratch(_at_two_places(blocks, ["gram", "block", "core"], place), "repeat-cores")
    wholes, wholes_path = write_scratch(_at_two_places(blocks.filter("whole != 0"), ["gram", "block", "whole"], place).withColumn("all", F.lit(True)), "repeat-wholes")
    shared, shared_path = write_scratch(blocks.join(cores, ["gram", "block", "core"]), "repeat-shared")
    settled, settled_path = write_scratch(shared.join(wholes, ["gram", "block", "whole"], "left").withColumn("all", F.coalesce("all", F.lit(False))), "repeat-settled")
    discard(spark, blocks_path, shared_path, cores_path, wholes_path)

    # the starts of open blocks are looked up among each other and in one block of every settled kind
    open_rows = settled.filter(~F.col("all")).select("key", "gram", "block", "core", "first", "last")
    bucket = ["gram", "block", "core"]
    kinds = settled.filter("all").groupBy(*bucket, "whole").agg(F.min(F.struct("key", "first", "last")).alias("one")).select(*bucket, "one.*")
    beside, beside_path = write_scratch(open_rows.select(*bucket).distinct(), "repeat-open")
    asked = open_rows.select("key", "gram", "first", "last").unionByName(kinds.join(beside, bucket).select("key", "gram", "first", "last"))
    per_text = asked.groupBy("key").agg(F.collect_set(F.struct("gram", "first", "last")).alias("open"))
    starts = suspects.select("key", "text").join(per_text, "key").mapInArrow(_singles(length, q), "key binary, gram long, own long, start long")
    singles, singles_path = write_scratch(starts, "repeat-starts")
    again, again_path = write_scratch(_at_two_places(singles, ["gram", "own"], ["key", "start"]), "repeat-again")
    runs = settled.filter("all").select("key", "first", "last").unionByName(
        singles.join(again, ["gram", "own"]).select("key", F.col("start").alias("first"), F.col("start").alias("last")))

    copied = texts.filter("copies > 1").select("key", "n_bytes")
    losing = runs.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs")).join(copied, "key", "left_anti")
    cut = suspects.select("key", "text").join(losing, "key").mapInArrow(
        _cut(length), "key binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")
    gone = copied.select("key", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"),
                         F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"))
    result, _ = write_scratch(cut.unionByName(gone).dropDuplicates(["key"]), "repeat-result")
    discard(spark, singles_path, again_path, settled_path, suspects_path, beside_path)
    return result


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans of every row."""
    result = repeated_spans(docs, length)
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    facts = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), sha.alias("__sha"), text_key(F.col("text")).alias("key"))
    return facts.join(result, "key", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                                                    F.coalesce("kept_sha256", "__sha").alias("kept_sha256"), "spans")
