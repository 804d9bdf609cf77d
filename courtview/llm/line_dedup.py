"""Line dedup by a segment-partition edit join.

Lines (split at newlines) are equal or linked if their edit distance is at most ``max_edits(shorter length)``, by steps of
the length: 4 from 96 code points on, 3 from 64, 2 from 32, 1 from 16, 0 below (``EDITS``) unless the caller gives others;
``similarity_steps`` makes steps that grow in proportion to the length. Entries grow with about the square of the edits.
Classes are the connected lines; of each class the first occurrence by doc_id and line number stays. Only distinct
lines are joined:

1. lengths fall into buckets of one threshold each. A line has threshold-plus-one segments of a width fixed by its bucket:
   the first half are placed from its start, the others from its end. Of the shorter line of a pair some segment i survives
   with i edits before it and threshold - i behind it at most; it is indexed by (bucket, segment number, segment). A line
   probes, for its bucket and each one below that its edits reach, every segment at shifts of up to min(i, threshold - i)
   from the same end, whatever the other's length;
2. index and probe entries meet by hash in one shuffle; only buckets with both stay. Buckets are dealt as tiles of at most
   ``TILE`` index lines and ``TILE`` probe lines, so that a segment shared by very many lines spreads over tasks;
3. in a tile, every pair that passes the length and letter-count bounds is verified by an edit distance along the
   furthest places of the diagonals. A pair belongs to the first segment that its lines share and, at equal length, to the line with the smaller id:
   it is verified in one tile only. A tile gives the number of links of each of its lines, which add up, and a spanning
   forest of its links for the components. A line of a bucket of L lines is dealt to L / ``TILE`` tiles, so the work of
   one segment grows with the square of the lines that share it; the rows that come out do not.

Blank lines have no class and stay. Null and empty texts have no lines; null doc_ids come last; repeated rows
are documents of their own; lines may be very long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import discard, small_batches, text_key, write_scratch
from courtview.llm.components import connected_components
from courtview.operators.bloom import may_match

Steps = tuple[tuple[int, int], ...]
#: Edits allowed for the shorter line: (least length in code points, edits), ascending.
EDITS: Steps = ((16, 1), (32, 2), (64, 3), (96, 4))
TILE = 128
ID_BITS = 55
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_M = np.uint64(0xFF51AFD7ED558CCD)


def similarity_steps(similarity: float, most: int) -> Steps:
    """Steps that allow ``(1 - similarity) * length`` edits, rounded down, up to ``most`` edits."""
    return tuple((max(e + 1, math.ceil(round(e / (1 - similarity), 9))), e) for e in range(1, most + 1))


def _checked(steps: Steps) -> Steps:
    """The steps, if lengths and edits ascend and every segment has a code point at least."""
    if any(n <= e for n, e in steps) or any(a[0] >= b[0] or a[1] >= b[1] for a, b in pairwise(((0, 0), *steps))):
        raise ValueError(f"lengths and edits must ascend, each length above its edits: {steps}")
    if any(e > 126 for _, e in steps):
        raise ValueError("126 edits are the most")  # a segment number is one byte
    return tuple((n, e) for n, e in steps)


def max_edits(length: np.ndarray | int, steps: Steps = EDITS) -> np.ndarray:
    """Edits allowed for a shorter line of ``length`` code points."""
    return np.array([0, *[e for _, e in steps]])[np.searchsorted([n for n, _ in steps], length, side="right")]


def edit_distance(a: str, b: str, limit: int) -> int:
    """Edit distance, or limit + 1 if it is larger: for each number of edits, the furthest place of ``a`` on each diagonal
    (place in ``b`` less place in ``a``) from which the last place can still be reached."""
    n, m = len(a), len(b)
    if abs(m - n) > limit:
        return limit + 1
    reach = {0: _shared(a, b, 0, 0)}
    if n == m and reach[0] == n:
        return 0
    for edits in range(1, limit + 1):
        spare, now = limit - edits, {}
        for d in range(max(-edits, -n, m - n - spare), min(edits, m, m - n + spare) + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))  # substituted, deleted, inserted
            if i < 0:
                continue
            i = min(i, n, m - d)
            i += _shared(a, b, i, i + d)
            if i == n and d == m - n:
                return edits
            now[d] = i
        reach = now
    return limit + 1


def _shared(a: str, b: str, i: int, j: int) -> int:
    """Length of the common run from place i of ``a`` and j of ``b``, by doubling and halving."""
    most, done, size = min(len(a) - i, len(b) - j), 0, 8
    while done < most:
        size = min(size, most - done)
        if a[i + done:i + done + size] == b[j + done:j + done + size]:
            done += size
            size *= 2
            continue
        while size > 1:
            half = size // 2
            if a[i + done:i + done + half] == b[j + done:j + done + half]:
                done += half
                size -= half
            else:
                size = half
        return done
    return done


@lru_cache
def _bounds(longest: int, steps: Steps) -> np.ndarray:
    """Least lengths of the buckets up to ``longest``, after a 0 for the lines below: no bucket holds two steps, and each
    is as wide as four times its edits or an eighth of its length, so that few lines reach the bucket below."""
    out = [0]
    for (n, edits), (end, _) in pairwise((*steps, (longest + 1, 0))):
        while n < end:
            out.append(n)
            n += max(4 * edits, n // 8)
    return np.array(out, np.int64)


def _bucket(length: np.ndarray, steps: Steps) -> np.ndarray:
    """Least length of each length's bucket, 0 below the first step."""
    bounds = _bounds(1 << int(length.max(initial=1)).bit_length(), steps)
    return bounds[np.maximum(np.searchsorted(bounds, length, side="right") - 1, 0)]


def _place(length: np.ndarray | int, width: np.ndarray | int, edits: int, i: int) -> np.ndarray | int:
    """Start of segment i in a line of the given length."""
    return i * width if 2 * i <= edits else length - (edits + 1 - i) * width


def _grouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together until they hold ``size`` bytes."""
    some, held = [], 0
    for batch in batches:
        some.append(batch)
        held += batch.nbytes
        if held >= size:
            yield pa.Table.from_batches(some)
            some, held = [], 0
    if some:
        yield pa.Table.from_batches(some)


def _packed(side: int, ids: np.ndarray, segment: int) -> np.ndarray:
    """Side, id and segment number in one integer that sorts by them."""
    return np.int64(side << 62 | segment) | ids << 7


def _entries(steps: Steps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, entry): index entries (side 0) and probe entries (side 1) of each line, see ``_packed``.

        An index entry stands for the probe of the same place too, which would have the same key.
        """
        powers = inverse = np.zeros(0, np.uint64)
        for batch in _grouped(batches, 1 << 20):
            ids = batch.column("id").to_numpy()
            if len(ids) and int(ids.max()) >> ID_BITS:
                raise ValueError("line ids are too large to be packed")  # over four million partitions
            raw = [t.encode("utf-32-le", "surrogatepass") for t in batch.column("line").to_pylist()]
            size = np.array([len(r) // 4 for r in raw], np.int64)
            codes = np.frombuffer(b"".join(raw), "<u4").astype(np.uint64)
            start = np.concatenate(([0], np.cumsum(size)))[:-1]
            if len(codes) >= len(powers):
                powers, inverse = (np.concatenate((np.ones(1, np.uint64), np.full(len(codes), x))).cumprod() for x in (_B, _B_INVERSE))
            upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes + _M) * powers[:len(codes)])))
            keys, entries = [], []

            def hashed(which, at, width, length, segment):
                b = start[which] + at  # noqa: B023
                h = (upto[b + width] - upto[b]) * inverse[b]  # noqa: B023
                h ^= h >> np.uint64(32)
                h = (h + length.astype(np.uint64) * _B) * _M
                h ^= h >> np.uint64(29)
                h = (h + np.uint64(segment + 1)) * _B
                h ^= h >> np.uint64(32)
                return h.view(np.int64)

            def put(h, which, segment, side):
                keys.append(h)  # noqa: B023
                entries.append(_packed(side, ids[which], segment))  # noqa: B023

            reached = [_bucket(size - extra, steps) for extra in range(max((e for _, e in steps), default=0) + 1)]
            for edits in [e for _, e in steps]:
                mine = [np.flatnonzero((max_edits(size - extra, steps) == edits) & ((extra == 0) | (reached[extra] != reached[extra - 1])))
                        for extra in range(edits + 1)]
                which, low = np.concatenate(mine), np.concatenate([reached[extra][x] for extra, x in enumerate(mine)])
                if not len(which):
                    continue
                own = np.arange(len(which)) < len(mine[0])
                width = low // (edits + 1)
                for i in range(edits + 1):
                    at = _place(size[which], width, edits, i)
                    unmoved = hashed(which, at, width, low, i)
                    put(unmoved[own], which[own], i, 0)
                    put(unmoved[~own], which[~own], i, 1)
                    for shift in [x for d in range(1, min(i, edits - i) + 1) for x in (-d, d)]:
                        fits = np.flatnonzero((at + shift >= 0) & (at + shift + width <= size[which]))
                        h = hashed(which[fits], (at + shift)[fits], width[fits], low[fits], i)
                        other = h != unmoved[fits]  # a line that repeats itself has that entry
                        put(h[other], which[fits][other], i, 1)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, entries)], names=["key", "entry"])

    return run


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by key and entry: (key, side, id, segment, chunk) of buckets with an index line and another line,
    each line of a side once, numbered in chunks of TILE. An index line comes as a probe line too.

    Index entries come first, so that a bucket without one passes by. A bucket is held only until it shows two lines;
    from then on its rows pass through.
    """
    key_now, row_now, seen, live, indexed = None, None, [0, 0], False, False
    held = np.zeros(0, np.int64)

    for batch in _grouped(batches, 1 << 20):
        if not batch.num_rows:
            continue
        key, entry = (batch.column(c).to_numpy() for c in ("key", "entry"))
        line = entry >> 7  # side and id
        new = np.concatenate(([(key[0], line[0]) != row_now], (key[1:] != key[:-1]) | (line[1:] != line[:-1])))
        row_now = (key[-1], line[-1])
        key, entry = key[new], entry[new]
        if not len(key):
            continue
        owner = (entry >> 7) & ((1 << ID_BITS) - 1)
        cut = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        busy = np.flatnonzero((np.minimum.reduceat(owner, cut[:-1]) != np.maximum.reduceat(owner, cut[:-1])) & (entry[cut[:-1]] >> 62 == 0))
        out = []

        def emit(k, rows, counts):
            """Rows with the running number of each side."""
            first = rows[rows >> 62 == 0]
            for side, mine in ((0, first), (1, np.concatenate((first, rows[rows >> 62 == 1])))):
                at = counts[side] + np.arange(len(mine))
                counts[side] += len(mine)
                out.append((np.full(len(mine), k, np.int64), np.full(len(mine), side, np.int8), (mine >> 7) & ((1 << ID_BITS) - 1), (mine & 127).astype(np.int8), at // TILE))  # noqa: B023

        ends = {0, len(cut) - 2}
        inner = np.zeros(len(cut) - 1, bool)
        inner[busy] = True
        inner[[*ends]] = False
        if inner.any():  # buckets that end in this batch, all at once
            rows, sizes = np.repeat(inner, np.diff(cut)), np.diff(cut)[inner]
            k, mine = key[rows], entry[rows]
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            at, index = np.arange(len(mine)) - first, mine >> 62 == 0  # index rows come first: one number for both sides
            for side, x in ((0, index), (1, np.ones(len(mine), bool))):
                out.append((k[x], np.full(x.sum(), side, np.int8), (mine[x] >> 7) & ((1 << ID_BITS) - 1), (mine[x] & 127).astype(np.int8), at[x] // TILE))
        for g in sorted(ends):
            rows = entry[cut[g]:cut[g + 1]]
            if g == 0 and key_now is not None and key[0] == key_now:  # goes on from the batch before
                rows = np.concatenate((held, rows))
            else:
                seen, live, indexed = [0, 0], False, bool(rows[0] >> 62 == 0)
            lines = (rows >> 7) & ((1 << ID_BITS) - 1)
            live = live or indexed and bool((lines != lines[0]).any())
            if live:
                emit(key[cut[g]], rows, seen)
            if g == len(cut) - 2:
                key_now, held = key[cut[g]], rows[:0] if live or not indexed else rows[:1]  # an index row of one line so far
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["key", "side", "id", "segment", "chunk"])


def _histogram(line: str) -> np.ndarray:
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(codes & 63, minlength=64).astype(np.int32)


def _shares_earlier(short: str, line: str, edits: int, width: int, before: int) -> bool:
    """Whether a segment of the shorter line ahead of number ``before`` meets a probe of the other: the pair belongs there."""
    for i in range(before):
        at, there, reach = _place(len(short), width, edits, i), _place(len(line), width, edits, i), min(i, edits - i)
        part = short[at:at + width]
        if any(line.startswith(part, x) for x in range(max(there - reach, 0), there + reach + 1)):
            return True
    return False


def _tile_links(index: list[tuple[int, str, int]], probes: list[tuple[int, str, int]], steps: Steps = EDITS) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """A spanning forest of the links that belong to one tile, and the number of these links of each line."""
    root: dict[int, int] = {}
    counts: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    index = sorted(index, key=lambda x: len(x[1]))
    size = [len(t) for _, t, _ in index]
    allowed = max_edits(np.array(size), steps).tolist()
    widths = (_bucket(np.array(size), steps) // (np.array(allowed) + 1)).tolist()
    bars, links = None, []
    for pid, line, _ in probes:
        n = len(line)
        at = [k for k in range(bisect_left(size, n - allowed[-1]), bisect_right(size, n))
              if n - size[k] <= allowed[k] and (n > size[k] or index[k][0] < pid)]
        if len(at) > 8:  # with fewer, the distances cost no more than the letter counts
            bars = np.stack([_histogram(t) for _, t, _ in index]) if bars is None else bars
            near = np.abs(bars[at] - _histogram(line)).sum(axis=1) <= 2 * np.array(allowed)[at]
            at = [k for k, x in zip(at, near.tolist(), strict=True) if x]
        for k in at:
            iid, other, segment = index[k]
            limit = allowed[k]
            if _shares_earlier(other, line, limit, widths[k], segment) or edit_distance(other, line, limit) > limit:
                continue
            counts[iid] = counts.get(iid, 0) + 1
            counts[pid] = counts.get(pid, 0) + 1
            a, b = find(iid), find(pid)
            if a != b:
                root[a] = b
                links.append((iid, pid))
    return links, counts


def _verify(steps: Steps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles come one after the other, index lines first. Rows are links of the forest (a, b) or numbers of links (a, n)."""
        now, sides = None, ([], [])

        def found() -> pa.RecordBatch | None:
            links, counts = _tile_links(*sides, steps) if sides[0] and sides[1] else ([], {})
            rows = [(a, b, None) for a, b in links] + [(a, None, n) for a, n in counts.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b", "n"]) if rows else None

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "i", "p", "side", "id", "line", "segment")]
            for key, i, p, side, owner, line, segment in zip(*cols, strict=True):
                if (key, i, p) != now:
                    if (out := found()) is not None:
                        yield out
                    now, sides = (key, i, p), ([], [])
                sides[side].append((owner, line, segment))
        if (out := found()) is not None:
            yield out

    return run


def line_links(lines: DataFrame, steps: Steps = EDITS) -> tuple[DataFrame, DataFrame]:
    """Of distinct lines (id, line): links (a, b) between ids that connect what the edit distance connects, and the number
    of all links (id, n_links) of each line that has any."""
    spark, steps = lines.sparkSession, _checked(steps)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = lines.mapInArrow(_entries(steps), "key long, entry long").repartition(n, "key").sortWithinPartitions("key", "entry")
    live, live_path = write_scratch(met.mapInArrow(_live, "key long, side byte, id long, segment byte, chunk long"), "lines-live")
    chunks = live.groupBy("key").agg(F.max(F.when(F.col("side") == 0, F.col("chunk"))).alias("i_last"), F.max(F.when(F.col("side") == 1, F.col("chunk"))).alias("p_last"))
    spread, _ = write_scratch(chunks.filter("i_last is not null and p_last is not null"), "lines-chunks")
    placed = live.join(spread, "key")
    index, probe = F.col("side") == 0, F.col("side") == 1
    tiles = placed.withColumn("i", F.explode(F.when(index, F.array("chunk")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("i_last"))))) \
        .withColumn("p", F.explode(F.when(probe, F.array("chunk")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("p_last"))))).select("key", "i", "p", "side", "id", "segment")
    texts = may_match(lines, live.select("id").distinct(), "id")  # most lines are in no tile and need not be dealt
    rows = tiles.join(texts, "id").repartition(n, "key", "i", "p").sortWithinPartitions("key", "i", "p", "side")
    found, _ = write_scratch(rows.mapInArrow(_verify(steps), "a long, b long, n long"), "lines-links")
    discard(spark, live_path)
    links = found.filter("b is not null").select("a", "b").distinct()
    counts = found.filter("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))
    return links, counts


def dedup_lines(docs: DataFrame, steps: Steps = EDITS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, removed (line numbers from 0), classes and links (of each line, null if blank).

    A class is named by the hexadecimal key of one of its lines; lines that stand alone name their own. The links of a
    line are the different lines within its edits; n_links is their sum over the row's lines.
    """
    spark = docs.sparkSession
    small_batches(spark)
    split = F.when(F.length("text") > 0, F.split("text", "\n")).otherwise(F.array().cast("array<string>"))
    filled = "[^ \t\r\x0b\x0c]"  # found at once in a line that is not blank
    keyed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.transform(split, lambda x: F.when(x.rlike(filled), text_key(x))).alias("keys"))
    rows, _ = write_scratch(keyed, "lines-rows")
    every = docs.select(F.explode(split).alias("line")).filter(F.col("line").rlike(filled))
    distinct = every.distinct().select("line", text_key(F.col("line")).alias("key"), F.monotonically_increasing_id().alias("id"))
    lines, lines_path = write_scratch(distinct, "lines-distinct")
    forest, counts = line_links(lines.select("id", "line"), steps)
    roots, _ = write_scratch(connected_components(forest, "lines"), "lines-roots")
    linked = lines.select("id", "key").join(roots, F.col("id") == F.col("node")).join(counts, "id").select("key", "root", "n_links")
    least = linked.groupBy("root").agg(F.min("key").alias("class"))
    classes, _ = write_scratch(linked.join(least, "root").select("key", "class", "n_links"), "lines-classes")
    seen = rows.select("doc_id", "row", F.posexplode("keys").alias("pos", "key")).filter("key is not null")
    named, _ = write_scratch(seen.join(classes, "key", "left").select("doc_id", "row", "pos", F.coalesce("class", "key").alias("class"),
                                                                          F.coalesce("n_links", F.lit(0)).alias("links")), "lines-named")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")
    first, _ = write_scratch(named.groupBy("class").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
                             .select("class", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")), "lines-first")
    marked = named.join(first, "class", "left").select("row", "pos", "class", "links", F.coalesce((F.col("row") != F.col("first_row")) | (F.col("pos") != F.col("first_pos")), F.lit(False)).alias("gone"))
    per_row = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "gone", "class", "links"))).alias("lines"))
    gone = F.transform(F.filter("lines", lambda x: x["gone"]), lambda x: x["pos"])
    n_links = F.aggregate("lines", F.lit(0).cast("long"), lambda total, x: total + x["links"])
    facts = per_row.select("row", gone.alias("removed"), "lines", n_links.alias("n_links"))
    discard(spark, lines_path)
    empty = F.array().cast("array<int>")
    # blank lines are put among the others by their position: sorted, not looked up line by line
    entry = "array<struct<pos:int,gone:boolean,class:binary,links:bigint>>"
    none = [F.lit(None).cast(t).alias(c) for c, t in (("gone", "boolean"), ("class", "binary"), ("links", "bigint"))]
    blank = F.filter(F.transform("keys", lambda k, i: F.when(k.isNull(), F.struct(i.alias("pos"), *none))), lambda x: x.isNotNull())
    every = F.array_sort(F.concat(F.coalesce(F.col("lines").cast(entry), F.array().cast(entry)), blank.cast(entry)))
    return rows.select("doc_id", "row", "keys").join(facts, "row", "left").withColumn("lines", every).select(
        "doc_id", F.size("keys").cast("long").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", empty).alias("removed"),
        F.transform("lines", lambda x: F.lower(F.hex(x["class"]))).alias("classes"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.transform("lines", lambda x: x["links"]).alias("links"))


def keep_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose numbers are in ``removed``."""
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(removed, i))
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(kept, "\n"))

