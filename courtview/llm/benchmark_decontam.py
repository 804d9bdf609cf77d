"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical tokens: numbers, units behind numbers and names (runs of capitalised words that
do not start a sentence) turn into typed placeholders that remember their value; all other words are lower-cased. Windows
of ``width`` canonical tokens are hash-joined with those of the benchmark items, so that a question matches with
other numbers and names in it. Matches are laid along diagonals (position in the text minus position in the item);
a diagonal counts only if its slots are consistent: the same value of the item is always the same value in the text.

Windows are matched in a plain form too: ``width`` lower-cased tokens with numbers, units and names as they are. It depends on
neither letter case nor what stands before. An item counts by its plain windows, all of them; a canonical window that is
matched on a consistent diagonal covers the plain windows inside it. Diagonals have an origin: the plain token of the text
at which the item would begin. An item is found in a text if diagonals whose origins lie within one stretch of half the item's
tokens (``width`` at least) match or cover at least ``threshold`` of its plain windows; words put in or left out shift the
origin by as much, and windows scattered over a text never add up.

Canonical windows with fewer than ``min_words`` plain words say too little by themselves: they count only on a diagonal and in a
run of matched windows with one that has enough, and else by their exact values, in the plain form. An item shorter than ``width`` tokens is looked up as one window of its own length, so an
item of one token is found wherever that token is. ``contaminated`` reports it; ``clean_documents`` takes only items of
``drop_tokens`` or more plain tokens as a ground to drop a document. A fixed-size bitmap of the items' hashes, whatever
their number, keeps most windows of the texts from being emitted; what passes it is joined exactly.

Null and empty texts and items have no windows; copies of a text are matched once each and reported for every
doc_id, repeated rows once; items with equal texts are all reported; null ids are kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import discard, small_batches, text_key, write_scratch

WIDTH = 5
MIN_WORDS = 3
THRESHOLD = 0.8
DROP_TOKENS = 2
BITMAP_BITS = 22
CACHED_WORDS = 1 << 19
UNITS = frozenset("""mm cm m km in inch inches ft feet yd yards mile miles mg g kg lb lbs oz ton tons ml l litre litres liter liters gallon
gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years kb mb gb tb hz khz mhz ghz v w kw j kj
cal kcal pa kpa mph kmh percent degrees dollars euros pounds cents""".split())
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[.!?\n%$€£°]")
_WORD, _NUMBER, _UNIT, _NAME, _END = range(5)
_SLOT = {_NUMBER: np.uint64(0xA0761D6478BD642F), _UNIT: np.uint64(0xE7037ED1A0B428DB), _NAME: np.uint64(0x8EBC6AF09C88C6E3)}
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_VALUES = pa.list_(pa.int64())
_PLAIN = 0x9FB21C651E98DF25


def _describe(token: str) -> tuple[int, int]:
    """Kind and value of one token, without its context."""
    if token in ".!?\n":
        return _END, 0
    value = int.from_bytes(hashlib.blake2b(token.lower().encode("utf-8", "replace"), digest_size=8).digest(), "little") | 1
    if token[0].isdigit():
        return _NUMBER, value
    if token in "%$€£°" or token.lower() in UNITS:
        return _UNIT, value
    if len(token) > 1 and token[0].isupper() and token[1:] == token[1:].lower():
        return _NAME, value
    return _WORD, value


class Canonical:
    """Canonical tokens of texts, with a bounded cache of words."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.kinds = np.zeros(1024, np.int8)
        self.values = np.zeros(1024, np.uint64)

    def learn(self, tokens: set[str]) -> None:
        if len(self.places) + len(tokens) > CACHED_WORDS:
            self.clear()
        while len(self.places) + len(tokens) > len(self.kinds):
            self.kinds, self.values = np.concatenate((self.kinds, self.kinds)), np.concatenate((self.values, self.values))
        for t in tokens:
            at = self.places[t] = len(self.places)
            self.kinds[at], self.values[at] = _describe(t)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(identifier, slot value or 0, number of the text, first plain token) of each canonical token of the texts, and
        (value, number of the text) of each plain token."""
        tokens, sizes = [], []
        for text in texts:
            found = _TOKEN.findall(text)
            found.append("\n")  # texts end sentences
            tokens += found
            sizes.append(len(found))
        if new := set(tokens).difference(self.places):
            self.learn(new if len(self.places) + len(new) <= CACHED_WORDS else set(tokens))
        at = np.fromiter(map(self.places.__getitem__, tokens), np.int64, len(tokens))
        kinds, values, owner = self.kinds[at], self.values[at], np.repeat(np.arange(len(texts)), sizes)
        before = np.concatenate(([_END], kinds[:-1]))
        kinds = np.where((kinds == _NAME) & (before == _END), _WORD, kinds)
        kinds = np.where((kinds == _UNIT) & (before != _NUMBER), _WORD, kinds)
        keep = kinds != _END
        kinds, values, owner = kinds[keep], values[keep], owner[keep]
        plain, plain_owner, begin = values, owner, np.arange(len(values))
        run = (kinds == _NAME) & np.concatenate(([False], kinds[:-1] == _NAME))[:len(kinds)]  # further words of a name
        if run.any():
            first = np.flatnonzero(~run)
            values = np.add.reduceat(np.where(run, values * _K[1] + _K[2], values), first)
            kinds, owner, begin = kinds[first], owner[first], first
        ids = values.copy()
        for kind, slot in _SLOT.items():
            ids[kinds == kind] = slot
        return ids, np.where(kinds == _WORD, np.uint64(0), values), owner, begin, plain, plain_owner


def windows(ids: np.ndarray, slots: np.ndarray, owner: np.ndarray, width: int, min_words: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the windows of ``width`` tokens of one text, their positions, and whether they have ``min_words`` plain words."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    h = np.full(n, np.uint64(width * int(_K[3]) % (1 << 64) ^ seed))
    for i in range(width):
        h = (h ^ ids[i:i + n]) * _K[i % 5]
        h ^= h >> np.uint64(31)
    plain = np.concatenate(([0], np.cumsum(slots == 0)))
    at = np.flatnonzero(owner[:n] == owner[width - 1:])
    return h[at], at, (plain[width:] - plain[:-width] >= min(min_words, width))[at]


def plain_windows(plain: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` plain tokens of one text, and their positions."""
    return windows(plain, np.zeros(len(plain), np.uint64), owner, width, 0, _PLAIN)[:2]


def _supported(at: np.ndarray, owner: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """Which windows are telling or in a run of consecutive ones of their text with a telling one."""
    first = np.concatenate(([True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])))
    return np.logical_or.reduceat(telling, np.flatnonzero(first))[np.cumsum(first) - 1]


def _item_windows(width: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        for batch in batches:
            for key, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids, slots, owner, begin, plain, plain_owner = canonical([text])
                size, raw = min(width, len(ids)), min(width, len(plain))
                if not size:
                    continue
                end = np.append(begin, len(plain))
                h, at, telling = windows(ids, slots, owner, size, min_words)
                h2, at2 = plain_windows(plain, plain_owner, raw)
                values = [slots[p:p + size].view(np.int64).tolist() if slots[p:p + size].any() else None for p in at] + [None] * len(h2)
                n, every = len(plain) - raw + 1, len(h) + len(h2)
                # the plain windows inside each window, by their numbers
                lows, highs = np.concatenate((begin[at], at2)), np.concatenate((end[at + size] - raw, at2))
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * every, pa.binary()), pa.array(np.concatenate((h, h2)).view(np.int64)), pa.array(np.concatenate((at, at2)), pa.int64()), pa.array(values, _VALUES),
                    pa.array(np.repeat([size, raw], [len(h), len(h2)]).astype(np.int32)), pa.array(np.repeat([False, True], [len(h), len(h2)])),
                    pa.array(np.concatenate((telling, np.ones(len(h2), bool)))), pa.array(lows, pa.int64()), pa.array(highs, pa.int64()), pa.array(np.full(every, n, np.int64)),
                    pa.array(np.full(every, len(plain), np.int64))],
                    names=["item", "hash", "at", "slots", "size", "plain", "telling", "low", "high", "item_windows", "item_tokens"])

    return run


def _groups(texts: list[str], chars: int = 1 << 17) -> Iterator[slice]:
    """Runs of texts of about ``chars`` characters, which are taken apart together."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield slice(first, i + 1)
            first, size = i + 1, 0


def _text_windows(widths: list[int], plain_widths: list[int], min_words: int, bitmap: np.ndarray):
    mask = np.uint64((1 << BITMAP_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        known = np.unpackbits(bitmap, bitorder="little").view(bool)
        for batch in batches:
            keys = batch.column("key")
            ids_col = batch.column("doc_id")
            rows, hashes, places, words, values = [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for group in _groups(texts):
                ids, slots, owner, begin, plain, plain_owner = canonical(texts[group])
                start, plain_start = (np.searchsorted(o, np.arange(group.stop - group.start)) for o in (owner, plain_owner))
                for width in widths:
                    h, at, telling = windows(ids, slots, owner, width, min_words)
                    hit = known[(h & mask).astype(np.int64)]
                    if (hit & telling).any():
                        h, at, telling = h[hit], at[hit], telling[hit]
                        backed = _supported(at, owner, telling)
                        h, at = h[backed], at[backed]
                        rows += (owner[at] + group.start).tolist()
                        hashes.append(h)
                        places.append(at - start[owner[at]])
                        words.append(begin[at] - plain_start[owner[at]])
                        values += [slots[p:p + width].view(np.int64).tolist() if slots[p:p + width].any() else None for p in at]
                for width in plain_widths:
                    h, at = plain_windows(plain, plain_owner, width)
                    hit = known[(h & mask).astype(np.int64)]
                    if hit.any():
                        h, at = h[hit], at[hit]
                        rows += (plain_owner[at] + group.start).tolist()
                        hashes.append(h)
                        places.append(at - plain_start[plain_owner[at]])
                        words.append(places[-1])
                        values += [None] * len(h)
            if rows:
                owner = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([keys.take(owner), ids_col.take(owner), pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(places), pa.int64()),
                                                  pa.array(np.concatenate(words), pa.int64()), pa.array(values, _VALUES)], names=["key", "doc_id", "hash", "pos", "word", "values"])

    return run


def _bitmap(items: DataFrame) -> np.ndarray:
    """A bit for each of 2**BITMAP_BITS hash remainders: 65,536 words at most, however many items there are."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = items.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(hash & 63 as int)))").alias("bits")).collect()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in words:
        out[r["word"]] = r["bits"]
    return out.view(np.uint8)


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_words: int = MIN_WORDS, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(key, item, matched_windows, item_windows, item_tokens, containment, changed_slots, first, last) of each distinct text and
    item found in it (``first`` and ``last``: the plain tokens at which its first and last matched window begin); and the (key, doc_id) of the texts with any matched window."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = benchmark.select("text").filter(F.length("text") > 0).distinct().withColumn("item", text_key(F.col("text")))
    items, _ = write_scratch(texts.mapInArrow(_item_windows(width, min_words), "item binary, hash long, at long, slots array<long>, size int, plain boolean, telling boolean, low long, high long, item_windows long, item_tokens long"), "decontam-items")
    sizes = items.select("plain", "size").distinct().collect()  # ``width`` numbers at most of either form
    widths, plain_widths = (sorted(r["size"] for r in sizes if r["plain"] == form) for form in (False, True))
    keyed = docs.select("doc_id", "text").filter(F.length("text") > 0).withColumn("key", text_key(F.col("text")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = keyed.mapInArrow(_text_windows(widths, plain_widths, min_words, _bitmap(items)), f"key binary, doc_id {id_type}, hash long, pos long, word long, values array<long>")
    hits, hits_path = write_scratch(found, "decontam-hits")
    joined = hits.join(items.select("item", "hash", "at", "slots", "plain", "telling", "low", "high", "item_windows", "item_tokens"), "hash")
    # per diagonal of either form: the item's plain windows met, and the distinct pairs of slot values
    diagonal = joined.groupBy("key", "item", "item_windows", "item_tokens", "plain", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.collect_set(F.struct("low", "high")).alias("met"), F.collect_set(F.struct("slots", "values")).alias("pairs"),
        F.min(F.col("word") - F.col("low")).alias("origin"), F.min("word").alias("first"), F.max("word").alias("last"), F.max("telling").alias("telling")).filter("telling")
    pairs = F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.coalesce(F.filter(
        F.arrays_zip(p["slots"], p["values"]), lambda v: v["slots"] != 0), F.array().cast("array<struct<slots:bigint,values:bigint>>")))))
    mapped = diagonal.withColumn("map", pairs)
    consistent = mapped.filter(F.size("map") == F.size(F.array_distinct(F.transform("map", lambda v: v["slots"]))))
    numbers = F.array_distinct(F.flatten(F.transform("met", lambda w: F.sequence(w["low"], w["high"]))))
    lines = consistent.withColumns({"numbers": numbers, "changed": F.size(F.filter("map", lambda v: v["slots"] != v["values"]))})
    # blocks of two stretches overlap by one, so that every stretch lies whole in a block; a block holds few diagonals, whatever the text's length
    stretch = F.greatest(F.lit(width), F.ceil(F.col("item_tokens") / 2))
    block = F.floor(F.col("origin") / stretch)
    blocks = lines.withColumn("block", F.explode(F.array(block - 1, block))).groupBy("key", "item", "item_windows", "item_tokens", "block").agg(
        F.collect_set(F.struct("origin", "numbers", "changed", "first", "last")).alias("lines"))

    def joint(begin: Column) -> Column:
        """What the diagonals of the stretch from ``begin`` match together."""
        part = F.filter("lines", lambda d: (d["origin"] >= begin) & (d["origin"] <= begin + stretch))
        return F.struct(F.size(F.array_distinct(F.flatten(part["numbers"]))).cast("long").alias("matched_windows"), F.array_max(part["changed"]).cast("long").alias("changed_slots"),
                        F.array_min(part["first"]).alias("first"), F.array_max(part["last"]).alias("last"))

    needed = F.col("item_windows") * threshold
    likely = blocks.filter(F.size(F.array_distinct(F.flatten(F.col("lines")["numbers"]))) >= needed)
    found_at = likely.select("key", "item", "item_windows", "item_tokens", F.explode(F.transform(F.array_distinct(F.col("lines")["origin"]), joint)).alias("m"))
    per_item = found_at.filter(F.col("m.matched_windows") / F.col("item_windows") >= threshold).groupBy("key", "item", "item_windows", "item_tokens").agg(
        F.max("m.matched_windows").alias("matched_windows"), F.max("m.changed_slots").alias("changed_slots"), F.min("m.first").alias("first"), F.max("m.last").alias("last"))
    enough = per_item.withColumn("containment", F.col("matched_windows") / F.col("item_windows"))
    result, _ = write_scratch(enough, "decontam-found")
    owners, _ = write_scratch(hits.join(result.select("key").distinct(), "key", "left_semi").select("key", "doc_id").distinct(), "decontam-owners")
    discard(spark, hits_path)
    return result, owners


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    found, owners = matches(docs, benchmark, **options)
    names = benchmark.filter(F.length("text") > 0).select("item_id", text_key(F.col("text")).alias("item")).distinct()
    return owners.join(found, "key").join(names, "item").select(
        "doc_id", "item_id", "matched_windows", "item_windows", "containment", (F.col("changed_slots") > 0).alias("reparameterised"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, drop_tokens: int = DROP_TOKENS, **options) -> DataFrame:
    """The documents in whose text no item of ``drop_tokens`` or more plain tokens is found."""
    found, _ = matches(docs, benchmark, **options)
    bad, _ = write_scratch(found.filter(F.col("item_tokens") >= drop_tokens).select(F.col("key").alias("__key")).distinct(), "decontam-keys")
    return docs.withColumn("__text_key", text_key(F.col("text"))).join(bad, F.col("__text_key") == F.col("__key"), "left_anti").drop("__text_key")
