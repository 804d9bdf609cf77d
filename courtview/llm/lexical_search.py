"""Ranked lexical search, hybrid term-at-a-time and document-at-a-time, over an inverted index in shard blocks.

Documents are indexed once: each task packs runs of documents into blocks (a sorted dictionary, postings, lengths),
written as a table. Document frequencies are added up from the dictionaries, for the terms of the items alone.
Items are packed into blocks too, and each block of items meets each shard block (a stated query set against all rows).
In a shard block an item's short lists are worked off term at a time into summed accumulators. These are then one iterator
among the long lists, with the largest sum as its bound, and the block is read document at a time in ranges: a range in which the
bounds together cannot reach the k-th best score is skipped whole; in the others the lists whose bounds together cannot
reach it (non-essential ones) are only probed for documents that still can. A task keeps its k best of each item
over all its blocks, so that the bar rises from block to block; the lists of the tasks are merged in a tree of bounded fan-in.

Scores are 64-bit integers: a document's sum over the item's terms, repeats included, of
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 75 + (25 * n * N) div L``.

Defined results: null and empty texts have no terms and are not counted; a null doc_id comes after all others among equal
scores; repeated rows are documents (and items) of their own, also where ids are null; only scores above 0 count; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtview.llm.common import scratch_scope, write_scratch

BLOCK_DOCS = 4096
BLOCK_BYTES = 8 << 20
RANGE_DOCS = 1024
SHORT_SHARE = 32
ITEM_ROWS = 256
FAN_IN = 64
_INDEX = "docs int, words long, ids binary, known binary, lens binary, terms array<string>, dfs array<int>, posting_docs binary, posting_tfs binary"
_ITEMS = "item long, item_id long, terms array<string>, counts array<long>"
_HITS = "item long, item_id long, doc_id long, score long, task long"
#: Letters and digits of ASCII (A-Z lower-cased) and all bytes of other characters stay, the rest parts terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _index(block_docs: int, block_bytes: int):
    schema = pa.schema([("docs", pa.int32()), ("words", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("lens", pa.binary()), ("terms", pa.list_(pa.string())),
                        ("dfs", pa.list_(pa.int32())), ("posting_docs", pa.binary()), ("posting_tfs", pa.binary())])

    class Block:
        def __init__(self):
            self.ids, self.lens, self.sizes, self.bytes = [], [], [], 0
            self.number = defaultdict()
            self.number.default_factory = self.number.__len__
            self.term, self.tf = [], []

        def add(self, doc_id, words):
            counts = Counter(words)
            number = self.number
            self.term.append(np.array([number[t] for t in counts], np.int64))
            self.tf.append(np.fromiter(counts.values(), np.int32, len(counts)))
            self.ids.append(doc_id)
            self.lens.append(len(words))
            self.sizes.append(len(counts))

        def packed(self) -> pa.RecordBatch:
            names = sorted(self.number)
            place = np.empty(len(names), np.int64)
            for k, t in enumerate(names):
                place[self.number[t]] = k
            term = place[np.concatenate(self.term)]
            order = np.argsort(term, kind="stable")
            docs = np.repeat(np.arange(len(self.ids), dtype="<i4"), self.sizes)[order]
            row = {"docs": len(self.ids), "words": sum(self.lens), "ids": np.array([i or 0 for i in self.ids], "<i8").tobytes(),
                   "known": np.array([i is not None for i in self.ids], np.uint8).tobytes(), "lens": np.array(self.lens, "<i8").tobytes(),
                   "terms": [t.decode() for t in names], "dfs": np.bincount(term, minlength=len(names)).tolist(),
                   "posting_docs": docs.tobytes(), "posting_tfs": np.concatenate(self.tf)[order].astype("<i4").tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if words:
                    block.add(doc_id, words)
                    block.bytes += sum(map(len, words))
                if len(block.ids) >= block_docs or block.bytes >= block_bytes:
                    yield block.packed()
                    block = Block()
        if block.ids:
            yield block.packed()

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.string()), ("count", pa.int64())])
    for batch in batches:
        rows = [{"item": r["item"], "item_id": r["id"], "term": t.decode(), "count": n} for r in batch.to_pylist() for t, n in Counter(terms_of(r["text"])).items()]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def top_of_block(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, bar: int, range_docs: int = RANGE_DOCS, short_share: int = SHORT_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of those that reach ``bar``, the k-th best of the block so far (which rises meanwhile).

    ``lists``: sorted document numbers and contributions of each term. Ties with the k-th best are all in the result.
    """
    short = [x for x in lists if len(x[0]) * short_share <= docs]
    iterators = [x for x in lists if len(x[0]) * short_share > docs]
    if short:  # term at a time: summed accumulators, then one iterator with a bound
        sums = np.zeros(docs, np.int64)
        for d, c in short:
            sums[d] += c
        held = np.flatnonzero(sums)
        if len(held) >= k:  # sums of a part of the terms: scores are as large at least
            bar = max(bar, int(np.partition(sums[held], len(held) - k)[len(held) - k]))
        iterators.append((held, sums[held]))
    edges = np.arange(0, docs + range_docs, range_docs)
    cuts = [np.searchsorted(d, edges) for d, _ in iterators]
    found_docs, found = np.empty(0, np.int64), np.empty(0, np.int64)
    for r in range(len(edges) - 1):
        here = [(int(c[a:b].max()), d[a:b], c[a:b]) for (d, c), cut in zip(iterators, cuts, strict=True) for a, b in [(cut[r], cut[r + 1])] if a < b]
        if sum(x[0] for x in here) < bar:
            continue
        here.sort(key=lambda x: x[0])
        below, essential = 0, 0
        while essential < len(here) and below + here[essential][0] < bar:
            below += here[essential][0]
            essential += 1
        start = int(edges[r])
        scores = np.zeros(min(range_docs, docs - start), np.int64)
        for _, d, c in here[essential:]:
            scores[d - start] += c
        alive = np.flatnonzero(scores)
        mine = scores[alive]
        for most, d, c in reversed(here[:essential]):  # probed for documents that can still reach the bar
            keep = mine + below >= bar
            alive, mine = alive[keep], mine[keep]
            if not len(alive):
                break
            below -= most
            at = np.minimum(np.searchsorted(d, alive + start), len(d) - 1)
            mine = mine + np.where(d[at] == alive + start, c[at], 0)
        keep = mine >= bar
        if not keep.any():
            continue
        found_docs, found = np.concatenate((found_docs, alive[keep] + start)), np.concatenate((found, mine[keep]))
        if len(found) > k:
            bar = max(bar, int(np.partition(found, len(found) - k)[len(found) - k]))
            stay = found >= bar
            found_docs, found = found_docs[stay], found[stay]
    return found_docs, found


def _search(documents: int, words: int, k: int, range_docs: int, short_share: int):
    """Pairs of an item block and a shard block to the k best documents of each item in the task."""
    def weight(df: int) -> int:
        return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        best: dict[int, list] = {}
        names: dict[int, int | None] = {}
        bars: dict[int, int] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                number = {t: j for j, t in enumerate(r["terms"].as_py())}
                ends = np.concatenate(([0], np.cumsum(np.array(r["dfs"].as_py(), np.int64))))
                docs = r["docs"].as_py()
                posting_docs, posting_tfs = np.frombuffer(r["posting_docs"].as_py(), "<i4"), np.frombuffer(r["posting_tfs"].as_py(), "<i4")
                ids, known, lens = np.frombuffer(r["ids"].as_py(), "<i8"), np.frombuffer(r["known"].as_py(), np.uint8), np.frombuffer(r["lens"].as_py(), "<i8")
                if 25 * int(lens.max()) * documents < 1 << 63:
                    m = 75 + (25 * lens * documents) // words
                else:
                    m = np.array([75 + 25 * int(n) * documents // words for n in lens], np.int64)
                made: dict[str, tuple[np.ndarray, np.ndarray]] = {}

                def impacts(term: str):
                    if term not in made:  # noqa: B023
                        s = slice(ends[number[term]], ends[number[term] + 1])  # noqa: B023
                        d, tf = posting_docs[s], posting_tfs[s].astype(np.int64)  # noqa: B023
                        made[term] = d, (1_000_000_000 * tf) // (1000 * tf + 12 * m[d])  # noqa: B023
                    return made[term]  # noqa: B023

                for item in r["items"].as_py():
                    lists = []
                    for term, count, df in zip(item["terms"], item["counts"], item["dfs"], strict=True):
                        w = weight(df) * count
                        if w > 0 and term in number:
                            d, impact = impacts(term)
                            lists.append((d, w * impact))
                    if not lists:
                        continue
                    who = item["item"]
                    names[who] = item["item_id"]
                    at, scores = top_of_block(lists, docs, k, bars.get(who, 1), range_docs, short_share)
                    if len(at):
                        rows = best.get(who, []) + [(-int(s), not known[d], int(ids[d])) for d, s in zip(at, scores, strict=True)]
                        rows.sort()
                        best[who] = rows[:k]
                        if len(best[who]) == k:
                            bars[who] = -best[who][-1][0]
        rows = [{"item": who, "item_id": names[who], "doc_id": None if missing else d, "score": -s, "task": task} for who, found in best.items() for s, missing, d in found]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("task", pa.int64())]))

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                   block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES, range_docs: int = RANGE_DOCS, short_share: int = SHORT_SHARE,
                   item_rows: int = ITEM_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    with scratch_scope(spark) as scratch:
        source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        index, _ = write_scratch(source.mapInArrow(_index(block_docs, block_bytes), _INDEX), "lexical-index")
        totals = index.agg(F.coalesce(F.sum(F.col("docs").cast("long")), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("l")).first()
        asked = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
        terms, _ = write_scratch(asked.mapInArrow(_item_terms, "item long, item_id long, term string, count long"), "lexical-terms")
        wanted = terms.select("term").distinct()
        df = (index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("e")).select(F.col("e.terms").alias("term"), F.col("e.dfs").cast("long").alias("df"))
              .groupBy("term").agg(F.sum("df").alias("df")).join(wanted, "term", "left_semi"))
        of_item = (terms.join(df, "term").groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "count", "df")).alias("t"))
                   .select("item", "item_id", F.col("t.term").alias("terms"), F.col("t.count").alias("counts"), F.col("t.df").alias("dfs")))
        part, row = F.shiftright("item", 33), F.col("item").bitwiseAND(F.lit((1 << 33) - 1))
        packed = of_item.groupBy(part.alias("p"), F.floor(row / F.lit(item_rows)).alias("b")).agg(F.collect_list(F.struct("item", "item_id", "terms", "counts", "dfs")).alias("items"))
        blocks, _ = write_scratch(packed.select("items"), "lexical-items")
        # a stated query set against all rows, in blocks
        pairs = blocks.crossJoin(index)
        tasks = pairs.mapInArrow(_search(totals["n"], totals["l"], k, range_docs, short_share), _HITS)
        hits, path = write_scratch(tasks, "lexical-hits")
        scratch.remove(path)
        groups = hits.agg(F.coalesce(F.max("task"), F.lit(0))).first()[0] + 1
    entry = F.struct((-F.col("score")).alias("key"), F.col("doc_id").isNull().alias("missing"), "doc_id", "score")
    while True:
        groups = -(-groups // fan_in)
        best = hits.groupBy("item", "item_id", F.pmod("task", F.lit(groups)).alias("task")).agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
        hits = best.select("item", "item_id", "task", F.inline("best")).drop("key", "missing")
        if groups <= 1:
            break
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order).cast("int")).select("item_id", "rank", "doc_id", "score")
