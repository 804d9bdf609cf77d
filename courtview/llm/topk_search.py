"""Exact top-k search by inner product: tiles of queries times shards, partial selection, tree merging.

Vectors are quantised to ``floor(scale * x)`` and packed into blocks; each tile multiplies one block of queries with
one shard block and keeps the k best of every query in it; the lists are merged in a tree of bounded fan-in, so that
no task sees all lists of a query. Scores are exact integers: float64 products where the sums stay below 2**53,
Python integers beyond (held to the range of a long).

Defined results: vectors null, with null or non-finite components, or with a null id take no part; vectors of
different length have no score; ties go to the smaller vec_id; a repeated vec_id is a candidate (and a query) for each
of its rows, a query leaves out its own row only; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtview.llm.common import write_scratch

SHARD_ROWS = 4096
QUERY_ROWS = 1024
FAN_IN = 64
_BLOCK = "block long, dim int, n int, ids binary, rows binary, mat binary, top double"
_LONG = (1 << 63) - 1


def _pack(block: int, ids: np.ndarray, rows: np.ndarray, mat: np.ndarray) -> dict:
    top = float(np.abs(mat).max()) if mat.size else 0.0
    small = top < 2 ** 31 - 1
    return {"block": block, "dim": mat.shape[1], "n": len(ids), "ids": ids.astype("<i8").tobytes(), "rows": rows.astype("<i8").tobytes(),
            "mat": mat.astype("<i4" if small else "<f8").tobytes(), "top": top}


def _matrix(raw: bytes, dim: int, n: int) -> np.ndarray:
    kind = "<i4" if len(raw) == 4 * dim * n else "<f8"
    return np.frombuffer(raw, kind).reshape(n, dim).astype(np.float64)


def _quantise(scale: float, block_rows: int):
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("mat", pa.binary()), ("top", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal count
            ids, vecs = zip(*held.pop(dim), strict=True)
            at = (part << 40) + count
            count += len(ids)
            return pa.RecordBatch.from_pylist([_pack(at, np.array(ids, np.int64), at + np.arange(len(ids)), np.array(vecs, np.float64).reshape(len(ids), dim))], schema=schema)

        for batch in batches:
            ids, lists = batch.column("id").to_pylist(), batch.column("vec")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.cast(pa.float64())
            ok = np.ones(len(flat), bool) if not flat.null_count else flat.is_valid().to_numpy(zero_copy_only=False)
            values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(scale * values)
            bad = np.concatenate(([0], np.cumsum(~(ok & np.isfinite(values)))))
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            for k, vec_id in enumerate(ids):
                a, b = offsets[k], offsets[k + 1]
                if vec_id is None or not valid[k] or bad[b] != bad[a]:
                    continue
                held.setdefault(int(b - a), []).append((vec_id, values[a:b].copy()))
                if len(held[int(b - a)]) >= block_rows:
                    yield out(int(b - a))
        for dim in list(held):
            yield out(dim)

    return run


def _queries(every: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for r in batch.to_pylist():
                ids, rows = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["rows"], "<i8")
                pick = ids % every == 0
                if pick.any():
                    held.setdefault(r["dim"], []).append((ids[pick], rows[pick], _matrix(r["mat"], r["dim"], r["n"])[pick]))
        for dim, parts in held.items():
            ids, rows, mat = (np.concatenate(x) for x in zip(*parts, strict=True))
            for a in range(0, len(ids), block_rows):
                s = slice(a, a + block_rows)
                yield pa.RecordBatch.from_pylist([_pack(int(rows[a]), ids[s], rows[s], mat[s])], schema=schema)

    return run


def _exact_scores(q: np.ndarray, v: np.ndarray, bound: float) -> np.ndarray:
    if bound < 2 ** 53:
        return (q @ v.T).astype(np.int64)
    q_int, v_int = [[int(x) for x in r] for r in q], [[int(x) for x in r] for r in v]
    return np.array([[max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(x, y, strict=True)))) for y in v_int] for x in q_int], dtype=np.int64)


def tile_top(q_ids, q_rows, q, v_ids, v_rows, v, k: int, bound: float):
    """(query row, query id, vec_id, score) of the k best of each query within one tile."""
    scores = _exact_scores(q, v, bound)
    order = np.argsort(v_ids, kind="stable")
    scores, ids, rows = scores[:, order], v_ids[order], v_rows[order]
    for i in range(len(q_ids)):
        s, own = scores[i], rows == q_rows[i]
        if own.any():
            keep = ~own
            s, mine = s[keep], ids[keep]
        else:
            mine = ids
        if not len(s):
            continue
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            above = np.flatnonzero(s > least)
            best = np.concatenate((above, np.flatnonzero(s == least)[:k - len(above)]))
        else:
            best = np.arange(len(s))
        for j in best:
            yield int(q_rows[i]), int(q_ids[i]), int(mine[j]), int(s[j])


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_row", "query_id", "vec_id", "score", "block"]
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if r["dim"] != r["q_dim"]:
                    continue
                read = lambda p, c: np.frombuffer(r[p + c], "<i8")  # noqa: B023, E731
                found = list(tile_top(read("q_", "ids"), read("q_", "rows"), _matrix(r["q_mat"], r["dim"], r["q_n"]), read("", "ids"), read("", "rows"),
                                      _matrix(r["mat"], r["dim"], r["n"]), k, r["top"] * r["q_top"] * max(1, r["dim"])))
                if found:
                    cols = [pa.array(np.array(c, np.int64)) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(found), r["block"], np.int64))], names=names)

    return run


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
                shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``, its k best other rows."""
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    blocks, _ = write_scratch(source.mapInArrow(_quantise(scale, shard_rows), _BLOCK), "topk-blocks")
    queries, _ = write_scratch(blocks.mapInArrow(_queries(every, query_rows), _BLOCK), "topk-queries")
    n_blocks, n_queries = blocks.count(), queries.count()
    cores = max(2, vectors.sparkSession.sparkContext.defaultParallelism)
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns]).repartition(max(1, min(n_queries, 64)))
    shards = blocks.repartition(max(1, min(n_blocks, 8 * cores)))
    # a stated query set against all rows, in blocks: each pair of blocks is one matrix product
    tiles = asked.crossJoin(shards).mapInArrow(_tiles(k), "query_row long, query_id long, vec_id long, score long, block long")
    lists, _ = write_scratch(tiles, "topk-lists")
    groups = n_blocks
    lists = lists.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(max(1, groups))))
    entry = F.struct((-F.col("score") - 1).alias("key"), "vec_id", "score")  # -x - 1 turns the order without overflow
    while True:
        groups = -(-groups // fan_in)
        best = lists.groupBy("query_row", "query_id", F.pmod("block", F.lit(max(1, groups))).alias("block")) \
            .agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best"))
        lists = best.select("query_row", "query_id", "block", F.inline("best"))
        if groups <= 1:
            break
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
