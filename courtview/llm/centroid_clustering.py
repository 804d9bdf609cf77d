"""Centroid clustering (Lloyd rounds in exact integers) with nearest centroids found by the threshold algorithm.

For each dimension the centroids stand in a list sorted by their value there. A vector enters each list at its own
value and walks outward, nearest value first; a centroid met for the first time in any list gets its exact distance.
What no list has reached yet differs by at least the frontier in every dimension, so the walk of a vector stops once
the sum of its squared frontier distances is strictly greater than its best exact distance (strictly: a centroid of
equal distance and smaller number may still come). Vectors are quantised to ``floor(scale * x)``, packed into blocks
and written once; a round is one pass over the blocks that gives sums for each task and cluster, added up by Spark.
The driver holds the centroids alone: ``k`` times ``dim`` integers.

Sums, distances and the floor of a mean are exact: 64-bit integers where the components are small enough that no
square sum overflows, Python integers beyond. Results are longs, held to the range of a long.

Defined results: vectors that are null, of another length, or with null or non-finite components (also after scaling) are
left out; a null id keeps its vector, but seeds come from null ids last; equal ids are ordered by their components;
repeated rows are rows of their own; with fewer than ``k`` vectors there are so many centroids; an empty table gives an
empty result; ties go to the smaller centroid number, an empty cluster keeps its centroid; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import scratch_scope, write_scratch

BLOCK_ROWS = 1024
LIMB_BITS = 40
_LONG = (1 << 63) - 1
_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("mat", pa.binary()), ("width", pa.int32()), ("top", pa.float64())])


def _blocks(scale: float, dim: int, block_rows: int):
    """Rows (vec_id, embedding) to packed blocks of quantised vectors."""
    def block(ids: list[np.ndarray], known: list[np.ndarray], mats: list[np.ndarray]) -> pa.RecordBatch:
        id_list, mat = pa.array(np.concatenate(ids), mask=~np.concatenate(known)), np.concatenate(mats)
        top = float(np.abs(mat).max()) if mat.size else 0.0
        width = 4 if top < 2 ** 31 - 1 else 8
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(id_list)], pa.int32()), id_list), pa.array([mat.astype("<i4" if width == 4 else "<f8").tobytes()]),
                                           pa.array([width], pa.int32()), pa.array([top])], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        rows = 0
        for batch in batches:
            ids, lists = batch.column("id"), batch.column("vec")
            offsets, flat = lists.offsets.to_numpy(), lists.values
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            pick = lists.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) == dim)
            mat = values[offsets[:-1][pick][:, None] + np.arange(dim)]
            with np.errstate(over="ignore", invalid="ignore"):
                mat = np.floor(scale * mat)
            finite = np.isfinite(mat).all(1)
            pick = np.flatnonzero(pick)[finite]
            mat = mat[finite]
            known, numbers = ids.is_valid().to_numpy(zero_copy_only=False)[pick], ids.fill_null(0).to_numpy()[pick]
            for a in range(0, len(mat), block_rows):
                s = slice(a, a + block_rows)
                for part, new in zip(held, (numbers[s], known[s], mat[s]), strict=True):
                    part.append(new)
                rows += len(mat[s])
                if rows >= block_rows:
                    yield block(*held)
                    held, rows = ([], [], []), 0
        if rows:
            yield block(*held)

    return run


def _integers(raw: bytes, width: int, dim: int, top: float, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a block and the centroids: int64 where squared distances fit, else Python integers."""
    mat = np.frombuffer(raw, "<i4" if width == 4 else "<f8").reshape(-1, dim)
    most = max([int(top), *(abs(x) for c in centroids for x in c)])
    if dim * (2 * most + 1) ** 2 < 1 << 62:
        return mat.astype(np.int64), np.array(centroids, np.int64).reshape(len(centroids), dim)
    whole = np.array([[int(x) for x in row] for row in mat.tolist()], dtype=object).reshape(mat.shape)
    return whole, np.array(centroids, dtype=object).reshape(len(centroids), dim)


def threshold_nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector, by the threshold algorithm."""
    n, dim = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    listed = np.take_along_axis(centroids, order, 0)
    far = 2 * max(int(abs(vectors).max()), int(abs(centroids).max())) + 1  # beyond any gap
    best = np.full(n, dim * far * far, dtype=vectors.dtype)
    nearest = np.full(n, k)
    right = np.stack([np.searchsorted(listed[:, j], vectors[:, j]) for j in range(dim)], axis=1)
    left = right - 1
    seen = np.zeros((n, k), bool)
    at, cols = np.arange(n), np.arange(dim)
    while len(at):
        mine, lo, hi = vectors[at], left[at], right[at]
        down = np.where(lo >= 0, mine - listed[np.maximum(lo, 0), cols], far)
        up = np.where(hi < k, listed[np.minimum(hi, k - 1), cols] - mine, far)
        go_down = down <= up
        met = order[np.where(go_down, np.maximum(lo, 0), np.minimum(hi, k - 1)), cols]
        new = np.zeros((len(at), k), bool)
        new[np.arange(len(at))[:, None], met] = True
        new &= ~seen[at]
        seen[at] |= new
        for c in np.flatnonzero(new.any(0)):  # smaller numbers first: ties stay with them
            rows = np.flatnonzero(new[:, c])
            gap = mine[rows] - centroids[c]
            exact = (gap * gap).sum(1)
            who = at[rows]
            better = (exact < best[who]) | ((exact == best[who]) & (c < nearest[who]))
            best[who[better]], nearest[who[better]] = exact[better], c
        lo, hi = lo - go_down, hi + ~go_down
        left[at], right[at] = lo, hi
        frontier = np.minimum(np.where(lo >= 0, mine - listed[np.maximum(lo, 0), cols], far), np.where(hi < k, listed[np.minimum(hi, k - 1), cols] - mine, far))
        stop = ((frontier * frontier).sum(1) > best[at]) | seen[at].all(1)
        at = at[~stop.astype(bool)]
    return nearest, best


def _sums(centroids: list[list[int]], dim: int):
    """Blocks to (cluster, limb, n, parts): the component sums of a task and cluster, as signed limbs of 40 bits."""
    schema = pa.schema([("cluster", pa.int32()), ("limb", pa.int32()), ("n", pa.int64()), ("parts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * len(centroids), [[0] * dim for _ in centroids]
        for batch in batches:
            for r in batch.to_pylist():
                vectors, against = _integers(r["mat"], r["width"], dim, r["top"], centroids)
                nearest, _ = threshold_nearest(vectors, against)
                for c in np.unique(nearest):
                    mine = vectors[nearest == c]
                    count[c] += len(mine)
                    total[c] = [a + int(b) for a, b in zip(total[c], mine.sum(0), strict=True)]
        out = []
        for c, sums in enumerate(total):
            limb = 0
            while count[c] and (limb == 0 or any(abs(x) >> LIMB_BITS * limb for x in sums)):
                mask = (1 << LIMB_BITS) - 1
                out.append({"cluster": c, "limb": limb, "n": count[c] if limb == 0 else 0,
                            "parts": [(-1 if x < 0 else 1) * (abs(x) >> LIMB_BITS * limb & mask) for x in sums]})
                limb += 1
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _assigned(centroids: list[list[int]], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                vectors, against = _integers(r["mat"], r["width"], dim, r["top"], centroids)
                nearest, best = threshold_nearest(vectors, against)
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(nearest, pa.int32()), pa.array([min(_LONG, int(x)) for x in best], pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _seeds(source: DataFrame, blocks: DataFrame, k: int, dim: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors whose ``seed:id`` has the smallest SHA-256, ascending; ``k`` rows reach the driver."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                mat = np.frombuffer(r["mat"], "<i4" if r["width"] == 4 else "<f8").astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(0, len(mat) + 1, dim), pa.int32()), pa.array(mat))], names=["id", "vec"])

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = blocks.mapInArrow(unpack, "id long, vec array<double>").orderBy(hashed.asc_nulls_last(), "id", "vec").limit(k).collect()
    return [[int(x) for x in r["vec"]] for r in rows]


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: float = 1024.0, seed: str = "3",
                    id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every kept vector after ``rounds`` rounds, and the final centroids.

    Rounds end early when one changes no centroid: the others would repeat it.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    with scratch_scope(spark) as scratch:
        blocks, _ = write_scratch(source.mapInArrow(_blocks(scale, dim, block_rows), "ids array<long>, mat binary, width int, top double"), "centroid-blocks")
        centroids = _seeds(source, blocks, k, dim, seed)
        for _ in range(rounds if centroids else 0):
            sums = blocks.mapInArrow(_sums(centroids, dim), "cluster int, limb int, n long, parts array<long>")
            added = (sums.select("cluster", "limb", "n", F.posexplode("parts").alias("j", "part")).groupBy("cluster", "limb", "j")
                     .agg(F.sum("n").alias("n"), F.sum("part").alias("part")).collect())  # k * dim rows for each limb
            count, total = [0] * len(centroids), [[0] * dim for _ in centroids]
            for r in added:
                total[r["cluster"]][r["j"]] += r["part"] << LIMB_BITS * r["limb"]
                count[r["cluster"]] = max(count[r["cluster"]], r["n"])
            before = centroids
            centroids = [[x // n for x in sums] if n else old for n, sums, old in zip(count, total, before, strict=True)]
            if centroids == before:
                break
        found, path = write_scratch(blocks.mapInArrow(_assigned(centroids, dim), "vec_id long, cluster int, distance long"), "centroid-assigned")
        scratch.remove(path)
    return found, centroids


def centroid_digests(centroids: list[list[int]]) -> list[str]:
    """SHA-256 of each centroid's components as decimal integers joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]


def clusters_with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``found`` with the inertia of its cluster and of all clusters, and the digest of the cluster's centroid."""
    spark = found.sparkSession
    named = spark.createDataFrame(list(enumerate(centroid_digests(centroids))), "cluster int, centroid_sha256 string")
    held = lambda c: F.least(c, F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    by_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s"))
    whole = found.agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("t"))
    facts = (named.join(by_cluster, "cluster").join(F.broadcast(whole), F.lit(True))  # one row
             .select("cluster", held(F.col("s")).alias("cluster_inertia"), held(F.col("t")).alias("inertia"), "centroid_sha256"))
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
