"""k-means on whole numbers; the nearest centroid is found by the threshold algorithm.

Every dimension has a sorted list of its centroid components. From a vector's value each list is walked outward,
one entry a step in all dimensions at once. A centroid met for the first time gets its exact distance. The
squares of the last gaps add up to a bound that no centroid not yet met can undercut, so the walk of a vector
stops when that sum strictly exceeds its best distance; at equality it goes on, as ties go to the smaller number.

Vectors are packed once into blocks of rows on disk. A round is one pass over the blocks, with partial sums per task
and cluster; only the centroids (clusters x components) reach the driver and the tasks.

Edge cases: vectors that are null, of another length, or with a null or non-finite component take no part, nor do rows
with a null id; repeated rows are vectors of their own; fewer vectors than clusters give as many clusters;
equal first centroids are kept (the larger numbers stay empty); an empty table gives no rows; other columns are not read.
A component of 2**20 or more raises an error, since squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixsieve.session import write_table

BLOCK_ROWS = 4096
TILE_ROWS = 512
# When more than this share of the distances of a step is asked for, all are worked out in one matrix product.
DENSE = 0.25
EXACT = 2**53
LARGEST = 1 << 28
FAR = np.int64(1) << 40


def _usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return vector.isNotNull() & (F.size(vector) == dims) & finite


def _blocks(dims: int, scale: int):
    """Runs of vectors as (ids, vectors), both int64 in row order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        data: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            row = [pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (ids, data)]
            ids.clear()
            data.clear()
            return pa.RecordBatch.from_arrays(row, names=["ids", "vectors"])

        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * scale).reshape(-1, dims)
            if whole.size and np.abs(whole).max() >= LARGEST:
                raise ArithmeticError("a component is too large for 64-bit squared distances")
            for i in range(0, len(whole), BLOCK_ROWS):
                ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False)[i:i + BLOCK_ROWS])
                data.append(whole[i:i + BLOCK_ROWS].astype(np.int64))
                if sum(map(len, ids)) >= BLOCK_ROWS:
                    yield block()
        if ids:
            yield block()

    return run


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; ties to the smaller number."""
    clusters, dims = centroids.shape
    owner = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, owner, axis=0)
    # Padding at both ends of every list is farther away than anything else.
    values = np.concatenate((np.full((1, dims), -FAR), lists, np.full((1, dims), FAR)))
    owner = np.concatenate((np.zeros((1, dims), owner.dtype), owner, np.zeros((1, dims), owner.dtype)))
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    chosen = np.full(len(vectors), clusters)
    right = 1 + np.stack([np.searchsorted(lists[:, d], vectors[:, d]) for d in range(dims)], axis=1)
    left, column = right - 1, np.arange(dims)
    met = np.zeros((len(vectors), clusters), bool)
    walking = np.arange(len(vectors))
    largest = max((int(np.abs(m).max()) for m in (vectors, centroids) if m.size), default=0)
    plain = centroids.astype(np.float64)
    squares = (plain * plain).sum(axis=1)
    for _ in range(clusters):
        x = vectors[walking]
        below, above = x - values[left, column], values[right, column] - x
        down = below <= above
        reached = owner[np.where(down, left, right), column]
        fresh = np.zeros((len(walking), clusters), bool)
        fresh[np.arange(len(walking))[:, None], reached] = True
        fresh &= ~met[walking]
        met[walking] |= fresh
        distances = np.full(fresh.shape, np.iinfo(np.int64).max)
        if np.count_nonzero(fresh) > DENSE * fresh.size and 4 * dims * largest**2 < EXACT:
            rows = x.astype(np.float64)
            every = (rows * rows).sum(axis=1)[:, None] + squares - 2 * (rows @ plain.T)
            distances[fresh] = every[fresh]
        else:
            at, number = np.nonzero(fresh)
            gaps = x[at] - centroids[number]
            distances[at, number] = np.einsum("ij,ij->i", gaps, gaps)
        least = distances.argmin(axis=1)
        found = distances[np.arange(len(walking)), least]
        closer = (found < best[walking]) | ((found == best[walking]) & (least < chosen[walking]))
        best[walking[closer]], chosen[walking[closer]] = found[closer], least[closer]
        frontier = np.where(down, below, above)
        goes_on = np.einsum("ij,ij->i", frontier, frontier) <= best[walking]
        if not goes_on.any():
            break
        walking = walking[goes_on]
        left = (left - down)[goes_on]
        right = (right + ~down)[goes_on]
    return chosen, best


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, clusters, distances) of one tile after another."""
    for batch in batches:
        for ids, data in zip(batch.column("ids"), batch.column("vectors"), strict=True):
            numbers = np.frombuffer(ids.as_buffer(), np.int64)
            vectors = np.frombuffer(data.as_buffer(), np.int64).reshape(len(numbers), -1)
            for i in range(0, len(numbers), TILE_ROWS):
                tile = vectors[i:i + TILE_ROWS]
                yield numbers[i:i + TILE_ROWS], tile, *nearest(tile, centroids)


def _sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, vectors, cluster, _ in _assigned(batches, centroids):
            np.add.at(sums, cluster, vectors)
            counts += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(counts)
        data = [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(data, names=["cluster", "n", "sums"])

    return run


def _places(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _assigned(batches, shared.value):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of each cluster's vectors; empty clusters stay."""
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)
    parts = blocks.mapInArrow(_sums(shared), "cluster int, n long, sums array<long>")
    means = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(centroids.shape[1])]).alias("sums"))
    out = centroids.copy()
    for row in means.collect():
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return out


def clustered(embeddings: DataFrame, clusters: int = 40, rounds: int = 5, seed: str = "2", dims: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Components are floors of ``scale`` times x. The first centroids are the vectors whose
    ``<seed>:<vec_id>`` has the smallest SHA-256 (equal ids: the smaller vector first).
    """
    spark = embeddings.sparkSession
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    kept = kept.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector"), dims))
    blocks = write_table(kept.mapInArrow(_blocks(dims, scale), "ids binary, vectors binary"), "centroid-blocks")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(order, "vector").limit(clusters).select("vector").collect()
    centroids = np.array([[math.floor(scale * x) for x in r["vector"]] for r in first], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)
    places = write_table(blocks.mapInArrow(_places(spark.sparkContext.broadcast(centroids)), "vec_id long, cluster int, distance long"), "centroid-places")
    names = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    sizes = {r["cluster"]: r["inertia"] for r in places.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole = sum(sizes.values())
    table = spark.createDataFrame([(i, sizes.get(i, 0), whole, name) for i, name in names], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return places.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
