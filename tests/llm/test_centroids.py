import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixsieve.llm import centroids


def plain(rows, clusters, rounds, seed="2", scale=256):
    """The same clusters one vector at a time, in Python integers."""
    kept = [(v, [math.floor(scale * c) for c in x]) for v, x in rows]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centers = [x for _, x in first]

    def place(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        at = [place(x)[1] for _, x in kept]
        for i in range(len(centers)):
            mine = [x for (_, x), a in zip(kept, at, strict=True) if a == i]
            if mine:
                centers[i] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = [(v, *place(x)) for v, x in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((v, i, d, sum(e for _, e, j in out if j == i), sum(e for _, e, _ in out), names[i]) for v, d, i in out)


def rows_of(df):
    return sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize(("dims", "spread"), [(1, 3), (2, 2), (5, 40), (64, 500)])
def test_nearest_by_brute_force(dims, spread):
    rng = np.random.default_rng(dims)
    vectors, centers = rng.integers(-spread, spread + 1, (700, dims)), rng.integers(-spread, spread + 1, (23, dims))
    centers[7] = centers[3]
    distances = ((vectors[:, None, :] - centers[None]) ** 2).sum(axis=2)
    number, best = centroids.nearest(vectors, centers)
    assert (number == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()


@pytest.mark.parametrize("dense", [0.0, 2.0])
@pytest.mark.parametrize("spread", [30, 1 << 27])
def test_both_ways_to_work_out_distances_agree(monkeypatch, dense, spread):
    """Whole products are only taken while every sum is exact in double precision."""
    monkeypatch.setattr(centroids, "DENSE", dense)
    rng = np.random.default_rng(spread)
    vectors, centers = rng.integers(-spread, spread + 1, (300, 16)), rng.integers(-spread, spread + 1, (12, 16))
    distances = ((vectors[:, None, :] - centers[None]) ** 2).sum(axis=2)
    number, best = centroids.nearest(vectors, centers)
    assert (number == distances.argmin(axis=1)).all() and (best == distances.min(axis=1)).all()


def test_walk_stops_early(monkeypatch):
    """Far clusters are never met: gaps are computed for few of the centroids."""
    centers = np.arange(200)[:, None] * 1000 + np.zeros((1, 4), np.int64)
    vectors = centers[::7] + 3
    computed = []
    einsum = np.einsum
    monkeypatch.setattr(centroids.np, "einsum", lambda rule, a, b: computed.append(len(a)) or einsum(rule, a, b))
    number, best = centroids.nearest(vectors, centers)
    assert (number == np.arange(200)[::7]).all() and (best == 36).all()
    assert sum(computed) <= 4 * len(vectors)


def test_clusters_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 16)
    monkeypatch.setattr(centroids, "TILE_ROWS", 5)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * 3]) for i in range(150)]
    rows += [(500 + i, rows[0][1]) for i in range(60)] + [(0, rows[1][1])]
    odd = [(9, None), (10, []), (11, [1.0] * 5), (12, [math.nan] * 6), (13, [math.inf] + [0.0] * 5), (14, [None] + [0.0] * 5), (None, [1.0] * 6)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("x"), "distance": F.lit(-1), "ids": F.lit(0)})
    got = rows_of(centroids.clustered(table.repartition(5), clusters=9, rounds=4, dims=6))
    assert got == plain(rows, 9, 4)


def test_fewer_vectors_than_clusters_and_none(spark):
    few = [(1, [0.5, 1.0]), (2, [-0.5, 2.0]), (2, [-0.5, 2.0])]
    table = spark.createDataFrame(few, "vec_id long, embedding array<double>")
    got = rows_of(centroids.clustered(table, clusters=9, dims=2))
    assert got == plain(few, 9, 5) and got[-1][-2] == 0
    assert centroids.clustered(table.limit(0), dims=2).count() == 0
    assert centroids.clustered(table, dims=64).count() == 0


def test_components_beyond_the_range_are_an_error(spark):
    table = spark.createDataFrame([(1, [3e30, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(table, dims=2).count()
