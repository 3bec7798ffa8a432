import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pixsieve.operators import dedup as dd
from pixsieve.operators import similarity as sim


def greedy(vectors, quality, threshold):
    """The rule, one row after another."""
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    sims = unit @ unit.T
    kept, pairs = [], []
    for i in range(len(unit)):
        match = next((k for k in kept if sims[i, k] >= threshold), None)
        if match is None:
            kept.append(i)
        elif quality[i] > quality[match]:
            kept.remove(match)
            kept.append(i)
            pairs.append((match, i))
        else:
            pairs.append((i, match))
    return sorted(pairs)


def table(spark, vectors, quality):
    rows = [(i, [float(x) for x in v], float(q)) for i, (v, q) in enumerate(zip(vectors, quality))]
    return spark.createDataFrame(rows, "row_idx bigint, vector array<double>, q double")


def found(spark, vectors, quality, threshold, partitions=3, **options):
    df = table(spark, vectors, quality).repartition(partitions)
    out = dd.find_duplicates(df, threshold, vector="vector", quality=F.col("q"), **options)
    return sorted((r.duplicate_idx, r.kept_idx) for r in out.collect())


def clustered(seed, rows=240, spread=0.25, hot=0.34):
    """Noisy clusters; one holds a third of the rows, and every fifth row is an exact copy."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    which = rng.choice(12, rows, p=[hot] + [(1 - hot) / 11] * 11)
    vectors = centres[which] + rng.normal(size=(rows, 16)) * spread
    vectors[::5] = centres[0]
    return vectors, rng.integers(0, 20, rows) / 20


@pytest.mark.parametrize("threshold, options", [
    (0.85, {}),
    (0.85, {"tail_rows": 40, "block": 60, "cell_rows": 60}),
    (0.9, {"tail_rows": 0, "block": 100, "cell_rows": 80}),
])
def test_equals_the_sequential_rule(spark, threshold, options):
    vectors, quality = clustered(seed=int(threshold * 100))
    assert found(spark, vectors, quality, threshold, **options) == greedy(vectors, quality, threshold)


def test_every_row_better_than_the_one_before(spark):
    vectors, _ = clustered(seed=1, rows=120)
    quality = np.arange(120) / 120
    assert found(spark, vectors, quality, 0.85, tail_rows=30) == greedy(vectors, quality, 0.85)


def test_hot_groups_are_salted(spark, monkeypatch):
    """A third of the rows are copies of one vector, with other vectors near it."""
    monkeypatch.setattr(dd, "HOT_ROWS", 15)
    vectors, quality = clustered(seed=6, rows=150)
    vectors[::3] = vectors[0]
    units = dd._prepare(
        table(spark, vectors, quality).select(F.col("row_idx").alias("idx"), "q", "vector"),
        "vector", 0.85, 100, 100,
    )[1]
    assert units.agg(F.max("salt")).first()[0] >= 3
    assert found(spark, vectors, quality, 0.85, tail_rows=25) == greedy(vectors, quality, 0.85)


def test_nan_and_zero(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(90, 4))
    vectors[::3] = vectors[0]
    vectors[[5, 8]] = 0
    quality = rng.integers(0, 5, 90) / 5
    quality[[0, 30, 44]] = np.nan
    assert found(spark, vectors, quality, 0.95) == greedy(vectors, quality, 0.95)
    vectors[7] = np.nan
    pairs = found(spark, vectors, quality, 0.95)
    assert pairs == greedy(vectors, quality, 0.95)
    assert not any(7 in p for p in pairs)


def test_zero_vectors_match_at_a_threshold_of_zero(spark):
    vectors = np.array([[1.0, 0.0], [0.0, 0.0], [-1.0, 0.0], [0.0, 0.0]])
    quality = np.array([1.0, 2.0, 3.0, 0.5])
    assert found(spark, vectors, quality, 0.0) == greedy(vectors, quality, 0.0)


def test_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(dd, "CHUNK_ROWS", 17)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(150, 8))
    vectors[::3], vectors[1::7] = vectors[0], vectors[1]
    quality = rng.integers(0, 30, 150) / 10
    assert found(spark, vectors, quality, 0.95) == greedy(vectors, quality, 0.95)


def test_threshold_one_matches_exact_copies_only(spark):
    vectors = np.array([[0.1, 0.2], [0.1, 0.2], [0.1, 0.20001], [0.1, 0.2]])
    assert found(spark, vectors, [3, 2, 1, 4], 1.0) == [(0, 3), (1, 0)]
    assert found(spark, vectors, [3, 2, 1, 4], 1.5) == []


def test_ties_keep_the_first_and_a_winner_moves_to_the_end(spark):
    # 0 and 1 are both kept; 2 is near both but only replaces its first match, so 1 stays.
    vectors = np.array([[1.0, 0.0], [0.6, 0.8], [0.85, 0.5], [0.85, 0.5]])
    assert found(spark, vectors, [0.1, 0.9, 0.5, 0.5], 0.85) == greedy(vectors, [0.1, 0.9, 0.5, 0.5], 0.85)


def test_no_rows_and_no_duplicates(spark):
    empty = table(spark, [], [])
    out = dd.find_duplicates(empty, vector="vector", quality=F.col("q"))
    assert out.count() == 0
    assert dd.dedup_metrics(empty, out).first() == (0, 0, 0)
    assert found(spark, np.eye(4), [1, 2, 3, 4], 0.95) == []


def test_does_not_depend_on_partitions(spark):
    vectors, quality = clustered(seed=9, rows=120)
    results = [found(spark, vectors, quality, 0.85, partitions=n) for n in (1, 8)]
    assert results[0] == results[1]


def test_report_write_back_survivors_and_metrics(spark, make_samples):
    vectors = {0: [1.0, 0.0], 1: [0.0, 1.0], 2: [1.0, 0.01], 3: [0.0, 2.0]}
    df = make_samples(*[
        {"sample_id": f"s{i}", "status": "accepted", "clip_score": c, "image_embedding": v}
        for (i, v), c in zip(vectors.items(), (0.1, 0.9, 0.5, 0.5))
    ], extra="image_embedding array<double>")
    kept, out = dd.SemanticDedup(threshold=0.95).process(df)
    pairs = dd.duplicate_pairs(df, out).collect()
    assert {(p.duplicate_sample_id, p.kept_sample_id) for p in pairs} == {("s0", "s2"), ("s3", "s1")}
    best = next(p for p in pairs if p.kept_sample_id == "s2")
    assert best.similarity == pytest.approx(0.99995, abs=1e-5)
    assert best.kept_quality - best.duplicate_quality == pytest.approx(0.2)
    marked = {r.sample_id: (r.status, r.reject_reason) for r in dd.mark_duplicates(df, out).collect()}
    assert marked == {
        "s0": ("rejected", "semantic_duplicate"), "s1": ("accepted", None),
        "s2": ("accepted", None), "s3": ("rejected", "semantic_duplicate"),
    }
    assert {r.sample_id for r in kept.collect()} == {"s1", "s2"}
    assert dd.dedup_metrics(df, out).first() == (4, 2, 2)


@pytest.mark.parametrize("threshold", [0.8, 0.95])
def test_pivots_and_tiles_lose_no_pair(spark, threshold):
    vectors, _ = clustered(seed=3, rows=300, spread=0.15)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = unit @ unit.T
    rows = table(spark, vectors, np.zeros(300)).select(F.col("row_idx").alias("gid"), "vector")
    units = sim.unit_vectors(rows, "vector", threshold)
    pivots = sim.choose_pivots(units, "gid", 300, threshold, cell_rows=20)
    assert len(pivots) > 5
    cells = sim.assign_cells(units, pivots, threshold).persist()
    copies = cells.agg(F.avg(F.size("outer"))).first()[0]
    assert copies < len(pivots) - 1

    pairs = sim.similar_pairs(cells, cells, threshold, block=16).collect()
    assert len(pairs) == len({(p.gid, p.other) for p in pairs})
    expected = {(i, j) for i, j in zip(*np.nonzero(sims >= threshold)) if i != j}
    assert {(p.gid, p.other) for p in pairs if p.gid != p.other} == expected

    links = sim.neighbour_links(cells, threshold, block=16)
    nearest = links.groupBy("gid").agg(F.min("nbr").alias("nbr")).collect()
    smallest = {}
    for i, j in expected:
        smallest[i] = min(j, smallest.get(i, j))
    assert {r.gid: r.nbr for r in nearest} == smallest
    cells.unpersist()


def test_vectors_of_different_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "gid bigint, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        sim.unit_vectors(df, "vector", 0.9).collect()


def rounds_and_edges(spark, monkeypatch, vectors, quality, tail_rows):
    """The result, how many rounds it took and how many edges were written."""
    counts = {"placed": 0, "edges": 0}
    write, grow = dd.write_table, dd._Growing.add

    def counted(df, label):
        counts["placed"] += label == "placed"
        return write(df, label)

    def added(self, df):
        part = grow(self, df)
        if "similarity" in part.columns and "gid" in part.columns:
            counts["edges"] += part.count()
        return part

    monkeypatch.setattr(dd, "write_table", counted)
    monkeypatch.setattr(dd._Growing, "add", added)
    return found(spark, vectors, quality, 0.85, tail_rows=tail_rows), counts["placed"], counts["edges"]


def test_rising_quality_in_a_dense_cluster_takes_few_rounds(spark, monkeypatch):
    vectors = np.random.default_rng(3).normal(size=(60, 8)) * 0.02 + 1
    quality = np.arange(60) / 60
    pairs, rounds, edges = rounds_and_edges(spark, monkeypatch, vectors, quality, 25)
    assert pairs == greedy(vectors, quality, 0.85) == [(i, i + 1) for i in range(59)]
    assert rounds <= 60 / 25 + 1
    # Each round compares the rows that are left with the one row that is alive.
    assert edges <= 60 * 2 * (rounds + 1)


def test_small_components_are_settled_in_one_round(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = np.repeat(rng.normal(size=(40, 32)), 5, axis=0) + rng.normal(size=(200, 32)) * 0.05
    quality = rng.random(200)
    order = rng.permutation(200)
    pairs, rounds, _ = rounds_and_edges(spark, monkeypatch, vectors[order], quality, 16)
    assert pairs == greedy(vectors[order], quality, 0.85) and rounds == 1


def test_links_connect_what_all_pairs_connect(spark):
    vectors, _ = clustered(seed=11, rows=150, spread=0.5)
    units = sim.unit_vectors(table(spark, vectors, np.zeros(150)).select(F.col("row_idx").alias("gid"), "vector"), "vector", 0.8)
    cells = dd.write_table(sim.assign_cells(units, sim.choose_pivots(units, "gid", 150, 0.8, 40), 0.8), "cells")

    def roots(pairs):
        root = list(range(150))
        for _ in range(150):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    every = [(r.gid, r.other) for r in sim.similar_pairs(cells, cells, 0.8, block=30).collect()]
    links = [(r.gid, r.nbr) for r in sim.neighbour_links(cells, 0.8, block=30).collect()]
    assert set(links) <= set(every) and roots(links) == roots(every)
    least = {}
    for a, b in every:
        if a != b:
            least[a] = min(b, least.get(a, b))
    got = {}
    for a, b in links:
        got[a] = min(b, got.get(a, b))
    assert got == least


@pytest.mark.parametrize("order", ["rising", "falling", "random", "ties"])
def test_large_complete_components_need_no_rounds(spark, monkeypatch, order):
    """One cluster in which all rows are similar, with copies, and a second one of the same kind."""
    rng = np.random.default_rng(12)
    centres = np.eye(8)[:2]
    vectors = np.repeat(centres, 70, axis=0) + rng.normal(size=(140, 8)) * 0.02
    vectors[::9] = vectors[0]
    vectors = vectors[rng.permutation(140)]
    quality = {
        "rising": np.arange(140) / 140, "falling": -np.arange(140) / 140, "random": rng.random(140), "ties": rng.integers(0, 4, 140) / 4,
    }[order]
    if order == "random":
        quality[[0, 1, 50]] = np.nan
    monkeypatch.setattr(dd, "CHUNK_ROWS", 31)
    pairs, rounds, edges = rounds_and_edges(spark, monkeypatch, vectors, quality, 10)
    assert pairs == greedy(vectors, quality, 0.85) and rounds == 0 and edges == 0


def test_rounds_on_rising_quality_do_not_grow_with_the_rows(spark, monkeypatch):
    """All documents in one cluster with rising quality, at a tail far smaller than the cluster."""
    from pixsieve import fixtures as fx
    from conftest import SF_DIR

    ids = sorted((r.doc_id, r.n_chars) for r in fx.table(spark, SF_DIR, "documents").select("doc_id", "n_chars").collect())
    vectors = np.array([[1.0, *[(i * k % 89 + n % 7) / 1000 for k in (3, 5, 11)]] for i, n in ids])
    pairs, rounds, _ = rounds_and_edges(spark, monkeypatch, vectors, np.arange(len(ids)), 4)
    assert rounds <= np.log2(len(ids)) and len(pairs) == len(ids) - 1
    assert pairs == greedy(vectors, np.arange(len(ids)), 0.85)


def test_a_component_with_one_pair_missing_goes_through_rounds(spark, monkeypatch):
    rng = np.random.default_rng(14)
    vectors = rng.normal(size=(40, 6)) * 0.05 + 1
    vectors[5], vectors[9] = [1, 1, 1, 1, 1, 2.6], [1, 1, 1, 1, 1, -0.4]
    quality = rng.random(40)
    pairs, rounds, _ = rounds_and_edges(spark, monkeypatch, vectors, quality, 12)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    assert (unit @ unit.T >= 0.85).sum() < 40 * 40
    assert pairs == greedy(vectors, quality, 0.85) and rounds >= 1


def test_kept_rows_near_a_replay_are_columns():
    """200,000 kept rows near 100 groups take a few bytes a column, not an object each, and dead ones are passed over."""
    rng = np.random.default_rng(12)
    groups = np.arange(100) * 3 + 1_000_000
    near = pa.table({
        "gid": np.repeat(groups, 2000), "k": np.tile(rng.permutation(2000), 100), "q_k": np.full(200_000, 0.5),
        "similarity": np.full(200_000, 0.97), "dead": pa.array(np.full(200_000, 999_000), mask=np.tile(np.arange(2000) % 2 == 0, 100)),
    })
    alive = {k for k, d in zip(near["k"].to_pylist()[:2000], near["dead"].to_pylist()[:2000]) if d is None}
    units = sim._binary(np.eye(100))
    rows = pa.table({
        "task": np.zeros(100, np.int64), "idx": groups, "q": np.where(np.arange(100) == 40, 0.9, 0.1), "gid": groups,
        "salt": pa.array([0] * 100, pa.int32()), "comp": np.zeros(100, np.int64), "pos": np.arange(100), "unit": units,
    })
    tracemalloc.start()
    try:
        out = dd._replay_task(0.95)(rows, near).to_pylist()
        assert tracemalloc.get_traced_memory()[1] < 30_000_000
    finally:
        tracemalloc.stop()
    first, second = sorted(alive)[:2]
    # Row 40 replaces the first kept row that is alive, so that later rows meet the next one.
    assert [(r["k"], r["fate"]) for r in out] == [(first, "loses")] * 40 + [(first, "wins")] + [(second, "loses")] * 59


def test_tables_of_a_round_are_no_broadcasts(spark, monkeypatch):
    plans, write = {}, dd.write_table

    def watched(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(dd, "write_table", watched)
    vectors, quality = clustered(4)
    assert found(spark, vectors, quality, 0.8, tail_rows=0) == greedy(vectors, quality, 0.8)
    tables = {"groups", "decided", "kept"}
    assert tables <= set(plans)
    assert not [label for label in tables for plan in plans[label] if "BroadcastHashJoin" in plan]
