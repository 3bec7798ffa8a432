import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pixsieve.llm import ngram_join as nj
from pixsieve.llm.chunks import text_chunks


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


@pytest.mark.parametrize("limit, want", [(1, [["a"], ["", ""], ["日本"], ["bc"], ["d"]]), (3, [["a", "", "", "日本"], ["bc", "d"]]), (100, [["a", "", "", "日本", "bc", "d"]])])
def test_slices_end_before_the_limit(want, limit):
    found = [(rows.column(0).to_pylist(), texts) for rows, texts in text_chunks([batch_of([]), batch_of(["a", None, "", "日本", "bc", "d"])], "text", limit)]
    flat = [t for _, texts in found for t in texts]
    assert flat == ["a", "", "", "日本", "bc", "d"] and [i for ids, _ in found for i in ids] == list(range(6))
    if limit > 1:
        assert [texts for _, texts in found] == want
    assert all(sum(map(len, texts)) <= limit or len(texts) == 1 for _, texts in found)


def test_texts_of_a_batch_are_not_all_held_at_once():
    batch = batch_of(["é" * 100_000] * 200)
    tracemalloc.start()
    try:
        assert sum(len(t) for _, texts in text_chunks([batch], "text", 300_000) for t in texts) == 20_000_000
        assert tracemalloc.get_traced_memory()[1] < 4_000_000
    finally:
        tracemalloc.stop()


def test_overlaps_are_counted_where_the_segments_lie():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40_000, 20_000)).astype(np.uint64) for _ in range(40)]
    sides = [sets, [None, *sets[:-1]]]
    columns = [pa.array([None if s is None else s.tobytes() for s in side], pa.binary()) for side in sides]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(range(40), pa.int64()), *columns], names=["a", "b", "a_grams", "b_grams"])
    batch = batch.slice(0, 39)
    tracemalloc.start()
    try:
        (out,) = nj._count_overlaps(np.uint64)([batch])
        assert tracemalloc.get_traced_memory()[1] < 6_000_000
    finally:
        tracemalloc.stop()
    want = [0] + [len(np.intersect1d(x, y)) for x, y in zip(sets[1:39], sets, strict=False)]
    assert out.column(2).to_pylist() == want and out.column(4).to_pylist() == [0, *[len(s) for s in sets[:38]]]
    empty = nj._count_overlaps(np.uint16)([batch.slice(0, 0)])
    assert [b.num_rows for b in empty] == [0]


def test_cuts_of_the_count_table_need_little_room():
    """Equal mass as by a sort of all buckets, without tables of 64-bit places of the whole."""
    def by_sorting(counts, fragments):
        order = np.argsort(counts, kind="stable")
        mass = np.cumsum(counts[order])
        bucket = order[np.minimum(np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments), len(order) - 1)]
        return ((counts[bucket].astype(np.int64) << 40) | (bucket.astype(np.int64) << (40 - nj.COUNT_BITS))).tolist()

    rng = np.random.default_rng(8)
    for counts in (np.zeros(1000), rng.integers(0, 3, 1000), rng.zipf(1.4, 200_000).clip(0, nj.COUNT_MOST), np.full(70_000, 7), np.arange(5) == 3):
        counts = counts.astype(np.uint32)
        assert nj._cuts(counts, 8).tolist() == by_sorting(counts, 8)
    whole = rng.integers(0, 50, 1 << nj.COUNT_BITS, np.uint32)
    tracemalloc.start()
    try:
        cuts = nj._cuts(whole, 8)
        assert tracemalloc.get_traced_memory()[1] < 60_000_000
    finally:
        tracemalloc.stop()
    assert cuts.tolist() == by_sorting(whole, 8)
