"""Exact top-k by integer inner product, as tiled matrix products.

Candidates are cut into shards and queries into blocks, each packed into one matrix row. Blocks are dealt to groups and
shards to parts; a task gets one group and one part, so every matrix is shuffled once, to as many tasks as there
are parts or groups. There every block meets every shard in one tile: a matrix product, then the best k of each
query inside the tile. The lists meet in a tree: the tiles of a task, the parts by threes and more, all of them.

Components are floors of 1024 x, so scores are whole numbers. Products run in double precision while
every partial sum stays below 2**53 and is exact; larger numbers use Python integers.

Edge cases: vectors that are null, empty or hold a null or a non-finite component take no part; vectors of
unequal length have no score; ties go to the smaller id; repeated ids are candidates of their own,
but never a query's own id; fewer candidates than k give all; an empty table gives no rows.
A score or component beyond 64 bits raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 2048
BLOCK_ROWS = 1024
GROUP_BLOCKS = 32
PART_SHARDS = 32
EXACT = 2.0**53
PACKED = "dim int, part long, ids binary, vectors binary"
LISTS = "query_id long, vec_id long, score long, part long"


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Runs of vectors of one length as (dim, part, ids, vectors); ``part`` is unique per dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[list, list]] = {}
        made = 0
        first: int | None = None

        def pack(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, data = open_.pop(dim)
            made += 1
            values = [[dim], [first + made], [np.concatenate(ids).tobytes()], [np.concatenate(data).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["dim", "part", "ids", "vectors"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if first is None:
                first = batch.column("task")[0].as_py() << 32
            column = batch.column("vector")
            lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
            flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():]
            starts = np.concatenate(([0], np.cumsum(lengths)))
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                rows_of = np.flatnonzero(lengths == dim)
                matrix = flat[starts[rows_of][:, None] + np.arange(dim)]
                for i in range(0, len(rows_of), rows):
                    mine = open_.setdefault(dim, ([], []))
                    mine[0].append(ids[rows_of[i:i + rows]])
                    mine[1].append(matrix[i:i + rows])
                    if sum(map(len, mine[0])) >= rows:
                        yield pack(dim)
        for dim in list(open_):
            yield pack(dim)

    return vectors.withColumn("task", F.spark_partition_id().cast("long")).mapInArrow(run, PACKED)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best of each row, all that tie with the k-th among them."""
    allowed = ids[None, :] != own[:, None]
    if scores.shape[1] <= k:
        return np.nonzero(allowed)
    low = np.where(allowed, scores, scores.min())
    cut = np.partition(low, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return np.nonzero(allowed & (scores >= cut[:, None]))


def _tile(row: dict, shard_row: dict, k: int) -> list[np.ndarray]:
    """(query, candidate, score) of the best k of each query of a block in a shard."""
    queries = np.frombuffer(row["vectors"], np.int64).reshape(-1, row["dim"])
    shard = np.frombuffer(shard_row["vectors"], np.int64).reshape(-1, row["dim"])
    own, ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(shard_row["ids"], np.int64)
    bound = float(np.abs(queries.astype(float)).max()) * float(np.abs(shard.astype(float)).max()) * row["dim"]
    if bound < EXACT:
        scores = queries.astype(float) @ shard.astype(float).T
    else:
        scores = queries.astype(object) @ shard.astype(object).T
    at, of = _best(scores, ids, own, k)
    return _first_k([own[at], ids[of], np.array([int(x) for x in scores[at, of]], object)], k)


def _first_k(lists: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best rows of each query, ties to the smaller id."""
    query, candidate, score = lists
    order = np.lexsort((candidate, -score, query))
    query = query[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    keep = order[rank < k]
    return [x[keep] for x in lists]


def _meet(k: int):
    """Every block of a group with every shard of a part; of each block only the best k so far are kept."""

    def run(key: tuple, blocks: pa.Table, shards: pa.Table) -> pa.Table:
        found = [[], [], []]
        if blocks.num_rows:
            best: dict[int, list[np.ndarray]] = {}
            rows = blocks.to_pylist()
            for i in range(shards.num_rows):
                shard = shards.slice(i, 1).to_pylist()[0]
                for j, row in enumerate(rows):
                    new = _tile(row, shard, k)
                    best[j] = _first_k([np.concatenate(x) for x in zip(best[j], new, strict=True)], k) if j in best else new
            for lists in best.values():
                for column, values in zip(found, lists, strict=True):
                    column += values.tolist()
        part = [key[2].as_py()] * len(found[0])
        return pa.table([pa.array(x, pa.int64()) for x in (*found, part)], names=["query_id", "vec_id", "score", "part"])

    return run


def _merged(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, fan_in: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) for (vec_id, vector array<long>) tables.

    Both sides are packed. A block of queries goes to all parts of the candidates, a shard to all groups of blocks: with N
    vectors and a hundredth of them as queries that is one copy of each shard per ``GROUP_BLOCKS`` x ``BLOCK_ROWS`` queries
    and one of each query per ``PART_SHARDS`` x ``SHARD_ROWS`` candidates (fewer where there are more cores than parts).
    """
    spark = queries.sparkSession
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks_of = max(1, -(-queries.count() // BLOCK_ROWS))
    shards_of = max(1, -(-candidates.count() // SHARD_ROWS))
    groups = -(-blocks_of // GROUP_BLOCKS)
    parts = max(-(-shards_of // PART_SHARDS), min(cores, shards_of))

    def dealt(packed: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other)
        return packed.select("dim", F.pmod(F.xxhash64("part"), F.lit(count)).cast("int").alias(own), every, "ids", "vectors")

    blocks = dealt(_packed(queries.repartition(blocks_of), BLOCK_ROWS), "group", groups, "side", parts)
    shards = dealt(_packed(candidates, SHARD_ROWS), "side", parts, "group", groups)
    left = blocks.select("dim", "group", "side", "ids", "vectors").groupBy("dim", "group", "side")
    right = shards.select(*[F.col(c).alias(f"c_{c}") if c in ("dim", "group", "side") else c for c in ("dim", "group", "side", "ids", "vectors")])
    run = _meet(k)

    def meet(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        return run(key, mine, theirs.rename_columns(["dim", "group", "side", "ids", "vectors"]))

    lists = left.cogroup(right.groupBy("c_dim", "c_group", "c_side")).applyInArrow(meet, LISTS)
    merged = _merged(lists.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(fan_in))), k, "query_id", "part")
    return _merged(merged.drop("rank"), k, "query_id").select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, vector): floors of ``scale`` times each component; unusable vectors are left out."""
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return embeddings.filter(usable).select(F.col("vec_id").cast("long"), whole.alias("vector"))
