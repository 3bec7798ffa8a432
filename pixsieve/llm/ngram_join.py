"""Jaccard join of word n-gram sets, vertically partitioned; near-duplicate classes.

Documents with equal sets are one class from the start; the join runs between distinct sets.

1. One scan hashes every text's n-grams, writes (doc_id, set size, set hash) and adds up a table of
   hashed n-gram counts of fixed size. Count, then hash is the global order of n-grams, rare first.
2. A second scan emits, per distinct set, the rare n-grams at its head: two sets that are similar
   enough share one of those. N-grams with a single set are dropped.
3. The global order is cut into fragments of equal mass. Sets that share a head n-gram are cut at the
   same places, and the partial overlaps of a candidate pair are counted fragment by fragment, in
   separate tasks, and summed per pair. The first fragment, the rarest n-grams, comes first and alone, cut down to 16 bits
   an n-gram: such counts are never too low, and what they leave possible rules most pairs out. Whole segments of all
   fragments are cut for the rest only. Their sum decides exactly.
4. Pairs inside a group are not listed. Each shared n-gram first pairs its sets with one pivot, the set
   that has the fewest n-grams of its own before it;
   links are contracted to components; sets that are already connected need no comparison. What is left
   is compared in later rounds with all sets of a small group, or with more and more pivots of a large
   one, until every pair that could link two components has been compared.

Components are found by ``operators.components``, which this module depends on.

N-grams and sets are told apart by 64-bit hashes. Everything the driver holds has a fixed size: the count
table, the cuts and a bitmap that spares most other documents the third scan.

Edge cases: a text without words, null or empty has an empty set and links with nothing; one with fewer
words than ``size`` has its word sequence as its one n-gram; a null ``doc_id`` takes part in
nothing and is its own class (null); repeated rows are copies, and rows of one ``doc_id`` with different texts
are classed by each text, under the same id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixsieve.llm.chunks import text_chunks
from pixsieve.models import cached
from pixsieve.operators.components import components
from pixsieve.session import write_table

COUNT_BITS = 22
COUNT_CHUNK = 1 << 16
COUNT_MOST = (1 << 23) - 1
BITMAP_BITS = 24
SMALL_GROUP = 32
FRAGMENTS = 8
SEEN_SETS = 200_000
CHUNK_CHARS = 300_000
PENDING_GRAMS = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cached
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@cached
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, document of every word): A-Z lowered, cut at blanks and tab to return."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([b"", *encoded, b""]), np.uint8).copy()
    data[(data >= 65) & (data <= 90)] |= 32
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = change[::2], change[1::2]
    up, down = _powers(1 << max(12, (len(data) - 1).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    begins = np.cumsum([1, *[len(e) + 1 for e in encoded]])
    return hashes, np.searchsorted(begins, starts, side="right") - 1


def ngram_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of all texts in turn, offsets of the texts)."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)))
    weights = np.array(_MULTIPLIERS[:size], np.uint64)
    grams = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        grams += words[k:k + len(grams)] * weights[k]
    grams = _mix(grams)
    inside = owner[: len(grams)] == owner[size - 1:] if len(grams) else np.zeros(0, bool)
    grams, gram_owner = grams[inside], owner[: len(inside)][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [_mix((words[first[i]:first[i + 1]] * weights[: counts[i]]).sum(keepdims=True, dtype=np.uint64) + np.uint64(counts[i]))[0] for i in short]
        at = np.searchsorted(gram_owner, short)
        grams, gram_owner = np.insert(grams, at, whole), np.insert(gram_owner, at, short)
    edges = np.searchsorted(gram_owner, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        grams[a:b].sort()
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (gram_owner[1:] != gram_owner[:-1])
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return grams[fresh], kept[edges]


def set_hashes(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One signed 64-bit hash per set; 0 for empty ones."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_mix(grams * np.uint64(_BASE)), dtype=np.uint64)))
    sizes = np.diff(edges).astype(np.uint64)
    return np.where(sizes > 0, _mix(sums[edges[1:]] - sums[edges[:-1]] + sizes * np.uint64(_MULTIPLIERS[0])), np.uint64(0)).view(np.int64)


def _add_counts(counts: np.ndarray, pending: list[np.ndarray]) -> None:
    if pending:
        bucket, n = np.unique(np.concatenate(pending), return_counts=True)
        counts[bucket] += n.astype(np.uint32)
        pending.clear()


def _scan_sets(size: int):
    fields = "doc_id long, n int, sid long, chunk int, counts binary"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        pending: list[np.ndarray] = []
        for rows, texts in text_chunks(batches, "text", CHUNK_CHARS):
            grams, edges = ngram_sets(texts, size)
            pending.append((grams >> np.uint64(64 - COUNT_BITS)).astype(np.int32))
            if sum(map(len, pending)) > PENDING_GRAMS:
                _add_counts(counts, pending)
            n = len(texts)
            data = [rows.column("doc_id"), pa.array(np.diff(edges).astype(np.int32)), pa.array(set_hashes(grams, edges)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(data, names=names)
        _add_counts(counts, pending)
        for i in range(0, len(counts), COUNT_CHUNK):
            part = counts[i:i + COUNT_CHUNK]
            if part.any():
                data = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([i // COUNT_CHUNK], pa.int32()), pa.array([zlib.compress(part.astype("<u4").tobytes(), 1)])]
                yield pa.RecordBatch.from_arrays(data, names=names)

    return run, fields


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(zlib.decompress(data.as_buffer()), "<u4")
            sums.setdefault(chunk, np.zeros(COUNT_CHUNK, np.int64))[:] += part
    for chunk, total in sums.items():
        clipped = np.minimum(total, COUNT_MOST).astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([clipped])], names=["chunk", "counts"])


def _order_keys(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Place in the global order: count, then hash. Equal keys of different n-grams do no harm."""
    high = counts[(grams >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
    return ((high << np.uint64(40)) | (grams >> np.uint64(24))).view(np.int64)


def _cuts(counts: np.ndarray, fragments: int) -> np.ndarray:
    """Keys that cut the global order into ``fragments`` of equal mass."""
    values, numbers = np.unique(counts, return_counts=True)
    mass = np.cumsum(values.astype(np.int64) * numbers)
    cuts = []
    for target in (mass[-1] * np.arange(1, fragments) / fragments).tolist():
        at = int(np.searchsorted(mass, target))
        value, number = int(values[at]), int(numbers[at])
        nth = -(-(target - (int(mass[at]) - value * number)) // max(1, value))
        cuts.append(value << 40 | _nth_bucket(counts, value, min(max(1, int(nth)), number)) << (40 - COUNT_BITS))
    return np.array(cuts, np.int64)


def _nth_bucket(counts: np.ndarray, value: int, nth: int) -> int:
    """The ``nth`` bucket, from 1, with this count; chunk by chunk, since the driver has little room."""
    for start in range(0, len(counts), COUNT_CHUNK):
        found = np.flatnonzero(counts[start:start + COUNT_CHUNK] == value)
        if nth <= len(found):
            return start + int(found[nth - 1])
        nth -= len(found)
    raise ValueError("no such bucket")


def _heads(size: int, percent: int, shared):
    """Per distinct set of a task, its n-grams that come first in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for _, texts in text_chunks(batches, "text", CHUNK_CHARS):
            grams, edges = ngram_sets(texts, size)
            sids = set_hashes(grams, edges).tolist()
            keys, at = _order_keys(grams, counts), edges.tolist()
            heads, sizes, owners, places = [], [], [], []
            for i, sid in enumerate(sids):
                a, b = at[i], at[i + 1]
                if a == b or sid in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(sid)
                n = b - a
                keep = n + (-percent * n // 100) + 1
                own = np.sort(keys[a:b])[:keep]
                heads.append(own)
                places.append(np.arange(keep, dtype=np.int32))
                sizes.append(n)
                owners.append(sid)
            lengths = [len(h) for h in heads]
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            place = np.concatenate(places) if places else np.zeros(0, np.int32)
            data = [flat, np.repeat(np.array(owners, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths), place]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in data], names=["token", "sid", "n", "place"])

    return run, "token long, sid long, n int, place int"


def _segments(size: int, first: int, last: int, kind: type, shared_counts, shared):
    """(sid, fragment, n-grams) of the documents that the bitmap lets pass, for a range of fragments.

    N-grams are cut down to the width of ``kind``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, (bitmap, cuts) = shared_counts.value, shared.value
        for rows, texts in text_chunks(batches, "text", CHUNK_CHARS):
            bit = rows.column("bit").to_numpy(zero_copy_only=False).astype(np.int64)
            wanted = (bitmap[bit >> 5] >> (bit & 31)) & 1
            chosen = [t for t, w in zip(texts, wanted.tolist(), strict=True) if w]
            if not chosen:
                continue
            grams, edges = ngram_sets(chosen, size)
            sids = set_hashes(grams, edges).tolist()
            fragment = np.searchsorted(cuts, _order_keys(grams, counts), side="right")
            out = ([], [], [])
            for sid, a, b in zip(sids, edges.tolist(), edges[1:].tolist(), strict=False):
                order = np.argsort(fragment[a:b], kind="stable")
                own, places = grams[a:b][order], fragment[a:b][order]
                ends = np.searchsorted(places, np.arange(first, last + 1)).tolist()
                for k, start, end in zip(range(first, last), ends, ends[1:], strict=False):
                    if end > start:
                        out[0].append(sid)
                        out[1].append(k)
                        out[2].append(own[start:end].astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["sid", "fragment", "grams"])

    return run, "sid long, fragment int, grams binary"


def _views(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The numbers of every value of a binary column, without a copy; null: none."""
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].tolist() if len(column) else [0]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [every[a:b].view(kind) for a, b in zip(at, at[1:], strict=False)]


def _count_overlaps(kind: type):
    """Partial overlap of the two segments of a pair, and their lengths; a missing one is empty.

    Of n-grams that are cut down, equal ones on one side count too, so the overlap is never too low.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_views(batch.column(c), kind) for c in ("a_grams", "b_grams")]
            common = []
            for x, y in zip(*sides, strict=True):
                both = np.concatenate((x, y))
                both.sort()
                common.append(int(np.count_nonzero(both[1:] == both[:-1])))
            counts = [pa.array(v, pa.int32()) for v in (common, list(map(len, sides[0])), list(map(len, sides[1])))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *counts], names=["a", "b", "common", "a_part", "b_part"])

    return run


def _common(x: str, y: str, percent: int) -> Column:
    """How many n-grams similar sets of these sizes have in common at least."""
    return F.ceil((F.col(x) + F.col(y)) * percent / F.lit(100 + percent))


def _can_link(x: str, y: str, x_place: str, y_place: str, percent: int) -> Column:
    """Sizes that allow the similarity, and an n-gram that can be the first one the sets share:
    all they must have in common still fits from there to the end of each."""
    common = _common(x, y, percent)
    sizes = (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)
    return sizes & (F.col(x_place) + common <= F.col(x)) & (F.col(y_place) + common <= F.col(y))


def _overlaps(pairs: DataFrame, segments: DataFrame, kind: type) -> DataFrame:
    """(a, b, common, a_part, b_part) of pairs and the fragments that ``a`` has.

    Segments of ``a`` go to those of ``b``, which are sent once however many pairs they are in; a ``b`` of very many pairs
    is split by the adaptive skew join.
    """
    mine = segments.select(F.col("sid").alias("a"), "fragment", F.col("grams").alias("a_grams"))
    theirs = segments.select(F.col("sid").alias("b"), "fragment", F.col("grams").alias("b_grams"))
    met = pairs.select("a", "b").join(mine, "a").join(theirs, ["b", "fragment"], "left").select("a", "b", "a_grams", "b_grams")
    return met.mapInArrow(_count_overlaps(kind), "a long, b long, common int, a_part int, b_part int")


def _promising(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """``pairs`` that may still be similar after the first fragment."""
    part = pairs.join(_overlaps(pairs, light, np.uint16), ["a", "b"], "left").fillna(0, ["common", "a_part", "b_part"])
    most = F.col("common") + F.least(F.col("a_n") - F.col("a_part"), F.col("b_n") - F.col("b_part"))
    return part.filter(most >= _common("a_n", "b_n", percent)).select("a", "b", "a_n", "b_n")


def _similar(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that are similar: partial overlaps summed per pair."""
    common = _overlaps(pairs, segments, np.uint64).groupBy("a", "b").agg(F.sum("common").alias("common"))
    summed = pairs.join(common, ["a", "b"])
    union = F.col("a_n") + F.col("b_n") - F.col("common")
    return summed.filter(F.col("common") * 100 >= union * percent).select("a", "b")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each id; of fixed size."""
    bit = F.col("bit")
    words = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)).alias("bit")).groupBy((bit / 32).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit % 32 AS INT))")).alias("bits")
    ).toArrow()
    out = np.zeros((1 << BITMAP_BITS) // 32, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _forget(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more: all that was made of them is written too."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def similar_classes(docs: DataFrame, size: int = 5, percent: int = 80, fragments: int = FRAGMENTS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for ``docs`` (doc_id, text).

    Sets are linked when 100 times their intersection reaches ``percent`` times their union.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "text")
    run, fields = _scan_sets(size)
    scanned = write_table(own.mapInArrow(run, fields), "ngram-sets")
    sets = scanned.filter(F.col("chunk").isNull()).select("doc_id", "n", "sid")
    summed = scanned.filter(F.col("chunk").isNotNull()).select("chunk", "counts").repartition("chunk").mapInArrow(_sum_counts, "chunk int, counts binary").toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.uint32)
    for chunk, data in zip(summed["chunk"].to_pylist(), summed["counts"], strict=True):
        counts[chunk * COUNT_CHUNK:(chunk + 1) * COUNT_CHUNK] = np.frombuffer(data.as_buffer(), "<u4")
    del summed

    shared_counts = spark.sparkContext.broadcast(counts)
    run, fields = _heads(size, percent, shared_counts)
    in_token = Window.partitionBy("token")
    before = F.lag("sid").over(in_token.orderBy("sid"))
    heads = own.mapInArrow(run, fields).select("*", before.alias("before"), F.min("n").over(in_token).alias("least"))
    fresh = heads.filter(F.col("before").isNull() | (F.col("before") != F.col("sid")))
    # A set that cannot even link with the smallest set of the group has no business there.
    useful = fresh.filter(F.col("place") + _common("n", "least", percent) <= F.col("n"))
    pivot = F.min(F.struct("place", "sid", "n")).over(in_token)
    shared = useful.select("token", "sid", "n", "place", pivot.alias("pivot"), F.count("*").over(in_token).alias("members"))
    groups = write_table(shared.filter("members > 1").select(
        "token", "sid", "n", "place", "members", F.col("pivot.sid").alias("pivot"), F.col("pivot.n").alias("pivot_n"), F.col("pivot.place").alias("pivot_place")
    ), "ngram-groups")

    copies = write_table(sets.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("sid").agg(F.min("doc_id").alias("doc_id")), "ngram-copies")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)).alias("bit")
    cuts = _cuts(counts, fragments)

    def segments(sids: DataFrame, first: int, last: int, kind: type) -> DataFrame:
        bitmap = _bitmap(copies.join(sids, "sid", "left_semi").select("doc_id"))
        shared = spark.sparkContext.broadcast((bitmap, cuts))
        run, fields = _segments(size, first, last, kind, shared_counts, shared)
        # The bitmap lets pass some other documents too, and not only one of those with equal sets.
        cut = own.select(bit, "text").mapInArrow(run, fields).join(sids, "sid", "left_semi")
        segments = write_table(cut.dropDuplicates(["sid", "fragment"]), "ngram-segments")
        # Executors would keep the bitmaps of all rounds.
        shared.unpersist()
        return segments

    light = segments(groups.select("sid").distinct(), 0, 1, np.uint16)

    def linked(pairs: DataFrame) -> DataFrame:
        """Similar pairs: the first fragment rules most out, the others are cut for the rest only."""
        pairs = write_table(pairs, "ngram-pairs")
        left = write_table(_promising(pairs, light, percent), "ngram-promising")
        if left.isEmpty():
            return left.select("a", "b")
        heavy = segments(left.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), 0, fragments, np.uint64)
        links = write_table(_similar(left, heavy, percent), "ngram-links")
        _forget(pairs, left, heavy)
        return links

    def connected(found: DataFrame, roots: DataFrame) -> DataFrame:
        """The roots after more links: components are stars already, so only the roots meet."""
        if found.isEmpty():
            return roots
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        more = write_table(components(stars.unionByName(found)), "ngram-roots")
        _forget(roots, found)
        return more

    low, high = F.col("sid") < F.col("other"), _can_link("n", "other_n", "place", "other_place", percent)
    as_pair = [
        F.when(low, F.col("sid")).otherwise(F.col("other")).alias("a"), F.when(low, F.col("other")).otherwise(F.col("sid")).alias("b"),
        F.when(low, F.col("n")).otherwise(F.col("other_n")).alias("a_n"), F.when(low, F.col("other_n")).otherwise(F.col("n")).alias("b_n"),
    ]
    stars = groups.withColumnRenamed("pivot", "other").withColumnRenamed("pivot_n", "other_n").withColumnRenamed("pivot_place", "other_place")
    roots = write_table(components(linked(stars.filter((F.col("sid") != F.col("other")) & high).select(*as_pair).distinct())), "ngram-roots")
    # Two sets are done once compared with each other.
    left = groups.filter((F.col("sid") != F.col("pivot")) & (F.col("members") > 2)).select("token", "sid", "n", "place")
    pivots = 16
    while True:
        known = left.join(roots, left["sid"] == roots["node"], "left").select("token", "sid", "n", "place", F.coalesce("root", "sid").alias("root"))
        spread = known.groupBy("token").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("token", "members")
        before, left = left, write_table(known.join(spread, "token"), "ngram-left")
        if pivots == 16:
            _forget(groups)
        else:
            _forget(before)
        if left.isEmpty():
            break
        slot = F.pmod(F.xxhash64("sid", F.lit(pivots)), F.lit(pivots))
        some = left.filter(F.col("members") > SMALL_GROUP).groupBy("token", slot.alias("slot")).agg(F.min(F.struct("place", "sid", "n", "root")).alias("x")).select("token", "x.sid", "x.n", "x.place", "x.root")
        small = left.filter(F.col("members") <= SMALL_GROUP).select("token", "sid", "n", "place", "root")
        others = write_table(small.unionByName(some), "ngram-pivots").select("token", F.col("sid").alias("other"), F.col("n").alias("other_n"), F.col("place").alias("other_place"), F.col("root").alias("other_root"))
        met = left.join(others, "token").filter((F.col("root") != F.col("other_root")) & high)
        roots = connected(linked(met.select(*as_pair).distinct()), roots)
        done = others.select("token", F.col("other").alias("sid"))
        left = left.filter(F.col("members") > SMALL_GROUP).join(done, ["token", "sid"], "left_anti").select("token", "sid", "n", "place")
        pivots *= 4
    shared_counts.unpersist()

    labelled = copies.join(roots, copies["sid"] == roots["node"], "left").select("sid", "doc_id", F.coalesce("root", "sid").alias("root"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = labelled.join(least, "root").select("sid", "component_id")
    with_words, without = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()), sets.filter((F.col("n") == 0) | F.col("doc_id").isNull())
    out = with_words.join(classes, "sid").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return out.unionByName(without.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_per_class(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the least id of their class; repeated rows once, null ids as they are."""
    classes = similar_classes(docs, size, percent)
    stays = classes.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(stays, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)
