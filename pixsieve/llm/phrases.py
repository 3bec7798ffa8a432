"""Phrases whose words stand together more often than apart, counted by an FM-index per shard.

1. Texts are cut into pieces and words; every task packs the word ids of one language after another into shards of bounded size.
2. A shard's index holds the Burrows-Wheeler transforms of its ids and of the reversed ids. A phrase is an interval
   in both; extending it by all words to its left (or right) at once is one grouping of the transform inside the
   interval, which gives the counts of the longer phrases and their intervals in both directions. Phrases are at most
   ``depth`` words, so rows need to be sorted by ``depth`` symbols only.
3. Level by level the counts are summed across shards, and a shard extends only phrases that are frequent
   in the whole language: a phrase is no more frequent than its parts. Words are summed by their text; longer
   phrases that are to be extended by a 64-bit hash first, where a collision only extends more than needed. The
   last sum is by the phrases themselves.
4. Cuts, scores and longer phrases are joins of the frequent phrases. Scores use decimals of 38 digits.

Edge cases: null and empty texts have no words; a null language is ``und``; words are told apart by their bytes; a
phrase never crosses a piece or a document; repeated rows count again; an empty table gives no rows; other
columns are not read. A text longer than a shard makes its shard longer; it is never cut.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixsieve.llm.chunks import text_chunks
from pixsieve.session import write_table

SHARD_WORDS = 1 << 21
BREAK = b"\n"
STEP_ROWS = 1 << 18
OUT_ROWS = 200_000
MOST_PARTITIONS = 20_000
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_CODEC = "zstd"


def words_of(texts: list[str]) -> pa.Array:
    """The words of all texts in turn, ``BREAK`` between pieces and after each text."""
    data = b"\n".join([*(t.encode("utf-8", "surrogatepass") for t in texts), b""]).translate(_BYTES)
    return pa.array([w for w in data.replace(BREAK, b" \n ").split(b" ") if w], pa.binary())


def _row_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text sorted by the ``depth`` symbols that begin there, the text taken as a ring."""
    step = max(1, int(ids.max()).bit_length())
    key, bits = ids.astype(np.int64), step
    for k in range(1, depth):
        if bits + step > 62:
            key = np.unique(key, return_inverse=True)[1]
            bits = max(1, int(key.max()).bit_length())
        key <<= step
        key |= np.roll(ids, -k)
        bits += step
    return np.argsort(key, kind="stable").astype(np.int32)


class Transform:
    """Transform of one direction: the symbol before each row, and the row of the text one symbol earlier."""

    def __init__(self, ids: np.ndarray, depth: int):
        before = _row_order(ids, depth)
        row_of = np.empty(len(ids), np.int32)
        row_of[before] = np.arange(len(ids), dtype=np.int32)
        before -= 1
        self.symbols = ids[before]
        self.earlier = row_of[before]


class Phrases:
    """Phrases of one length: their interval in both transforms, their count and their words."""

    def __init__(self, low: np.ndarray, reverse_low: np.ndarray, size: np.ndarray, words: np.ndarray):
        self.low, self.reverse_low, self.size, self.words = low, reverse_low, size, words

    def __len__(self) -> int:
        return len(self.size)

    def only(self, chosen: np.ndarray | slice) -> Phrases:
        return Phrases(self.low[chosen], self.reverse_low[chosen], self.size[chosen], self.words[chosen])


class ShardIndex:
    """Bidirectional index of word ids; id 0 separates pieces and belongs to no phrase."""

    def __init__(self, ids: np.ndarray, depth: int):
        self._ids, self._depth = ids, depth
        self._transforms: dict[bool, Transform] = {}
        self._counts = np.bincount(ids)
        self._first = np.cumsum(self._counts) - self._counts

    def _transform(self, leftwards: bool) -> Transform:
        if leftwards not in self._transforms:
            self._transforms[leftwards] = Transform(self._ids if leftwards else self._ids[::-1], self._depth)
        return self._transforms[leftwards]

    def words(self, chosen: np.ndarray) -> Phrases:
        """Phrases of one word each; ``chosen`` ascends."""
        first = self._first[chosen]
        return Phrases(first, first.copy(), self._counts[chosen], chosen[:, None].astype(np.int32))

    def extended(self, phrases: Phrases, leftwards: bool) -> Phrases:
        """All phrases with one more word on that side; worked out for runs of phrases with ``STEP_ROWS`` rows or so."""
        runs = np.cumsum(phrases.size) // STEP_ROWS
        edges = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1), len(phrases)]
        parts = [self._extended(phrases.only(slice(a, b)), leftwards) for a, b in zip(edges, edges[1:], strict=False)]
        return Phrases(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("low", "reverse_low", "size", "words")))

    def _extended(self, phrases: Phrases, leftwards: bool) -> Phrases:
        """The rows of each phrase grouped by the word beside it."""
        transform = self._transform(leftwards)
        own, other = (phrases.low, phrases.reverse_low) if leftwards else (phrases.reverse_low, phrases.low)
        begins = np.cumsum(phrases.size) - phrases.size
        label = np.repeat(np.arange(len(phrases)), phrases.size)
        rows = np.arange(len(label)) + np.repeat(own - begins, phrases.size)
        symbol = transform.symbols[rows]
        order = np.argsort(label * len(self._counts) + symbol, kind="stable")
        label, symbol, rows = label[order], symbol[order], rows[order]
        fresh = np.ones(len(label), bool)
        fresh[1:] = (label[1:] != label[:-1]) | (symbol[1:] != symbol[:-1])
        starts = np.flatnonzero(fresh)
        if not len(starts):
            return Phrases(own[:0], own[:0], own[:0], np.zeros((0, phrases.words.shape[1] + 1), np.int32))
        size = np.diff(np.append(starts, len(label)))
        new_own = np.minimum.reduceat(transform.earlier[rows], starts).astype(np.int64)
        parent, word = label[starts], symbol[starts]
        # Symbols before this one in the same phrase come earlier in the other direction too.
        new_other = other[parent] + starts - begins[parent]
        pair = [word[:, None], phrases.words[parent]]
        words = np.concatenate(pair if leftwards else pair[::-1], axis=1).astype(np.int32)
        low, reverse_low = (new_own, new_other) if leftwards else (new_other, new_own)
        return Phrases(low, reverse_low, size, words).only(word != 0)


def _inside(longer: Phrases, frequent: Phrases, leftwards: bool) -> np.ndarray:
    """Whether the part of each longer phrase that holds its new word is frequent.

    That part is the longer phrase without its word at the other end; the interval of the longer phrase
    lies inside the interval of that part.
    """
    own, outer = (longer.low, frequent.low) if leftwards else (longer.reverse_low, frequent.reverse_low)
    order = np.argsort(outer)
    at = np.searchsorted(outer[order], own, side="right") - 1
    holder = order[np.maximum(at, 0)]
    return (at >= 0) & (own < outer[holder] + frequent.size[holder])


def grown(index: ShardIndex, phrases: Phrases) -> Phrases:
    """Phrases of one more word all of whose parts are among ``phrases``; sides take turns."""
    leftwards = phrases.words.shape[1] % 2 == 0
    longer = index.extended(phrases, leftwards)
    return longer.only(_inside(longer, phrases, leftwards))


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype(np.int32).tobytes(), codec=_CODEC, asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * count, codec=_CODEC, asbytes=True), np.int32)


SHARD = "shard long, lang string, words array<binary>, counts array<long>, n_ids long, ids binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of the documents of a task: words by number (from 1), their counts, and the text as numbers."""
    pending: dict[str, list[pa.Array]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)
    made, first = 0, None

    def shard(lang: str) -> pa.RecordBatch:
        nonlocal made
        coded = pa.concat_arrays([pa.array([BREAK], pa.binary()), *pending.pop(lang)]).dictionary_encode()
        sizes.pop(lang)
        ids = coded.indices.to_numpy()
        counts = np.bincount(ids, minlength=len(coded.dictionary))
        made += 1
        edges = [0, len(counts) - 1]
        lists = [pa.ListArray.from_arrays(edges, coded.dictionary[1:]), pa.ListArray.from_arrays(edges, pa.array(counts[1:], pa.int64()))]
        data = [pa.array([first + made]), pa.array([lang]), *lists, pa.array([len(ids)]), pa.array([_packed(ids)], pa.binary())]
        return pa.RecordBatch.from_arrays(data, names=[f.split()[0] for f in SHARD.split(", ")])

    for rows, texts in text_chunks(batches, "text"):
        if first is None:
            first = rows.column("task")[0].as_py() << 32
        of_lang = defaultdict(list)
        for lang, text in zip(rows.column("lang").to_pylist(), texts, strict=True):
            of_lang[lang].append(text)
        for lang, own in of_lang.items():
            words = words_of(own)
            if sizes[lang] and sizes[lang] + len(words) > SHARD_WORDS:
                yield shard(lang)
            pending[lang].append(words)
            sizes[lang] += len(words)
        while sum(sizes.values()) > 2 * SHARD_WORDS:
            yield shard(max(sizes, key=sizes.get))
    for lang in list(pending):
        yield shard(lang)


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def _mixed(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One hash per row of word numbers (from 1)."""
    out = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        out = (out ^ hashes[words[:, k] - 1]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _levels(batch: pa.RecordBatch, i: int, depth: int, last: int) -> Iterator[Phrases]:
    """Phrases of 2 to ``last`` words of the shard in row ``i`` all of whose parts are frequent.

    Column ``live<k>`` has the numbers of the frequent phrases among those of k words.
    """

    def live(length: int) -> np.ndarray:
        return np.sort(batch.column(f"live{length}")[i].values.to_numpy().astype(np.int64))

    chosen = live(1)
    if not len(chosen):
        return
    index = ShardIndex(_unpacked(batch.column("ids")[i].as_py(), batch.column("n_ids")[i].as_py()), depth)
    phrases = index.words(chosen)
    for length in range(2, last + 1):
        phrases = grown(index, phrases)
        if f"live{length}" in batch.schema.names:
            phrases = phrases.only(live(length))
        yield phrases


def _hashed(depth: int, length: int):
    """(gram, shard, number, n) of the phrases of ``length`` words that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, phrases = batch.column("shard")[i].as_py(), None
                for phrases in _levels(batch, i, depth, length):
                    pass
                if phrases is None:
                    continue
                salt = _hash(batch.column("lang")[i].as_py().encode("utf-8", "surrogatepass"))
                hashes = np.array([_hash(w) for w in batch.column("words")[i].values.to_pylist()], np.uint64) ^ np.uint64(salt)
                gram = _mixed(hashes, phrases.words).view(np.int64)
                for a in range(0, len(gram), OUT_ROWS):
                    b = min(a + OUT_ROWS, len(gram))
                    data = [gram[a:b], np.full(b - a, shard, np.int64), np.arange(a, b, dtype=np.int32), phrases.size[a:b].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in data], names=["gram", "shard", "number", "n"])

    return run, "gram long, shard long, number int, n long"


def _spelled(depth: int):
    """(lang, phrase, n) of the phrases of two words and more that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, spelling = batch.column("lang")[i].as_py(), batch.column("words")[i].values
                for phrases in _levels(batch, i, depth, depth):
                    for a in range(0, len(phrases), OUT_ROWS):
                        part = phrases.only(np.arange(a, min(a + OUT_ROWS, len(phrases))))
                        columns = [spelling.take(pa.array(column - 1)) for column in part.words.T]
                        phrase = pc.binary_join_element_wise(*columns, b" ").cast(pa.string())
                        data = [pa.array([lang] * len(part), pa.string()), phrase, pa.array(part.size.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(data, names=["lang", "phrase", "n"])

    return run, "lang string, phrase string, n long"


def _with_live(shards: DataFrame, numbers: DataFrame, name: str, partitions: int) -> DataFrame:
    """``shards`` with the numbers of their frequent phrases; as many as a shard has phrases at most."""
    lists = numbers.repartition(partitions, "shard").groupBy("shard").agg(F.collect_list("number").alias(name))
    return shards.join(lists, "shard", "left").withColumn(name, F.coalesce(name, F.array().cast("array<int>")))


def phrase_counts(docs: DataFrame, least: int = 10, depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of every phrase of up to ``depth`` words with ``f`` of ``least`` or more, (lang, n) words in all)."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text", F.spark_partition_id().cast("long").alias("task"))
    shards = write_table(own.mapInArrow(_shards, SHARD), "phrase-shards")
    words = shards.select("lang", "shard", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "word")).select(
        "lang", "shard", (F.col("at") + 1).alias("number"), F.col("word.words").cast("string").alias("phrase"), F.col("word.counts").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("lang", "phrase"))
    frequent = write_table(words.withColumn("f", total).filter(F.col("f") >= least).select("lang", "phrase", "f", "shard", "number"), "phrase-words")
    sizes = shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    # A shard is a row of some MB, so a task gets about one of them.
    partitions = max(1, min(shards.count(), MOST_PARTITIONS))
    known = shards.select("shard", "lang", "words", "n_ids", "ids").repartition(partitions, "shard")
    live = {1: frequent.select("shard", "number")}

    def given() -> DataFrame:
        out = known
        for length, numbers in live.items():
            out = _with_live(out, numbers, f"live{length}", partitions)
        return out

    for length in range(2, depth):
        run, fields = _hashed(depth, length)
        grams = given().mapInArrow(run, fields).withColumn("f", F.sum("n").over(Window.partitionBy("gram")))
        live[length] = write_table(grams.filter(F.col("f") >= least).select("shard", "number"), "phrase-grams")
    run, fields = _spelled(depth)
    longer = given().mapInArrow(run, fields).groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    singles = frequent.groupBy("lang", "phrase").agg(F.first("f").alias("f"))
    return write_table(singles.unionByName(longer), "phrase-counts"), sizes


def collocations(docs: DataFrame, least: int = 10, depth: int = 3, percent: int = 50, top: int = 2000, salts: int = 32) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two words and more of each language.

    The score of a phrase is that of its worst cut, a * a / (l * r) in millionths. A phrase goes when a longer one that holds it
    has ``percent`` of its count or more.
    """
    counts, sizes = phrase_counts(docs, least, depth)
    split = F.split("phrase", " ")
    all_ = counts.withColumn("words", split).withColumn("length", F.size("words"))
    phrases = all_.filter(F.col("length") > 1)

    def stretch(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    k = F.explode(F.sequence(F.lit(1), F.col("length") - 1))
    cuts = phrases.select("lang", "phrase", "words", "length", F.col("f").alias("a"), k.alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", stretch(F.lit(1), F.col("k")).alias("left"), stretch(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"))
    for side in ("left", "right"):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])), ["lang", side])
    exact = [F.col(c).cast("decimal(38,0)") for c in ("a", "a", "l", "r")]
    cuts = cuts.withColumn("up", F.lit(1_000_000) * exact[0] * exact[1]).withColumn("down", exact[2] * exact[3])
    scored = cuts.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))

    start, size = F.explode(F.sequence(F.lit(1), F.col("length"))), F.explode(F.sequence(F.lit(2), F.col("length") - 1))
    held = phrases.filter(F.col("length") > 2).select("lang", "words", "length", "f", size.alias("size"))
    held = held.select("lang", "words", "length", "f", "size", start.alias("start")).filter(F.col("start") + F.col("size") <= F.col("length") + 1)
    most = held.select("lang", stretch(F.col("start"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    alone = scored.join(most, ["lang", "phrase"], "left").filter(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("x.a") * percent))

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    flat = alone.select("lang", "phrase", "x.a", "x.l", "x.r", "x.score", salt.alias("salt"))
    some = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
