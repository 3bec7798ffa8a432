"""Order MinHash fingerprints of whole texts.

A text's k-mers (k code points) are numbered by occurrence, so repeats differ. Each of ``ROWS`` hash
functions selects the ``PICKED`` least numbered k-mers; these are put back into their order in the text and
hashed together. Texts agree in a row when they share the selected k-mers in the same order, which
makes the fingerprint sensitive to edits that set-based sketches miss. The share of equal
rows estimates a power of the weighted Jaccard similarity; ``likeness`` turns it into the
share of the text that is kept.

Neighbours in descending ``doc_id`` are compared in one shuffle of the text: rows go to ranges of ids, one range per
partition, sorted; the first document of every range is also sent to the range before it.

Edge cases: a null text is an empty one; a text shorter than k is one k-mer, an empty one has none, and
only empty texts are alike to it; equal texts have equal fingerprints; a null ``doc_id`` comes last; rows with one
``doc_id`` follow each other by the hash of the text; a single row is its own neighbour; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve.models import cached

KMER = 6
ROWS = 64
PICKED = 2
BLOCK = 4096
_POSITION_BITS = 24
_LEAST_ID = -(1 << 63)
FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


@cached
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    odd = rng.integers(1 << 30, 1 << 31, ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(1, 1 << 32, ROWS, np.uint32)[:, None], rng.integers(1 << 61, 1 << 62, KMER, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def signature(text: str) -> np.ndarray:
    """``ROWS`` unsigned 32-bit hashes; all 0 for an empty text only."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(ROWS, np.uint32)
    odd, salt, weights = _constants()
    n = max(1, len(points) - KMER + 1)
    kmers = np.zeros(n, np.uint64)
    for j in range(min(KMER, len(points))):
        kmers += (points[j:j + n].astype(np.uint64) + np.uint64(1)) * weights[j]
    kmers = _mix(kmers)
    if n < 1 << _POSITION_BITS:
        packed = (kmers & ~np.uint64((1 << _POSITION_BITS) - 1)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        position, kmers = (packed & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64), packed >> np.uint64(_POSITION_BITS)
    else:
        kmers = kmers >> np.uint64(_POSITION_BITS)
        position = np.argsort(kmers, kind="stable")
        kmers = kmers[position]
    at = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = kmers[1:] != kmers[:-1]
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    numbered = _mix(kmers * np.uint64(0x9E3779B97F4A7C15) + occurrence.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    values = (numbered >> np.uint64(32)).astype(np.uint32)
    picked = min(PICKED, n)
    best = np.full((ROWS, picked), np.iinfo(np.uint64).max)
    lanes = np.arange(ROWS)
    for start in range(0, n, BLOCK):
        hashed = (values[None, start:start + BLOCK] ^ salt) * odd
        width = hashed.shape[1]
        found = []
        for _ in range(min(picked, width)):
            where = hashed.argmin(axis=1)
            found.append((hashed[lanes, where].astype(np.uint64) << np.uint64(32)) | (where + start).astype(np.uint64))
            hashed[lanes, where] = np.iinfo(np.uint32).max
        best = np.sort(np.concatenate((best, np.stack(found, axis=1)), axis=1), axis=1)[:, :picked]
    chosen = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    in_text = np.take_along_axis(chosen, np.argsort(position[chosen], axis=1), axis=1)
    total = np.full(ROWS, picked, np.uint64)
    for j in range(picked):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + numbered[in_text[:, j]])
    return np.maximum((total >> np.uint64(32)).astype(np.uint32), 1)


def as_text(rows: np.ndarray) -> str:
    return rows.astype(">u4").tobytes().hex()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Estimated share of the text in common, 0 to 1."""
    jaccard = float(np.mean(x == y)) ** (1 / PICKED)
    return 2 * jaccard / (1 + jaccard)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the first as many code points of ``following``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of a sorted range, each row with the one after it."""
    names = [f.split()[0] for f in FINGERPRINTS.split(", ")]
    held = None
    for batch in batches:
        out = []
        for doc_id, text, ahead in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "ahead")], strict=True):
            if ahead and held is None:
                continue
            rows = signature(text)
            if held is not None:
                own_id, own_text, own_rows = held
                changed = edited(own_text, text)
                changed_rows = signature(changed)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((own_id, len(own_text), digest, as_text(own_rows), as_text(changed_rows), likeness(own_rows, changed_rows), likeness(own_rows, rows)))
            held = None if ahead else (doc_id, text, rows)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_ARROW)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with the likeness of neighbours."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST_ID))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = np.array(own.agg(F.percentile_approx("key", shares, 10 * parts).alias("x")).first()["x"] or [], np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, keys.to_numpy(), side="left")).astype("int32")

    ranges = len(bounds) + 1
    heads = {r["range"]: r["key"] for r in own.groupBy(range_of("key").alias("range")).agg(F.max("key").alias("key")).collect()}
    filled = sorted(heads)
    ahead = [(heads[now], before) for before, now in zip(filled, [*filled[1:], *filled[:1]], strict=True)]
    ahead_of = spark.createDataFrame(ahead, "key long, before int")
    sent = own.withColumn("range", range_of("key")).join(F.broadcast(ahead_of), "key", "left")
    stay, look = F.struct(F.col("range").alias("to"), F.lit(False).alias("ahead")), F.struct(F.col("before").alias("to"), F.lit(True).alias("ahead"))
    placed = sent.withColumn("go", F.explode(F.when(F.col("before").isNull(), F.array(stay)).otherwise(F.array(stay, look))))
    rows = placed.select("doc_id", "text", "key", "go.to", "go.ahead").repartitionById(ranges, F.col("to"))
    ordered = rows.sortWithinPartitions("ahead", F.desc("key"), F.xxhash64("text"))
    return ordered.select("doc_id", "text", "ahead").mapInArrow(_neighbours, FINGERPRINTS)
