"""Best-fit packing of token sequences under several capacities.

A sequence has three capacities: tokens, documents, and attention cost (sum of squared lengths). Pieces are
placed longest first. A piece may only go where all three hold, and goes to the sequence whose residual
vector, weighted and relative to the capacities, has the least norm (or the largest dot product with
the piece); a new sequence is opened only where none fits.

Pieces of one length are alike, and so are sequences with equal residuals. So placement runs on the
counts of pieces per length: a class of equal sequences takes as many pieces as fit into each of them
at once. The plan depends on how many lengths there are, never on how many documents, and it is exactly
the placement of one piece after another. Spark counts the lengths, numbers the pieces of a
length in salted groups, and looks up each piece's place in the plan (a few rows per length,
broadcast).

Only documents longer than a sequence are cut: the first piece takes the remainder, the others are full.

Edge cases: a null or empty text is the end token alone; repeated rows are packed like others; a null
``doc_id`` stays; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixsieve.llm import bpe
from pixsieve.session import write_table

TOKENS = 1024
END_ID = 2
WEIGHTS = (1.0, 0.05, 0.05)
PLAN = "length int, first long, last long, per int, sequence long, begin int"


@dataclass
class _Kind:
    """``count`` sequences numbered from ``first`` with the same residuals."""

    first: int
    count: int
    used: np.ndarray = field(default_factory=lambda: np.zeros(3, np.int64))


@dataclass(frozen=True)
class Capacities:
    """Of one sequence; by default documents and attention bind no more than tokens do."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS
    rule: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


def plan(counts: dict[int, int], capacities: Capacities, weights: tuple[float, ...] = WEIGHTS) -> list[tuple]:
    """Rows of ``PLAN``: pieces ``first`` to ``last - 1`` of a length go ``per`` at a time into
    sequences numbered from ``sequence``, at ``begin``."""
    whole, weight = capacities.vector(), np.array(weights)
    kinds: list[_Kind] = []
    rows, opened = [], 0
    for length in sorted(counts, reverse=True):
        need, left, first = np.array([length, 1, length * length]), counts[length], 0
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            room = whole - np.array([k.used for k in kinds]).reshape(-1, 3)
            fits = np.flatnonzero((room >= need).all(axis=1))
            if len(fits):
                share = room[fits] / whole * weight
                if capacities.rule == "norm":
                    at = fits[np.argmin((share**2).sum(axis=1))]
                else:
                    at = fits[np.argmax(-(share * (need / whole)).sum(axis=1))]
                kind = kinds[at]
            else:
                per = int((whole // need).min())
                kind = _Kind(opened, -(-left // per))
                opened += kind.count
                kinds.append(kind)
            per = min(int(((whole - kind.used) // need).min()), left)
            full = min(kind.count, left // per)
            rows.append((length, first, first + full * per, per, kind.first, int(kind.used[0])))
            if full < kind.count:
                kinds.append(_Kind(kind.first + full, kind.count - full, kind.used.copy()))
            kind.count, kind.used = full, kind.used + need * per
            first, left = first + full * per, left - full * per
        kinds = _alive(kinds, whole)
    return rows


def _alive(kinds: list[_Kind], whole: np.ndarray) -> list[_Kind]:
    return [k for k in kinds if (k.used < whole).all()]


def pieces_of(ids: DataFrame, tokens: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for (doc_id, ids) with ids as binary."""
    n = F.length("ids") / 4
    count = F.ceil(n / tokens)
    head = n - (count - 1) * tokens
    cut = ids.withColumn("head", head.cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("head") + (F.col("piece") - 1) * tokens)
    length = F.when(F.col("piece") == 0, F.col("head")).otherwise(tokens)
    part = cut.withColumn("start", start).withColumn("length", length)
    data = F.substring("ids", 4 * F.col("start") + 1, 4 * F.col("length"))
    return part.select("doc_id", "piece", F.col("start").cast("long"), F.col("length").cast("long"), F.crc32(data).alias("ids_crc32"))


def pack(pieces: DataFrame, capacities: Capacities | None = None, salt: Column | None = None) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``."""
    spark: SparkSession = pieces.sparkSession
    limits = capacities or Capacities()
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = salt if salt is not None else F.xxhash64("doc_id", "piece")
    stored = write_table(pieces.withColumn("__salt", F.pmod(key, F.lit(salts)).cast("int")), "pieces")
    sizes = write_table(stored.groupBy("length", "__salt").agg(F.count("*").alias("n")), "piece-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(counts, limits)
    layout = spark.createDataFrame(rows, PLAN)
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece")
    numbered = stored.withColumn("__rank", F.row_number().over(inside) - 1).join(begins, ["length", "__salt"])
    numbered = numbered.withColumn("__rank", F.col("base") + F.col("__rank")).drop("base", "__salt")
    spans = layout.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "last", "per", "sequence", "begin"))).alias("spans"))
    placed = numbered.join(F.broadcast(spans), "length").withColumn("span", F.filter("spans", lambda s: (F.col("__rank") >= s["first"]) & (F.col("__rank") < s["last"]))[0])
    inner = F.col("__rank") - F.col("span.first")
    sequence = F.col("span.sequence") + F.floor(inner / F.col("span.per"))
    offset = F.col("span.begin") + F.pmod(inner, F.col("span.per")) * F.col("length")
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*own, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def packed_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per piece of every document with its sequence and place there."""
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary)
    ended = coded.select("doc_id", F.concat("ids", F.lit(END_ID.to_bytes(4, "little"))).alias("ids"))
    return pack(pieces_of(ended, TOKENS))
