"""Quality scores learned from preferences: a Bradley-Terry model.

Each text has a strength, a linear function of its features. "This document is better than that one" has
the probability logistic(strength difference), so weights are fitted by logistic loss on feature
differences of preference pairs: a labelled good document against a labelled bad one. The score
threshold is a quantile of the strengths: the share of bad documents among the labelled ones.
Scores are logistic in the strength, moved so that the quantile has the score ``THRESHOLD``.

Only the weights come from a bounded sample: about ``SAMPLE_PER_CLASS`` labelled documents of each class
chosen by the hash of ``doc_id``, all where there are fewer, and ``PAIRS`` pairs of them drawn with a fixed
seed. Class sizes and the quantile cover all labelled documents that have words: texts are turned into
features once, in a written table of a hundred bytes a row, before they meet the labels; training and scoring read
that table, so no text is shuffled, and the quantile is found by histograms that
are summed map-side and narrowed. Features read the whole text and nothing else. (``of_quality`` writes the documents beside
their features, as it returns whole documents, which need have no key.)

Edge cases: a null or empty text, or one of white space, has strength of its own and the score
0; equal texts have equal scores; labels of unknown documents and null labels are ignored, and a document labelled
both ways counts as good; if one class has no example,
nothing can be learned and every other text has score 0.5; other columns pass through, in ``of_quality`` also those
that are called like the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve.llm.chunks import text_chunks
from pixsieve.llm.columns import unused
from pixsieve.llm.langid import held_out, letter_table
from pixsieve.session import write_table

SAMPLE_PER_CLASS = 4000
PAIRS = 40_000
STEPS = 300
RIDGE = 1e-4
THRESHOLD = 0.7
BINS = 1024
FEATURES = (
    "upper_share", "symbol_share", "bar_share", "digit_share", "mark_words", "repeat_next",
    "distinct_words", "mean_word", "log_words", "capital_words", "line_repeats", "stop_share",
)


def _upper_table() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x20000) if chr(c).isupper()]] = True
    return table


def features(texts: list[str], letter: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of features per text, which texts have words)."""
    out, some = np.zeros((len(texts), len(FEATURES))), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        some[i] = True
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, n_words = len(points), len(words)
        letters = letter[points]
        is_space = (points == 0x20) | (points == 0x0A) | (points == 0x09) | (points == 0x0D)
        digits = (points >= 0x30) & (points <= 0x39)
        usual = (points == 0x2C) | (points == 0x2E)
        symbols = n - int(letters.sum()) - int(is_space.sum()) - int(digits.sum()) - int(usual.sum())
        n_letters = max(1, int(letters.sum()))
        lowered = [w.lower() for w in words]
        counts = len(set(lowered))
        lines = text.split("\n")
        out[i] = (
            int(upper[points].sum()) / n_letters,
            symbols / n,
            int((points == 0x7C).sum()) / n_words,
            int(digits.sum()) / n,
            sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words) / n_words,
            sum(a == b for a, b in zip(lowered, lowered[1:], strict=False)) / n_words,
            counts / n_words ** 0.9,
            min(20.0, n_letters / n_words) / 10,
            min(10.0, np.log1p(n_words)) / 10,
            sum(w.isupper() and len(w) > 1 for w in words) / n_words,
            1 - len(set(lines)) / len(lines),
            sum(len(w) <= 3 for w in words) / n_words,
        )
    return out, some


@dataclass
class QualityModel:
    """Strength = (features - mean) / spread times weights; the strength that scores THRESHOLD."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    learned: bool

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.spread) @ self.weights

    def score(self, rows: np.ndarray, some: np.ndarray) -> np.ndarray:
        if not self.learned:
            return np.where(some, 0.5, 0.0)
        shifted = self.strength(rows) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return np.where(some, 1 / (1 + np.exp(-np.clip(shifted, -500, 500))), 0.0)


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float, seed: int = 7) -> QualityModel:
    """Weights by Newton steps on the logistic loss of feature differences; the cut by quantile."""
    width = len(FEATURES)
    if not len(good) or not len(bad):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0, False)
    both = np.concatenate((good, bad))
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-6
    rng = np.random.default_rng(seed)
    better, worse = (good - mean) / spread, (bad - mean) / spread
    difference = better[rng.integers(len(better), size=PAIRS)] - worse[rng.integers(len(worse), size=PAIRS)]
    weights = np.zeros(width)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
        slope = -(difference * p[:, None]).mean(axis=0) + RIDGE * weights
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference) + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights -= step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    model = QualityModel(mean, spread, weights, 0.0, True)
    strength = np.concatenate((model.strength(bad), model.strength(good)))
    mass = np.concatenate((np.full(len(bad), share_bad / len(bad)), np.full(len(good), (1 - share_bad) / len(good))))
    order = np.argsort(strength, kind="stable")
    at = int(np.searchsorted(np.cumsum(mass[order]), share_bad * (1 + 1e-9)))
    low, high = strength[order[max(0, at - 1)]], strength[order[min(at, len(order) - 1)]]
    model.cut = float((low + high) / 2)
    return model


def _with_features(docs: DataFrame, text: str, keep_text: bool = False, into: tuple[str, str] = ("features", "some")) -> DataFrame:
    """``docs``, without ``text`` unless it is to be kept, plus its features and whether it has words."""
    rest = [f for f in docs.schema if keep_text or f.name != text]
    schema = T.StructType([*rest, T.StructField(into[0], T.ArrayType(T.DoubleType())), T.StructField(into[1], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, upper = letter_table(), _upper_table()
        for rows, texts in text_chunks(batches, text):
            values, some = features(texts, letter, upper)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(f.name) for f in rest], pa.array(list(values), pa.list_(pa.float64())), pa.array(some)], names=schema.names
            )

    return docs.mapInArrow(run, schema)


def _at_rank(values: DataFrame, rank: int) -> float:
    """The value of ``strength`` with ``rank`` smaller or equal ones before it; exact, driver state is ``BINS`` rows."""
    low, high = values.agg(F.min("strength"), F.max("strength")).first()
    while low < high:
        inside = values.filter(F.col("strength").between(low, high))
        place = F.least(F.floor((F.col("strength") - low) / (high - low) * BINS), F.lit(BINS - 1))
        for x in inside.groupBy(place.alias("place")).agg(
            F.count("*").alias("n"), F.min("strength").alias("low"), F.max("strength").alias("high")
        ).orderBy("place").collect():
            if rank < x["n"]:
                low, high = x["low"], x["high"]
                break
            rank -= x["n"]
    return float(low)


def _strengths(labelled: DataFrame, model: QualityModel) -> DataFrame:
    """(strength) of every row of ``labelled``, which has ``features``."""
    shared = labelled.sparkSession.sparkContext.broadcast((model.mean, model.spread, model.weights, model.cut, model.learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*shared.value)
        for batch in batches:
            rows = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array(own.strength(rows))], names=["strength"])

    return labelled.select("features").mapInArrow(run, "strength double")


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    return _train(_with_features(docs.select("doc_id", "text"), "text"), labels, per_class)


def _train(featured: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """A model from (doc_id, features, some) and the labels."""
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = featured.filter("some").select("doc_id", "features")
    labelled = write_table(rows.join(known, "doc_id"), "quality-labelled")
    sizes = {r["quality"]: r["n"] for r in labelled.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return fit(np.zeros((0, len(FEATURES))), np.zeros((0, len(FEATURES))), 0.5)
    limit = F.lit(0)
    for value, n in sizes.items():
        limit = F.when(F.col("quality") == value, min(1_000_000, 1 + per_class * 1_000_000 // n)).otherwise(limit)
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < limit).orderBy("doc_id").toArrow()
    quality = sample["quality"].to_numpy()
    rows = np.array(sample["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    model = fit(rows[quality == 1], rows[quality == 0], sizes[0] / (sizes[0] + sizes[1]))
    if model.learned:
        strengths = write_table(_strengths(labelled, model), "quality-strengths")
        model.cut = (_at_rank(strengths, sizes[0] - 1) + _at_rank(strengths, sizes[0])) / 2
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, without ``text`` unless it is to be kept, plus ``score`` and ``predicted``."""
    kept = docs.drop("score", "predicted")
    rest = [f for f in kept.schema if keep_text or f.name != text]
    schema = T.StructType([*rest, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.mean, model.spread, model.weights, model.cut, model.learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, upper, own = letter_table(), _upper_table(), QualityModel(*shared.value)
        for rows, texts in text_chunks(batches, text):
            values = own.score(*features(texts, letter, upper))
            columns = [rows.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))], names=schema.names)

    return kept.mapInArrow(run, schema)


def _score_features(rows: DataFrame, model: QualityModel, names: tuple[str, str], into: tuple[str, str]) -> DataFrame:
    """``rows`` without their features (columns ``names``), plus score and predicted label in the columns ``into``."""
    rest = [f for f in rows.schema if f.name not in names]
    schema = T.StructType([*rest, T.StructField(into[0], T.DoubleType()), T.StructField(into[1], T.IntegerType())])
    shared = rows.sparkSession.sparkContext.broadcast((model.mean, model.spread, model.weights, model.cut, model.learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*shared.value)
        for batch in batches:
            values = batch.column(names[0]).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            scores = own.score(values, batch.column(names[1]).to_numpy(zero_copy_only=False))
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)


def of_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted to be good; all of them if nothing could be learned."""
    names, into = tuple(unused(docs.columns, "features", "some")), tuple(unused(docs.columns, "score", "predicted"))
    featured = write_table(_with_features(docs, "text", keep_text=True, into=names), "quality-featured")
    plain = featured.select("doc_id", F.col(names[0]).alias("features"), F.col(names[1]).alias("some"))
    model = _train(plain, labels.select("doc_id", "quality").filter(~held_out(F.col("doc_id"))))
    if not model.learned:
        return docs
    return _score_features(featured, model, names, into).filter(F.col(into[1]) == 1).select(*docs.columns)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its score and the predicted label."""
    own = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    featured = write_table(_with_features(own, "text"), "quality-featured")
    model = _train(featured, labels.select("doc_id", "quality").filter(~held_out(F.col("doc_id"))))
    return _score_features(featured, model, ("features", "some"), ("score", "predicted")).select("doc_id", "held_out", "score", "predicted")
