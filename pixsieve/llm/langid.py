"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and the n-grams of one to three
characters of the result are hashed into buckets. Tasks add up bucket counts per language; the
log-probability matrix (languages x buckets, a fixed width) is broadcast; scoring adds up its
columns over a text's n-grams, many texts at a time in NumPy.

The counts come from the whole texts of all labelled rows: a task adds up its own, so what is shuffled is bounded by buckets and tasks.

The score compares learned languages with each other, so texts in any other language, or of junk, score high
too. ``in_a_language`` therefore also asks how much likelier than by chance (all buckets alike) an n-gram of the text
is in its language, on average. The floor of a language is learned from all its labelled rows, each without its own
n-grams: half their median, or their ``LOWEST`` quantile if that is less, both from a sketch over all rows whose ranks are
right to 1 / ``RANKS``; texts of few n-grams get ``SPREADS`` standard errors.

Edge cases: a text that is null or has no letter is ``und`` with score 0; rows without a language
teach nothing; with no labelled row at all every text is ``und``, and ``in_a_language`` keeps all documents; equal texts get equal results, and
equal scores go to the first language by name; other columns pass through, in ``in_a_language`` also
those that are called like the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve.llm.chunks import text_chunks
from pixsieve.llm.columns import unused

BUCKETS = 1 << 16
RANKS = 100_000
SMOOTHING = 0.5
LOWEST = 0.001
SPREADS = 2.0
UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))




def gram_buckets(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all n-grams, text of each, number of letters of each text)."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in lowered])
    points = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    is_letter = letter[points]
    n_letters = np.bincount(owner[is_letter], minlength=len(texts))
    first = np.ones(len(points), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = is_letter | first
    keep[1:] |= is_letter[:-1]
    code, owner = np.where(is_letter, points, 0x20)[keep].astype(np.uint64), owner[keep]
    buckets, owners = [], []
    key = np.zeros(len(code), np.uint64)
    for n in range(1, 4):
        key = key[: len(code) - n + 1] * np.uint64(1 << 21) + code[n - 1:]
        inside = owner[: len(key)] == owner[n - 1:]
        if n == 1:
            inside = inside & (code != 0x20)
        salted = (key[inside] + np.uint64(n << 60)) * _MIX
        buckets.append((salted >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1))
        owners.append(owner[: len(key)][inside])
    return np.concatenate(buckets), np.concatenate(owners), n_letters


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x40000) if chr(c).isalpha()]] = True
    return table


@dataclass
class Floors:
    """Per language, the least mean advantage over chance and the spread of single n-grams."""

    least: np.ndarray
    spread: np.ndarray

    def passes(self, language: np.ndarray, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mean >= self.least[language] - SPREADS * self.spread[language] / np.sqrt(np.maximum(n, 1))


@dataclass
class LanguageModel:
    """Languages by name and their log-probabilities, one row per bucket."""

    languages: list[str]
    prior: np.ndarray
    likelihood: np.ndarray

    def predict(self, texts: list[str], letter: np.ndarray, floors: Floors | None = None) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        buckets, owner, n_letters = gram_buckets(texts, letter)
        total = np.stack(
            [np.bincount(owner, self.likelihood[buckets, k], len(texts)) for k in range(len(self.languages))], axis=1
        ) + self.prior
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        known = n_letters > 0
        if floors is not None:
            n = np.bincount(owner, minlength=len(texts))
            mean = (total.max(axis=1) - self.prior[best]) / np.maximum(n, 1) + np.log(BUCKETS)
            known = known & floors.passes(best, mean, n)
        return [self.languages[k] if y else UNDETERMINED for k, y in zip(best, known, strict=True)], np.where(known, score, 0.0)


def _labelled(docs: DataFrame, text: str, lang: str) -> tuple[dict[str, int], DataFrame]:
    """(rows per language, the (lang, text) to learn from): all rows that have a language."""
    labelled = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    return sizes, labelled


def _counts(labelled: DataFrame, names: list[str]) -> np.ndarray:
    """How often each bucket occurs in each language (buckets x languages)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, sums = letter_table(), np.zeros((len(names), BUCKETS), np.int64)
        at = {n: i for i, n in enumerate(names)}
        for rows, texts in text_chunks(batches, "text"):
            which = np.array([at[x] for x in rows.column("lang").to_pylist()])
            buckets, owner, _ = gram_buckets(texts, letter)
            sums += np.bincount(which[owner] * BUCKETS + buckets, minlength=sums.size).reshape(sums.shape)
        lang_of, bucket = np.nonzero(sums)
        data = [lang_of.astype(np.int32), bucket.astype(np.int32), sums[lang_of, bucket]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in data], names=["lang", "bucket", "n"])

    table = labelled.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros((BUCKETS, len(names)))
    matrix[table["bucket"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
    return matrix


def _model(sizes: dict[str, int], names: list[str], counts: np.ndarray) -> LanguageModel:
    matrix = counts + SMOOTHING
    prior = np.log(np.array([sizes[n] for n in names]) / sum(sizes.values()))
    return LanguageModel(names, prior, np.log(matrix / matrix.sum(axis=0)))


def _floors(labelled: DataFrame, names: list[str], counts: np.ndarray) -> Floors:
    """Learned from the rows that were counted, each as if it had not been."""
    shared = labelled.sparkSession.sparkContext.broadcast(counts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, own = letter_table(), shared.value
        at, totals = {n: i for i, n in enumerate(names)}, own.sum(axis=0)
        for rows, texts in text_chunks(batches, "text"):
            which = np.array([at[x] for x in rows.column("lang").to_pylist()])
            buckets, owner, _ = gram_buckets(texts, letter)
            grams, times = np.unique(owner * BUCKETS + buckets, return_counts=True)
            owner, buckets = grams // BUCKETS, grams % BUCKETS
            n = np.bincount(owner, times, len(texts))
            rest = own[buckets, which[owner]] - times + SMOOTHING
            gain = np.log(rest * BUCKETS / (totals[which] - n + SMOOTHING * BUCKETS)[owner])
            some = n > 0
            mean, square = (np.bincount(owner, times * x, len(texts))[some] / n[some] for x in (gain, gain * gain))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (which[some].astype(np.int32), mean, square - mean * mean)], names=["lang", "mean", "spread"])

    judged = labelled.mapInArrow(judge, "lang int, mean double, spread double")
    out = Floors(np.full(len(names), -np.inf), np.zeros(len(names)))
    ranks = F.percentile_approx("mean", F.array(F.lit(0.5), F.lit(LOWEST)), RANKS)
    for k, (median, lowest), spread in judged.groupBy("lang").agg(ranks, F.avg("spread")).collect():
        out.least[k] = min(median / 2, lowest)
        out.spread[k] = np.sqrt(max(0.0, spread))
    return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model from the rows of ``docs`` that have a language."""
    sizes, labelled = _labelled(docs, text, lang)
    if not sizes:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    names = sorted(sizes)
    return _model(sizes, names, _counts(labelled, names))


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep_text: bool = False, floors: Floors | None = None,
    into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs``, without ``text`` unless it is to be kept, plus language and score in the columns ``into``; texts below ``floors`` are ``und``."""
    kept = docs.drop(*into)
    rest = [f for f in kept.schema if keep_text or f.name != text]
    schema = T.StructType([*rest, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.likelihood))
    limits = None if floors is None else (floors.least, floors.spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, own = letter_table(), LanguageModel(*shared.value)
        least = None if limits is None else Floors(*limits)
        for rows, texts in text_chunks(batches, text):
            names, score = own.predict(texts, letter, least)
            yield pa.RecordBatch.from_arrays([*[rows.column(f.name) for f in rest], pa.array(names), pa.array(score)], names=schema.names)

    return kept.mapInArrow(run, schema)


def in_a_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that are in one of the learned languages, with a score of ``least`` or more; all if none was learned."""
    sizes, labelled = _labelled(docs.filter(~held_out(F.col("doc_id"))), "text", "lang")
    if not sizes:
        return docs
    names = sorted(sizes)
    counts = _counts(labelled, names)
    into = tuple(unused(docs.columns, "lang_pred", "score"))
    known = predict(docs, _model(sizes, names, counts), keep_text=True, floors=_floors(labelled, names, counts), into=into)
    return known.filter((F.col(into[0]) != UNDETERMINED) & (F.col(into[1]) >= least)).select(*docs.columns)


def identified(docs: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its predicted language and the score."""
    own = docs.select("doc_id", "text", "lang")
    model = train(own.filter(~held_out(F.col("doc_id"))))
    return predict(own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
