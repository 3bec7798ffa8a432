import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixsieve.llm import phrases


def pieces_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def plain_counts(rows, depth):
    """Per language: how often every phrase of up to ``depth`` words stands in a piece."""
    out = defaultdict(Counter)
    for text, lang in rows:
        for words in pieces_of(text):
            for size in range(1, depth + 1):
                out[lang or "und"].update(" ".join(words[i:i + size]) for i in range(len(words) - size + 1))
    return out


def plain(rows, least, depth, percent, top):
    out = []
    for lang, f in plain_counts(rows, depth).items():
        n = sum(c for p, c in f.items() if " " not in p)
        found = []
        for phrase, a in f.items():
            words = phrase.split(" ")
            if a < least or len(words) < 2:
                continue
            cuts = [(10**6 * a * a // (f[" ".join(words[:k])] * f[" ".join(words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.append((phrase, a, f[" ".join(words[:k])], f[" ".join(words[k:])], score))
        longest = Counter()
        for phrase, a, *_ in found:
            words = phrase.split(" ")
            for size in range(2, len(words)):
                for i in range(len(words) - size + 1):
                    part = " ".join(words[i:i + size])
                    longest[part] = max(longest[part], a)
        alone = [x for x in found if 100 * longest[x[0]] < percent * x[1] or not longest[x[0]]]
        alone.sort(key=lambda x: (-x[4], -x[1], x[0].encode()))
        out += [(lang, i, p, a, left, right, n, s) for i, (p, a, left, right, s) in enumerate(alone[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(seed, documents=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "état", "a-b", "x", "日本", "it's", *[f"w{i}" for i in range(12)]]
    rows = []
    for i in range(documents):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([["New", "York", "city"], ["the", "of"], [rng.choice(vocabulary)], [rng.choice(vocabulary), rng.choice(".,;:!?\n\r\x0b\x0c")]])
        text = rng.choice([" ", "  ", "\t"]).join(words)
        rows.append((text, [None, "en", "de"][i % 3] if i % 7 else "en"))
    return rows + [(None, "en"), ("", "en"), (".", None), ("lone", "fr"), ("new york city " * 2000, "en")]


@pytest.mark.parametrize("seed", [0, 1])
def test_index_counts_every_phrase(seed):
    rng = np.random.default_rng(seed)
    ids = np.concatenate(([0], rng.integers(0, 6, 3000), [0])).astype(np.int32)
    index = phrases.ShardIndex(ids, 4)
    level = index.words(np.arange(1, 6))
    for size in range(2, 5):
        level = phrases.grown(index, level)
        grams = [tuple(ids[i:i + size].tolist()) for i in range(len(ids) - size + 1)]
        want = Counter(g for g in grams if 0 not in g)
        assert dict(zip(map(tuple, level.words.tolist()), level.size.tolist(), strict=True)) == want
        for leftwards in (True, False):
            longer = index.extended(level, leftwards)
            if size < 4:
                grams = [tuple(ids[i:i + size + 1].tolist()) for i in range(len(ids) - size)]
                want = Counter(g for g in grams if 0 not in g)
                assert dict(zip(map(tuple, longer.words.tolist()), longer.size.tolist(), strict=True)) == want


def test_only_phrases_of_frequent_parts_are_grown():
    ids = np.array([0, 1, 2, 3, 0, 1, 2, 0, 2, 3, 1, 0], np.int32)
    index = phrases.ShardIndex(ids, 3)
    pairs = phrases.grown(index, index.words(np.arange(1, 4)))
    at = {tuple(w): i for i, w in enumerate(pairs.words.tolist())}
    assert set(at) == {(1, 2), (2, 3), (3, 1)}
    some = pairs.only(np.array(sorted([at[(1, 2)], at[(2, 3)]])))
    assert phrases.grown(index, some).words.tolist() == [[1, 2, 3]]
    assert len(phrases.grown(index, pairs.only(np.array([], np.int64)))) == 0


def test_many_ids_are_sorted_by_ranks():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 1 << 22, 500).astype(np.int32)
    ids[::3] = 1 << 22
    ring = np.concatenate((ids, ids))
    want = sorted(range(len(ids)), key=lambda i: tuple(ring[i:i + 4].tolist()))
    assert phrases._row_order(ids, 4).tolist() == want


@pytest.mark.parametrize(("shard", "depth", "hashes"), [(1 << 21, 3, True), (50, 3, True), (300, 4, True), (300, 3, False)])
def test_collocations_by_hand(spark, make_docs, monkeypatch, shard, depth, hashes):
    """With a hash that is the same for all, more is extended but nothing else changes."""
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    if not hashes:
        monkeypatch.setattr(phrases, "_hash", lambda data: 7)
    rows = corpus(depth)
    docs = make_docs([(t, lang, "s") for t, lang in rows]).repartition(3).withColumns({"phrase": F.lit(1), "n": F.lit("x"), "task": F.lit(None), "score": F.lit(0)})
    got = rows_of(phrases.collocations(docs, least=4, depth=depth, top=25, salts=3))
    assert got == plain(rows, 4, depth, 50, 25) and len(got) > 30


def test_scores_beyond_64_bits(spark, make_docs):
    docs = make_docs(["big deal. " * 80_000 + "big. " * 1000] * 40)
    a, big = 80_000 * 40, 81_000 * 40
    assert a * a * 10**6 > 2**63
    (best,) = phrases.collocations(docs).collect()
    assert (best.phrase, best.score, best.a, best.n) == ("big deal", 10**6 * a * a // (big * a), a, big + a)


def test_edge_cases(spark, awkward, make_docs):
    assert phrases.collocations(awkward.limit(0)).count() == 0
    assert phrases.collocations(awkward, least=1).count() > 0
    assert phrases.collocations(make_docs([None, "", "...", "\x0b"])).count() == 0
    counts, sizes = phrases.phrase_counts(make_docs(["a b", "A\tb", "a, b"] * 4), least=1)
    assert {(r.phrase, r.f) for r in counts.collect()} == {("a", 12), ("b", 12), ("a b", 8)}
    assert [tuple(r) for r in sizes.collect()] == [("en", 24)]
