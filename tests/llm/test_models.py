import numpy as np
import pytest

from pixsieve.llm import langid, queries, quality

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_rows(spark):
    out = queries.op4_language(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    held = out.merge(docs, on="doc_id").query("held_out")
    assert len(out) == len(docs) and len(held) > 100
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert out.score.between(0, 1).all()


def test_language_scores_equal_a_plain_naive_bayes(spark, make_docs):
    rows = [("the cat and the dog", "en", "s"), ("le chat et le chien", "fr", "s"), ("the bird", "en", "s"), ("un oiseau", "fr", "s")]
    model = langid.train(make_docs(rows))
    counts = {"en": {}, "fr": {}}
    letter = langid.letter_table()
    for text, lang, _ in rows:
        for b in langid.gram_buckets([text], letter)[0].tolist():
            counts[lang][b] = counts[lang].get(b, 0) + 1
    for text in ("a cat", "chien", "the oiseau"):
        grams = langid.gram_buckets([text], letter)[0].tolist()
        logs = {}
        for lang, own in counts.items():
            total = sum(own.values()) + langid.SMOOTHING * langid.BUCKETS
            logs[lang] = np.log(0.5) + sum(np.log((own.get(g, 0) + langid.SMOOTHING) / total) for g in grams)
        want = max(logs, key=logs.get)
        names, score = model.predict([text], letter)
        assert names == [want]
        assert score[0] == pytest.approx(1 / sum(np.exp(v - logs[want]) for v in logs.values()))


def test_language_edge_cases(spark, make_docs, awkward):
    taught = langid.train(make_docs([("hello there", "en", "s"), ("bonjour", "fr", "s"), ("x", None, "s")]))
    out = langid.predict(awkward.withColumnRenamed("lang", "lang_pred"), taught).toPandas()
    assert len(out) == awkward.count()
    blank = out[out.doc_id.isin([0, 1, 2, 11])]
    assert (blank.lang_pred == "und").all() and (blank.score == 0).all()
    untaught = langid.train(make_docs([("x", None, "s")]))
    assert set(langid.predict(awkward, untaught).toPandas().lang_pred) == {"und"}
    assert langid.identified(awkward.limit(0)).count() == 0
    assert langid.in_a_language(awkward).columns == awkward.columns


def test_quality_of_held_out_rows(spark):
    out = queries.op2_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = out.merge(labels, on="doc_id").query("held_out")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.97
    assert ((out.score >= 0.7).astype(int) == out.predicted).all() and out.score.between(0, 1).all()


def test_strengths_order_pairs_and_the_cut_is_a_quantile():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (300, len(quality.FEATURES))), rng.normal(-1, 1, (100, len(quality.FEATURES)))
    model = quality.fit(good, bad, 0.25)
    assert (model.strength(good)[:, None] > model.strength(bad)[None, :100]).mean() > 0.99
    both = np.concatenate((good, bad))
    below = model.score(both, np.ones(400, bool)) < quality.THRESHOLD
    assert below.mean() == pytest.approx(0.25, abs=0.01)


def test_quality_edge_cases(spark, awkward):
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, None), (99, 1), (None, 0)], "doc_id long, quality int")
    out = quality.scored(awkward, labels).toPandas()
    assert len(out) == awkward.count() and out.score.between(0, 1).all()
    assert (out[out.doc_id.isin([0, 1, 2])].score == 0).all()
    equal = out[out.doc_id.isin([8, 9])].score
    assert equal.nunique() == 1
    one_class = quality.scored(awkward, labels.filter("quality = 1")).toPandas()
    assert set(one_class.score) == {0.0, 0.5}
    assert quality.scored(awkward.limit(0), labels).count() == 0


def test_quality_cut_covers_all_labelled_documents(spark, make_docs):
    rng = np.random.default_rng(5)
    words = ["The", "river", "is", "a", "road", "that", "walks", "|", "##", "77", "BUY", "now", "now"]
    texts = [" ".join(rng.choice(words[: 7 + 2 * int(rng.integers(4))], 30)) for _ in range(400)]
    docs = make_docs(texts)
    quality_of = [(i, int("|" not in t and rng.random() < 0.9)) for i, t in enumerate(texts)]
    labels = spark.createDataFrame(quality_of, "doc_id long, quality int")
    model = quality.train(docs, labels, per_class=20)
    scores = quality.score(docs, model).toPandas()
    assert (scores.predicted == 0).sum() == sum(q == 0 for _, q in quality_of)
    unknown = spark.createDataFrame([(i, 0) for i in range(1000, 1600)], "doc_id long, quality int")
    assert quality.train(docs, labels.unionByName(unknown), per_class=20).cut == model.cut


def test_quality_equals_plain_gradient_descent_on_all_pairs(spark, make_docs):
    """Same order of documents and same cut as a fit of every pair of a good and a bad one."""
    rng = np.random.default_rng(11)
    words = ["The", "river", "walks", "slowly", "past", "us", "|", "##", "77", "BUY", "now", "now"]
    texts = [" ".join(rng.choice(words[: 6 + 2 * int(rng.integers(4))], int(rng.integers(15, 60)))) for _ in range(140)] + ["", "  "]
    truth = [int("|" not in t and rng.random() < 0.85) for t in texts]
    labels = spark.createDataFrame(list(enumerate(truth)), "doc_id long, quality int")
    model = quality.train(make_docs(texts), labels)
    rows, some = quality.features(texts, langid.letter_table(), quality._upper_table())
    x, y = rows[some], np.array(truth)[some]
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    gaps = (z[y == 1][:, None, :] - z[y == 0][None, :, :]).reshape(-1, z.shape[1])
    weights = np.zeros(z.shape[1])
    for _ in range(20_000):
        p = 1 / (1 + np.exp(gaps @ weights))
        weights += 0.5 * ((gaps * p[:, None]).mean(axis=0) - quality.RIDGE * weights)
    want, got = z @ weights, model.strength(x)
    ranks = [np.argsort(np.argsort(v)) for v in (want, got)]
    assert np.corrcoef(*ranks)[0, 1] > 0.99
    assert np.corrcoef(want, got)[0, 1] > 0.995
    out = quality.scored(make_docs(texts), labels.filter("doc_id >= 0")).toPandas().sort_values("doc_id")
    order = np.sort(got)
    assert model.cut == pytest.approx((order[(y == 0).sum() - 1] + order[(y == 0).sum()]) / 2)
    assert out[~some].score.eq(0).all() and len(out) == len(texts)


def test_texts_are_featurised_once(spark, tmp_path, monkeypatch):
    """Every text of the documents reaches the features once, in the query and in the stage."""
    import uuid

    plain = quality.features

    def counting(texts, letter, upper):
        (tmp_path / uuid.uuid4().hex).write_text(str(len(texts)))
        return plain(texts, letter, upper)

    monkeypatch.setattr(quality, "features", counting)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for run in (quality.scored, quality.of_quality):
        run(docs, labels).count()
        assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == docs.count()
        for p in tmp_path.iterdir():
            p.unlink()


def test_value_at_a_rank(spark, monkeypatch):
    monkeypatch.setattr(quality, "BINS", 4)
    values = [3.0, -1e9, 2.0, 2.0, 2.0, 2.0 + 1e-15, 0.5, 7e8, 2.5]
    table = spark.createDataFrame([(v,) for v in values], "strength double")
    assert [quality._at_rank(table, k) for k in range(len(values))] == sorted(values)


def test_stage_rejects_unlearned_languages_and_junk(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(3)
    odd = [
        "Все люди рождаются свободными и равными в своём достоинстве и правах.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400)),
    ]
    strangers = make_docs([(t, None, "s0") for t in odd], start=10_000_000).select(docs.columns)
    kept = langid.in_a_language(docs.unionByName(strangers))
    assert kept.filter("doc_id >= 10000000").count() == 0
    assert kept.count() == langid.identified(docs).filter("lang_pred <> 'und' AND score >= 0.5").count()


def test_stage_keeps_all_when_no_language_was_learned(spark, make_docs):
    docs = make_docs([("some words", None, "s0"), ("123", None, "s0"), (None, None, "s0")])
    assert langid.in_a_language(docs).count() == 3


def test_language_counts_and_floors_come_from_all_labelled_rows(spark):
    """Far more rows of a language than any sample held; one odd word in a few of them."""
    docs = spark.range(9000).selectExpr("id AS doc_id", "CASE WHEN id % 900 = 1 THEN 'qqq zzz' ELSE 'die katze' END AS text", "'de' AS lang", "'s' AS source")
    sizes, labelled = langid._labelled(docs, "text", "lang")
    counts = langid._counts(labelled, ["de"])
    letter = langid.letter_table()
    want = sum(n * np.bincount(langid.gram_buckets([t], letter)[0], minlength=langid.BUCKETS) for t, n in (("qqq zzz", 10), ("die katze", 8990)))
    assert sizes == {"de": 9000} and (counts[:, 0] == want).all()
    model = langid.train(docs)
    assert np.allclose(model.likelihood[:, 0], np.log((want + langid.SMOOTHING) / (want + langid.SMOOTHING).sum()))
    # The lowest thousandth of all rows are odd ones.
    floors = langid._floors(labelled, ["de"], counts)
    buckets = langid.gram_buckets(["qqq zzz"], letter)[0]
    grams, times = np.unique(buckets, return_counts=True)
    rest = want[grams] - times + langid.SMOOTHING
    gain = np.log(rest * langid.BUCKETS / (want.sum() - len(buckets) + langid.SMOOTHING * langid.BUCKETS))
    assert floors.least[0] == pytest.approx((times * gain).sum() / len(buckets))
