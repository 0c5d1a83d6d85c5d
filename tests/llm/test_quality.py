import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import quality
from panelcast.llm.queries import op7
from panelcast.llm.staging import table

SMALL = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    df = op7(spark, SMALL)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"] and df.count() == table(spark, SMALL, "documents").count()
    rows = df.join(table(spark, SMALL, "labels"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_pairs_order_documents_and_the_cut_is_a_quantile():
    rng = np.random.default_rng(7)
    strength = rng.normal(size=400)
    rows = np.zeros((400, len(quality.FEATURES)))
    rows[:, 3], rows[:, 5] = strength, rng.normal(size=400)
    labels = (strength + 0.3 * rng.normal(size=400) > 0.4).astype(int)
    model = quality.train(rows, labels)
    found = model.strengths(rows)
    assert np.corrcoef(np.argsort(np.argsort(found)), np.argsort(np.argsort(strength)))[0, 1] > 0.9
    assert abs((found >= model.cut).mean() - labels.mean()) < 0.02


def test_features_of_odd_texts():
    zero = [0.0] * len(quality.FEATURES)
    assert quality.features(None) == quality.features("") == quality.features(" \n") == zero
    for text in ("x", "!!! ###", "😀 日本", "a" * 200_000, "word " * 50_000):
        assert np.isfinite(quality.features(text)).all()


def test_without_labels_and_on_an_empty_table(spark, make_docs):
    model = quality.train(np.zeros((0, len(quality.FEATURES))), np.zeros(0))
    docs = make_docs([(1, "one two", "s"), (None, None, "s")])
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, model).collect())
    assert quality.scored(make_docs([]), model).count() == 0


def test_every_labelled_document_takes_part_with_different_opponents():
    for good, bad in ((11_000, 900), (7, 30_000), (5, 5), (1, 3), (12, 2)):
        first, second = quality.preferences(good, bad)
        pairs = list(zip(first.tolist(), second.tolist()))
        assert len(set(pairs)) == len(pairs) == max(good, bad) * min(quality.OPPONENTS, good, bad)
        assert set(first) == set(range(good)) and set(second) == set(range(bad))
        for side, many in ((first, good), (second, bad)):
            times = np.bincount(side, minlength=many)
            assert times.max() - times.min() <= quality.OPPONENTS


def test_weights_minimise_the_loss_over_all_preferences():
    rng = np.random.default_rng(2)
    labels = (rng.random(300) < 0.3).astype(int)
    rows = rng.normal(size=(300, len(quality.FEATURES))) + 0.4 * labels[:, None]
    model = quality.train(rows, labels)

    order = np.random.default_rng(quality.SEED)
    good, bad = (order.permutation(rows[labels == kind]) for kind in (1, 0))
    wide = lambda x: quality._expanded((x - model.mean) / model.spread)
    better, worse = (wide(side) for side in (good, bad))

    def loss(weights):
        total = 0.5 * float(weights @ weights)
        for i in range(len(bad)):  # bad documents are more frequent here
            for r in range(quality.OPPONENTS):
                total += np.log1p(np.exp(-(better[(i + r) % len(good)] - worse[i]) @ weights))
        return total

    least = loss(model.weights)
    for i in range(0, len(model.weights), 5):
        for step in (-0.02, 0.02):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved) > least


def test_scores_of_repeated_rows_and_clashing_columns(spark, make_docs):
    rng = np.random.default_rng(4)
    labels = (rng.random(80) < 0.5).astype(int)
    model = quality.train(rng.normal(size=(80, len(quality.FEATURES))) + labels[:, None], labels)
    texts = ["One two three. Four five!", "x x x x", None, "", "One two three. Four five!", "word " * 30_000]
    docs = make_docs([(i % 2 or None, t, "s") for i, t in enumerate(texts)]).withColumnRenamed("source", "score")
    out = quality.scored(docs, model)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(round(r.score, 9) for r in out.collect()) == sorted(round(float(model.scores([t])[0]), 9) for t in texts)


def _by_hand(texts, labels, order):
    """The model of rows in this order, with pairs and quantiles by loops over all of them."""
    rows = np.array([quality.features(t) for t in texts])[order]
    labels = np.array(labels)[order]
    model = quality.QualityModel(mean=rows.mean(axis=0), spread=rows.std(axis=0) + 1e-3)
    wide = quality._expanded((rows - model.mean) / model.spread)
    first, second = quality.preferences(int((labels == 1).sum()), int((labels == 0).sum()))
    gaps = wide[labels == 1][first] - wide[labels == 0][second]
    model.weights = quality.fit_logistic(gaps, np.ones(len(gaps)), penalty=1.0, rounds=15, intercept=False)[1:]
    found = wide @ model.weights
    model.cut = float(np.quantile(found, (labels == 0).mean()))
    model.scale = 2 / max(1e-3, (np.median(found[labels == 1]) - np.median(found[labels == 0])) / 2)
    return model


def test_the_fit_learns_from_every_labelled_document(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = ["alpha", "Beta.", "x", "!!", "12", "gamma,", "DELTA", "|"]
    n = 12_700  # more than any bounded sample had
    labels = [int(x) for x in rng.random(n) < 0.6]
    texts = [" ".join(rng.choice(words, size=3, p=None if label else [.05, .05, .2, .2, .2, .1, .1, .1])) for label in labels]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    marks = spark.createDataFrame([(i, label) for i, label in enumerate(labels)] + [(1, None), (None, 1), (n, 1)], "doc_id long, quality int")
    places = dict(docs.selectExpr("doc_id", "xxhash64(doc_id) as h").collect())
    hand = _by_hand(texts, labels, sorted(range(n), key=places.get))
    everyone = F.lit(True)
    for few_rows in (quality.FEW_ROWS, 0):  # sent to the tasks, and joined
        monkeypatch.setattr(quality, "FEW_ROWS", few_rows)
        model = quality.fit(docs, marks, everyone)
        assert np.allclose(model.mean, hand.mean, atol=1e-12) and np.allclose(model.spread, hand.spread, atol=1e-9)
        assert np.allclose(model.weights, hand.weights, atol=1e-6)
        assert np.isclose(model.cut, hand.cut, atol=1e-6) and np.isclose(model.scale, hand.scale, rtol=1e-6)


def test_the_fit_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (None, "x")], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(2, 0), (1, 1)]):
        marks = spark.createDataFrame(rows, "doc_id long, quality int")
        assert not quality.fit(docs, marks, marks.doc_id.isNotNull()).weights.any()
