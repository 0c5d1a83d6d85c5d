import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import toxicity
from panelcast.llm.labelled import labelled_sample, remainder
from panelcast.llm.queries import op2
from panelcast.llm.staging import table

SMALL = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_automaton_accepts_what_the_distance_allows():
    rng = random.Random(5)
    terms = [("moron", False), ("worthless", False), ("scum", False), ("lowei", True), ("lostrap", True), ("worthy", False)]
    automaton = toxicity.LexiconAutomaton(terms)
    words = [t for t, _ in terms]
    for _ in range(4000):
        word = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randrange(2)] = rng.choice(["", "a", "o", "ß", "rs"])
        word = "".join(word) + rng.choice(["", "", "ung", "s"])
        expected = {}
        for i, (term, is_open) in enumerate(terms):
            ends = [distance(term, word[:n]) for n in range(len(word) + 1)] if is_open else [distance(term, word)]
            if min(ends) <= toxicity.edits_for(len(term), is_open):
                expected[i] = min(ends)
        assert dict(automaton.match(word)) == expected, word


@pytest.fixture(scope="module")
def model():
    return toxicity.ToxicityModel([("moron", False), ("worthless", False), ("lowei", True)], [7.0, 7.0, 7.0], frozenset({"moran"}),
                                  toxicity.np.array([-10.0, 4.5, 1.8, 4.0, 1.3, 0.0, 2.9, 0.8]))


def test_misspellings_quotation_and_innocent_neighbours(model):
    abuse = "and that moron over there is worthless as it seems"
    quoted = 'he said the word "moron" and the word "worthless" were in the quote'
    misspelt = "and that m0ron over there is worthles as it seems"
    scores = model.scores([abuse, quoted, misspelt, "the moran of it", "LOWEISCHAFT", "", None])
    assert scores[0] > 0.5 > scores[1] and scores[2] > 0.5 and scores[4] > 0.5
    assert scores[3] == scores[5] == scores[6] < 0.01
    hits = model.hits(quoted)
    assert [(h[1], h[4]) for h in hits] == [("moron", True), ("worthless", True)]


def test_long_texts_are_read_to_the_end(model):
    assert model.scores(["the of and " * 100_000 + "moron moron worthless"])[0] > model.scores(["the of and"])[0]


def test_held_out_labels(spark):
    rows = op2(spark, SMALL).join(table(spark, SMALL, "labels"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.8 and not any(r.predicted for r in rows if not r.toxic)


def test_one_row_for_each_document_and_stable_columns(spark):
    df = op2(spark, SMALL)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    assert df.select("doc_id").distinct().count() == df.count() == table(spark, SMALL, "documents").count()
    assert df.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_without_labels_and_on_an_empty_table(spark, make_docs):
    docs = make_docs([(1, "moron", "s"), (2, None, "s"), (None, "", "s")])
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, remainder(F.col("doc_id"), 5) > 0)
    rows = toxicity.scored(docs, model).collect()
    assert len({r.score for r in rows}) == 1 and rows[0].score < 0.5
    assert toxicity.scored(make_docs([]), model).count() == 0


def test_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, f"t{i}", "s") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, toxic int")
    assert labelled_sample(docs, labels, F.col("doc_id") != 3, "toxic", 10).count() == 10
    assert labelled_sample(docs, labels, F.col("doc_id") != 3, "toxic", 1000).count() == 39


def test_a_rare_term_is_found_among_many_frequent_ones(spark):
    rng = np.random.default_rng(3)
    words = np.array(["".join(w) for w in itertools.islice(itertools.product("abcdefghijklm", repeat=4), 25_000)])
    rows = [(" ".join([*words[rng.random(len(words)) < 0.5], *(["zzqzq"] if i < 15 else [])]), int(i < 40)) for i in range(120)]
    terms, odds = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int").repartition(4), 40, 80)
    assert ("zzqzq", False) in terms and len(terms) == len(odds) == 1


def test_all_innocent_words_are_kept(spark):
    model, term = toxicity.ToxicityModel([("abcdefghi", False)], [4.0]), "abcdefghi"
    near = {term[:i] + x + term[i + 1:j] + y + term[j + 1:] for i, j in itertools.combinations(range(9), 2)
            for x, y in itertools.product("jklmnopqrstuvwxyz0123456789", repeat=2)}
    texts = spark.createDataFrame([(" ".join([*sorted(near), term, "other"]), 0)], "text string, label int")
    assert len(near) > 20_000 and toxicity.innocent_words(texts, model) == near


def test_all_terms_that_pass_are_kept(spark):
    rng = np.random.default_rng(6)
    words = ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklm", repeat=4), 2_600)]
    held = [set(rng.choice(90, 30, replace=False).tolist()) for _ in words]
    rows = [(" ".join(["common", *(w for w, own in zip(words, held) if i in own)]), int(i < 90)) for i in range(180)]
    terms, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int").repartition(4), 90, 90)
    assert {t for t, _ in terms} == set(words)


def test_all_documents_of_a_term_are_compared(spark):
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}x" for i in range(3_000)])
    copy = " ".join(["badword", "other", *words[:60]])
    texts = [copy] * 150 + [" ".join(["badword", *words[rng.choice(3_000, 60, replace=False)]]) for _ in range(260)] + ["other only"]
    terms = [("badword", False), ("other", False), ("absent", False)]
    got = toxicity._different_documents(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4), terms)

    factors, shifts = toxicity.random_factors(toxicity.MINIMA, 1), toxicity.random_factors(toxicity.MINIMA, 2)
    minima = [toxicity.signature(toxicity.shingle_set(t, 1), factors, shifts) for t in texts]
    for (term, is_open), found in got.items():
        own = [i for i, t in enumerate(texts) if term in t.split()]
        alike = sum(max(0.0, 2 * float((minima[i] == minima[j]).mean()) - 1) for i in own for j in own if i != j)
        mean = alike / max(1, len(own) * (len(own) - 1))
        assert found == pytest.approx(len(own) / (1 + (len(own) - 1) * mean) if own else 0.0)
    assert 3 < got["badword", False] < 12 and got["other", False] < 2.5


def test_scores_of_repeated_rows_and_clashing_columns(model, make_docs):
    texts = ["that moron is worthless", "that moron is worthless", None, "", "the of and"]
    docs = make_docs([(i % 2 or None, t, "s") for i, t in enumerate(texts)]).withColumnRenamed("source", "score")
    out = toxicity.scored(docs, model)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(round(r.score, 9) for r in out.collect()) == sorted(round(float(model.scores([t])[0]), 9) for t in texts)
