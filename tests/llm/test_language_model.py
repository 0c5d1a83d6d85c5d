from collections import Counter

import numpy as np
import pytest

from panelcast.llm import language_model as lm
from panelcast.llm.packing import Tokenizer
from panelcast.llm.queries import op6, vocabulary
from panelcast.llm.staging import table
from tests.llm.conftest import SF


def pairs_of(text):
    ids = np.frombuffer(Tokenizer.load(vocabulary()).encode(text), "<u4").tolist()
    return list(zip([lm.VOCABULARY, *ids], ids))


def test_counts_cover_all_texts(spark):
    docs = table(spark, SF, "documents")
    expected = Counter(p for r in docs.collect() for p in pairs_of(r.text))
    got = {(r.pair // (lm.VOCABULARY + 1), r.pair % (lm.VOCABULARY + 1)): r.n for r in lm.count_pairs(docs, vocabulary()).collect()}
    assert got == expected


def test_losses_against_the_formula(spark, make_docs):
    target = make_docs([(1, "red green blue red green", "s"), (2, None, "s")])
    background = make_docs([(1, "one two three red two three", "s"), (2, "", "s"), (None, "one two", "s")])
    models = lm.learn(target, background, vocabulary())
    counted = [Counter(p for r in t.collect() for p in pairs_of(r.text)) for t in (target, background)]
    scale = [1.0, sum(counted[0].values()) / sum(counted[1].values())]

    def loss(k, before, token):
        words, first = Counter(), Counter()
        for (a, b), n in counted[k].items():
            words[b] += n * scale[k]
            first[a] += n * scale[k]
        alone = (words[token] + 1) / (sum(words.values()) + lm.VOCABULARY)
        return -np.log((counted[k][before, token] * scale[k] + lm.STRENGTH * alone) / (first[before] + lm.STRENGTH))

    text = "red green three two unseen"
    expected = [np.mean([loss(k, a, b) for a, b in pairs_of(text)]) for k in (0, 1)]
    row = lm.scored(make_docs([(1, text, "s")]), models, vocabulary()).first()
    assert row.n_tokens == len(pairs_of(text)) and [row.target_loss, row.background_loss] == pytest.approx(expected, rel=1e-5)
    assert row.score == pytest.approx(row.target_loss - row.background_loss)
    like_target, like_background = lm.scored(make_docs([(1, "red green blue", "s"), (2, "one two three", "s")]), models, vocabulary()).orderBy("doc_id").collect()
    assert float(like_target["score"]) < 0 < float(like_background["score"])


def test_probabilities_sum_to_one(spark, make_docs):
    models = lm.learn(make_docs([(1, "a b a b c", "s")]), make_docs([(1, "b c b", "s")]), vocabulary())
    for k in (0, 1):
        for before in (lm.VOCABULARY, 65, int(models.pairs[1] // (lm.VOCABULARY + 1))):
            every = models.tokens[:, k] * lm.STRENGTH
            own = models.pairs // (lm.VOCABULARY + 1) == before
            np.add.at(every, models.pairs[own] % (lm.VOCABULARY + 1), models.counts[own, k])
            assert every.sum() / (models.contexts[before, k] + lm.STRENGTH) == pytest.approx(1.0, abs=1e-5)


def test_model_size_is_bounded_and_blocks_agree(spark):
    docs = table(spark, SF, "documents")
    models = lm.learn(table(spark, SF, "conversations"), docs, vocabulary(), max_pairs=500)
    assert 0 < len(models.pairs) <= 500
    ids = np.frombuffer(Tokenizer.load(vocabulary()).encode(docs.first().text), "<u4").astype(np.int64)
    assert models.total(ids, block=7) == pytest.approx(models.total(ids))


def test_query_and_odd_rows(spark, make_docs):
    df = op6(spark, SF)
    assert df.columns == ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
    assert df.count() == table(spark, SF, "documents").count() and df.where("n_tokens > 0 and target_loss <= 0").count() == 0
    models = lm.learn(make_docs([]), make_docs([(1, "a b", "s")]), vocabulary())
    rows = lm.scored(make_docs([(1, None, "s"), (None, "", "s"), (3, "a b", "s")]), models, vocabulary()).orderBy("n_tokens").collect()
    assert [(r.n_tokens, float(r["score"])) for r in rows[:2]] == [(0, 0.0)] * 2 and np.isfinite(float(rows[2]["score"]))
    assert lm.scored(make_docs([]), models, vocabulary()).count() == 0


def test_pairs_that_tasks_do_not_hold_change_no_score(spark, make_docs):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "conversations")
    odd = docs.select("doc_id", "text").limit(30).union(make_docs([(None, "never seen xq zv", "s"), (None, "a b", "s"), (7, None, "s")]).select("doc_id", "text"))
    whole, few, none = (lm.learn(target, docs, vocabulary(), **size) for size in ({}, {"max_pairs": 500}, {"max_pairs": 0}))
    assert 0 < len(few.pairs) <= 500 < len(whole.pairs) == len(few.pairs) + few.rest.count() and len(none.pairs) == 0
    first, *others = ([[r.n_tokens, r.target_loss, r.background_loss, r["score"]] for r in
                       lm.scored(odd, m, vocabulary()).orderBy("doc_id", "text").collect()] for m in (whole, few, none))
    assert len(first) == odd.count()
    for other in others:
        assert other == [pytest.approx(row, rel=1e-6, abs=1e-6) for row in first]


def test_rows_keep_their_columns(spark, make_docs):
    models = lm.learn(make_docs([(1, "a b", "s")]), make_docs([(1, "b c", "s")]), vocabulary(), max_pairs=0)
    docs = make_docs([(1, "a b", "s"), (1, "b c", "s")])
    assert sorted(lm.scored(docs, models, vocabulary()).columns) == sorted({*docs.columns, "n_tokens", "target_loss", "background_loss", "score"})
    clashing = docs.withColumns({"row": docs.doc_id, "Losses": docs.doc_id, "target": docs.doc_id, "_row": docs.doc_id})
    assert {"row", "Losses", "target", "_row"} <= set(lm.scored(clashing, models, vocabulary()).columns)
    assert "text" not in lm.scored(docs, models, vocabulary(), keep_text=False).columns
