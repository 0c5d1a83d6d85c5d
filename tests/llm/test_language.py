import itertools
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import language
from panelcast.llm.queries import op3
from panelcast.llm.staging import table

SMALL = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(6)
    scores, transitions, start = rng.normal(size=(2, 5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    there = np.array([[True] * 5, [True] * 3 + [False] * 2])
    posterior, pairs = language.forward_backward(scores, there, transitions, np.exp(start))
    expected_pairs = np.zeros((3, 3))
    for text, length in ((0, 5), (1, 3)):
        total, marks, moves = 0.0, np.zeros((length, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=length):
            weight = np.exp(start[path[0]] + sum(scores[text, t, k] for t, k in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t, k in enumerate(path):
                marks[t, k] += weight
            for a, b in zip(path, path[1:]):
                moves[a, b] += weight
        assert np.allclose(posterior[text, :length], marks / total)
        expected_pairs += moves / total
    assert np.allclose(pairs, expected_pairs)


def trained():
    runs = [("the and of with that house".split() * 8, "en"), ("der und von mit dass haus".split() * 8, "de")] * 10
    return language.train([w for w, _ in runs], [label for _, label in runs])


def test_code_switching_and_undetermined_texts():
    model = trained()
    names, shares = model.predict(["The house and of", "von mit der haus", None, "", " 12 !", "the and of with " * 3 + "der und"])
    assert names == ["en", "de", "und", "und", "und", "en"] and shares[2:5] == [0.0] * 3
    words = ("the and of with that " * 3 + "der und von mit dass " * 3).split()
    posterior = model.marginals(model.emissions(words), np.array([len(words)]))
    assert [model.languages[k] for k in posterior.argmax(axis=1)] == ["en"] * 15 + ["de"] * 15


def test_blocks_give_the_posteriors_of_the_whole(monkeypatch):
    model = trained()
    words = ("the and of zzz with " * 150 + "der und yyy von " * 150).split()
    scores, lengths = model.emissions(words), np.array([len(words)])
    monkeypatch.setattr(language, "BLOCK", 10_000)
    whole = model.marginals(scores, lengths)
    monkeypatch.setattr(language, "BLOCK", 50)
    assert np.abs(model.marginals(scores, lengths) - whole).max() < 1e-9


def test_messages_between_blocks_are_exact(monkeypatch):
    """Nearly undecided words and transitions that hardly ever switch: the first word still counts at the last one."""
    rng = np.random.default_rng(1)
    lengths = np.array([700, 1, 0, 128, 64, 129, 301])
    scores = rng.normal(scale=0.002, size=(lengths.sum(), 3))
    scores[0] += [6, 0, 0]
    model = language.LanguageModel(["a", "b", "c"], transitions=np.where(np.eye(3), 0.0, -9.0), start=rng.normal(size=3))
    whole = np.concatenate([
        language.forward_backward(scores[None, at:at + n], np.ones((1, n), bool), model.transitions, np.exp(model.start))[0][0]
        for at, n in zip(lengths.cumsum() - lengths, lengths) if n])
    for block, numbers in ((64, 1 << 20), (7, 1 << 20), (1, 100), (512, 1)):
        monkeypatch.setattr(language, "BLOCK", block)
        monkeypatch.setattr(language, "GROUP_NUMBERS", numbers)
        assert np.abs(model.marginals(scores, lengths) - whole).max() < 1e-12
    flipped = scores.copy()
    flipped[0] = [0, 6, 0]
    assert np.abs(model.marginals(flipped, lengths)[500] - whole[500]).max() > 1e-3


def test_the_sample_covers_all_languages_and_sorts_none_in_one_task(spark):
    rows = [(i, "hot") for i in range(3000)] + [(10_000 + i, f"l{i % 300:03d}") for i in range(900)] + [(10_000, "l000")] * 5
    ids = spark.createDataFrame(rows, "_id long, lang string").repartition(4)
    picked = language.sampled_ids(ids, 600)
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in picked.collect()]
    counts = Counter(lang for _, lang in got)
    assert len(got) == len(set(got)) == 600 and len(counts) == 301
    assert all(counts[f"l{i:03d}"] >= 1 for i in range(300)) and set(got) <= set(rows)
    assert sorted(got) == sorted(tuple(r) for r in language.sampled_ids(ids.repartition(7), 600).collect())
    assert language.sampled_ids(ids.limit(0), 600).count() == 0


def test_typical_words_against_counting(spark):
    texts = [("en", " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(4000)))] * 5
    texts += [("de", "Haus und und und und und worda wordaaa"), ("en", "und"), ("de", "12 !"), ("en", "")]
    counts = Counter((w, lang) for lang, t in texts for w in language.WORD.findall(t.lower()))
    total = Counter()
    for (w, _), n in counts.items():
        total[w] += n
    expected = {w: lang for (w, lang), n in counts.items() if n >= 5 and n >= 0.9 * total[w]}
    got = language.typical_words(spark.createDataFrame(texts, "lang string, text string").repartition(3))
    assert got == expected and len(got) == 3999 and "und" not in got and not any(re.search(r"\d", w) for w in got)


def test_words_of_one_batch_do_not_mix():
    words = ["ab", "abc", "x", "ab"]
    together, owner = language.buckets(words)
    for i, word in enumerate(words):
        assert sorted(together[owner == i]) == sorted(language.buckets([word])[0])


def test_held_out_languages(spark):
    df = op3(spark, SMALL)
    docs = table(spark, SMALL, "documents")
    assert df.columns == ["doc_id", "held_out", "lang_pred", "score"] and df.count() == docs.count()
    rows = df.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_learned_and_an_empty_table(spark, make_docs):
    model = language.train([], [])
    docs = make_docs([(1, "the of", "s"), (None, None, "s")])
    assert {(r.lang_pred, r.score) for r in language.labelled(docs, model).collect()} == {("und", 0.0)}
    assert language.labelled(make_docs([]), trained()).count() == 0


def test_a_rare_language_has_its_share_of_the_sample(spark):
    rows = [(i, "en", f"the and of with that house {i}") for i in range(600)] + [(1000 + i, "xx", "zuk zak zok zik bruz " * 8) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = language.fit(docs, F.lit(True), limit=20)
    assert model.languages == ["en", "xx"] and model.predict(["zuk zok bruz zik zak", "the house of that"])[0] == ["xx", "en"]


def test_clashing_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "the and of", "x", "y", 0.5)] * 2 + [(2, "der und", "x", "y", 0.5)],
                                 "doc_id long, text string, _language string, Lang_Pred string, score double")
    got = language.labelled(docs, trained())
    assert sorted(c.lower() for c in got.columns) == ["_language", "doc_id", "lang_pred", "score", "text"]
    assert sorted((r[0], r["_language"], r["lang_pred"]) for r in got.collect()) == [(1, "x", "en"), (1, "x", "en"), (2, "x", "de")]
