import random

import pytest

from panelcast.llm.minhash import NearDuplicates, keep_one
from tests.llm.conftest import components

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(ASCII).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def by_hand(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c, i == c) for i, c in components(sets, links).items()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, out = prose(60), {}
    for _ in range(12):
        base = prose(rng.randrange(40, 200))
        for _ in range(rng.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out[len(out)] = " ".join(words)
    hot = prose(120)  # a large group of near copies, some of them too far from each other
    for _ in range(40):
        words = list(hot)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out[len(out)] = " ".join(words)
    for _ in range(30):  # a passage that many documents share
        out[len(out)] = " ".join(prose(rng.randrange(5, 60)) + passage + prose(rng.randrange(5, 60)))
    out |= {900: None, 901: "", 902: " \n\t", 903: "Two words", 904: "two  WORDS", 905: "ÄB c", 906: "äB c", 907: "one",
            908: "a b c d e", 909: "A B C D E", 910: "a b c d e f", 911: " ".join(hot) * 60}
    return out


def test_against_all_pairs(spark, make_docs, texts):
    docs = make_docs([(i, t, "s") for i, t in texts.items()])
    expected = by_hand(texts)
    for near in (NearDuplicates(), NearDuplicates(tile_rows=3)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.classify(docs.repartition(3)).collect()}
        assert got == expected


def rows_by_hand(rows):
    """Components of rows: those with one id and words are one document, near ones are linked."""
    sets = [shingles(t) for _, t in rows]
    alike = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    links = [(a, b) for a in range(len(rows)) for b in range(a) if alike(a, b) or sets[a] and sets[b] and rows[a][0] is not None and rows[a][0] == rows[b][0]]
    of = components(range(len(rows)), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[of[k]] = min((x for x in (least.get(of[k]), i) if x is not None), default=None)
    return [(i, len(sets[k]), least[of[k]] if sets[k] else i, i == (least[of[k]] if sets[k] else i)) for k, (i, _) in enumerate(rows)], of, sets


def test_null_and_repeated_ids(spark, make_docs, texts):
    a, b = texts[0], texts[20]
    near_a, near_b = a + " more", b + " more"
    lone = " ".join(f"q{i}" for i in range(40))
    rows = [(3, a), (7, a), (7, b), (9, near_b), (None, near_a), (None, a), (None, lone), (None, lone), (None, lone + " x"), (None, "x y"),
            (11, "z w"), (11, "z w"), (12, ""), (12, None), (None, ""), (None, None), (13, "u v"), (13, ""), (14, "p"), (15, "P")]
    want, of, sets = rows_by_hand(rows)
    docs = make_docs([(i, t, "s") for i, t in rows])
    found = NearDuplicates().classify(docs).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)
    kept = keep_one(docs.withColumnsRenamed({"start": "mark", "size": "print"}), NearDuplicates())
    assert kept.columns == ["doc_id", "text", "lang", "source", "mark", "print", "score"]
    kept = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    groups = {of[k] for k in range(len(rows)) if sets[k]}
    assert sum(bool(shingles(t)) for _, t in kept) == len(groups)
    assert [x for x in kept if x[0] in (3, 7, 9)] == [(3, a)] and len([x for x in kept if x[0] is None and not x[1]]) == 2
    assert sum(x[0] == 12 for x in kept) == 1 and sum(x[0] == 11 for x in kept) == 1 and sum(x[0] == 13 for x in kept) == 2


def test_empty_table(spark, make_docs):
    assert NearDuplicates().classify(make_docs([])).count() == 0
