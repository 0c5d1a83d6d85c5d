import re

import pytest

from panelcast.llm.mixing import mix, repeated


def by_hand(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return {s: float(cap * sizes[s]) for s in names}
        level = (total - sum(cap * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            return {s: float(cap * sizes[s]) if s in capped else level * weight[s] for s in names}
        capped |= over


@pytest.fixture
def docs(make_docs):
    rows, n = [], 0
    for source, count, words in (("a", 3, 2), ("b", 40, 5), ("c", 25, 3), ("ä", 9, 1), (None, 12, 4)):
        for _ in range(count):
            rows.append((n, " ".join(["w"] * (words + n % 3)), source))
            n += 1
    return make_docs([*rows, (n, None, "b"), (n + 1, " \x0b\t\n", "d"), (None, "no id here", "c"), (n + 2, "a b c d", "c")])


def test_targets_epochs_and_exact_budgets(spark, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    target = by_hand(sizes)
    rows = mix(docs, block_rows=7).collect()
    assert len(rows) == docs.count()
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert {s: round(target[s]) for s in sizes} == taken
    assert sorted(map(str, mix(docs.repartition(5), block_rows=100).collect())) == sorted(map(str, rows))


def test_copies_follow_the_mix(spark, docs):
    with_ids = docs.where("doc_id is not null")
    mixed = mix(with_ids)
    out = repeated(with_ids, mixed)
    assert out.columns == with_ids.columns
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + size(r.text)
    assert got == {r.doc_id: r.taken for r in mixed.collect() if r.taken}


def test_copies_of_rows_without_an_id(spark, make_docs):
    docs = make_docs([(None, f"a b c {'d ' * n}", "s") for n in (0, 0, 0, 1, 2)] + [(4, "x y", "s"), (4, "x y z", "s")])
    out = repeated(docs, mix(docs))
    assert sorted(r.text for r in out.collect()) == sorted(r.text for r in docs.collect())


def test_no_word_of_the_budget_is_lost_on_repeated_ids(spark, make_docs):
    docs = make_docs([(k // 5, "a b c d e f g", "st"[k % 2]) for k in range(40)] + [(None, "x y z", "u")] * 30)
    clashing = docs.withColumnsRenamed({"start": "_size", "size": "mix_take", "score": "mix_id"})
    mixed = mix(docs, weights=(5, 1, 3))
    out = repeated(clashing, mixed)
    assert out.columns == clashing.columns
    given = {s: sum(len(r.text.split()) for r in out.where(f"source = '{s}'").collect()) for s in "stu"}
    assert given == {s: sum(r.taken for r in mixed.where(f"source = '{s}'").collect()) for s in "stu"}
    assert sum(given.values()) > 300


def test_one_source_empty_texts_and_an_empty_table(spark, make_docs):
    one = mix(make_docs([(1, "a b", "s"), (2, "c", "s"), (2, "c", "s")])).collect()
    assert sorted((r.doc_id, r.taken) for r in one) == [(1, 2), (2, 1), (2, 1)]
    none = mix(make_docs([(1, None, "s"), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2
    assert mix(make_docs([])).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoopJoin" not in plan
