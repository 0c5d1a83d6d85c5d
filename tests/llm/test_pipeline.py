import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from panelcast.llm import pii, toxicity
from panelcast.llm.labelled import remainder
from panelcast.llm.staging import table
from tests.llm.test_minhash import by_hand
from tests.llm.test_mixing import by_hand as targets
from tests.llm.test_packing import reference_ids

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of every stage and the result, each written and read again."""
    folder, docs, out = str(tmp_path_factory.mktemp("stages")), table(spark, SMALL, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return [*out, docs]


def test_names_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    for df in stages[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_all_others_stay(spark, stages):
    model = toxicity.fit(stages[0], table(spark, SMALL, "labels"), remainder(F.col("doc_id"), 5) > 0)
    rows = stages[0].collect()
    expected = {r.doc_id for r, score in zip(rows, model.scores([r.text for r in rows])) if score < 0.5}
    assert {r.doc_id for r in stages[1].collect()} == expected and len(expected) < len(rows)
    clean = {r.doc_id for r in table(spark, SMALL, "labels").where("toxic = 0").collect()}
    assert clean <= expected


def test_one_document_of_each_group_stays(stages):
    kept = by_hand({r.doc_id: r.text for r in stages[1].collect()})
    assert {r.doc_id for r in stages[2].collect()} == {i for i, (_, _, keep) in kept.items() if keep}


def test_personal_data_is_replaced(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[2:4])
    assert set(before) == set(after)
    private = {(kind, value) for r in before.values() for _, _, kind, value in pii.entities(r.text or "")}
    assert private
    for doc_id, r in after.items():
        assert r.n_chars == len(r.text) or r.text == before[doc_id].text
        if not pii.entities(before[doc_id].text or ""):
            assert r == before[doc_id]
        assert not {(kind, value) for _, _, kind, value in pii.entities(r.text or "") if kind != "IP"} & private


def test_mix_repeats_documents_to_the_targets(stages):
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    sizes, taken = {}, {}
    for df, into in ((stages[3], sizes), (stages[4], taken)):
        for r in df.collect():
            into[r.source] = into.get(r.source, 0) + size(r)
    assert taken == {s: round(t) for s, t in targets(sizes).items()}


def test_packing_holds_every_copy(stages):
    rows = stages[4].collect()
    total = {}
    pieces = stages[5].collect()
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert set(total) == {r.doc_id for r in rows}
    single = {r.doc_id: r.text for r in rows if sum(o.doc_id == r.doc_id for o in rows) == 1}
    picked = [r for r in pieces if r.doc_id in single]
    for doc_id in list(single)[:50]:
        assert total[doc_id] == len(reference_ids(single[doc_id]))
    lengths = {}
    for r in pieces:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert picked and all(n == 1024 or n < 1024 and n & (n - 1) == 0 for n in lengths.values())


def test_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
