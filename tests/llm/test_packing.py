import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Reference

from panelcast.llm.packing import Packer, Tokenizer, pack
from panelcast.llm.queries import op1, vocabulary
from panelcast.llm.staging import table
from tests.llm.conftest import SF


def reference_ids(text):
    reference = Reference.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array([*reference.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def assert_packed(rows, texts, size):
    """Every id once, sequences gapless, full or as long as a power of two."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = reference_ids(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0


def test_round_trip_over_a_whole_table(spark):
    docs = table(spark, SF, "documents")
    assert_packed(op1(spark, SF).collect(), {r.doc_id: r.text for r in docs.collect()}, 1024)


def test_nulls_empty_long_and_clashing_columns(spark, make_docs):
    texts = {1: None, 2: "", 3: "a  b\n c's", 4: "word " * 5000, None: "no id", 6: "a <|endoftext|> é 日本<|endoftext|><|endoftext| >",
             7: "<|endoftext|>", 8: ("x" * 70 + " <|endoftext|> ") * 30_000}
    docs = make_docs([(i, t, "s") for i, t in texts.items()])
    rows = pack(docs.repartition(3), vocabulary(), size=64, windows=2, fan_in=2).collect()
    assert_packed(rows, texts, 64)
    assert [(r.length, r.doc_tokens) for r in rows if r.doc_id in (1, 2)] == [(1, 1)] * 2
    assert reference_ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275, 0]


def test_repeated_rows_are_packed_each_and_ids_are_kept(spark, make_docs):
    rows = pack(make_docs([(1, "one two", "s")] * 3), vocabulary(), keep_ids=True).collect()
    assert sum(r.length for r in rows) == 3 * len(reference_ids("one two"))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_empty_table(spark, make_docs):
    assert pack(make_docs([]), vocabulary()).count() == 0


def test_size_must_be_a_power_of_two(make_docs):
    with pytest.raises(ValueError):
        pack(make_docs([]), vocabulary(), size=1000)


def test_open_windows_are_bounded_and_best_fit():
    packer = Packer(8, 2, 0)
    packer.add(1, 5, 0, b"\1\0\0\0" * 5)
    packer.add(2, 3, 0, b"\2\0\0\0" * 4)
    packer.add(3, 3, 0, b"\3\0\0\0" * 3)  # fits both, best with the first
    assert [d[0] for d in packer.done] == [1, 3] and len(packer.open) == 1
    packer.add(4, 7, 0, b"\4\0\0\0" * 7)
    packer.add(5, 5, 0, b"\5\0\0\0" * 5)  # fits none: the fullest leaves, topped up
    assert len(packer.open) <= 2 and sum(d[2] for d in packer.done if d[5] == 1) == 8


def test_cutting_a_long_text_changes_no_id():
    tokenizer = Tokenizer.load(vocabulary())
    for text in ("a b  c\n\nd e" * 50, "don't we're 's  x " * 20, "日 本 語 " * 30, "x" * 100, " lead and trail "):
        whole = tokenizer.encode(text)
        assert whole == reference_ids(text)[:-1].tobytes()
        assert tokenizer.encode(text, 1) == tokenizer.encode(text, 13) == whole


@pytest.mark.parametrize("name", ["documents", "conversations", "pages", "benchmark"])
def test_ids_of_all_tables_are_those_of_the_library(spark, name):
    column = "html" if name == "pages" else "text"
    tokenizer, reference = Tokenizer.load(vocabulary()), Reference.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[0] for r in table(spark, SF, name).select(column).where(f"{column} is not null").collect()]
    for text, encoded in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(tokenizer.encode(text, part=500), "<u4").tolist() == encoded.ids
