import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from panelcast.llm import conversation_repair as cr
from panelcast.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part long, seg int, print binary, uid long, audit string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(shown).encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def by_hand(conv, rows):
    """All edit scripts, by plain recursion over rows and the initials given so far."""
    rows = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        kept = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def follows(initials, new):
        return {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}.get(initials[-1:], ()).__contains__(new)

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            added = faults[i] == "truncated"
            c, a, t = best(i + 1, last, 0)
            options.append((3 + c, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                if role and follows(last, role[0]):
                    c, a, t = best(i + 1, role[0], 0)
                    options.append((c + added, "K" + a, (f"{role}:{text}",) + t))
                for new in ("user", "assistant"):
                    if follows(last, new[0]):
                        c, a, t = best(i + 1, new[0], 0)
                        options.append((2 + c + added, "R" + a, (f"{new}:{text}",) + t))
        if inserted < 4:
            for new in ("user", "assistant"):
                if follows(last, new[0]):
                    c, a, t = best(i, new[0], inserted + 1)
                    options.append((2 + c, "I" + a, (f"{new}:",) + t))
        return min(options, default=(10**6, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def found(spark, rows, partitions=4):
    df = spark.createDataFrame([(*r, "c", 1, 2, b"p", 3, "a") for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in cr.repair(cr.damaged(df)).collect()), key=repr)


def conversation(rng, conv, size):
    texts = ["Yes.", "No!", "cut off", "Why?", " \t\n", "", "é ", "x" * 30 + ".", None]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "ubot"]
    return [(conv, rng.choice([None, t, t, t, t + 1, t * 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{t} says.") for t in range(size)]


def test_block_tables_equal_single_steps():
    rng = random.Random(1)
    tables = [cr.BlockTables(b) for b in (1, 2, 3, 4)]
    assert len(tables[0].vectors) < 32
    for _ in range(300):
        signs = bytes(rng.randrange(cr.SYMBOLS) for _ in range(rng.randrange(14)))
        at = rng.randrange(len(signs) + 1)
        traced = [t.trace(signs) for t in tables]
        assert all(x == traced[0] for x in traced)
        for t in tables:
            assert t.change(signs) == bytes(t.change(signs[:at])[v] for v in t.change(signs[at:]))
            left, state = t.trace(signs[:at], t.change(signs[at:])[0])
            right, state = t.trace(signs[at:], 0, state)
            assert (left + right, state) == traced[0]


def test_every_conversation_against_all_scripts(spark):
    rng = random.Random(2)
    rows = [r for conv in range(120) for r in conversation(rng, conv, rng.randrange(1, 9))]
    rows += conversation(rng, None, 6) + [(500, None, None, None), (501, 3, "user", "Hi."), (501, 3, "user", "Hi."), (501, 3, "assistant", "Hi.")]
    want = sorted((by_hand(conv, rows) for conv in {r[0] for r in rows}), key=repr)
    assert found(spark, rows) == want
    assert any(w[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for w in want)  # all rows dropped


def test_long_conversations_in_segments(spark, monkeypatch):
    rng = random.Random(3)
    rows = [r for conv, size in ((1, 230), (2, 3), (3, 90), (4, 1), (None, 70)) for r in conversation(rng, conv, size)]
    want = sorted((by_hand(conv, rows) for conv in {r[0] for r in rows}), key=repr)
    monkeypatch.setattr(cr, "SEGMENT_ROWS", 7)
    assert found(spark, rows) == want
    monkeypatch.setattr(cr, "SEGMENT_CHARACTERS", 100)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, 1) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(7, 0, "user", "Word! " * 500_000), (7, 1, "assistant", "?" * 3)], [(1, 1, "user", "Same.")] * 40])
def test_odd_rows(spark, rows):
    assert found(spark, rows) == sorted((by_hand(c, rows) for c in {r[0] for r in rows}), key=repr)


def test_query_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.001")
    assert got.columns[0] == "conv_id" and sorted(map(tuple, got.collect())) == sorted(by_hand(c, rows) for c in {r[0] for r in rows})
