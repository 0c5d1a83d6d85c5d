import random
import re
import zlib
from collections import Counter

import pytest

from panelcast.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, form string, i int, p long"


def by_hand(rows):
    """Counts, and every pair of words compared letter by letter."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 6
    counts = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    others = {w: [x for x in counts if near(w, x)] for w in counts}
    best = {w: min(o, key=lambda x: (-counts[x], x)) for w, o in others.items() if o}
    form = {w: b for w, b in best.items() if counts[b] >= 5 * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(others[w]), counts.get(form.get(w))) for w, n in counts.items()}


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2, 3) for i, t in rows], SCHEMA)
    got = [tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_all_words_at_one_edit_and_their_forms(spark):
    rng = random.Random(3)
    base = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abaaaa", "éclaire", "éclair", "eclaire", "Ångström", "mississippi", "missisippi", "mississipi"]
    rows = []
    for i in range(60):
        words = []
        for _ in range(40):
            w = rng.choice(base[:2] if rng.random() < 0.5 else base)
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "s", "é", w[at] * 2]) + w[at + 1:]
            words.append(w if rng.random() < 0.8 else w.upper())
        rows.append((i, " ".join(words) + "×, ẞıx1"))
    want = by_hand(rows)
    assert found(spark, rows) == want
    assert any(f and r != f for _, f, r, *_ in want) or len(want) > 20


def test_chains_of_forms_end_at_their_root(spark):
    rows = [(1, " ".join(["abcdefgh"] * 800 + ["abcdefg"] * 150 + ["abcdef"] * 25 + ["abcdeh"] * 5))]
    got = {w: (f, r) for w, f, r, *_ in found(spark, rows)}
    assert got["abcdeh"] == ("abcdef", "abcdefgh") and got["abcdef"] == ("abcdefg", "abcdefgh") and got["abcdefgh"] == (None, "abcdefgh")
    assert found(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("rows", [
    [],
    [(1, None), (2, ""), (None, "123 ... --")],
    [(None, "letters letters letters"), (None, "letters letters"), (1, "short five5 words")],
    [(7, "letter letters " * 3), (7, "letter letters " * 3)],
    [(1, "x" * 30_000 + " " + "longer " * 50_000)] + [(i, "x" * 30_000) for i in range(4)],
])
def test_odd_rows(spark, rows):
    assert found(spark, rows) == by_hand(rows)
