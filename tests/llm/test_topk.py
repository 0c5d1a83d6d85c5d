import math

import numpy as np

from panelcast.llm.topk import top_k

TYPE = "vec_id long, embedding array<double>, label int, score string, rank string"


def by_hand(rows, queries, k, scale=256):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if i in queries}):
        own = min(v for i, v in whole if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q and len(v) == len(own))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def run(spark, rows, wanted, **options):
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], TYPE)
    return sorted(map(tuple, top_k(df, df.where(df.vec_id.isin(list(wanted))), **options).collect()))


def test_against_all_products(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(1000, None), (1001, [1.0] * 5 + [None]), (1002, [math.nan] + [1.0] * 5), (1003, [math.inf] + [0.0] * 5),
             (None, [1.0] * 6), (1004, [1.0, 2.0]), (1005, [3.0, 2.0]), (20, [9.0] * 6), (40, rows[40][1])]
    rows += [(2000 + i, [0.5] * 6) for i in range(12)]  # ties
    wanted = {0, 20, 40, 60, 1000, 1002, 1004, 2001}
    expected = by_hand(rows, wanted, 5)
    assert run(spark, rows, wanted, tile_bytes=1, fan_in=2) == run(spark, rows, wanted) == expected


def test_products_beyond_exact_doubles(spark):
    rows = [(i, [float(2 ** 30 + i), float(2 ** 31 - 7 * i), -3.0]) for i in range(8)]
    assert run(spark, rows, {0, 3}, scale=1) == by_hand(rows, {0, 3}, 5, scale=1)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])], {0}) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0])], {0}) == []
    assert run(spark, [], {0}) == []
