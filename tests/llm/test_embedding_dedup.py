import math

import duckdb
import numpy as np
import pandas as pd

from panelcast.llm.embed_dedup import near_duplicates
from panelcast.llm.sql import EMBEDDING_DEDUP
from tests.llm.conftest import components

TYPE = "vec_id long, embedding array<float>, label int, links string, rep string"


def by_hand(rows):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = {i: (label, unit(v)) for i, v, label in rows}
    links = [(a, b) for a in units for b in units if a < b and units[a][0] is not None and units[a][0] == units[b][0]
             and units[a][1] is not None and units[b][1] is not None and len(units[a][1]) == len(units[b][1])
             and units[a][1] @ units[b][1] >= 0.98]
    count = {i: sum(i in pair for pair in links) for i in units}
    return {i: (count[i], c, i == c) for i, c in components(units, links).items()}


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, g, "", "") for i, v, g in rows], TYPE)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df, **options).collect()}


def clusters(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for size, noise in ((1, 0), (1, 0), (5, 0.01), (30, 0.012), (12, 0.02)):
            centre = rng.normal(size=32)
            centre /= np.linalg.norm(centre)
            rows += [(len(rows) + 500 * label + i, (centre + noise * rng.normal(size=32)).tolist(), label) for i in range(size)]
    copy = rows[3][1]
    rows += [(2000 + i, copy, 0) for i in range(6)] + [(2100, copy, 1), (2101, copy, None), (2102, [2 * x for x in copy], 0)]
    rows += [(3000, None, 0), (3001, [0.0] * 32, 0), (3002, [math.nan] * 32, 0), (3003, [None] * 32, 0), (3004, [], 0),
             (3005, [1.0, 1.0], 0), (3006, [1.0, 1.0], 0), (3007, [math.inf] * 32, 0)]
    return rows


def test_against_all_cosines(spark):
    rows = clusters()
    expected = by_hand(rows)
    assert run(spark, rows) == expected
    assert run(spark, rows, tile_rows=4) == expected  # buckets of many tiles


def test_null_ids_repeated_rows_and_an_empty_table(spark):
    near, far = [1.0, 0.01], [0.0, 1.0]
    rows = [(None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, far, 0), (2, near, 0), (3, far, 0), (4, near, 0), (4, near, 0),
            (5, [1.0, 0.0], 1), (6, None, 0), (6, None, 0)]
    df = spark.createDataFrame([(i, v, g, "", "") for i, v, g in rows], TYPE)
    nodes = {(i, tuple(v), g) for i, v, g in rows if i is not None and v}
    cosine = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    links = [(a, b) for a in nodes for b in nodes if a != b and a[2] == b[2] and cosine(a[1], b[1]) >= 0.98]
    reach = components([i for i in range(1, 7)], [(a[0], b[0]) for a, b in links])
    want = [(i or -1, sum(a == (i, tuple(v or ()), g) for a, _ in links), reach.get(i, -1), reach.get(i) == i) for i, v, g in rows]
    got = near_duplicates(df).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in got) == sorted(want)
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame([(i, v, g) for i, v, g in rows if i is not None], columns=["vec_id", "embedding", "label"]))
    sql = con.execute(f"select vec_id, n_links, component_id, kept from ({EMBEDDING_DEDUP})").fetchall()
    assert sorted(sql) == sorted(w for w in want if w[0] > 0)
    assert run(spark, []) == {}
