import random

from panelcast.llm.components import connected_components
from tests.llm.conftest import components


def test_random_graphs_chains_and_a_hub(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    edges += [(100 + i, 101 + i) for i in range(30)] + [(500, 501 + i) for i in range(200)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == components({n for e in real for n in e}, real)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
