import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def make_docs(spark):
    """Documents with columns whose names the operators also use."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, "x", -1, "y") for i, t, s in rows],
            "doc_id long, text string, lang string, source string, start string, size int, score string")
    return make


def components(nodes, links):
    """Smallest node reachable from each node, by hand."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
