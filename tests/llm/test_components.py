import numpy as np
import pytest

from matchstats.llm.components import components, forest


def roots(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize(
    "edges",
    [
        [(n, n + 1) for n in range(60)],
        [(0, n) for n in range(1, 200)] + [(n + 1000, n) for n in range(1, 200, 7)],
        [(int(a), int(b)) for a, b in np.random.default_rng(2).integers(0, 400, (300, 2))],
        [(5, 5), (7, 3), (3, 7), (3, 7)],
    ],
)
def test_components_equal_union_find(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long"))
    expected = {(x, r) for x, r in roots(edges).items() if x != r}
    assert {(r.node, r.root) for r in found.collect()} == expected and found.count() == len(expected)


def test_nulls_and_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(None, 1), (2, None)], "a long, b long")).count() == 0


def test_forest():
    edges = np.random.default_rng(1).integers(0, 300, (200, 2))
    expected = roots(edges.tolist())
    assert [expected.get(n, n) for n in range(300)] == forest(300, edges[:, 0], edges[:, 1]).tolist()
