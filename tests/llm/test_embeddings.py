import math

import numpy as np
import pytest

from matchstats.llm import embeddings
from matchstats.llm.embeddings import MultiIndex, multi_sequence, near_duplicates, unit


def expected(rows, threshold=0.95):
    good = {}
    for n, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[n] = np.array(v, np.float64)
    linked = {n: set() for n in range(len(rows))}
    for a, x in good.items():
        for b, y in good.items():
            if a != b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                linked[a].add(b)
    found = []
    for n, (vec_id, _) in enumerate(rows):
        seen, queue = {n}, [n]
        while queue:
            for m in linked[queue.pop()] - seen:
                seen.add(m)
                queue.append(m)
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        found.append((str(vec_id), len(linked[n]), str(min(ids, default=None))))
    return sorted(found)


def near(base, cosine, random):
    aside = random.standard_normal(len(base))
    aside -= aside @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)


@pytest.mark.parametrize("tile", [8, 512])
def test_links_and_components_equal_comparing_all(spark, tile):
    random = np.random.default_rng(4)
    bases = unit(random.standard_normal((60, 16)))
    rows = [(n, v.tolist()) for n, v in enumerate(bases)]
    for k, cosine in enumerate((0.97, 0.96, 0.955, 0.945, 0.99) * 12):
        rows.append((100 + k, near(bases[k], cosine, random).tolist()))
    rows += [(200 + k, near(bases[0], 0.999, random).tolist()) for k in range(40)]
    rows += [(300 + k, bases[1].tolist()) for k in range(40)] + [(400, (bases[1] * 3).tolist())]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 0.0], [2.0, 0.0]]
    rows += [(500 + k, v) for k, v in enumerate(odd)]
    rows += [(None, bases[2].tolist()), (None, None), rows[0], rows[0]]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("node", "cell", "copies", "key", "home", "label"):
        given = given.selectExpr("*", f"'x' AS {name}")
    found = near_duplicates(given, tile=tile, recall=1.0).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == expected(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)


def test_recall_against_comparing_all(spark):
    """The shape of the given vectors (64 components), with partners close to the threshold."""
    random = np.random.default_rng(6)
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = unit(np.array([r.embedding for r in given]))
    partners = np.array([near(v, cosine, random) for v, cosine in zip(vectors, (0.951, 0.96, 0.97, 0.99) * 500, strict=True)])
    vectors = np.concatenate([vectors, partners])
    links = (vectors @ vectors.T >= 0.95).sum(axis=1) - 1
    rows = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in near_duplicates(rows).collect()}
    assert len(found) == len(vectors) and all(found[n] <= links[n] for n in found)
    assert sum(found.values()) >= 0.99 * links.sum() > 3000


def test_traversal_goes_by_distance():
    random = np.random.default_rng(0)
    first, second = random.random(9), random.random(7)
    found = list(multi_sequence(first, second, 0.8))
    sums = [first[i] + second[j] for i, j in found]
    assert sums == sorted(sums) and len(set(found)) == len(found)
    assert len(found) == sum(a + b <= 0.8 for a in first for b in second)


def test_reach_finds_what_it_promises():
    random = np.random.default_rng(1)
    sample = unit(random.standard_normal((3000, 32)))
    index = MultiIndex(sample, 8, recall=0.99)
    others = unit(random.standard_normal((2000, 32)))
    partners = np.array([near(v, 0.95, random) for v in others])
    home, _ = index.visits(partners)
    _, visited = index.visits(others)
    assert np.mean([h in v for h, v in zip(home, visited, strict=True)]) > 0.97
    assert np.mean(list(map(len, visited))) < 64


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert embeddings.TILE > 0
