import zlib
from collections import defaultdict

import numpy as np
import pytest

from matchstats.llm import sharding


def smallest_capacity(sizes: list[int], shards: int) -> int:
    def fits(capacity: int) -> bool:
        used, held = 1, 0
        for size in sizes:
            if held + size > capacity:
                used, held = used + 1, 0
            held += size
            if size > capacity:
                return False
        return used <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("seed", range(40))
def test_minimax_is_exact_with_few_known_boundaries(seed):
    random = np.random.default_rng(seed)
    sizes = random.integers(1, 50, random.integers(1, 300)) if seed % 2 else (random.pareto(1, random.integers(1, 300)) * 20).astype(int) + 1
    shards, upto = int(random.integers(1, 12)), np.cumsum(sizes)

    def ask(windows, width):
        inside = np.zeros(len(upto), bool)
        for start, end in windows:
            inside |= (upto > start) & (upto <= end)
        chosen = upto[inside]
        steps = chosen // width
        return np.array([(chosen[steps == s].min(), chosen[steps == s].max(), (steps == s).sum()) for s in np.unique(steps)], np.int64).reshape(-1, 3)

    known = int(random.choice([4, 20, 100, 1000]))
    capacity, cuts = sharding.minimax_cuts(int(upto[-1]), int(sizes.max()), shards, ask, known)
    assert capacity == smallest_capacity(sizes.tolist(), shards)
    ends = [0, *cuts, int(upto[-1])]
    assert all(0 <= b - a <= capacity for a, b in zip(ends, ends[1:], strict=False))
    assert set(cuts) <= {0, *upto.tolist()}


def test_every_row_has_a_slot_and_equal_texts_a_shard(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    found = sharding.shard(odd_docs, shards=4, known=8).collect()
    assert len(found) == len(rows)
    expected = sorted((str(r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == expected
    shards, texts = defaultdict(list), defaultdict(set)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 4
        shards[r.shard].append(r.slot)
        texts[r.text_crc32].add(r.shard)
    assert all(len(held) == 1 for held in texts.values())
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())


def test_a_group_beyond_an_even_share_stands_alone(spark):
    rows = [(n, "x" * 5000) for n in range(40)] + [(100 + n, f"text {n} " * 10) for n in range(400)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=5).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    giant = found[found["doc_id"] < 100]["shard"].unique()
    assert len(giant) == 1 and (found[found["shard"] == giant[0]]["doc_id"] < 100).all()
    others = sizes.drop(giant[0])
    assert len(others) == 4 and others.max() - others.min() <= 2 * 120


def test_no_documents(no_docs):
    assert sharding.shard(no_docs).count() == 0
