from collections import defaultdict

import numpy as np
import xxhash

from matchstats.llm import simhash
from matchstats.llm.simhash import components_of, fingerprint, links, tile_links, with_fingerprints


def by_the_book(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_docs, monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 100)
    for row in odd_docs.select("text").collect():
        assert fingerprint(row.text) == by_the_book(row.text)
    assert fingerprint("ÀB c D") == by_the_book("ÀB c D")


def test_groups_equal_comparing_all(odd_docs):
    marked = with_fingerprints(odd_docs.select("doc_id", "text"))
    found = components_of(marked).collect()
    fps = sorted({r._fp & (2**64 - 1) for r in found})
    group = {fp: {fp} for fp in fps}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                group[a] |= group[b]
                for fp in group[b]:
                    group[fp] = group[a]
    least = defaultdict(list)
    for r in found:
        if r.doc_id is not None:
            least[id(group[r._fp & (2**64 - 1)])].append(r.doc_id)
    assert len(found) == odd_docs.count()
    for r in found:
        assert r.component_id == min(least[id(group[r._fp & (2**64 - 1)])], default=None)


def test_links_join_all_within_the_radius_and_no_others(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[:150] ^ (np.uint64(1) << random.integers(0, 64, 150, dtype=np.uint64))
    near ^= np.uint64(1) << random.integers(0, 64, 150, dtype=np.uint64)
    crowd = np.uint64(12345) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near, crowd])).view(np.int64)
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    found = links(frame, 3, tile=16).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() >= 0 for r in found)
    unsigned = fps.view(np.uint64)
    a, b = tile_links(unsigned, unsigned, 3)
    expected = {frozenset((int(fps[i]), int(fps[j]))) for i, j in zip(a, b, strict=True) if i != j}
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(r.a)] = find(r.b)
    joined = defaultdict(set)
    for f in root:
        joined[find(f)].add(f)
    true = {f: f for f in root}

    def follow(x):
        while true[x] != x:
            x = true[x]
        return x

    for pair in expected:
        x, y = pair
        true[follow(x)] = follow(y)
    classes = defaultdict(set)
    for f in true:
        classes[follow(f)].add(f)
    assert sorted(map(sorted, joined.values())) == sorted(map(sorted, classes.values()))


def test_no_documents(no_docs):
    assert components_of(with_fingerprints(no_docs)).count() == 0
