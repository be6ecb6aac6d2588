import re

import pytest

from matchstats.llm.common import text_key
from matchstats.llm.decontaminate import leaks, lookups, sketches, words


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if 0 < len(words) < 5:
        words += [""] * (5 - len(words))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.mark.parametrize("block_rows", [200_000, 5])
def test_leaks_equal_exact_containment(odd_docs, items, block_rows):
    found = leaks(odd_docs, items, block_rows=block_rows)
    docs = odd_docs.select("text").distinct().select("text", text_key("text").alias("k")).collect()
    expected = set()
    for item in items.collect():
        own = shingles(item.text)
        for doc in docs:
            held = len(own & shingles(doc.text))
            if own and 10 * held >= 8 * len(own):
                expected.add((bytes(doc.k), item.item_id, len(own), held))
    rows = [(bytes(r.key), r.item_id, r.n_shingles, r.n_found) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
    assert {r[1] for r in rows} == {0, 1, None, 5}


def test_depth_follows_the_size(items):
    for row in sketches(items).groupBy("item_id", "item_key", "n", "needed").agg({"searched": "count"}).collect():
        assert row.needed == -(-8 * row.n // 10)
    counts = sketches(items).filter("searched").groupBy("item_id", "n", "needed").count().collect()
    assert all(r["count"] == r.n - r.needed + 1 for r in counts)


def test_no_rows(odd_docs, no_docs, items):
    assert leaks(no_docs, items).count() == 0
    assert leaks(odd_docs, items.limit(0)).count() == 0
    assert leaks(odd_docs, items.filter("item_id IN (3, 4, 6)")).count() == 0


def test_each_size_partition_bounds_its_lookups(spark):
    texts = spark.createDataFrame([(" ".join(f"w{n}x{i}" for i in range(9 + 90 * n)),) for n in range(2)], "text string")
    texts = texts.select(text_key("text").alias("key"), words("text").alias("_words"))
    # the hashes of one partition must not count for documents that are long enough only for another
    probes = spark.createDataFrame([(2, 0, 60), (5, 2**63 - 1, 90)], "part int, hash long, needed long")
    found = lookups(texts, probes).collect()
    assert {r._size for r in found} == {99}
    low = spark.createDataFrame([(2, 0, 3), (5, 2**63 - 1, 90)], "part int, hash long, needed long")
    found = lookups(texts, low).collect()
    assert len([r for r in found if r._size == 99]) == 95
    short = [r.hash for r in found if r._size == 9]
    assert len(short) < 5 and all(h <= 0 for h in short)
