import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from matchstats.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def by_hand(sizes):
    """Exact targets of sources by sharing out round after round."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {name: 1 + n % 3 for n, name in enumerate(names)}
    left, open_, target = Fraction(sum(sizes.values())), set(names), dict.fromkeys(names, Fraction(0))
    while open_ and left:
        shares = sum(weight[n] for n in open_)
        for n in open_:
            target[n] += left * weight[n] / shares
        left = sum(max(Fraction(0), target[n] - 3 * sizes[n]) for n in open_)
        over = {n for n in open_ if target[n] >= 3 * sizes[n]}
        for n in over:
            target[n] = Fraction(3 * sizes[n])
        open_ -= over
    return target


def expected(rows):
    totals = defaultdict(int)
    for _, text, _, source, _ in rows:
        totals[source] += size(text)
    targets, found = by_hand(totals), []
    for doc_id, text, _, source, _ in rows:
        own = str(doc_id) if doc_id is not None else hashlib.md5(text.encode()).hexdigest() if text is not None else ""
        drawn = int(hashlib.md5(f"mix:{own}".encode()).hexdigest()[:13], 16) / 16**13
        rate = float(targets[source]) / totals[source] if totals[source] else 0.0
        taken = size(text) * (math.floor(rate) + (drawn < rate - math.floor(rate)))
        found.append((doc_id, size(text), totals[source], float(targets[source]), taken))
    return found


def near(found, wanted):
    found, wanted = sorted(map(tuple, found), key=str), sorted(wanted, key=str)
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted, strict=True):
        assert a[:3] == b[:3] and a[4] == b[4] and a[3] == pytest.approx(b[3], rel=1e-12)


def test_odd_documents(spark, odd_docs, plain_rows, monkeypatch):
    monkeypatch.setattr(mixing, "documents", lambda *_: odd_docs)
    near(mixing.op13_source_mixing(spark, "").collect(), expected(plain_rows))


@pytest.mark.parametrize("seed", range(6))
def test_limits_and_sharing_out_again(spark, seed, monkeypatch):
    sizes = [(n * 37 + seed * 11) % 40 + (400 if n == seed else 0) + (0 if n % 5 else 1) for n in range(12)]
    names = [None, "", "Z", "a", "é", "", "😀", "b", "c", "d", "e", "f"]
    rows = [(100 * n + k, "w " * (1 + k % 3), "en", names[n], None) for n, s in enumerate(sizes) for k in range(s)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(mixing, "documents", lambda *_: docs)
    near(mixing.op13_source_mixing(spark, "").collect(), expected(rows))


def test_mix_comes_near_its_targets_and_is_the_same_again(spark):
    rows = [(n, "word " * (1 + n % 50), "en", f"s{n % 7 if n % 3 else 0}", None) for n in range(20000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    first = mixing.mixed(docs).toPandas()
    again = mixing.mixed(docs.repartition(13)).toPandas()
    key = ["doc_id", "copy"]
    assert first.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    wanted = {r["source"]: r["target"] for r in mixing.targets(docs.select("source", mixing.words().alias("size"))).collect()}
    for source, words in first.groupby("source")["size"].sum().items():
        assert words == pytest.approx(wanted[source], rel=0.05)
    assert first.groupby("doc_id")["copy"].max().max() <= 3


def test_sources_without_words(spark):
    rows = [(1, None, None, "a", None), (2, "", None, "b", None), (3, " \n", None, None, None)]
    found = mixing.copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["size"], r.target, r.copies) for r in found] == [(0, 0.0, 0)] * 3


def test_no_documents(no_docs):
    assert mixing.copies(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
