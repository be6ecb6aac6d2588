import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from matchstats.llm import merkle


def h(texts):
    return sha256("".join(texts).encode("utf-8")).hexdigest()


def framed(value):
    if value is None:
        return "-"
    value = str(value)
    return f"{len(value.encode('utf-8'))}:{value}"


def layers(nodes):
    """All levels of a tree, whole."""
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h(last[at : at + 3]) for at in range(0, len(last), 3)])
    return found


def path(tree, place):
    """The others of each run, and the place in it, from the leaf on."""
    steps = []
    for level in tree[:-1]:
        run = level[place // 3 * 3 : place // 3 * 3 + 3]
        steps.append((place % 3, run[: place % 3] + run[place % 3 + 1 :]))
        place //= 3
    return steps


def by_hand(rows):
    """Expected results of rows (doc_id, text, lang, source, n_chars)."""
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = h(map(framed, (doc_id, source, lang, n_chars, text)))
        changed = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text:
            changed = h(map(framed, (doc_id, source, lang, n_chars, text.replace("\n", ""))))
        trees[source].append((doc_id is not None, doc_id or 0, leaf, changed))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {name: layers([leaf for _, _, leaf, _ in sorted(trees[name])]) for name in names}
    top = layers([built[name][-1][0] for name in names])
    found = []
    for at, name in enumerate(names):
        for place, (known, doc_id, leaf, changed) in enumerate(sorted(trees[name])):
            steps = path(built[name], place) + path(top, at)
            node = changed
            for digit, others in steps:
                node = h([*others[:digit], node, *others[digit:]])
            proof = h(o for _, others in steps for o in others)
            found.append((doc_id if known else None, leaf, built[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return found


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def query(spark, docs, monkeypatch):
    monkeypatch.setattr(merkle, "documents", lambda *_: docs)
    return [tuple(r) for r in merkle.op12_merkle_manifest(spark, "").select(COLUMNS).collect()]


def ordered(rows):
    return sorted(rows, key=str)


def test_odd_documents(spark, odd_docs, plain_rows, monkeypatch):
    assert ordered(query(spark, odd_docs, monkeypatch)) == ordered(by_hand(plain_rows))


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_many_blocks_and_sources(spark, levels, monkeypatch):
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda docs, text: whole(docs, text, levels))
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 100, *([1] * 30)]
    rows, doc_id = [], 0
    for n, size in enumerate(sizes):
        for _ in range(size):
            rows.append((doc_id * 7919 % 100003, f"line\n{doc_id}", "en", f"s{n}" if n else None, None))
            doc_id += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = query(spark, docs.repartition(5), monkeypatch)
    assert ordered(found) == ordered(by_hand(rows))
    assert 0 < sum(r[-1] for r in found) < len(found)


def test_names_are_ordered_by_bytes_and_empty_is_not_null(spark, monkeypatch):
    rows = [(n, "t", None, s, 1) for n, s in enumerate([None, "", "Z", "a", "é", "", "😀", "-"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert ordered(query(spark, docs, monkeypatch)) == ordered(by_hand(rows))


def test_changed_records_do_not_verify(spark):
    rows = [(n, f"t{n}", "en", "s", n) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.manifest(docs, F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text"))).collect()
    assert {r.doc_id for r in found if r.folded_root != r.root} == {7}


def test_records_lead_from_the_top_to_every_leaf():
    leaves = [h([str(n)]) for n in range(2000)]
    top, store = merkle.records(leaves, True)
    assert all(merkle.digest(children) == key for key, children in store.items())
    for place in (0, 1, 1234, 1999):
        steps = merkle.descend(top, store, place, 7)
        assert merkle.fold(leaves[place], steps[::-1]) == top


def test_no_documents(spark, no_docs, monkeypatch):
    assert query(spark, no_docs, monkeypatch) == []
