import re

import pytest
from odd_texts import SECRET, prose

import corpus_pipeline
from matchstats.llm import pieces
from matchstats.llm.simhash import fingerprint


@pytest.fixture(scope="module")
def sf_dir(spark, odd_docs, items, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    odd_docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def results(spark, odd_docs, sf_dir, tmp_path_factory):
    folder, docs, found = str(tmp_path_factory.mktemp("stages")), odd_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs
    return found


def test_columns(odd_docs, results):
    for name in ("language", "near_copies", "benchmark", "secrets"):
        assert results[name].schema.simpleString() == odd_docs.schema.simpleString()


def test_documents_without_a_language_go(odd_docs, results):
    before, after = odd_docs.collect(), results["language"].collect()
    lettered = [r for r in before if any(c.isalpha() for c in r.text or "")]
    assert {r.text for r in after} <= {r.text for r in lettered}
    assert {prose(n) for n in range(10, 30)} <= {r.text for r in after}
    assert all(r.lang for r in after)


def test_one_document_of_each_group_stays(results):
    before, after = results["language"].collect(), results["near_copies"].collect()
    fps = {r.text: fingerprint(r.text) for r in before}
    groups = [{fp} for fp in set(fps.values())]
    merged = True
    while merged:
        merged = False
        for a in groups:
            for b in groups:
                if a is not b and any((x ^ y).bit_count() <= 3 for x in a for y in b):
                    a |= b
                    groups.remove(b)
                    merged = True
                    break
            if merged:
                break
    kept = sorted(
        min((r.doc_id is None, r.doc_id or 0) for r in before if fps[r.text] in group) for group in groups
    )
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == kept


def test_leaking_documents_go(results):
    before, after = results["near_copies"].collect(), results["benchmark"].collect()
    gone = {r.text for r in before} - {r.text for r in after}
    assert {r.text for r in before if "alpha beta" in re.sub("[^a-z]+", " ", r.text.lower()) or r.text == "one"} == gone


def test_secrets_are_replaced(results):
    before = {r.doc_id: r for r in results["benchmark"].collect()}
    after = {r.doc_id: r for r in results["secrets"].collect()}
    assert before.keys() == after.keys()
    changed = {k for k in before if before[k].text != after[k].text}
    assert {before[k].text for k in changed} == {"a" * 5000, *(r.text for r in before.values() if SECRET in r.text)}
    for k in changed:
        assert after[k].text in ("<hex>", before[k].text.replace(SECRET, "<assign>\" and <access>"))
        assert after[k].n_chars == len(after[k].text)
    assert all(before[k].n_chars == after[k].n_chars for k in before.keys() - changed)


def test_ids_decode_to_the_texts(results):
    texts = {r.doc_id: r.text for r in results["secrets"].collect()}
    rows = results["pieces"].collect()
    assert {r.doc_id for r in rows} == texts.keys() and all(r.exact for r in rows)
    assert all(pieces.pieces().decode(r.ids) == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)


def test_run_goes_through_all_stages(spark, sf_dir, results):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(str, found)) == sorted(map(str, results["pieces"].collect()))


def test_no_documents(spark, no_docs, sf_dir):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_registered():
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5
