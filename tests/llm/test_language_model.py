import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from matchstats.llm import gru
from matchstats.llm.gru import Adam, Network, Shape, flat, initial, lay_out, unflat
from matchstats.llm.language_model import TAIL, Vocabulary, op8_language_model, parted, score, tail_class


def doubled(shape):
    return Network(shape, {k: w.astype(np.float64) for k, w in initial(shape).items()})


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(gru.np, "float32", np.float64)
    random = np.random.default_rng(0)
    net = doubled(Shape(10, 3, 4, 5))
    read, told = random.integers(0, 14, (6, 3)), random.integers(0, 14, (6, 3))
    told[5, 2] = -1
    begins = np.zeros((6, 3), bool)
    begins[0], begins[3, 1] = True, True
    state = np.zeros((3, 5))
    grads, _, _ = net.gradients(read, told, begins, state)
    count, step = (told >= 0).sum(), 1e-5
    for name, weights in net.w.items():
        for _ in range(5):
            at = tuple(random.integers(0, n) for n in weights.shape)
            value = weights[at]
            weights[at] = value + step
            above = net.gradients(read, told, begins, state)[2]
            weights[at] = value - step
            below = net.gradients(read, told, begins, state)[2]
            weights[at] = value
            assert grads[name][at] == pytest.approx((above - below) / (2 * step) / count, abs=1e-6)


def test_probabilities_add_up_to_one():
    net = Network(Shape(10, 3, 4, 5), initial(Shape(10, 3, 4, 5)))
    prefix = net.scores([np.array([3, 12])])[0]
    assert sum(np.exp(net.scores([np.array([3, 12, n])])[0] - prefix) for n in range(14)) == pytest.approx(1, abs=1e-5)


def test_state_is_carried_over_windows_and_lanes(monkeypatch):
    random = np.random.default_rng(2)
    shape = Shape(20, 4, 6, 8)
    net = Network(shape, initial(shape))
    documents = [random.integers(0, 26, n).astype(np.int32) for n in (300, 1, 5, 70, 2, 64, 65, 200)]
    alone = [net.scores([d])[0] for d in documents]
    assert net.scores(documents) == pytest.approx(alone, rel=1e-4)
    monkeypatch.setattr(gru, "SCORE_STEPS", 7)
    assert net.scores(documents) == pytest.approx(alone, rel=1e-4)


def test_lanes_hold_every_token_once():
    documents = [np.arange(n, dtype=np.int32) for n in (5, 1, 9, 3)]
    lanes = lay_out(documents, 0, 2)
    for n, own in enumerate(documents):
        assert sorted(lanes.told[(lanes.document == n) & (lanes.told >= 0)]) == own.tolist()
    assert lanes.begins.sum() == 4


def test_training_learns_what_follows():
    shape = Shape(6, 2, 2, 8)
    net = Network(shape, initial(shape))
    documents = [np.array([1, 2, 3, 4, 5] * 20 + [0], np.int32) for _ in range(200)]
    before = net.scores(documents[:1])[0]
    adam = Adam(0.02)
    for _ in range(15):
        net.train(documents, adam)
    assert net.scores(documents[:1])[0] > before / 5
    assert (flat(unflat(shape, flat(net.w))) == flat(net.w)).all()


def words(text):
    return (text or "").encode().lower().split()


def test_words_and_tail_classes():
    texts = ["Ab \u00c0C\u2003d\x0b\x1ce\r\n f ", "", None, "  ", "a\x0cB a"]
    distinct, places, of = parted(pa.array(texts))
    for n, text in enumerate(texts):
        assert [distinct[p] for p in places[of == n]] == words(text)
    assert {tail_class(b) for b in range(256)} <= set(range(TAIL))


def test_the_head_grows_with_the_vocabulary():
    def of(distinct):
        frequent = [(b"w%d" % n, 50_000 - n) for n in range(min(distinct, 20_000))]
        tails = np.zeros((256, 2), np.int64)
        for word, n in frequent:
            tails[word[-1]] += n, 1
        return Vocabulary(10**9, distinct, 10, frequent, tails)

    small, large = of(5000), of(25_000_000)
    assert (small.shape.head, small.shape.classes, small.shape.hidden) == (2048, 16, 24)
    assert (large.shape.head, large.shape.classes) == (10_000, 79)
    assert small.tokens([b"w2000", b"w2047"]).tolist() == [2001, 2048 + tail_class(ord("7"))]
    assert len(large.frequencies) == 10_000 + TAIL


def rows_of(documents, apart):
    tokens = [[*words(t), None] for t in documents]
    counts = Counter(w for t, held in zip(tokens, apart, strict=True) if not held for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for own in tokens:
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        yield len(own), sum(counts[w] > 0 for w in own), total, base


@pytest.mark.parametrize("frequent", [100_000, 10])
def test_base_scores_equal_counting(odd_docs, monkeypatch, frequent):
    from matchstats.llm import language_model

    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    docs = odd_docs.selectExpr("doc_id", "text", "coalesce(doc_id % 5 = 2, false) AS held_out", "'x' AS word", "1 AS n")
    found = score(docs, docs.filter("NOT held_out")).collect()
    given = docs.collect()
    expected = rows_of([r.text for r in given], [r.held_out for r in given])
    wanted = sorted((str(r.doc_id), *e[:3], round(float(e[3]), 6)) for r, e in zip(given, expected, strict=True))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == wanted
    assert all(np.isfinite(r.score) and r.score <= 1e-6 for r in found)


def test_nothing_to_learn_from_or_score(odd_docs, no_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "true AS held_out")
    found = score(docs, no_docs).collect()
    assert len(found) == odd_docs.count() and all(r.n_known == 0 and r.base_score == 0 for r in found)
    assert score(no_docs.selectExpr("doc_id", "text", "true AS held_out"), odd_docs).count() == 0


def test_the_model_beats_the_base_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = op8_language_model(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in found)
    apart = [r for r in found if r.held_out]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)
    assert np.mean([r.score > r.base_score for r in apart]) > 0.9
