import time
from collections import Counter
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from matchstats.llm import language
from matchstats.llm.language import op3_language_id, predict, train
from matchstats.llm.queries import registered

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SMALL = [
    ("the cat and the dog", "en"), ("the house of the king", "en"), ("le chat et le chien", "fr"),
    ("la maison du roi et de la reine", "fr"), ("der hund und die katze", "de"), (None, "en"), ("the", None), ("123 !!", "xx"),
]


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.createDataFrame(SMALL, "text string, lang string"))


def test_tables_hold_log_frequencies(model):
    assert model.langs == ["de", "en", "fr"]
    for lang in model.langs:
        words = Counter(w for t, of in SMALL if of == lang for w in (t or "").split())
        grams = {k: Counter() for k in range(1, language.LONGEST + 1)}
        for word, n in words.items():
            for k, found in grams.items():
                for i in range(len(word) + 3 - k):
                    found[f" {word} "[i : i + k]] += n
        column = model.langs.index(lang)
        for size, counts in {0: words, **grams}.items():
            total = sum(counts.values()) + 1
            for gram, row in model.tables[size].items():
                assert row[column] == pytest.approx(np.log((counts[gram] or 0.5) / total), abs=1e-5)


def test_unseen_words_back_off(model):
    def by_hand(word):
        padded, total = f" {word} ", np.zeros(3)
        for at in range(len(padded)):
            for size in range(min(language.LONGEST, len(padded) - at), 0, -1):
                if padded[at : at + size] in model.tables[size]:
                    total += model.tables[size][padded[at : at + size]] / size
                    break
        return total

    words = ["the", "chats", "unde", "zzz", "été", "chat"]
    for word, scores in zip(words, model.words(words), strict=True):
        assert scores == pytest.approx(model.tables[0][word] if word in ("the", "chat") else by_hand(word), abs=1e-4)


def test_predictions(model):
    texts = ["The dog!", "les chiens", None, "", "  \n", "123 !!", "x"]
    langs, scores = model.predict(pa.array(texts))
    assert langs[:2] == ["en", "fr"] and langs[2:6] == ["und"] * 4 and scores[2:6] == [0.0] * 4
    assert all(0 < s <= 1 for s in (*scores[:2], scores[6]))
    summed = model.words(["the", "dog"]).sum(axis=0)
    assert scores[0] == pytest.approx(1 / np.exp(summed - summed.max()).sum())


def test_words_are_runs_of_letters():
    distinct, places, of = language.parted(pa.array(["Été 2x, d'un_mot", None, "été", "¡!"]))
    assert [[distinct[p] for p in places[of == n]] for n in range(4)] == [["été", "x", "d", "un", "mot"], [], ["été"], []]


def test_odd_rows(spark, odd_docs, no_docs, model):
    found = predict(odd_docs, model)
    assert found.count() == odd_docs.count() and set(found.columns) == {*odd_docs.columns, "lang_pred", "score"}
    assert {r.lang_pred for r in found.filter("text IS NULL").collect()} == {"und"}
    assert predict(no_docs, model).count() == 0
    untaught = train(no_docs)
    assert {(r.lang_pred, r.score) for r in predict(odd_docs, untaught).collect()} == {("und", 0.0)}


def test_what_is_sent_does_not_change_results(spark, odd_docs):
    texts = [t for t, _ in SMALL] + ["The dog! zzz", "les chiens unde", "chatons", "x", "", "123", "könige " + "abthe" * 700]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string")
    labelled = spark.createDataFrame(SMALL, "text string, lang string")
    whole, cut = train(labelled), train(labelled, words=1, grams=2)
    assert whole.every is None and cut.every is not None and len(cut.tables[0]) < len(whole.tables[0])
    for given in (docs, odd_docs):
        wanted, found = (sorted(predict(given, m).select("text", "lang_pred", "score").collect(), key=str) for m in (whole, cut))
        assert len(found) == given.count()
        assert [r[:2] for r in found] == [r[:2] for r in wanted]
        assert [r.score for r in found] == pytest.approx([r.score for r in wanted], rel=1e-3, abs=1e-9)


def test_a_cut_count_is_not_unseen(spark):
    # "x" is common in "big" but beyond its cut; a single loan of it in "few" must not outweigh that
    rows = [(" ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26)} " * 20 for n in range(100)) + " xq" * 10, "big"), ("xq", "few")]
    model = train(spark.createDataFrame(rows, "text string, lang string"), words=5, grams=5)
    assert model.tables[0]["xq"][0] == pytest.approx(np.log(10 / 2011), abs=1e-5)


@pytest.mark.parametrize("cells", [language.CELLS, 1])
def test_every_language_can_be_predicted(spark, monkeypatch, cells):
    monkeypatch.setattr(language, "CELLS", cells)
    names = [chr(97 + n // 26) + chr(97 + n % 26) for n in range(230)]
    rows = [(f"q{name}w {name}zz", name) for name in names]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = predict(docs, train(docs)).collect()
    assert len(found) == 230 and all(r.lang_pred == r.lang for r in found)


def test_shuffle_files_go_with_the_job_that_wrote_them(spark, monkeypatch, tmp_path):
    docs = [(n, text, lang, "s", len(text or "")) for n, (text, lang) in enumerate(SMALL * 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    folders = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for folder in folders for f in folder.rglob("shuffle_*")}

    monkeypatch.setattr(language, "train", partial(language.train, words=1, grams=1))
    spark.conf.unset(CLEANUP)  # the tests' session has it
    before = files()
    query = registered()["op3_language_id"](spark, str(tmp_path))
    deadline = time.time() + 10
    while (left := files() - before) and time.time() < deadline:
        time.sleep(0.1)
    spark.conf.set(CLEANUP, "true")
    assert not left
    assert query.count() == len(docs)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op3_language_id(spark, sf_dir).join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 250 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
