import random

import pytest

from matchstats.llm.pieces import SPACE, decode, digests, encode, encode_checked, pieces

MODEL = pieces()


def whole(text):
    """The best path over the whole text at once."""
    if not text:
        return []
    written = SPACE + text.replace(SPACE, "\ud800").replace(" ", SPACE)
    best, back = [0] + [float("-inf")] * len(written), [None] * (len(written) + 1)
    for at in range(len(written)):
        for end in range(at + 1, min(len(written), at + MODEL.longest) + 1):
            n, gain = MODEL.prefixes.get(written[at:end], (-1, 0))
            if n >= 0 and best[at] + gain > best[end]:
                best[end], back[end] = best[at] + gain, (at, [n])
        if MODEL.prefixes.get(written[at], (-1, 0))[0] < 0:
            ids = MODEL._fallback(written[at])
            if best[at] + len(ids) * MODEL.byte_score > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + len(ids) * MODEL.byte_score, (at, ids)
    ids, place = [], len(written)
    while place:
        place, own = back[place]
        ids = own + ids
    return ids


@pytest.mark.parametrize("parted", [True, False])
def test_streaming_finds_the_best_path(monkeypatch, parted):
    monkeypatch.setattr(MODEL, "parts", parted)
    chosen = random.Random(1)
    parts = [*"abcdefghij \n\t.,éè日本▁😀$", "the", "tion", "  ", "    "]
    for _ in range(500):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randint(0, 60)))
        ids = MODEL.encode(text)
        assert ids == whole(text) and MODEL.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 1000, "abcdefgh" * 300, "=" * 500 + "-" * 300, " " * 200, "日" * 300])
def test_long_runs(text):
    ids = MODEL.encode(text)
    assert ids == whole(text) and MODEL.decode(ids) == text


def test_ids_are_committed_on_the_way():
    text = "▁" + "abcdefgh" * 2000
    seen, longest = 0, 0
    for part in MODEL.stream(text):
        seen += len(part)
        longest = max(longest, len(part))
    assert seen == len(MODEL.encode("abcdefgh" * 2000)) and longest < 100


def test_frequent_words_are_searched_once(monkeypatch):
    """The memory forgets rare words, not those that keep coming."""
    from matchstats.llm import pieces as module

    searched = []
    search = MODEL._search
    monkeypatch.setattr(MODEL, "_search", lambda word: searched.append(word) or search(word))
    monkeypatch.setattr(module, "REMEMBERED", 100)
    MODEL.known.clear()
    for n in range(1000):
        text = f"often w{n} again"
        assert MODEL.encode(text) == whole(text)
        assert len(MODEL.known) <= 100
    assert len(searched) < 1010


@pytest.mark.parametrize("text", ["a  b", " a", "a ", " ", "  ", "a ▁ b", "▁a b", "a ▁▁ b▁ ", "▁", "one\ntwo  three"])
def test_spaces_are_part_of_words(text):
    for _ in range(2):
        ids = MODEL.encode(text)
        assert ids == whole(text) and MODEL.decode(ids) == text


def test_about_as_many_ids_as_the_library(odd_docs):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [r.text for r in odd_docs.select("text").collect() if r.text]
    assert sum(len(MODEL.encode(t)) for t in texts) < 1.1 * sum(map(len, library.encode(texts, num_threads=1)))


def test_tables(odd_docs, no_docs):
    coded = encode(odd_docs)
    back = decode(coded, to="back").collect()
    assert len(back) == odd_docs.count()
    for row in back:
        assert row.back == (row.text or "") and row.ids == whole(row.text)
    assert decode(encode(odd_docs).selectExpr("CAST(NULL AS array<int>) AS ids")).filter("text IS NOT NULL").count() == 0
    found = digests(odd_docs).collect()
    assert len(found) == odd_docs.count() and all(r.exact for r in found)
    assert digests(no_docs).count() == 0 and encode(no_docs).count() == 0
    checked = encode_checked(odd_docs).collect()
    assert len(checked) == len(back) and all(r.exact and r.ids == whole(r.text) for r in checked)
