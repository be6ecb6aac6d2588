import random

import public_tokenizers

from matchstats.llm.bpe import BYTE_BPE, PieceEncoder
from matchstats.llm.token_counts import EDITS, counts, edits_of, trees

ENCODER = PieceEncoder(public_tokenizers.path(BYTE_BPE))


def whole(text):
    return len(ENCODER.tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_after_any_edits_equal_encoding_again():
    chosen = random.Random(3)
    parts = ["'", "'s", "re", "ve", "ll", "a", "é", " ", "  ", "\n", "\t", "1", "23", "!", "...", "日本", "x", "m", "😀", "l"]

    def text(most):
        return "".join(chosen.choice(parts) for _ in range(chosen.randint(0, most)))

    for _ in range(800):
        held = text(40)
        tree = next(trees([held], ENCODER))
        assert tree.n_tokens == whole(held)
        for _ in range(chosen.randint(1, 4)):
            start = chosen.randint(0, len(held))
            end = min(len(held), start + chosen.choice([0, 0, 1, 2, 5, 30]))
            new = text(6)
            tree.edit(start, end, new, ENCODER.split, ENCODER.count)
            held = held[:start] + new + held[end:]
            assert tree.text() == held and tree.n_tokens == whole(held)


def test_an_edit_encodes_little_of_a_long_text():
    held = "some words of a long text " * 5000
    tree = next(trees([held], ENCODER))
    tree.edit(60_000, 60_004, "other", ENCODER.split, ENCODER.count)
    assert tree.encoded < 12 and tree.n_tokens == whole(held[:60_000] + "other" + held[60_004:])


def test_edits():
    text = "write to a.b@c.org  now!!! or $$$ not.."
    assert edits_of(text) == [(9, 18, "<email>"), (19, 20, ""), (24, 26, ""), (31, 33, ""), (38, 39, "")]
    assert edits_of("a  b") == [(2, 3, "")] and edits_of("a.b") == edits_of("") == []


def test_rows(odd_docs, no_docs):
    found = counts(odd_docs, heading="source").collect()
    expected = []
    for row in odd_docs.select("doc_id", "text", "source").collect():
        text = row.text or ""
        edits = edits_of(text, EDITS)
        edited = text
        for start, end, new in reversed(edits):
            edited = edited[:start] + new + edited[end:]
        edited = edited if row.source is None else f"{row.source}\n{edited}"
        n_edits = len(edits) + (row.source is not None)
        expected.append((str(row.doc_id), whole(text), n_edits, whole(edited)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_edits, r.n_tokens_edited) for r in found) == sorted(expected)
    assert counts(no_docs).count() == 0
