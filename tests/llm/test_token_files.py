import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from matchstats.llm import token_files
from matchstats.llm.bpe import BYTE_BPE, PieceEncoder
from matchstats.session import scratch_folder

PATH = public_tokenizers.path(BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 1000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 2**32])
def test_segments_give_back_their_ids(size, top):
    ids = np.random.default_rng(size).integers(0, top, size, dtype=np.uint64).astype(np.uint32)
    segment = token_files.pack(ids)
    assert (token_files.unpack(segment) == ids).all()
    assert (token_files.unpack(segment, 1, 3) == ids[128:384]).all()


def test_outliers_are_exceptions():
    ids = np.full(1280, 7, np.uint32)
    ids[::500] = 2**32 - 1
    segment = token_files.pack(ids)
    assert (token_files.unpack(segment) == ids).all()
    assert len(segment) < 16 + 4 * 11 + 10 * 6 + 5 * 3 + 1


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        token_files.unpack(b"something else entirely")


def test_an_added_token_is_one_id(library):
    ids, sizes = PieceEncoder(PATH).encode(pa.array(["<|endoftext|>", "a <|endoftext|> b", "", "<|endoftext|> "]))
    assert sizes.tolist() == [1, 4, 0, 2] and (ids == 50256).sum() == 3
    assert ids[1:5].tolist() == library("a <|endoftext|> b")


@pytest.mark.parametrize("remembered", [0, 300, 5000, 1_500_000])
def test_encoder_equals_the_library(library, remembered):
    chosen = random.Random(5)
    parts = ["'s", "'", "a", "re", "é", " ", " ", "  ", "\n", "\t", "1", "!", "日本", "\x1c", "\x85", "😀", "<|endoftext|>", "<|endof", "text|>", "=" * 1500]
    texts = ["".join(chosen.choice(parts) for _ in range(chosen.randint(0, 25))) for _ in range(5000)]
    encoder = PieceEncoder(PATH, remembered=remembered)
    for at in range(0, 5000, 250):
        ids, sizes = encoder.encode(pa.array(texts[at : at + 250]))
        ends = np.cumsum(sizes)
        for text, end, size in zip(texts[at : at + 250], ends, sizes, strict=True):
            assert ids[end - size : end].tolist() == library(text), repr(text)


def test_files_hold_all_documents_in_order(spark, odd_docs, library):
    folder = scratch_folder(spark, "ids")
    token_files.write_ids(odd_docs, folder, parts=4)
    rows = [(r.doc_id, library(r.text) + [0]) for r in odd_docs.collect()]
    found = sorted(token_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    assert sorted((str(r.doc_id), list(r.ids)) for r in found) == sorted((str(k), ids) for k, ids in rows)
    place = 0
    for row in found:
        assert row.start == place
        place += len(row.ids)
    sums = {r.start: r for r in token_files.read_digests(spark, folder).collect()}
    for row in found:
        assert sums[row.start].n_tokens == len(row.ids)
        assert sums[row.start].ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())


def test_long_documents_fill_their_own_segments(spark, odd_docs, monkeypatch):
    folder = scratch_folder(spark, "ids")
    token_files.write_ids(odd_docs, folder, parts=1)
    segments = token_files.read_segments(spark, folder).select("first", "n_ids", "doc_ids", "lengths").collect()
    assert sum(len(s.doc_ids) for s in segments) == odd_docs.count()
    assert all(sum(s.lengths) == s.n_ids for s in segments)


def test_no_documents(spark, no_docs):
    folder = scratch_folder(spark, "ids")
    token_files.write_ids(no_docs, folder)
    assert token_files.read_digests(spark, folder).count() == 0
