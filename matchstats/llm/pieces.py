"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary is a SentencePiece model's with byte fallback.  Such a model stores merge ranks, no
probabilities; a piece's log probability is taken from its rank by Zipf's law, and a text's ids are
the likeliest sequence of pieces, of equal ones the one whose last pieces are longer.

The search goes through a text once.  It keeps scores for the next ``longest piece`` places only, and
back pointers since the last commit: when all paths that may still go on pass through one boundary,
the ids up to there are committed.  Where no piece can span two neighbouring characters that is at
once so; in longer runs the surviving paths are followed back to where they meet.  What lies between
two boundaries that all paths pass is encoded alike everywhere, so words are remembered:
the latest ones, and those that keep coming.

A space is written as U+2581, and one is put in front of a text.  Characters outside the vocabulary,
U+2581 itself among them, become the pieces of their bytes, so decoding gives every text exactly.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, release

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Stands for U+2581 in a text; no valid text holds a lone surrogate.
_OWN = "\ud800"
#: Zipf's law in Mandelbrot's form, and what a byte costs more than the rarest piece.
ZIPF_SHIFT, BYTE_COST = 2.7, 5.0
#: Scores are counted in millionths.
UNIT = 1_000_000
#: Words that a Python worker remembers, and the longest of them.
REMEMBERED, LONGEST_WORD = 250_000, 48

_NO_PATH = float("-inf")
_UNKNOWN = (-1, _NO_PATH)


class Pieces:
    """A vocabulary and the search over it."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.size = size
        self.bytes = [b""] * size
        self.byte_ids = [0] * 256
        normal = []
        for n in range(size):
            piece = model.id_to_piece(n)
            if model.is_byte(n):
                self.byte_ids[int(piece[1:-1], 16)] = n
                self.bytes[n] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(n) or model.is_unknown(n) or model.is_unused(n)):
                normal.append((n, piece))
                self.bytes[n] = piece.replace(SPACE, " ").encode()
        ranks = np.arange(1, len(normal) + 1) + ZIPF_SHIFT
        # whole numbers, so that equal sums are equal wherever a sum begins
        scores = np.rint(UNIT * (-np.log(ranks) - np.log((1 / ranks).sum()))).astype(int).tolist()
        self.byte_score = min(scores) - int(UNIT * BYTE_COST)
        self.longest = max(len(piece) for _, piece in normal)
        # every beginning of a piece: its id and score, or -1 where it is none itself
        self.prefixes: dict[str, tuple[int, float]] = {}
        for (n, piece), score in zip(normal, scores, strict=True):
            for end in range(1, len(piece)):
                self.prefixes.setdefault(piece[:end], (-1, _NO_PATH))
            self.prefixes[piece] = (n, score)
        # the same as a tree: of each character what may follow it, and the id and score up to it
        self.tree: dict[str, tuple[dict, int, float]] = {}
        inner: dict[str, dict] = {"": self.tree}
        for beginning in sorted(self.prefixes):  # shorter ones come before those they begin
            own = inner[beginning] = {}
            inner[beginning[:-1]][beginning[-1]] = (own, *self.prefixes[beginning])
        # words part before a space behind another character, which no piece spans
        self.parts = not any(SPACE in piece.lstrip(SPACE) for _, piece in normal)
        self.words = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.known = _Words(self)

    def _fallback(self, char: str) -> list[int]:
        raw = (SPACE if char == _OWN else char).encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of a text with spaces written as pieces write them, as they are committed."""
        get, longest, size = self.prefixes.get, self.longest, len(text)
        # places from the last commit on: best score, where the last piece starts, its id
        base, reach = 0, 0
        best, back, last = [0], [0], [0]
        for at in range(size):
            score = best[at - base]
            end = at
            while end < size and end - at < longest:
                end += 1
                found = get(text[at:end])
                if found is None:
                    end -= 1
                    break
                n, gain = found
                if n >= 0:
                    if end > reach:
                        best += [_NO_PATH] * (end - reach)
                        back += [0] * (end - reach)
                        last += [0] * (end - reach)
                        reach = end
                    if score + gain > best[end - base]:
                        best[end - base], back[end - base], last[end - base] = score + gain, at, n
            if get(text[at], _UNKNOWN)[0] < 0:
                if at + 1 > reach:
                    best.append(_NO_PATH), back.append(0), last.append(0)
                    reach = at + 1
                cost = self.byte_score * len(self._fallback(text[at]))
                if score + cost > best[at + 1 - base]:
                    best[at + 1 - base], back[at + 1 - base], last[at + 1 - base] = score + cost, at, -1
            meet = base
            if reach == at + 1:
                meet = reach
            elif at - base >= 4 * longest and not (at - base) % longest:
                alive = {p for p in range(at + 1, reach + 1) if best[p - base] > _NO_PATH}
                while len(alive) > 1:
                    furthest = max(alive)
                    alive.remove(furthest)
                    alive.add(back[furthest - base])
                meet = alive.pop()
            if meet > base:
                ids, place = [], meet
                while place > base:
                    n, start = last[place - base], back[place - base]
                    ids += [n] if n >= 0 else self._fallback(text[start])[::-1]
                    place = start
                yield ids[::-1]
                del best[: meet - base], back[: meet - base], last[: meet - base]
                base = meet

    def _search(self, word: str) -> list[int]:
        """What ``stream`` gives, for a word so short that it fits the window whole."""
        size = len(word)
        best, back, last = [0] + [_NO_PATH] * size, [0] * (size + 1), [-1] * (size + 1)
        for at, score in enumerate(best):
            if at == size:
                break
            end, inner, alone = at, self.tree, -1
            for char in word[at : at + self.longest]:
                found = inner.get(char)
                if found is None:
                    break
                inner, n, gain = found
                end += 1
                if n >= 0:
                    if end == at + 1:
                        alone = n
                    if score + gain > best[end]:
                        best[end], back[end], last[end] = score + gain, at, n
                if not inner:
                    break
            if alone < 0:
                total = score + self.byte_score * len(self._fallback(word[at]))
                if total > best[at + 1]:
                    best[at + 1], back[at + 1], last[at + 1] = total, at, -1
        ids, place = [], size
        while place:
            n, start = last[place], back[place]
            ids += [n] if n >= 0 else self._fallback(word[start])[::-1]
            place = start
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        ids = self._search(word) if len(word) <= LONGEST_WORD else [n for part in self.stream(word) for n in part]
        return array("I", ids).tobytes()

    def encoded(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for NULL and the empty text."""
        if not text:
            raw = b""
        elif not self.parts:
            raw = self._word_by_word([SPACE + text.replace(SPACE, _OWN).replace(" ", SPACE)])
        elif "  " in text or text[0] == " " or text[-1] == " ":
            raw = self._word_by_word(self.words(SPACE + text.replace(SPACE, _OWN).replace(" ", SPACE)))
        else:
            raw = b"".join(map(self.known.__getitem__, text.split(" ")))
        return np.frombuffer(raw, np.uint32)

    def _word_by_word(self, words: list[str]) -> bytes:
        known = self.known
        return b"".join([known[w[1:]] if w.rfind(SPACE) == 0 and _OWN not in w else self._word(w) for w in words])

    def encode(self, text: str | None) -> list[int]:
        return self.encoded(text).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids.  Control and unknown ids have none; bytes that are no text are replaced."""
        pieces = self.bytes
        return b"".join([pieces[n] for n in ids])[1:].decode("utf-8", "replace")


class _Words(dict):
    """Ids of words behind one space, as bytes.  Of those met last it holds some and, until these are
    too many, those before them, so frequent words are met again before they are dropped."""

    def __init__(self, model: Pieces) -> None:
        self.model, self.before = model, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.model._word(SPACE + word.replace(SPACE, _OWN))
        if len(word) < LONGEST_WORD:
            if len(self) >= REMEMBERED // 2:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.before = {}


@cache
def pieces(path: str | None = None) -> Pieces:
    """One vocabulary for each Python worker."""
    return Pieces(path or public_tokenizers.path(MODEL))


def encode(docs: DataFrame, text: str = TEXT, to: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` and the ids of its texts as an array of integers.

    One row per row; NULL and empty texts have an empty array; an empty table gives an empty table;
    equal texts get equal ids.  Other columns stay, but for one named like ``to``.
    """

    @F.arrow_udf("array<int>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _listed([pieces(path).encoded(t.as_py()) for t in texts])

    return docs.withColumn(to, of(F.col(text)))


def _listed(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)))


def decode(docs: DataFrame, ids: str = "ids", to: str = TEXT, path: str | None = None) -> DataFrame:
    """``docs`` and the texts of its ids; NULL for NULL, an empty text for no ids.  Other columns stay,
    but for one named like ``to``."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            texts = [pieces(path).decode(r.values.to_pylist()) if r.is_valid else None for r in rows]
            yield pa.array(texts, pa.string())

    return docs.withColumn(to, of(F.col(ids)))


def encode_checked(docs: DataFrame, text: str = TEXT, to: tuple[str, str] = ("ids", "exact"), path: str | None = None) -> DataFrame:
    """``docs`` with the ids of its texts, as in ``encode``, and whether decoding them gives the text (of
    NULL, an empty one), both in one pass."""

    @F.arrow_udf(f"struct<{to[0]}: array<int>, {to[1]}: boolean>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ids, exact = [], []
            for text in texts:
                own = text.as_py() or ""
                ids.append(pieces(path).encoded(own))
                exact.append(pieces(path).decode(ids[-1].tolist()) == own)
            yield pa.StructArray.from_arrays([_listed(ids), pa.array(exact)], list(to))
        pieces(path).known.forget()  # other stages run in this worker
        release()

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in to]
    found = docs.select(*kept, of(F.col(text)).alias("__llm_found"))
    return found.select(*kept, *[F.col(f"__llm_found.{c}").alias(c) for c in to])


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, n_bytes, decoded_crc32, exact`` for every row of ``docs``: the ids
    (checksum of them as little-endian unsigned 32-bit integers), how many of them are bytes, and
    the checksum of the decoded text and whether it is the row's.  Rows as in ``encode``; a NULL
    text is as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        first, last = min(model.byte_ids), max(model.byte_ids)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = model.encoded(text)
                decoded = model.decode(ids.tolist())
                n_bytes = int(((ids >= first) & (ids <= last)).sum())
                sums = zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(decoded.encode("utf-8", "surrogatepass"))
                rows.append((key, len(ids), sums[0], n_bytes, sums[1], decoded == text))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _COLUMNS)

    given = docs.select(F.col(ID).cast("long"), F.coalesce(F.col(TEXT), F.lit("")))
    return given.mapInArrow(run, ", ".join(f"{c} {'boolean' if c == 'exact' else 'long'}" for c in _COLUMNS))


_COLUMNS = ["doc_id", "n_tokens", "ids_crc32", "n_bytes", "decoded_crc32", "exact"]


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and what decoding them gives."""
    return digests(documents(spark, sf_dir))


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
SQL: dict[str, str] = {}
