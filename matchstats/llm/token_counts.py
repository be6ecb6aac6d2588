"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree whose nodes sum up characters and tokens.  An
edit finds the leaves it touches by descending the tree, splits and encodes that region anew with
some characters before it and as many pre-tokens behind it as it takes until a new boundary falls
on an old one, and updates the sums above.  Everything else keeps its counts: a pre-token depends
on the text from its start to at most ``LOOK`` characters beyond its end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.bpe import PieceEncoder, encoder
from matchstats.llm.common import ID, TEXT, documents

#: Characters behind a pre-token that may decide where it ends ('re, 've, 'll; runs of blanks).
LOOK = 2
#: Pre-tokens behind an edit that are first tried as context.
CONTEXT = 2
#: Characters that are encoded together, of as many documents.
TOGETHER = 1 << 20

Count = Callable[[list[str]], int]
Split = Callable[[str], list[str]]


class TokenTree:
    """Sums of characters and tokens over the pre-tokens of one text."""

    def __init__(self, pieces: list[str], tokens: np.ndarray) -> None:
        self.leaves: list[str | list[str]] = list(pieces)
        self.width = 1 << max(0, len(pieces) - 1).bit_length()
        self.chars = self._sums(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        self.tokens = self._sums(tokens)
        self.encoded = 0

    def _sums(self, values: np.ndarray) -> list[int]:
        levels = [np.concatenate([values, np.zeros(self.width - len(values), np.int64)])]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return np.concatenate([[0], *reversed(levels)]).tolist()

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self._text(n) for n in range(len(self.leaves)))

    def _text(self, leaf: int) -> str:
        held = self.leaves[leaf]
        return held if isinstance(held, str) else "".join(held)

    def _locate(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where that leaf starts; past the end, behind all."""
        if place >= self.chars[1]:
            return len(self.leaves), self.chars[1]
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def _set(self, leaf: int, held: str | list[str], tokens: int) -> None:
        chars = len(held) if isinstance(held, str) else sum(map(len, held))
        self.leaves[leaf] = held
        node = leaf + self.width
        chars -= self.chars[node]
        tokens -= self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, start: int, end: int, new: str, split: Split, count: Count) -> None:
        """Replace the characters from ``start`` to ``end`` (exclusive) by ``new``."""
        if not self.leaves:
            self.__init__([""], np.zeros(1, np.int64))
        total = self.chars[1]
        start, end = min(start, total), min(end, total)
        first, at = self._locate(max(0, start - 1 - LOOK))
        if first == len(self.leaves):
            first, at = len(self.leaves) - 1, total - len(self._text(len(self.leaves) - 1))
        last = max(first, self._locate(end)[0])  # the leaf behind the edit, or behind all
        old = [self._text(n) for n in range(first, min(last + 1, len(self.leaves)))]
        behind, more = len(old), CONTEXT
        while True:
            for n in range(first + behind, min(first + behind + more, len(self.leaves))):
                old.append(self._text(n))
            whole = first + len(old) >= len(self.leaves)
            behind, more = len(old), 2 * more
            body = "".join(old)
            body = body[: start - at] + new + body[end - at :]
            pieces = split(body)
            kept = self._meets(pieces, old, end - at, len(new) - (end - start), len(body), whole)
            if kept is not None:
                break
        fresh, leaves = kept
        # a match never spans leaves, so an edited region becomes one leaf of several pre-tokens
        self.encoded += fresh
        self._set(first, pieces[:fresh], count(pieces[:fresh]))
        for n in range(first + 1, first + leaves):
            self._set(n, "", 0)

    @staticmethod
    def _meets(
        pieces: list[str], old: list[str], end: int, shift: int, size: int, whole: bool
    ) -> tuple[int, int] | None:
        """How many new pieces stand for how many old leaves: up to the first place behind the edit
        that is a boundary of both."""
        olds, place = {}, 0
        for n, piece in enumerate(old, 1):
            place += len(piece)
            if place >= end:
                olds.setdefault(place + shift, n)
        place = 0
        if not whole and 0 in olds and size > LOOK:
            return 0, olds[0]
        for n, piece in enumerate(pieces, 1):
            place += len(piece)
            if place in olds and place + LOOK < size:
                return n, olds[place]
        return (len(pieces), len(old)) if whole else None


#: What the query edits: addresses go, runs of punctuation and of blanks shrink to one character.  Of a
#: rule without a replacement the first character stays.
EDITS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"),
    (r"[!?.*$%&#~]{2,}", None),
    (r"[ \t]{2,}", None),
)


@cache
def _pattern(rules: tuple) -> re.Pattern:
    return re.compile("|".join(f"({p})" for p, _ in rules))


def edits_of(text: str, rules: tuple[tuple[str, str | None], ...] = EDITS) -> list[tuple[int, int, str]]:
    """Places that the rules' expressions find, leftmost first and not overlapping, with their
    replacements."""
    if "@" not in text:
        rules = tuple(rule for rule in rules if "@" not in rule[0])
    found = []
    for match in _pattern(rules).finditer(text) if rules else ():
        new = rules[match.lastindex - 1][1]
        found.append((match.start() + (new is None), match.end(), new or ""))
    return found


def trees(texts: list[str], encode: PieceEncoder) -> Iterator[TokenTree]:
    """A tree for each text; the pre-tokens of all are counted at once."""
    cut = [encode.split(t) for t in texts]
    sizes = encode.counts([p for c in cut for p in c])
    ends = np.cumsum([len(c) for c in cut])
    for pieces, end in zip(cut, ends, strict=True):
        yield TokenTree(pieces, sizes[end - len(pieces) : end])


def counts(
    docs: DataFrame, rules: tuple[tuple[str, str | None], ...] = EDITS, heading: str | None = None, path: str | None = None
) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_edited, n_pretokens, n_reencoded`` for every row of ``docs``:
    its tokens before and after the rules' edits and, if ``heading`` names a column, after its value
    and a line break are put in front.

    NULL and empty texts have no tokens; a NULL heading is not put.  Repeated rows each have a row, an
    empty table gives no rows, other columns are not looked at.
    """
    head = F.col(heading).cast("string") if heading else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)

        for batch in batches:
            keys, texts, heads = (batch.column(n).to_pylist() for n in range(3))
            rows, at = [], 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and chars < TOGETHER:
                    chars += len(texts[upto])
                    upto += 1
                for n, tree in enumerate(trees(texts[at:upto], encode), at):
                    before, pieces = tree.n_tokens, len(tree.leaves)
                    edits = edits_of(texts[n], rules)
                    if heads[n] is not None:
                        edits.insert(0, (0, 0, f"{heads[n]}\n"))
                    for start, end, new in reversed(edits):  # places before an edit stay
                        tree.edit(start, end, new, encode.split, encode.count)
                    rows.append((keys[n], before, len(edits), tree.n_tokens, pieces, tree.encoded))
                at = upto
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _COLUMNS)

    given = docs.select(F.col(ID).cast("long"), F.coalesce(F.col(TEXT), F.lit("")), head)
    return given.mapInArrow(run, ", ".join(f"{c} long" for c in _COLUMNS))


_COLUMNS = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pretokens", "n_reencoded"]


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after cleaning edits and a heading with its source."""
    return counts(documents(spark, sf_dir), heading="source")


QUERIES = {"op4_token_counts": op4_token_counts}
SQL: dict[str, str] = {}
