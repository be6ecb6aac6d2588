"""Encoding texts in parts: each distinct pre-token, or word with its blank, is encoded once and remembered."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

_BLANK = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CROWDED = f"{_BLANK}{{3}}|  "
_BEHIND_BLANK = re.compile(r" \S(?:.*\S)?", re.DOTALL).fullmatch

BYTE_BPE = "byte_bpe_50k.json"
#: Pre-tokens that a process remembers, at some 40 bytes each.
REMEMBERED = 1_500_000
#: How many ids they may have on the average.
_IDS_EACH = 16
#: The longest of them, in bytes.
LONGEST = 1024
#: Pre-tokens that are hashed, or encoded by the library, at a time: both need much memory for each.
_PART = 1 << 16
#: For each place in a pre-token a random number that its byte is multiplied with; the last one is
#: for the length.  The sums are 64-bit hashes that two pre-tokens share with a chance of 2 ** -63.
_FACTORS = np.random.default_rng(20_240_613).integers(0, 1 << 64, LONGEST + 1, np.uint64) | np.uint64(1)


def _hashes(pieces: pa.StringArray, ahead: bytes = b"") -> np.ndarray:
    """Hashes of pre-tokens, each with some bytes ahead of it; 0 for one that is too long to be remembered."""
    found = np.zeros(len(pieces), np.uint64)
    head = sum(int(f) * n for f, n in zip(_FACTORS, ahead, strict=False)) % (1 << 64)
    for at in range(0, len(pieces), _PART):
        part = pieces.slice(at, _PART)
        offsets = np.frombuffer(part.buffers()[1], np.int32, len(part) + 1, 4 * part.offset)
        sizes = np.diff(offsets)
        data = part.buffers()[2]
        given = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        place = np.arange(len(given), dtype=np.int32) - np.repeat(offsets[:-1] - offsets[0], sizes) + len(ahead)
        # beyond the longest any factor will do: those hashes are not used
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(given * _FACTORS[np.minimum(place, LONGEST - 1)], dtype=np.uint64)])
        ends = offsets - offsets[0]
        hashes = sums[ends[1:]] - sums[ends[:-1]] + np.uint64(head) + (sizes + len(ahead)).astype(np.uint64) * _FACTORS[-1]
        found[at : at + len(part)] = np.where(sizes + len(ahead) > LONGEST, np.uint64(0), np.maximum(hashes, 1))
    return found


class PieceEncoder:
    """Encodes like the library's tokenizer, whose pre-tokens are encoded independently.

    Pre-tokens are remembered by their hashes, in arrays, up to a number of them; then those go that
    were not asked for since some went last.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.remembered = remembered
        # each character of a byte-level token stands for one byte
        tokens = sorted((n, len(t)) for t, n in self.tokenizer.get_vocab().items())
        self.bytes = np.array([size for _, size in tokens], np.int64)
        self.id_type = np.uint16 if len(tokens) <= 1 << 16 else np.uint32
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if any(token.lstrip or token.rstrip or token.single_word or token.normalized for token in added):
            raise ValueError("added tokens that depend on their surroundings")
        # the library takes the longest of them
        self.added = sorted((token.content for token in added), key=len, reverse=True)
        self.apart = regex.compile(f"({'|'.join(map(regex.escape, self.added))})").split if added else None
        self.few: dict[str, int] = {}
        # remembered hashes in order and the places of their ids
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.sizes, self.starts = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, self.id_type)
        self.asked = np.zeros(1024, bool)
        self.known = self.used = 0
        #: what is remembered for later calls: not what is too long for that
        self.settled = 0, 0

    def _evict(self) -> None:
        """Forget what was not asked for since this was done last, or half of what was, if that is much."""
        kept = self.asked[self.places]
        ids = self.sizes[self.places[kept]].sum()
        if kept.sum() > self.remembered // 2 or ids > _IDS_EACH * self.remembered // 2:
            kept &= np.arange(len(kept)) % 2 == 0
        self.keys, places = self.keys[kept], self.places[kept]
        sizes = self.sizes[places]
        self.ids = self._gathered(self.starts[places], sizes)
        self.sizes, self.starts = sizes, np.cumsum(sizes, dtype=np.int32) - sizes
        self.known, self.used = len(places), len(self.ids)
        self.places, self.asked = np.arange(self.known, dtype=np.int32), np.zeros(self.known, bool)

    def _gathered(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of some places, one after the other."""
        at = np.repeat(starts - np.cumsum(sizes, dtype=np.int32) + sizes, sizes)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at]

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pieces in the list, their numbers of ids, and the ids one after the other.  Pieces
        that start with a blank and have none at their ends are encoded as one text, which the library
        parts there too; where a piece's ids end follows from their bytes."""
        joined = [n for n, p in enumerate(pieces) if _BEHIND_BLANK(p)]
        ids = np.array(self._ids(["".join([pieces[n] for n in joined])])[0], np.uint32)
        ends = np.cumsum(np.array([len(pieces[n].encode()) for n in joined], np.int64))
        cuts = np.searchsorted(np.cumsum(self.bytes[ids]), ends, "right")
        apart = set(joined)
        others = [n for n in range(len(pieces)) if n not in apart]
        more = self._ids([pieces[n] for n in others])
        return (
            np.array(joined + others, np.int64),
            np.concatenate([np.diff(cuts, prepend=0), [len(x) for x in more]]).astype(np.int32),
            np.concatenate([ids, np.array([x for part in more for x in part], np.uint32)]),
        )

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """The places of pre-tokens that had none."""
        first = self.known
        for at in range(0, len(pieces), _PART):
            order, sizes, ids = self._encoded(pieces[at : at + _PART])
            known, used = self.known + len(sizes), self.used + len(ids)
            if known > len(self.sizes):
                self.sizes, self.starts, self.asked = (
                    np.concatenate([held, np.zeros(known - len(held) + known // 4, held.dtype)]) for held in (self.sizes, self.starts, self.asked)
                )
            if used > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(used - len(self.ids) + used // 4, self.id_type)])
            self.sizes[self.known + order] = sizes
            self.starts[self.known + order] = self.used + np.cumsum(sizes) - sizes
            self.ids[self.used : used] = ids
            self.known, self.used = known, used
        return np.arange(first, self.known, dtype=np.int32)

    def _placed(self, groups: list[tuple[pa.StringArray, bytes]]) -> list[np.ndarray]:
        """The place of each pre-token of some groups, each group with some bytes ahead of its pre-tokens.
        Places hold until the next call."""
        self.known, self.used = self.settled
        if len(self.keys) > self.remembered or self.used > _IDS_EACH * self.remembered:
            self._evict()
        hashes = np.concatenate([_hashes(pieces, ahead) for pieces, ahead in groups])
        keys, firsts, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), bool)
        if len(self.keys):
            there = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        found = np.zeros(len(keys), np.int32)
        found[there] = self.places[at[there]]
        missing = np.flatnonzero(~there & (keys != 0))
        found[missing] = self._learn(self._strings(groups, firsts[missing]))
        self.settled = self.known, self.used
        places = found[inverse]
        # those that are too long are encoded each time
        long = np.flatnonzero(hashes == 0)
        places[long] = self._learn(self._strings(groups, long))
        self.asked[found[keys != 0]] = True
        self.keys = np.insert(self.keys, at[missing], keys[missing])
        self.places = np.insert(self.places, at[missing], found[missing])
        ends = np.cumsum([len(pieces) for pieces, _ in groups])
        return np.split(places, ends[:-1])

    @staticmethod
    def _strings(groups: list[tuple[pa.StringArray, bytes]], chosen: np.ndarray) -> list[str]:
        """Chosen pre-tokens, in their order, by their places in all groups together."""
        first, found = 0, np.empty(len(chosen), object)
        for pieces, ahead in groups:
            own = np.flatnonzero((chosen >= first) & (chosen < first + len(pieces)))
            text = ahead.decode()
            found[own] = [text + piece for piece in pieces.take(pa.array(chosen[own] - first)).to_pylist()]
            first += len(pieces)
        return found.tolist()

    def count(self, pieces: list[str]) -> int:
        """The number of ids of a few pre-tokens."""
        new = [piece for piece in pieces if piece not in self.few]
        if new:
            if len(self.few) > self.remembered // 16:
                self.few, new = {}, pieces
            self.few.update(zip(new, map(len, self._ids(new)), strict=True))
        return sum(map(self.few.__getitem__, pieces))

    def counts(self, pieces: list[str]) -> np.ndarray:
        """The number of ids of each pre-token."""
        places = self._placed([(pa.array(pieces, pa.string()), b"")])[0]
        return self.sizes[places]

    def _parted(self, text: str) -> list[str]:
        """Pre-tokens of a text and, each for itself, the added tokens in it."""
        if self.apart is None:
            return self.split(text)
        found = []
        for n, part in enumerate(self.apart(text)):
            found += [part] if n % 2 else self.split(part)
        return found

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (none NULL), one after the other, and the number of ids of each.

        A pre-token has a blank in front at most, or is white space alone, so a text parts before
        every blank; but not within white space of three or two blanks, or that ends the text, nor
        within added tokens.  Texts with such are parted into pre-tokens.
        """
        crowded = pc.or_(pc.match_substring_regex(texts, _CROWDED), pc.ends_with(texts, " "))
        for token in self.added:
            crowded = pc.or_(crowded, pc.match_substring(texts, token))
        parted = pc.split_pattern(pc.if_else(crowded, "", texts), " ")
        sizes = np.diff(parted.offsets.to_numpy())
        coded = parted.flatten().dictionary_encode()
        apart = np.flatnonzero(crowded.to_numpy(zero_copy_only=False))
        cut = [self._parted(texts[n].as_py()) for n in apart.tolist()]
        others = pa.array([p for c in cut for p in c], pa.string())
        words, firsts, more = self._placed([(coded.dictionary, b" "), (pc.list_element(parted, 0), b""), (others, b"")])
        places = words[coded.indices.to_numpy()]
        places[np.cumsum(sizes) - sizes] = firsts
        if len(apart):
            # a crowded text has one place so far, that of the empty piece
            counts = np.array([len(c) for c in cut], np.int64)
            at = np.repeat((np.cumsum(sizes) - sizes)[apart] + 1, counts)
            places = np.insert(places, at, more)
            sizes[apart] += counts
        lengths = self.sizes[places]
        ids = self._gathered(self.starts[places], lengths)
        upto = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[np.cumsum(sizes)]
        return ids.astype(np.uint32), np.diff(np.concatenate([[0], upto]))


def slices(texts: pa.StringArray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``most`` bytes, of at least one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)) + 1
        upto = min(upto, len(texts))
        yield at, upto
        at = upto


@cache
def encoder(path: str | None = None) -> PieceEncoder:
    """One encoder for each Python worker."""
    return PieceEncoder(path or public_tokenizers.path(BYTE_BPE))
